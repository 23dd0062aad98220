"""Suffix-array dedup: bytes inside strings of ``length`` bytes that start more than once.

The collection is too large for one suffix array, so it is parted by content first. Every string of
``length`` bytes has a minimizer: the leftmost of its k-grams with the smallest hash. Equal strings
have equal minimizers, so the strings around one minimizer form a collection of their own, and a
bucket of minimizers is a collection whose suffix array one task builds:

* Column-wise construction over many documents: each round takes one symbol of every document, from
  its end to its beginning, and inserts the suffixes that begin there into the order of those already
  in it. The place of a new suffix follows from its symbol and the place of the suffix it extends, as
  in the backward step over a Burrows-Wheeler transform. A symbol is ``STEP`` bytes, and each document
  is read in ``STEP`` phases, so that ``length`` bytes are ``length / STEP`` symbols.
* Common prefixes of neighbours in the order, of ``length / STEP`` symbols or more, mark strings that
  start more than once. Symbols are ranked exactly, so there are no false matches here.

What keeps the collections small: a minimizer of a shorter window lies in every 95 bytes, and a string
is a candidate only if all of those inside it occur twice (see ``repeats``). Equal surroundings are
merged before the construction. Minimizers that occur ``HOT`` times or more would make a collection that
grows with the input; their strings are compared by a hash of 96 bits instead, one line for each block
that holds one, so that no group is cut short and none fills a task. Documents are shuffled once and
read twice, and there is no state besides Spark's shuffles.

Defined results: NULL text is empty, with nothing removed. Rows with equal (doc_id, text) are separate
rows whose strings repeat. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import repeats
from riskframe.llm import text as T

GRAM = 32
FINE = 64
STEP = 16
HOT = 256
COLLECTION_BYTES = 1 << 19
PLACE = np.uint64((1 << 32) - 1)

CONTEXTS = "bucket int, blk int, keys binary, rids binary, starts binary, sizes binary, bytes binary, extras binary, several binary"
MARKS = "blk int, rids binary, starts binary, ends binary, keys binary, extras binary"
RESULT = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>"


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values (blocks of running minima from both sides)."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    full = -(-len(h) // width) * width
    x = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    x[: len(h)] = h
    x = x.reshape(-1, width)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Grams:
    """k-gram hashes of a slice, and the minimizers of its windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets, self.n = offsets, len(data)
        self.prefix = T.prefix_hash(data)
        at = np.arange(max(0, self.n - GRAM + 1))
        self.hashes = T.span_hash(self.prefix, at, at + GRAM)
        # Half a hash and the place behind it: the leftmost of equal ones is the smallest.
        self.ranked = (self.hashes & ~PLACE) | at.astype(np.uint64)

    def starts(self, length: int) -> np.ndarray:
        """Places at which ``length`` bytes of one document begin."""
        return T.gram_starts(self.offsets, length)[0]

    def minimizers(self, length: int) -> np.ndarray:
        """Place of the minimizer of the ``length`` bytes from each place on (crossing documents too)."""
        return (window_minima(self.ranked, length - GRAM + 1) & PLACE).astype(np.int64)


def shared_strings(contexts: list[bytes], twice: np.ndarray, length: int) -> list[np.ndarray]:
    """For each of some different documents, True at the starts of strings of ``length`` bytes that also
    start elsewhere in the collection; in documents marked ``twice`` all do.

    Column-wise construction: see the module.
    """
    sizes = np.array([len(c) for c in contexts])
    base = np.r_[0, np.cumsum(sizes)]
    data = np.frombuffer(b"".join(contexts) + bytes(STEP), np.uint8)
    n = int(base[-1])
    # Symbols: exact ranks of the STEP bytes from each place on, by halves of eight bytes.
    half = np.zeros(n + STEP, np.uint64)
    for j in range(8):
        half[: n + STEP - j] = (half[: n + STEP - j] << np.uint64(8)) | data[j:].astype(np.uint64)[: n + STEP - j]
    _, rank = np.unique(half, return_inverse=True)
    _, symbol = np.unique(rank[:n].astype(np.int64) << 32 | rank[8 : n + 8], return_inverse=True)
    symbol = symbol.astype(np.int64)

    # One sequence for each document and phase; its last symbol begins STEP bytes before the end or earlier.
    phases = np.minimum(STEP, np.maximum(sizes - STEP + 1, 0))
    of = np.repeat(np.arange(len(sizes)), phases)
    phase = np.arange(len(of)) - np.repeat(np.cumsum(phases) - phases, phases)
    column = base[of + 1] - STEP - phase
    begin = base[of]
    ends = len(of)  # the empty suffixes come first in the order
    tail = np.arange(ends)
    wide = np.int64(1) << 32
    keys = np.zeros(0, np.int64)  # symbol and place of the rest of each suffix, in order
    place = np.zeros(0, np.int64)  # where it begins
    active = np.arange(ends)
    while len(active):
        new = symbol[column[active]] * wide + tail[active]
        order = np.argsort(new, kind="stable")
        new, active = new[order], active[order]
        at = np.searchsorted(keys, new)
        # Rests move behind the suffixes that are inserted before them.
        moved = np.cumsum(np.bincount(at, minlength=len(keys) + 1))
        shift = np.r_[np.zeros(ends, np.int64), moved]
        keys = np.insert(keys + shift[keys & (wide - 1)], at, new + shift[new & (wide - 1)])
        place = np.insert(place, at, column[active])
        tail[active] = ends + at + np.arange(len(at))
        column[active] -= STEP
        active = active[column[active] >= begin[active]]

    # Neighbours with a common prefix of length / STEP symbols.
    owner_end = np.repeat(base[1:], sizes)
    left, right = place[:-1], place[1:]
    near = np.flatnonzero((owner_end[left] - left >= length) & (owner_end[right] - right >= length))
    for j in range(length // STEP):
        near = near[symbol[left[near] + j * STEP] == symbol[right[near] + j * STEP]]
    found = np.zeros(n, bool)
    found[left[near]] = found[right[near]] = True
    out = []
    for i, size in enumerate(sizes):
        own = found[base[i] : base[i] + max(0, size - length + 1)]
        out.append(np.ones(len(own), bool) if twice[i] else own)
    return out


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    change = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return np.flatnonzero(change > 0), np.flatnonzero(change < 0)


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, spans): UTF-8 texts without every byte covered by a
    string of ``length`` bytes that also starts anywhere else, the same document included.

    Overlaps count; strings are judged on the input, not on what is left, and never cross documents.
    """
    fine = FINE + GRAM - 1
    if length < fine or length % STEP:
        raise ValueError(f"length must be a multiple of {STEP} and {fine} at least")
    buckets = repeats.block_count(docs.sparkSession)
    rows = repeats.in_blocks(docs, buckets)

    def find(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for low, _, data, offsets in T.sliced(batch.column("text")):
            grams = Grams(data, offsets)
            starts, owner = T.gram_starts(offsets, fine)
            at = grams.minimizers(fine)[starts]
            new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
            yield grams.hashes[at[new]], owner[new] + low

    def candidates(data: np.ndarray, offsets: np.ndarray, live: np.ndarray, hot: np.ndarray):
        """Starts of strings whose inner minimizers all repeat, the minimizer of each, and whether it is hot."""
        grams = Grams(data, offsets)
        starts = grams.starts(fine)
        at = grams.minimizers(fine)
        inner = np.unique(at[starts])
        ids = repeats.ids_of(grams.hashes[inner], buckets)
        alive = T.member(ids, live)
        # A start is good if the minimizers of all shorter windows inside it repeat.
        good = np.zeros(grams.n, bool)
        good[inner[alive]] = True
        bad = np.zeros(grams.n + 1, np.int64)
        bad[1:][starts] = ~good[at[starts]]
        bad = np.cumsum(bad)
        whole = grams.starts(length)
        whole = whole[bad[whole + length - fine + 1] == bad[whole]]
        key = grams.minimizers(length)[whole] if len(whole) else whole
        is_hot = np.zeros(grams.n, bool)
        is_hot[inner[T.member(ids, hot)]] = True
        return grams, whole, key, is_hot[key]

    def collect(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        live, hot = repeats.told_ids(right)
        rids = left.column("rid").to_numpy()
        cold: dict[int, list[tuple]] = defaultdict(list)
        warm = []
        for low, _, data, offsets in T.sliced(left.column("text")) if len(live) else ():
            grams, whole, anchor, is_hot = candidates(data, offsets, live, hot)
            some = whole[is_hot]
            if len(some):
                second = T.prefix_hash(data, T.MULTIPLIERS[1])
                extras = T.span_hash(second, some, some + length, T.MULTIPLIERS[1]).astype(np.uint32)
                warm.append((T.span_hash(grams.prefix, some, some + length), extras))
            whole, anchor = whole[~is_hot], anchor[~is_hot]
            if not len(whole):
                continue
            cuts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)])
            first, last = whole[cuts], whole[np.r_[cuts[1:], len(whole)] - 1]
            hashes = grams.hashes[anchor[cuts]]
            owner = np.searchsorted(offsets, first, side="right") - 1
            raw = data.tobytes()
            home = (hashes >> np.uint64(33)) % np.uint64(buckets)
            for b, h, i, s, e in zip(home.tolist(), hashes.tolist(), owner.tolist(), first.tolist(), (last + length).tolist()):
                cold[b].append((h, int(rids[low + i]), s - int(offsets[i]), raw[s:e]))
        out = {x.split()[0]: [] for x in CONTEXTS.split(", ")}
        blk = key[0].as_py()
        pack = zstandard.ZstdCompressor(level=1)
        for b, found in cold.items():
            found.sort(key=lambda x: x[3])  # equal surroundings lie together and compress away
            h, r, s, c = zip(*found)
            values = (b, blk, np.array(h, np.uint64).tobytes(), np.array(r, np.int64).tobytes(), np.array(s, np.int64).tobytes(), np.array([len(x) for x in c], np.int32).tobytes(), pack.compress(b"".join(c)), None, None)
            for name, x in zip(out, values):
                out[name].append(x)
        if warm:
            keys, extras = (np.concatenate(x) for x in zip(*warm))
            order = np.lexsort((extras, keys))
            keys, extras = keys[order], extras[order]
            new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (extras[1:] != extras[:-1])])
            several = np.diff(np.r_[new, len(keys)]) > 1
            for b, (k, e, s) in repeats.split_by(((keys[new] >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), keys[new], extras[new], several):
                for name, x in zip(out, (b, blk, k.tobytes(), None, None, None, None, e.tobytes(), np.packbits(s).tobytes())):
                    out[name].append(x)
        return pa.table([pa.array(v, pa.int32() if n in ("bucket", "blk") else pa.binary()) for n, v in out.items()], names=list(out))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [r for b in batches for r in b.to_pylist()]
        marks: dict[int, list[np.ndarray]] = defaultdict(list)
        groups: dict[int, dict[bytes, list[tuple[int, int, int]]]] = defaultdict(lambda: defaultdict(list))
        unpack = zstandard.ZstdDecompressor()
        for r in entries:
            if r["bytes"] is None:
                continue
            h, rid, start = (np.frombuffer(r[k], kind).tolist() for k, kind in (("keys", np.uint64), ("rids", np.int64), ("starts", np.int64)))
            ends = np.cumsum(np.frombuffer(r["sizes"], np.int32)).tolist()
            raw, low = unpack.decompress(r["bytes"]), 0
            for key, x, s, e in zip(h, rid, start, ends):
                groups[key][raw[low:e]].append((r["blk"], x, s))
                low = e

        def note(context: bytes, shared: np.ndarray, places: list[tuple[int, int, int]]) -> None:
            low, high = spans_of(T.covered(len(context), np.flatnonzero(shared), length))
            for blk, rid, start in places:
                marks[blk].append(np.stack([np.full(len(low), rid), low + start, high + start]))

        waiting, size = [], 0
        def construct() -> None:
            contexts = [c for c, _ in waiting]
            twice = np.array([len(p) > 1 for _, p in waiting])
            for (c, places), shared in zip(waiting, shared_strings(contexts, twice, length)):
                if shared.any():
                    note(c, shared, places)

        for same in groups.values():
            if len(same) == 1:  # one text in one or more places: nothing to order
                (context, places), = same.items()
                if len(places) > 1:
                    note(context, np.ones(len(context) - length + 1, bool), places)
                continue
            waiting += same.items()
            size += sum(map(len, same))
            if size >= COLLECTION_BYTES:
                construct()
                waiting, size = [], 0
        if waiting:
            construct()
        kinds = (pa.int32(), *[pa.binary()] * 5)
        names = [x.split()[0] for x in MARKS.split(", ")]
        for blk, found in marks.items():
            m = np.concatenate(found, axis=1)
            values = (blk, m[0].tobytes(), m[1].tobytes(), m[2].tobytes(), None, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        warm = [r for r in entries if r["bytes"] is None]
        if warm:
            keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in warm])
            extras = np.concatenate([np.frombuffer(r["extras"], np.uint32) for r in warm])
            sizes = [len(r["extras"]) // 4 for r in warm]
            several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8))[:n] for r, n in zip(warm, sizes)]).astype(np.int64)
            blks = np.repeat(np.array([r["blk"] for r in warm], np.int32), sizes)
            order = np.lexsort((extras, keys))
            keys, extras, several, blks = (x[order] for x in (keys, extras, several, blks))
            new = np.r_[True, (keys[1:] != keys[:-1]) | (extras[1:] != extras[:-1])]
            cuts = np.flatnonzero(new)
            shared = (np.add.reduceat(several + 1, cuts) > 1)[np.cumsum(new) - 1]
            for blk, (k, e) in repeats.split_by(blks[shared], keys[shared], extras[shared]):
                values = (blk, None, None, None, k.tobytes(), e.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], x) for v, x in zip(values, kinds)], names)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        told = right.to_pylist()
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for r in told:
            if r["rids"]:
                for rid, s, e in zip(*(np.frombuffer(r[k], np.int64).tolist() for k in ("rids", "starts", "ends"))):
                    spans[rid].append((s, e))
        warm = [r for r in told if r["keys"]]
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in warm]) if warm else np.zeros(0, np.uint64)
        extras = np.concatenate([np.frombuffer(r["extras"], np.uint32) for r in warm]) if warm else np.zeros(0, np.uint32)
        maybe = np.zeros(1 << 20, bool)
        maybe[keys & np.uint64((1 << 20) - 1)] = True
        exact = np.unique(np.stack([keys, extras.astype(np.uint64)], axis=1), axis=0) if warm else np.zeros((0, 2), np.uint64)
        exact = exact.astype(">u8").tobytes()
        exact = np.frombuffer(exact, "S16") if exact else np.zeros(0, "S16")
        rids = left.column("rid").to_numpy()
        out: dict[str, list] = defaultdict(list)
        for low, high, data, offsets in T.sliced(left.column("text")):
            gone = np.zeros(len(data), bool)
            if warm:
                starts, _ = T.gram_starts(offsets, length)
                h = T.span_hash(T.prefix_hash(data), starts, starts + length)
                some = maybe[h & np.uint64((1 << 20) - 1)]
                starts, h = starts[some], h[some]
                e = T.span_hash(T.prefix_hash(data, T.MULTIPLIERS[1]), starts, starts + length, T.MULTIPLIERS[1]).astype(np.uint32)
                asked = np.frombuffer(np.stack([h, e.astype(np.uint64)], axis=1).astype(">u8").tobytes(), "S16") if len(h) else exact[:0]
                gone = T.covered(len(data), starts[T.member(asked, exact)], length)
            for i in range(low, high):
                a, b = int(offsets[i - low]), int(offsets[i - low + 1])
                own = gone[a:b]
                for s, e in spans.get(int(rids[i]), ()):
                    own[s:e] = True
                n = int(own.sum())
                first, last = spans_of(own) if n else ((), ())
                out["kept"].append(data[a:b][~own].tobytes() if n else data[a:b].tobytes())
                out["n_bytes"].append(b - a)
                out["n_removed"].append(n)
                out["n_spans"].append(len(first))
                out["spans"].append([{"start": int(s), "end": int(e)} for s, e in zip(first, last)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = {"kept": pa.binary(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "spans": span}
        return pa.table({"doc_id": left.column("doc_id")} | {k: pa.array(out[k], kind) for k, kind in kinds.items()})

    by_block = rows.groupBy("blk")
    live = repeats.repeated(rows, find, buckets, hot=HOT, within=True)
    contexts = by_block.cogroup(live.groupBy("blk")).applyInArrow(collect, CONTEXTS)
    marks = contexts.groupBy("bucket").applyInArrow(build, MARKS)
    return by_block.cogroup(marks.groupBy("blk")).applyInArrow(cut, RESULT)


def kept_digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
