"""Substring dedup: words that repeat a run of words of an earlier document.

A difference cover D of a period v holds, for any two places i and j, an offset d < v with i + d and
j + d both in D modulo v. Hashing windows of ``window - v + 1`` words only at places in D therefore
leaves no run of ``window`` equal words without an anchor that both copies share. Only windows around
an anchor that occurs in a second document are hashed in full and traced to the smallest doc_id.

Steps, each a shuffle of packed rows: anchors to buckets and back (``repeats``); documents by block
with the anchors that repeat, extended to whole windows; windows to buckets, one line for each block
that holds one; documents by block again (Spark reuses their shuffle) with the smallest doc_id.

Defined results: NULL text has no words. A row with NULL doc_id neither removes words nor loses any.
Rows with equal doc_id do not remove each other's words. An empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import repeats
from riskframe.llm import text as T

# Perfect difference sets by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

ENTRIES = "bucket int, blk int, keys binary, extras binary, docs binary, several binary"
ORIGINS = "blk int, keys binary, extras binary, docs binary"
RESULT = "doc_id long, text string, n_words long, n_removed long"
NO_DOC = np.iinfo(np.int64).max


def period_for(window: int) -> int:
    """Largest known period whose anchors keep at least half of the window's words."""
    return max(v for v in COVERS if window - v + 1 >= (window + 1) // 2)


def pack(ids: np.ndarray) -> bytes:
    """Integers in four bytes each where they fit."""
    small = len(ids) and ids.min() >= 0 and ids.max() < 1 << 32
    return (ids.astype(np.uint32) if small else ids.astype(np.int64)).tobytes()


def unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if len(raw) == 4 * n else np.int64).astype(np.int64)


class Origins:
    """Smallest doc_id of each repeated window told to a block."""

    def __init__(self, rows: list[dict]):
        join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows]) if rows else np.zeros(0, kind)
        keys, extras = join("keys", np.uint64), join("extras", np.uint32)
        docs = np.concatenate([unpack(r["docs"], len(r["extras"]) // 4) for r in rows]) if rows else np.zeros(0, np.int64)
        order = np.lexsort((extras, keys))
        self.keys, self.extras, self.docs = keys[order], extras[order], docs[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys & np.uint64((1 << 20) - 1)] = True

    def smallest(self, keys: np.ndarray, extras: np.ndarray) -> np.ndarray:
        """Smallest doc_id of each window, NO_DOC where none was told."""
        out = np.full(len(keys), NO_DOC)
        some = np.flatnonzero(self.maybe[keys & np.uint64((1 << 20) - 1)])
        keys, extras = keys[some], extras[some]
        at = np.searchsorted(self.keys, keys)
        while len(some):  # equal keys with other extras are all but unknown
            inside = at < len(self.keys)
            some, at, keys, extras = some[inside], at[inside], keys[inside], extras[inside]
            same = self.keys[at] == keys
            some, at, keys, extras = some[same], at[same], keys[same], extras[same]
            hit = self.extras[at] == extras
            out[some[hit]] = self.docs[at[hit]]
            some, at, keys, extras = some[~hit], at[~hit] + 1, keys[~hit], extras[~hit]
        return out


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, text, n_words, n_removed): texts without the words of any ``window`` consecutive words
    that also start in a document with a smaller doc_id; kept words are joined by one space.

    Windows are judged on the input, not on what is left.
    """
    period = period_for(window)
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True
    gram = window - period + 1
    spark = docs.sparkSession
    buckets = repeats.block_count(spark)
    rows = repeats.in_blocks(docs, buckets)

    def words_of(data: np.ndarray, offsets: np.ndarray):
        starts, ends, first = T.word_spans(data, offsets)
        return T.word_hashes(data, starts, ends), first

    def anchors(words: np.ndarray, first: np.ndarray):
        at, owner = T.gram_starts(first, gram)
        chosen = cover[(at - first[owner]) % period]
        at, owner = at[chosen], owner[chosen]
        return at, owner, T.gram_hashes(words, gram)[at]

    def find(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for low, _, data, offsets in T.sliced(batch.column("text")):
            words, first = words_of(data, offsets)
            _, owner, hashes = anchors(words, first)
            own = known[owner + low]
            yield hashes[own], owner[own] + low

    def extend(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        live, _ = repeats.told_ids(right)
        doc_ids = left.column("doc_id").to_numpy()
        known = ~left.column("doc_id").is_null().to_numpy()
        found = []
        for low, _, data, offsets in T.sliced(left.column("text")) if len(live) else ():
            words, first = words_of(data, offsets)
            at, owner, hashes = anchors(words, first)
            hit = T.member(repeats.ids_of(hashes, buckets), live) & known[owner + low]
            near = T.covered(len(words) + period, at[hit], period)  # shifted: windows begin up to period - 1 words earlier
            start, owner = T.gram_starts(first, window)
            chosen = near[start + period - 1]
            start, owner = start[chosen], owner[chosen]
            keys = T.gram_hashes(words, window)[start]
            extras = T.gram_hashes(words, window, T.MULTIPLIERS[1])[start].astype(np.uint32)
            found.append((keys, extras, doc_ids[owner + low].astype(np.int64)))
        out = {x.split()[0]: [] for x in ENTRIES.split(", ")}
        if found:
            keys, extras, docs_ = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((docs_, extras, keys))
            keys, extras, docs_ = keys[order], extras[order], docs_[order]
            new = np.r_[True, (keys[1:] != keys[:-1]) | (extras[1:] != extras[:-1])] if len(keys) else np.zeros(0, bool)
            first_of = np.flatnonzero(new)
            last_of = np.r_[first_of[1:], len(keys)] - 1 if len(keys) else first_of
            several = docs_[last_of] > docs_[first_of]
            parts = repeats.split_by(((keys[first_of] >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64), keys[first_of], extras[first_of], docs_[first_of], several)
            for bucket, (k, e, d, s) in parts:
                for name, x in zip(out, (bucket, key[0].as_py(), k.tobytes(), e.tobytes(), pack(d), np.packbits(s).tobytes())):
                    out[name].append(x)
        return pa.table([pa.array(v, pa.int32() if n in ("bucket", "blk") else pa.binary()) for n, v in out.items()], names=list(out))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [r for b in batches for r in b.to_pylist()]
        sizes = [len(r["extras"]) // 4 for r in entries]
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in entries])
        extras = np.concatenate([np.frombuffer(r["extras"], np.uint32) for r in entries])
        ids = np.concatenate([unpack(r["docs"], n) for r, n in zip(entries, sizes)])
        several = np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8))[:n] for r, n in zip(entries, sizes)]).astype(bool)
        blks = np.repeat(np.array([r["blk"] for r in entries], np.int32), sizes)
        order = np.lexsort((ids, extras, keys))
        keys, extras, ids, several, blks = (x[order] for x in (keys, extras, ids, several, blks))
        new = np.r_[True, (keys[1:] != keys[:-1]) | (extras[1:] != extras[:-1])]
        smallest = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        ask = several | (ids > smallest)
        for blk, (k, e, m) in repeats.split_by(blks[ask], keys[ask], extras[ask], smallest[ask]):
            yield pa.RecordBatch.from_pydict({"blk": pa.array([blk], pa.int32()), "keys": [k.tobytes()], "extras": [e.tobytes()], "docs": [pack(m)]})

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        origins = Origins(right.to_pylist())
        doc_ids = left.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
        texts, n_words, n_removed = [], [], []
        for low, high, data, offsets in T.sliced(left.column("text")):
            words, first = words_of(data, offsets)
            gone = np.zeros(len(words), bool)
            if len(origins.keys):
                start, owner = T.gram_starts(first, window)
                smallest = origins.smallest(
                    T.gram_hashes(words, window)[start], T.gram_hashes(words, window, T.MULTIPLIERS[1])[start].astype(np.uint32)
                )
                gone = T.covered(len(words), start[smallest < doc_ids[owner + low]], window)
            raw = data.tobytes()
            for i in range(high - low):
                own = raw[offsets[i] : offsets[i + 1]].split()
                lost = gone[first[i] : first[i + 1]]
                n = int(lost.sum())
                texts.append(b" ".join([w for w, x in zip(own, lost.tolist()) if not x] if n else own))
                n_words.append(len(own))
                n_removed.append(n)
        return pa.table({
            "doc_id": left.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
        })

    live = repeats.repeated(rows, find, buckets)
    by_block = rows.groupBy("blk")
    entries = by_block.cogroup(live.groupBy("blk")).applyInArrow(extend, ENTRIES)
    origins = entries.groupBy("bucket").applyInArrow(trace, ORIGINS)
    return by_block.cogroup(origins.groupBy("blk")).applyInArrow(cut, RESULT)


def kept_digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))
