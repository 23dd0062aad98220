"""N-gram Jaccard join: documents linked by their sets of word n-grams, with adaptive multi-match prefixes.

All sets are put into one order, rare n-grams first. If two sets overlap by ``least`` of either size, then prefixes
of n - ceil(least * n) + l elements share l elements at least: a longer prefix costs more index entries but asks
for more shared ones before a pair is compared. Each document takes the l (one of ``MATCHES`` as a share of its
size) with the least estimated cost, from the frequencies of its own n-grams; a pair must share the smaller l
of the two. Frequencies come from a sketch over all documents (``COUNTERS`` numbers, whatever the size): they only
set order and l.

What follows loses no link between different texts and yet never lists the pairs of a group:

1. Prefix elements that occur in no other prefix are dead (see ``repeats``); another set may still hold them behind its
   prefix. A document with fewer others than any set linked with it could ask for ends here, and most do.
2. Equal sets become one class, whose id is a hash of the set. Classes stand for their documents from here on.
3. Each class is compared with the class of fewest dead elements under its prefix elements (a few per class), which
   joins large groups of near copies into components by links to their least altered member.
4. Elements whose classes are in different components are joined in full, across components only: pairs that share
   enough of them are compared. What two sets share lies in both prefixes or behind the prefix that ends first in the
   one order, so a pair must also share what a link needs beyond the elements there (see ``asked_of``). Pairs inside a
   component are not needed to know the component. Most pairs have been compared with the same class, their hub, and
   share no more inside it than the smaller of their two overlaps with it. Where that is too little for a link, they must
   share elements outside the hub: such pairs are found by those elements alone, all of them and not just a prefix. So a
   group of near copies does not meet every text that just failed to be linked with its hub.
5. Components of all links: stars are merged until nothing changes, each step a table in the shared folder.

Texts are compared in blocks of documents; the hub of a pair is sent to the block of the other, so a hub with a
third of all rows is sent once to each block and its partners stay spread.

Words are runs of non-white characters with A-Z in lower case; fewer than n words are one n-gram, none make an empty
set that is linked with nothing. Defined results: NULL text has no words; a row with NULL doc_id is linked with nothing
and has no component; rows that share a doc_id are judged each by its text. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import repeats, scratch
from riskframe.llm import text as T

COUNTERS = 1 << 20
SLICES = 16
MATCHES = (0.02, 0.05, 0.1, 0.15)
# Of a candidate, in index entries; and the share of entries taken to repeat that the sketch cannot see.
COMPARE_COST, UNSEEN = 20.0, 0.15
HUBS = 3

SETS = "doc_id long, n_shingles long, sig_a long, sig_b long, matches int, prefix int, last long, tokens array<long>, text binary"


def overlap_of(sizes: np.ndarray, least: float) -> np.ndarray:
    """Elements that a set of this size shares with any set linked with it; such a set has as many at least."""
    return -(-sizes * round(least * 100) // 100)


def matches_of(sizes: np.ndarray, share: float, least: float) -> np.ndarray:
    """l by size; never more than the overlap a link needs, so that the prefix stays inside the set."""
    return np.clip(np.ceil(share * sizes).astype(np.int64), 1, np.maximum(overlap_of(sizes, least), 1))


class Sets:
    """The n-gram sets of a slice: distinct hashes by document, and where each document begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, n: int):
        starts, ends, first = T.word_spans(data, offsets)
        words = T.word_hashes(T.LOWER[data], starts, ends)
        at, owner = T.gram_starts(first, n)
        hashes = T.gram_hashes(words, n)[at]
        count = np.diff(first)
        short = np.flatnonzero((count > 0) & (count < n))
        whole = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            more = j < count[short]
            whole[more] = whole[more] * np.uint64(T.MULTIPLIERS[0]) + words[first[short[more]] + j]
        whole = T.mix(whole + count[short].astype(np.uint64))
        hashes, owner = np.r_[hashes, whole], np.r_[owner, short]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])] if len(hashes) else np.zeros(0, bool)
        self.hashes, self.owner = hashes[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(offsets)))
        self.sizes = np.diff(self.first)

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each whole set."""
        total = np.r_[np.uint64(0), np.cumsum(T.mix(self.hashes))]
        other = np.r_[np.uint64(0), np.cumsum(T.mix(self.hashes ^ np.uint64(T.MULTIPLIERS[1])))]
        return total[self.first[1:]] - total[self.first[:-1]], other[self.first[1:]] - other[self.first[:-1]]

    def prefixes(self, sketch: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes in the prefixes, their documents, the number of matches each document asks for, and the place of
        its last prefix element in the one order."""
        seen = sketch[self.hashes & np.uint64(COUNTERS - 1)].astype(np.float64)
        grade = np.log2(seen + 1).astype(np.int64)
        mixed = T.mix(self.hashes)
        order = np.lexsort((mixed, grade, self.owner))
        hashes, owner = self.hashes[order], self.owner[order]
        # Entries met in the index: what the sketch holds beyond its mean load.
        met = np.r_[0.0, np.cumsum(np.maximum(seen[order] - sketch.mean(), 0.0))]
        base, begin = self.sizes - overlap_of(self.sizes, least), self.first[:-1]
        matches = np.ones(len(self.sizes), np.int64)
        best = np.full(len(self.sizes), np.inf)
        for share in MATCHES:
            l = matches_of(self.sizes, share, least)  # noqa: E741
            size = np.minimum(base + l, self.sizes)
            candidates = met[begin + size] - met[begin] + UNSEEN * size
            cost = size + COMPARE_COST * candidates * (1 - l / np.maximum(size, 1)) ** 4
            matches = np.where(cost < best, l, matches)
            best = np.minimum(cost, best)
        place = np.arange(len(hashes)) - begin[owner]
        inside = place < (base + matches)[owner]
        # Different elements may get one number: equal ones do not tell which prefix ends first.
        rank = (grade.astype(np.uint64) << np.uint64(57) | mixed >> np.uint64(7)).astype(np.int64)[order]
        last = np.zeros(len(self.sizes), np.int64)
        some = self.sizes > 0
        last[some] = rank[begin[some] + np.minimum(base + matches, self.sizes)[some] - 1]
        return hashes[inside], owner[inside], matches, last


def sketch_of(docs: DataFrame, n: int) -> np.ndarray:
    """How often the n-grams under each counter occur in documents, over all documents."""
    width = COUNTERS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint64)
        for batch in batches:
            for _, _, data, offsets in T.sliced(batch.column("text")):
                total += np.bincount(Sets(data, offsets, n).hashes & np.uint64(COUNTERS - 1), minlength=COUNTERS).astype(np.uint64)
        if total.any():
            kind = next(k for k in (np.uint16, np.uint32, np.uint64) if total.max() <= np.iinfo(k).max)
            parts = [total[i * width : (i + 1) * width].astype(kind).tobytes() for i in range(SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.uint64)
        for batch in batches:
            for raw in batch.column("counts"):
                raw = raw.as_py()
                total += np.frombuffer(raw, {2: np.uint16, 4: np.uint32, 8: np.uint64}[len(raw) // width])
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    found = docs.select("text").mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect()  # SLICES rows
    out = np.zeros(COUNTERS, np.uint64)
    for r in found:
        out[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], np.uint64)
    return out


def indexed_sets(docs: DataFrame, n: int, least: float) -> DataFrame:
    """A row for each document; those that share a prefix element carry their live elements and their text, packed."""
    blocks = repeats.block_count(docs.sparkSession)
    rows = repeats.in_blocks(docs, blocks)
    sent: Broadcast = docs.sparkSession.sparkContext.broadcast(sketch_of(docs, n))

    def find(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for low, _, data, offsets in T.sliced(batch.column("text")):
            hashes, owner, *_ = Sets(data, offsets, n).prefixes(sent.value, least)
            own = known[owner + low]
            yield hashes[own], owner[own] + low

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        live, _ = repeats.told_ids(right)
        known = ~left.column("doc_id").is_null().to_numpy()
        pack = zstandard.ZstdCompressor(level=1)
        sizes, sig_a, sig_b, asked, prefix, ends, tokens, texts = [], [], [], [], [], [], [], []
        for low, high, data, offsets in T.sliced(left.column("text")):
            sets = Sets(data, offsets, n)
            hashes, owner, matches, last = sets.prefixes(sent.value, least)
            ends.append(last)
            prefix.append(np.bincount(owner, minlength=high - low))
            hit = T.member(repeats.ids_of(hashes, blocks), live) & known[owner + low]
            hashes, owner = hashes[hit].view(np.int64), owner[hit]
            cuts = np.searchsorted(owner, np.arange(high - low + 1))
            # The smallest l of its own or of any set linked with it, whatever share that one took.
            fewest = np.minimum(matches, matches_of(overlap_of(sets.sizes, least), min(MATCHES), least))
            a, b = sets.signatures()
            sizes.append(sets.sizes)
            sig_a.append(a.view(np.int64))
            sig_b.append(b.view(np.int64))
            asked.append(matches)
            for i in range(high - low):
                own = hashes[cuts[i] : cuts[i + 1]]
                goes_on = len(own) >= fewest[i]
                tokens.append(own if goes_on else None)
                texts.append(pack.compress(data[offsets[i] : offsets[i + 1]].tobytes()) if goes_on else None)
        join = lambda x, kind: pa.array(np.concatenate(x).astype(kind) if x else np.zeros(0, kind))
        return pa.table({
            "doc_id": left.column("doc_id"), "n_shingles": join(sizes, np.int64), "sig_a": join(sig_a, np.int64), "sig_b": join(sig_b, np.int64),
            "matches": join(asked, np.int32), "prefix": join(prefix, np.int32), "last": join(ends, np.int64), "tokens": pa.array(tokens, pa.list_(pa.int64())), "text": pa.array(texts, pa.binary()),
        })

    live = repeats.repeated(rows, find, blocks)
    return rows.groupBy("blk").cogroup(live.groupBy("blk")).applyInArrow(keep, SETS)


def compared(pairs: DataFrame, classes: DataFrame, n: int, least: float) -> DataFrame:
    """(x, y, link, inside, outside) for pairs (x, y) of class ids; x is sent to the block of y.

    Rows: pairs similar enough, with link true; and for each y one x that holds half of it at least, with the number of
    shared elements and y's elements outside x. Of several it is the x with most pairs, so that a group has few.
    """
    blocks = max(4, repeats.block_count(pairs.sparkSession) // 2)
    percent = round(least * 100)
    pairs = scratch.written(pairs.select("x", "y", F.pmod(F.xxhash64("y"), F.lit(blocks)).cast("int").alias("blk")), "pairs")
    wanted = pairs.select(F.col("blk").alias("to"), F.explode(F.array("x", "y")).alias("id")).distinct()
    texts = wanted.join(classes.select(F.col("rep").alias("id"), "text"), "id").select("to", "id", "text")
    pairs = pairs.join(pairs.groupBy("x").agg(F.count(F.lit(1)).alias("met")), "x")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        sets: dict[int, np.ndarray] = {}
        for i, raw in zip(right.column("id").to_pylist(), right.column("text").to_pylist()):
            data = np.frombuffer(unpack.decompress(raw), np.uint8)
            sets[i] = Sets(data, np.array([0, len(data)]), n).hashes
        x, y, met = (left.column(c).to_numpy() for c in ("x", "y", "met"))
        parts = []
        for hub, (others, common) in repeats.split_by(x, y, met):
            own = sets[hub]
            for low in range(0, len(others), 256):
                some = others[low : low + 256]
                size = np.array([len(sets[o]) for o in some.tolist()])
                hits = np.r_[0, np.cumsum(T.member(np.concatenate([sets[o] for o in some.tolist()]), own))]
                ends = np.cumsum(size)
                both = hits[ends] - hits[ends - size]
                link = 100 * both >= percent * (size + len(own) - both)
                parts.append(np.stack([np.full(len(some), hub), some, common[low : low + 256], both, size, link]).astype(np.int64))
        x, y, met, both, size, link = np.concatenate(parts, axis=1) if parts else np.zeros((6, 0), np.int64)
        order = np.lexsort((x, -met, y))
        order = order[2 * both[order] >= size[order]]
        nearest = np.zeros(len(y), bool)
        nearest[order] = np.r_[True, y[order][1:] != y[order][:-1]][: len(order)]
        kept = np.flatnonzero(nearest | (link > 0))
        inside, outside = [], []
        for i in kept.tolist():
            inside.append(int(both[i]) if nearest[i] else None)
            own = sets[int(y[i])]
            outside.append(own[~T.member(own, sets[int(x[i])])].view(np.int64) if nearest[i] else None)
        return pa.table({
            "x": pa.array(x[kept], pa.int64()), "y": pa.array(y[kept], pa.int64()), "link": pa.array(link[kept] > 0, pa.bool_()),
            "inside": pa.array(inside, pa.int64()), "outside": pa.array(outside, pa.list_(pa.int64())),
        })

    schema = "x long, y long, link boolean, inside long, outside array<long>"
    return pairs.groupBy("blk").cogroup(texts.groupBy("to")).applyInArrow(check, schema)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in the links (x, y).

    Large and small stars in turn: every id is linked to the smallest of its neighbours, until each
    component is one star. Each step is written to the shared folder.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    edges = links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    edges = scratch.written(edges, "links")
    now = state(edges)
    while now[0]:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.written(small.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, state(edges)
        if before == now:
            break
    stars = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionAll(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def possible(percent: int):
    """Can a class (n, behind, last, live) and a hub (m, behind_too, last_too, live_too) be linked, by ``asked_of``?"""
    first = F.when(F.col("last") < F.col("last_too"), F.col("behind")).when(F.col("last") > F.col("last_too"), F.col("behind_too"))
    behind = F.coalesce(first, F.greatest("behind", "behind_too"))
    common = F.least(F.col("n"), F.col("m"), behind + F.least("live", "live_too"))
    return 100 * common >= percent * (F.col("n") + F.col("m") - common)


def asked_of(i: int, n: np.ndarray, matches: np.ndarray, behind: np.ndarray, last: np.ndarray, percent: int) -> np.ndarray:
    """How many prefix elements class i must share with each class to be linked.

    An element that both hold and that is not in both prefixes lies behind the prefix that ends first.
    """
    overlap = -(-percent * (n + n[i]) // (100 + percent))
    first = np.where(last < last[i], behind, np.where(last > last[i], behind[i], np.maximum(behind, behind[i])))
    return np.where(overlap > np.minimum(n, n[i]), np.iinfo(np.int64).max, np.maximum(np.minimum(matches, matches[i]), overlap - first))


def across(entries: DataFrame, least: float) -> DataFrame:
    """Pairs of classes in different components that share the matches they ask for.

    ``entries``: token, outer, rep, n, matches, behind, last, live, component, hub, inside. Tokens are prefix elements or
    (``outer``) elements outside the hub; ``inside`` is -1 for classes without a hub. In a token's list the largest
    component's classes meet those of other components only.
    """
    percent = round(least * 100)
    buckets = repeats.block_count(entries.sparkSession)
    entries = entries.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int"))
    names = ("token", "rep", "n", "matches", "behind", "last", "live", "component", "hub", "inside")

    def found_by(table: np.ndarray, outer: bool) -> Iterator[np.ndarray]:
        # Lists of one component, most of them, are left out at once.
        table = table[:, np.argsort(table[0], kind="stable")]
        cuts = repeats.runs(table[0])
        if len(cuts) > 1:
            mixed = np.minimum.reduceat(table[7], cuts[:-1]) < np.maximum.reduceat(table[7], cuts[:-1])
            table = table[:, np.repeat(mixed, np.diff(cuts))]
        table = table[:, np.lexsort((table[1], table[7], table[0]))]
        cuts = repeats.runs(table[0])
        for low, high in zip(cuts[:-1], cuts[1:]):
            _, r, n, m, behind, last, live, c, hub, inside = table[:, low:high]
            parts = repeats.runs(c)
            largest = int(np.diff(parts).argmax())
            outside = np.r_[np.arange(parts[largest]), np.arange(parts[largest + 1], len(c))]
            meets = outside
            if not outer and (hub == hub[0]).all() and inside.min() >= 0:
                # Below what the smallest class would need of it, the hub leaves all pairs to the elements outside.
                meets = outside[inside[outside] >= -(-percent * (n.min() + n[outside]) // (100 + percent))]
            for i in meets.tolist():
                # Once for each pair: outside classes after this one, and all of the largest component.
                within = np.minimum(inside, inside[i])
                needed = -(-percent * (n + n[i]) // (100 + percent))
                by_outside = (hub == hub[i]) & (within >= 0) & (within < needed)
                asked = needed - within if outer else asked_of(i, n, m, behind, last, percent)
                other = (c != c[i]) & (asked <= np.minimum(live, live[i])) & (by_outside if outer else ~by_outside)
                # Pairs of two that meet others are listed by the first; the rest do not list at all.
                other[meets[meets <= i]] = False
                j = np.flatnonzero(other)
                if len(j):
                    yield np.stack([np.minimum(r[i], r[j]), np.maximum(r[i], r[j]), asked[j]])

    def pair(table: pa.Table) -> pa.Table:
        columns = np.stack([table.column(c).to_numpy().astype(np.int64) for c in names])
        kind = table.column("outer").to_numpy()
        found = [f for outer in (False, True) for f in found_by(columns[:, kind == outer], outer)]
        x = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        return pa.table({"x": pa.array(x[0], pa.int64()), "y": pa.array(x[1], pa.int64()), "asked": pa.array(x[2], pa.int64())})

    pairs = entries.groupBy("bucket").applyInArrow(pair, "x long, y long, asked long")
    return pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.max("asked").alias("asked")).where("shared >= asked").select("x", "y")


def join(docs: DataFrame, n: int = 5, least: float = 0.75) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document; ``least`` counts in whole per cent.

    Documents are linked if their sets of word ``n``-grams have a Jaccard similarity of ``least`` or more;
    component_id is the smallest doc_id reachable by links.
    """
    sets = scratch.written(indexed_sets(docs, n, least), "sets")
    live = sets.where(F.col("tokens").isNotNull())
    live = live.withColumn("rep", F.xxhash64("sig_a", "sig_b", "n_shingles"))
    first = F.min_by(F.struct("matches", "prefix", "last", "tokens", "text"), "doc_id").alias("first")
    classes = scratch.written(live.groupBy("rep", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("doc"), first).select("rep", "doc", "n", "first.*"), "classes")

    behind = (F.col("n") - F.col("prefix")).alias("behind")
    entries = classes.select(F.explode("tokens").alias("token"), "rep", "n", "matches", behind, "last", F.size("tokens").alias("live"))
    # The least altered class under an element: the one with the smallest share of dead elements.
    best = F.min_by(F.struct("rep", "n", "behind", "last", "live"), F.struct(-(F.col("behind") + F.col("live")) / F.col("n"), F.col("rep"))).alias("hub")
    hubs = entries.groupBy("token").agg(best, F.count(F.lit(1)).alias("k")).where("k > 1")
    hubs = hubs.select("token", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("m"), *(F.col(f"hub.{c}").alias(f"{c}_too") for c in ("behind", "last", "live")))
    met = entries.join(hubs, "token").where((F.col("rep") != F.col("hub")) & possible(round(least * 100)))
    met = met.groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("k"))
    few = F.slice(F.sort_array(F.collect_list(F.struct("k", "hub")), asc=False), 1, HUBS)
    near = met.groupBy("rep").agg(few.alias("few")).select("rep", F.explode("few").alias("h")).select(F.col("h.hub").alias("x"), F.col("rep").alias("y"))
    met = scratch.written(compared(near, classes, n, least), "near")
    known = scratch.written(components(met.where("link").select("x", "y")), "components")

    # A hub is its own hub, with nothing outside.
    nearest = met.where(F.col("inside").isNotNull())
    hubs = nearest.select(F.col("x").alias("rep")).distinct()
    nearest = nearest.select(F.col("y").alias("rep"), F.col("x").alias("hub"), "inside", "outside").join(hubs, "rep", "left_anti")
    own = hubs.select("rep", F.col("rep").alias("hub"), F.lit(None).cast("long").alias("inside"), F.lit(None).cast("array<long>").alias("outside"))
    labelled = classes.drop("text").join(known.withColumnRenamed("id", "rep"), "rep", "left").join(nearest.unionAll(own), "rep", "left")
    component = F.coalesce("component", "rep").alias("component")
    inside = F.when(F.col("hub").isNull(), -1).otherwise(F.coalesce("inside", "n")).cast("long").alias("inside")
    about = (component, F.coalesce("hub", "rep").alias("hub"), inside)
    by_prefix = labelled.select(F.explode("tokens").alias("token"), F.lit(False).alias("outer"), "rep", "n", "matches", behind, "last", F.size("tokens").alias("live"), *about)
    zero = lambda c, kind: F.lit(0).cast(kind).alias(c)
    by_outside = labelled.where(F.col("outside").isNotNull()).select(
        F.explode("outside").alias("token"), F.lit(True).alias("outer"), "rep", "n", zero("matches", "int"), zero("behind", "long"), zero("last", "long"), F.size("outside").alias("live"), *about
    ).withColumn("token", F.xxhash64("hub", "token"))
    far = compared(across(by_prefix.unionAll(by_outside), least), classes, n, least).where("link").select("x", "y")
    name = lambda side: known.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
    bridges = far.join(name("x"), "x", "left").join(name("y"), "y", "left").select(F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y"))
    merged = components(bridges).select(F.col("id").alias("component"), F.col("component").alias("merged"))

    known = known.join(merged, "component", "left").select(F.col("id").alias("rep"), F.coalesce("merged", "component").alias("group"))
    alone = merged.select(F.col("component").alias("rep"), F.col("merged").alias("group")).join(known, "rep", "left_anti")
    docs_of = classes.select("rep", "doc")
    grouped = known.unionAll(alone).join(docs_of, "rep")
    least_doc = grouped.groupBy("group").agg(F.min("doc").alias("component_id"))
    named = docs_of.join(grouped.select("rep", "group").join(least_doc, "group").select("rep", "component_id"), "rep", "left")
    named = named.select("rep", F.coalesce("component_id", "doc").alias("component_id"))
    single = sets.where(F.col("tokens").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return single.unionAll(live.select("doc_id", "n_shingles", "rep").join(named, "rep").select("doc_id", "n_shingles", "component_id"))
