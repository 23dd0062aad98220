"""Benchmark decontamination: documents that hold a passage of a benchmark item, words replaced or not.

Spaced seeds: each mask looks at some of the words of a short window and ignores the others, so that a
replaced word in an ignored place does not hide the match. Hashes of the masked words of the benchmark are
joined with those of every place of every document; along the diagonal of each hit, words are then compared
one by one. The masks together hit every 13 words of which any two are replaced; items of fewer words have
shorter masks besides.

The benchmark's hashes are sent to the tasks in blocks of bounded size (``BLOCK_BYTES`` of text, measured
first); a larger benchmark takes several passes over the documents, each against one block, and no
document or item is left out. Documents are not shuffled and nothing is gathered from them.

Words are runs of ASCII letters and digits and of any non-ASCII characters, with A-Z in lower case.

Defined results: NULL texts have no words and match nothing; an item of fewer than five words is too short
to be told from chance and matches nothing; one of fewer than ``window`` words must match as a whole.
Repeated documents are judged each for itself, repeated items too. A NULL doc_id or item_id is carried along.
Empty tables give empty results. ``clean`` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import text as T

MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 3, 4, 5))
# Of items below MASKED words only: with them, every such item is hit of which at most a fifth of the words is replaced.
SHORT_MASKS = ((0, 1, 2), (0, 1, 3))
MASKED = 13
BLOCK_BYTES = 8 << 20
OVERLAPS = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_replaced long"


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = T.word_spans(data, offsets, T.IS_ALNUM)
    return T.word_hashes(T.LOWER[data], starts, ends), first


def seed_hashes(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Hash of the words under the mask from each word on, over the joined documents."""
    n = max(0, len(words) - mask[-1])
    h = np.full(n, number + 1, np.uint64)
    for j in mask:
        h = h * np.uint64(T.MULTIPLIERS[1]) + words[j : j + n]
    return T.mix(h)


@dataclass
class Items:
    """A block of the benchmark: its words, and the places of its seeds by hash."""

    ids: list[int | None]
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    places: np.ndarray
    used: list[bool]

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Items:
        data, offsets = T.binary_of(pa.array([t for _, t in rows], pa.string()))
        words, first = words_of(data, offsets)
        seeds, places = [], []
        for number, mask in enumerate(MASKS + SHORT_MASKS):
            at, owner = T.gram_starts(first, mask[-1] + 1)
            if number >= len(MASKS):
                sizes = np.diff(first)[owner]
                at = at[(sizes >= 5) & (sizes < MASKED)]
            seeds.append(seed_hashes(words, mask, number)[at] if len(at) else np.zeros(0, np.uint64))
            places.append(at)
        used = [len(s) > 0 for s in seeds]
        seeds, places = np.concatenate(seeds), np.concatenate(places)
        order = np.argsort(seeds, kind="stable")
        return Items([i for i, _ in rows], words, first, seeds[order], places[order], used)


def longest_overlap(same: np.ndarray, most_replaced: float) -> tuple[int, int, int]:
    """Start, end and number of differences of the longest run with a share of at most ``most_replaced``
    differences that begins and ends with equal words."""
    if not same.any():
        return 0, 0, 0
    cost = np.where(same, most_replaced, most_replaced - 1)
    total = np.r_[0, np.cumsum(cost)] + 1e-9 * np.arange(len(same) + 1)
    # A run may open before an equal word only and close after one only: nothing is trimmed afterwards.
    lowest = np.minimum.accumulate(np.where(np.r_[same, False], total, np.inf))
    ends = np.flatnonzero(same) + 1
    starts = np.searchsorted(-lowest, -total[ends], side="left")
    best = int(np.argmax(ends - starts))
    start, end = int(starts[best]), int(ends[best])
    return start, end, int((~same[start:end]).sum())


def overlaps_in(column: pa.Array, items: Items, window: int, most_replaced: float) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, first word in the document, in the item, words, replaced) for a column of texts."""
    maybe = np.zeros(1 << 20, bool)
    maybe[items.seeds & np.uint64((1 << 20) - 1)] = True
    owner_of_item = T.owner_of(items.first)
    for low, _, data, offsets in T.sliced(column):
        words, first = words_of(data, offsets)
        found = []
        for number, mask in enumerate(MASKS + SHORT_MASKS):
            if not items.used[number]:
                continue
            h = seed_hashes(words, mask, number)
            at, owner = T.gram_starts(first, mask[-1] + 1)
            if not len(at):
                continue
            hit = np.flatnonzero(maybe[h[at] & np.uint64((1 << 20) - 1)])
            at, owner = at[hit], owner[hit]
            low_seed = np.searchsorted(items.seeds, h[at], side="left")
            n = np.searchsorted(items.seeds, h[at], side="right") - low_seed
            each = np.repeat(np.arange(len(at)), n)
            seed = low_seed[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            place = items.places[seed]
            found.append(np.stack([owner[each], owner_of_item[place], at[each] - place]))
        if not found:
            continue
        for doc, item, diagonal in np.unique(np.concatenate(found, axis=1), axis=1).T.tolist():
            a, b = int(items.first[item]), int(items.first[item + 1])
            start = max(a, int(first[doc]) - diagonal)
            end = min(b, int(first[doc + 1]) - diagonal)
            same = items.words[start:end] == words[start + diagonal : end + diagonal]
            s, e, replaced = longest_overlap(same, most_replaced)
            if e - s >= min(window, b - a):
                yield low + doc, item, start + s + diagonal - int(first[doc]), start + s - a, e - s, replaced


def blocks(bench: DataFrame) -> Iterator[Broadcast]:
    """The benchmark in blocks of about ``BLOCK_BYTES`` of text, each sent to all executors."""
    spark = bench.sparkSession
    bench = bench.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    for i in range(n):
        own = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else bench
        rows = sorted(((r[0], r[1]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield spark.sparkContext.broadcast(Items.of(rows))


def overlaps(docs: DataFrame, bench: DataFrame, window: int = 13, most_replaced: float = 0.2) -> DataFrame:
    """One row for each document, item and alignment with ``window`` words or more in common, of which a
    share of at most ``most_replaced`` differ: doc_id, item_id, first words, length, replaced words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def against(block: Broadcast) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id")
                items = block.value
                rows = list(overlaps_in(batch.column("text"), items, window, most_replaced))
                if rows:
                    row, item, *rest = zip(*rows)
                    columns = [ids.take(pa.array(row)), pa.array([items.ids[i] for i in item], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.int64()) for x in rest], [x.split()[0] for x in OVERLAPS.split(", ")])

        return docs.mapInArrow(search, OVERLAPS)

    out = None
    for block in blocks(bench):
        found = against(block)
        out = found if out is None else out.unionAll(found)
    return out


def clean(docs: DataFrame, bench: DataFrame, window: int = 13, most_replaced: float = 0.2) -> DataFrame:
    """The documents without any such overlap, with all their columns."""
    for block in blocks(bench):

        def keep(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for row, *_ in overlaps_in(batch.column("text"), block.value, window, most_replaced):
                    good[row] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def contaminated(result: DataFrame) -> DataFrame:
    """One row for each document and item: the longest overlap (the first of equal ones)."""
    best = F.max_by(
        F.struct("doc_start", "item_start", "n_words", "n_replaced"),
        F.struct("n_words", -F.col("n_replaced"), -F.col("doc_start"), -F.col("item_start")),
    )
    return result.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
