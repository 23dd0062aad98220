"""Exact top-k search by inner product.

Vectors are turned into integers. Each task goes through its part of them by descending length, in blocks,
against a block of queries. With axes turned by the singular vectors of the collection, most of an inner
product lies in the first axes: a partial sum over those plus the Cauchy-Schwarz bound of the rest (product of
the lengths of what remains) decides which pairs can still reach a query's k-th score; only those are summed
exactly, in integers. When the product of whole lengths falls below every query's k-th score, the rest of
the part is skipped.

Every part starts from the scores that the longest vectors give (a bounded head, see ``HEAD``); they only tell
how early a part may stop. Queries are taken in blocks of ``QUERY_BLOCK`` vectors, each block against all
rows, so that what is sent to the tasks is bounded. A part returns at most k rows of a query, and only
those that reach the head's k-th score; they are merged by query.

Sums of doubles are exact only below 2**53. A vector of length 2**26 or more takes another path: it meets all
others in 64-bit integers, and what these may not hold is summed in whole numbers of any size.

Defined results: rows with NULL vec_id, NULL vector, or a NULL, NaN or infinite component take no part. A
component or score that 64 bits do not hold fails the job. A shorter vector counts as filled with zeros. Rows that share the query's vec_id are its own and no candidates. Repeated rows of
other ids are candidates each. Ties go to the smaller vec_id. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
EXACT_NORM2 = float(1 << 52)
HEAD = 4_096
QUERY_BLOCK = 16_384
QUERY_ROWS = ITEM_ROWS = 512
FIRST_AXES = 0.25
FOUND = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm2): floor(scale * x) of each component, for rows that take part."""

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        held = F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(2.0**63)
        return F.when(held, y).otherwise(F.raise_error(F.lit("op9: a scaled component does not fit 64 bits")).cast("long"))

    scaled = F.transform("embedding", whole)
    right: Column = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    own = vectors.where(right & fine).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return own.select("vec_id", "v", norm2.alias("norm2"))


def matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """Rows of whole numbers, as doubles exact below 2**53, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def axes_of(items: DataFrame, width: int) -> np.ndarray:
    """Singular vectors of the collection, largest first, from the sum of outer products."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(batch.column("v"), width)
            total += m.T @ m
        row, column = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row, column, total.ravel())], ["i", "j", "s"])

    cells = items.select("v").mapInArrow(outer, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    gram = np.zeros((width, width))
    for i, j, s in cells.collect():  # width squared numbers
        gram[i, j] = s
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


class Block:
    """Queries, their turned vectors, and the k-th score known so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray, k: int):
        self.ids, self.vectors, self.axes, self.k = ids, vectors, axes, k
        self.cut = max(1, int(axes.shape[1] * FIRST_AXES))
        turned = vectors @ axes
        self.first = turned[:, : self.cut].copy()
        self.rest = np.linalg.norm(turned[:, self.cut :], axis=1)
        self.length = np.linalg.norm(vectors, axis=1)
        self.least = np.full(len(ids), -np.inf)

    def search(self, ids: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries (by place), ids and scores of the best of these items, at most k for each query and none below
        the known score. Work tables are ``QUERY_ROWS`` by ``ITEM_ROWS``, whatever the numbers of both."""
        length = np.linalg.norm(items, axis=1)
        order = np.argsort(-length, kind="stable")
        ids, items, length = ids[order], items[order], length[order]
        turned = items @ self.axes
        first, rest = turned[:, : self.cut].copy(), np.linalg.norm(turned[:, self.cut :], axis=1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for low in range(0, len(self.ids), QUERY_ROWS):
            found += self._search(slice(low, low + QUERY_ROWS), ids, items, length, first, rest)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else none

    def _search(self, own: slice, ids, items, length, first, rest) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        least, of_query = self.least[own].copy(), self.length[own]
        best: list[tuple[np.ndarray, np.ndarray]] = [(ids[:0], length[:0])] * len(least)
        slack = 1e-6  # of the products of lengths: rounding of the turned sums
        for low in range(0, len(ids), ITEM_ROWS):
            part = slice(low, low + ITEM_ROWS)
            open_ = np.flatnonzero(of_query * length[low] * (1 + slack) + slack >= least)
            if not len(open_):
                break  # no later item is longer
            bound = self.first[own][open_] @ first[part].T + np.outer(self.rest[own][open_], rest[part])
            bound += np.outer(of_query[open_], length[part]) * slack + slack
            left = bound >= least[open_][:, None]
            # Whole numbers below 2**53: exact in any order of summing.
            if left.mean() > 0.02:
                score = self.vectors[own][open_] @ items[part].T
                query, item = np.nonzero(left & (score >= least[open_][:, None]))
                score = score[query, item]
            else:
                query, item = np.nonzero(left)
                score = np.einsum("ij,ij->i", self.vectors[own][open_[query]], items[part][item])
                good = score >= least[open_[query]]
                query, item, score = query[good], item[good], score[good]
            query, item = open_[query], item + low
            good = self.ids[own][query] != ids[item]
            query, item, score = query[good], item[good], score[good]
            cuts = np.r_[np.flatnonzero(np.r_[True, query[1:] != query[:-1]]), len(query)] if len(query) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                q = query[a]
                found_ids, found = np.r_[best[q][0], ids[item[a:b]]], np.r_[best[q][1], score[a:b]]
                keep = top(found, found_ids, self.k)
                best[q] = found_ids[keep], found[keep]
                if len(keep) == self.k:
                    least[q] = max(least[q], found[keep[-1]])
        return [(np.full(len(f), own.start + q), i, f) for q, (i, f) in enumerate(best) if len(f)]


def exact_scores(queries: np.ndarray, items: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Inner products of 64-bit integers where ``wanted``; one that 64 bits do not hold is an error."""
    q, x = queries.astype(np.float64), items.astype(np.float64)
    error = np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)) * (4 * q.shape[1] * np.finfo(np.float64).eps)
    score = queries @ items.T  # modulo 2**64, so right whenever it fits
    for a, b in zip(*np.nonzero(wanted & (np.abs(q @ x.T) + error >= 2.0**63))):
        whole = sum(i * j for i, j in zip(queries[a].tolist(), items[b].tolist()))
        if not -(1 << 63) <= whole < 1 << 63:
            raise ArithmeticError("op9: a score does not fit 64 bits")
        score[a, b] = whole
    return score


def search_long(queries: DataFrame, items: DataFrame, width: int, k: int, n: int) -> DataFrame | None:
    """At most k rows of a query and batch, of the pairs with a vector of length 2**26 or more."""
    spark = items.sparkSession
    found = None
    blocks = -(-n // QUERY_BLOCK)
    for i in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).select("vec_id", "v", "norm2").distinct().toArrow()
        is_long = own.column("norm2").to_numpy() >= EXACT_NORM2
        sent = spark.sparkContext.broadcast((own.column("vec_id").to_numpy(), matrix(own.column("v"), width, np.int64), is_long))

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            all_ids, vectors, all_long = sent.value
            for batch in batches:
                item_ids, item_long = batch.column("vec_id").to_numpy(), batch.column("norm2").to_numpy() >= EXACT_NORM2
                item_vectors = matrix(batch.column("v"), width, np.int64)
                for low in range(0, len(all_ids), QUERY_ROWS):
                    part = slice(low, low + QUERY_ROWS)
                    # Without a long item only the long queries have pairs here.
                    own = np.arange(len(all_ids))[part] if item_long.any() else np.flatnonzero(all_long[part]) + low
                    if not len(own):
                        continue
                    absent = np.ones((len(own), 0), bool)
                    score, ids = np.zeros((len(own), 0), np.int64), np.zeros((len(own), 0), np.int64)
                    for at in range(0, len(item_ids), ITEM_ROWS):
                        of = slice(at, at + ITEM_ROWS)
                        wanted = (all_long[own][:, None] | item_long[of]) & (all_ids[own][:, None] != item_ids[of])
                        if not wanted.any():
                            continue
                        score = np.concatenate([score, exact_scores(vectors[own], item_vectors[of], wanted)], axis=1)
                        ids = np.concatenate([ids, np.broadcast_to(item_ids[of], wanted.shape)], axis=1)
                        absent = np.concatenate([absent, ~wanted], axis=1)
                        # ~score falls as score rises, without leaving the range.
                        keep = np.lexsort((ids, ~score, absent), axis=1)[:, :k]
                        score, ids, absent = (np.take_along_axis(t, keep, axis=1) for t in (score, ids, absent))
                    query, place = np.nonzero(~absent)
                    columns = (all_ids[own][query], ids[query, place], score[query, place])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        part = items.select("vec_id", "v", "norm2").mapInArrow(look, FOUND)
        found = part if found is None else found.unionAll(part)
    return found


def search(queries: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k items with the highest inner products for each query.

    Both as made by ``integers``; the query's own vec_id is no candidate.
    """
    spark = items.sparkSession
    is_long = F.col("norm2") >= EXACT_NORM2
    # Queries too, so that a longer one is not cut; what it has beyond the items meets zeros.
    width, long_items = items.agg(F.max(F.size("v")), F.count_if(is_long)).first()
    widest, n, long_queries = queries.agg(F.max(F.size("v")), F.count(F.lit(1)), F.count_if(is_long)).first()
    width = max(width or 0, widest or 0) if width else 0
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = None
    if long_items or long_queries:
        # Long items meet every query; the others only the long queries.
        found = search_long(queries, items if long_queries else items.where(is_long), width, k, n)
        queries, items, n = queries.where(~is_long), items.where(~is_long), n - long_queries
    axes = axes_of(items, width)
    head = items.orderBy(F.desc("norm2"), "vec_id").limit(HEAD).toArrow()
    head_ids, head_vectors = head.column("vec_id").to_numpy(), matrix(head.column("v"), width)
    blocks = -(-n // QUERY_BLOCK)
    for i in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).select("vec_id", "v").distinct().toArrow()
        block = Block(own.column("vec_id").to_numpy(), matrix(own.column("v"), width), axes, k)
        query, _, score = block.search(head_ids, head_vectors)
        enough = np.flatnonzero(np.bincount(query, minlength=len(block.ids)) == k)
        lowest = np.full(len(block.ids), np.inf)
        np.minimum.at(lowest, query, score)
        block.least[enough] = lowest[enough]
        sent = spark.sparkContext.broadcast(block)

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in batches:
                query, ids, scores = block.search(batch.column("vec_id").to_numpy(), matrix(batch.column("v"), width))
                columns = (block.ids[query], ids, scores.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        part = items.select("vec_id", "v").mapInArrow(look, FOUND)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
