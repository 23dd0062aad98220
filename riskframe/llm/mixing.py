"""Mixing sources to target weights, in documents' words, with DataFrame operations only.

Every document gets a hash-random key. A source's documents are cut into ranges of the key, which hold
about the same number of rows since the key is uniform; words are added up by range, running sums over a
source's ranges give where each range begins, and a running sum inside a range does the rest. The
source's budget is cut exactly there: whole epochs first, then documents in key order, the last one in part.

A source with a third of all rows is spread over all ranges; a range of a source is the unit of work. The only
global steps are over the table of sources, which is range-partitioned to number its rows.

Defined results: NULL text has size 0, NULL source is a source of its own and the last. Documents with equal doc_id,
or NULL, are ordered by size; equal rows may change places without changing the result. With no words at all, targets
are 0. An empty table gives an empty result. ``keep`` carries further columns along; others are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import scratch

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
KEY_BITS = 60
RANGE_ROWS = 20_000


def size_of(text: str = "text") -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(doc_id: str = "doc_id") -> Column:
    """60 bits of a hash of seed and doc_id."""
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """Number of each source from 0, by code point, NULL last: numbers within ranges of the name, and where ranges begin."""
    order = F.col("source").asc_nulls_last()
    ranged = scratch.written(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return ranged.withColumn("inside", inside).join(begins, "part").withColumn("number", F.col("begin") + F.col("inside")).drop("part", "inside", "begin")


def level(sources: DataFrame, most: int) -> float:
    """Words for each unit of weight once no source is above ``most`` times its size: sources at their limit are
    taken out and the rest reshared until none is added. A row for each step reaches the driver."""
    at_limit = lambda x: F.col("source_size") * most < F.lit(x) * F.col("weight")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    now = 0.0
    while True:
        capped, weight = sources.agg(
            F.sum(F.when(at_limit(now), F.col("source_size") * most).otherwise(0)), F.sum(F.when(at_limit(now), 0).otherwise(F.col("weight")))
        ).first()
        if not weight:
            return math.inf if words else 0.0
        then = (words - capped) / weight
        if then <= now:
            return then
        now = then


def budgets(rows: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(source, range): words before the range, and the source's size, target, whole epochs and rest."""
    ranges = scratch.written(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    sources = numbered(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sources = scratch.written(sources.withColumn("weight", weight), "weights")
    share = F.lit(level(sources, most)) * F.col("weight")
    limit = (F.col("source_size") * most).cast("double")
    target = F.when(limit < share, limit).otherwise(share)
    budget = F.floor(F.col("target"))
    safe = F.greatest(F.col("source_size"), F.lit(1))
    sources = sources.withColumn("target", target).select(
        F.col("source").alias("s"), "source_size", "target", F.floor(budget / safe).alias("epochs"), (budget % safe).alias("rest")
    )
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.withColumn("begin", F.coalesce(F.sum("words").over(before), F.lit(0)))
    return begins.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s", "words")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) and the columns in ``keep`` for every document.

    ``taken`` words of the document are in the mix, repeats counted; a source's taken words add up to its
    target, rounded down, and no document is taken more than ``most`` times.
    """
    n = docs.count()
    bits = max(0, math.ceil(math.log2(max(1, n / RANGE_ROWS))))
    cut = F.shiftright(key_of(), KEY_BITS - bits) if bits else F.lit(0).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), cut.alias("range"),
        key_of().alias("key"), size_of().alias("size"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    told = budgets(rows, weights, most).withColumnsRenamed({"source": "s", "range": "r"})
    joined = rows.join(told, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    earlier = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("begin") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    part = F.least(F.greatest(F.col("rest") - begin, F.lit(0)), F.col("size"))
    taken = (F.col("epochs") * F.col("size") + part).cast("long")
    return joined.withColumn("taken", taken).select("doc_id", "size", "source_size", "target", "taken", *[F.col(f"_keep_{c}").alias(c) for c in keep])
