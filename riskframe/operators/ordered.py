"""Exact order statistics without a global window.

Everything that needs "how much lies below this value" (ranks, ROC, average precision,
quantiles) is built on two operators here. Both cut the value axis into ranges of about
equal row count, add up the ranges first, and then only order rows inside a range. The
cut points come from a sketch, of each group's own values where there are groups; they
decide how even the ranges are, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskframe.operators.joins import small_table

BUCKET = "_bucket"
# Least number of ranges per quantile pass; only the ranges that contain a wanted rank are
# ever sorted.
QUANTILE_BUCKETS = 256


def default_buckets(df: DataFrame) -> int:
    """One range per shuffle task, so that ranges shrink as the cluster is sized up."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def value_edges(df: DataFrame, value: str, buckets: int) -> list[float]:
    """Approximate equal-count cut points of ``value``; at most ``buckets - 1`` numbers."""
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(F.col(value).cast("double"), probs, 10 * buckets)).first()[0]
    return sorted({c for c in cuts or [] if math.isfinite(c)})


def with_bucket(df: DataFrame, value: str, edges: Sequence[float], out: str = BUCKET) -> DataFrame:
    """Number of edges at or below ``value`` (ranges closed on the left), as ``out``."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *[float(e) for e in edges], float("inf")]
    binned = Bucketizer(splits=splits, inputCol=value, outputCol=out).transform(df)
    # Never NULL here; saying so keeps the range number out of inferred NOT NULL filters.
    return binned.withColumn(out, F.coalesce(F.col(out).cast("int"), F.lit(0)))


@dataclass(frozen=True)
class GroupCuts:
    """Cut points of all large groups together, by value column, and a table of those groups.

    Both are bounded by the number of ranges asked for.
    """

    edges: dict[str, list[float]]
    large: DataFrame


def group_cuts(rows: DataFrame, values: Sequence[str], by: Sequence[str], buckets: int) -> GroupCuts:
    """Cut points of each value column that cut every group evenly, from one aggregate by group.

    Groups with more than one part in ``buckets`` of the rows, fewer than ``buckets`` of them,
    are cut at their own quantiles, one with a share s at s * ``buckets`` of them or up to twice
    that. The cut points of all groups are used together, so that a range of any group holds no
    more than about one part in ``buckets`` of all rows, whatever the scales of the groups.
    """
    finest = max(2, buckets)
    # Counted beside the sketch, in the same job.
    total = rows.agg(F.count(F.lit(1))).scalar()
    probs = [i / finest for i in range(1, finest)]
    sketched = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.percentile_approx(F.col(v).cast("double"), probs, 4 * finest).alias(f"_e_{v}") for v in values],
    )
    large = sketched.where(F.col("_n") * buckets > total).withColumn(
        "_step", F.greatest(F.lit(1), F.floor(F.lit(finest) / F.ceil(F.col("_n") * buckets / total))).cast("int")
    )
    found = large.select(
        *by, *[F.filter(f"_e_{v}", lambda _, i: (i + 1) % F.col("_step") == 0).alias(f"_e_{v}") for v in values]
    ).collect()
    # Adding zero makes one of the two zeros.
    edges = {v: sorted({c + 0.0 for r in found for c in r[f"_e_{v}"] or [] if math.isfinite(c)}) for v in values}
    schema = StructType([rows.schema[k] for k in by])
    return GroupCuts(edges, rows.sparkSession.createDataFrame([tuple(r[k] for k in by) for r in found], schema))


def running_totals(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """One row per distinct (by, value) with three numbers per measure.

    ``m`` is the sum at this value, ``m_upto`` the sum over all values up to and including
    it, ``m_all`` the sum of the group. Rows are summed per distinct value before anything
    is shuffled, so a value that fills a third of the table costs one row per task; a group
    that fills a third of the table is spread over all ranges.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull())
    # The sketch reads one column and moves nothing. Cut at equal row counts, a range holds
    # no more distinct values than its share of the rows.
    buckets = buckets or default_buckets(df)
    cells = rows.groupBy(*by, value).agg(*[F.sum(m).alias(m) for m in measures])
    edges = group_cuts(rows, [value], by, buckets).edges[value] if by else value_edges(rows, value, buckets)
    cells = with_bucket(cells, value, edges)

    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row more than edges per group.
    ranges = cells.groupBy(*by, BUCKET).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = ranges.select(
        *[F.col(k).alias(f"_r_{k}") for k in [*by, BUCKET]],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_before") for m in measures],
        *[F.sum(m).over(group).alias(f"{m}_all") for m in measures],
    )
    inside = (
        Window.partitionBy(*by, BUCKET)
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cells.select(
        *by, value, BUCKET, *measures, *[F.sum(m).over(inside).alias(f"_{m}_in") for m in measures]
    )
    cond = local[BUCKET] == offsets[f"_r_{BUCKET}"]
    for k in by:
        cond = cond & local[k].eqNullSafe(offsets[f"_r_{k}"])
    # Without groups the offsets are one row per range: a bounded table.
    joined = local.join(offsets if by else F.broadcast(offsets), cond)
    return joined.select(
        *by,
        value,
        *measures,
        *[(F.col(f"_{m}_before") + F.col(f"_{m}_in")).alias(f"{m}_upto") for m in measures],
        *[f"{m}_all" for m in measures],
    )


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Distinct (by, value) with the 1-based rank, ties sharing the mean of their places.

    ``<out>_of`` is the number of ranked rows in the group.
    """
    counted = df.select(*by, value, F.lit(1).cast("long").alias("_n"))
    totals = running_totals(counted, value, ["_n"], by)
    rank = F.col("_n_upto") - (F.col("_n") - F.lit(1)) / F.lit(2)
    return totals.select(*by, value, rank.cast("double").alias(out), F.col("_n_all").alias(f"{out}_of"))


def companion_ranks(
    df: DataFrame, values: Sequence[str], by: Sequence[str], weight: str, cuts: GroupCuts | None = None
) -> DataFrame:
    """``df`` with ``<value>_rank`` for each value column and ``_of``, the weight of the group.

    Ranks are 1-based and count a row ``weight`` times; ties share the mean of their places. The
    other columns stay with their row, so nothing is joined on a value. Every cut point is a
    range of its own: its rows all have the rank that the range totals give, and are dealt out
    freely, so a value that fills a third of the table stays in many tasks. Only the rows
    between two cut points are ordered. Values must not be NULL. ``cuts`` may come from rows
    that are cheaper to read than ``df``.
    """
    by, buckets = list(by), default_buckets(df)
    cuts = cuts or group_cuts(df, values, by, buckets)
    out, group = df, Window.partitionBy(*by)
    for v in values:
        # Between a cut point and the next double lies no other value: odd ranges hold one value each.
        splits: list[float] = []
        for e in cuts.edges[v]:
            if not splits or e > splits[-1]:
                splits += [c for c in (e, math.nextafter(e, math.inf)) if math.isfinite(c)]

        def ranged(rows: DataFrame, v: str = v, splits: Sequence[float] = splits) -> DataFrame:
            known = cuts.large.select(*[F.col(k).alias(f"_c_{k}") for k in by], F.lit(True).alias("_large"))
            met = F.lit(True)
            for k in by:
                met = met & rows[k].eqNullSafe(known[f"_c_{k}"])
            cut = with_bucket(rows.withColumn("_double", F.col(v).cast("double")), "_double", splits, "_at")
            cut = cut.join(F.broadcast(known), met, "left").withColumn("_large", F.coalesce("_large", F.lit(False)))
            at = F.when(F.col("_large"), F.col("_at")).otherwise(F.lit(0))
            return (
                cut.withColumn(BUCKET, at).withColumn("_alone", F.col(BUCKET) % 2 == 1)
                .drop("_double", "_at", *[f"_c_{k}" for k in by])
            )

        # Large groups only, so as bounded as the cuts; a small group is one range.
        spans = ranged(df.select(*by, v, weight)).where("_large").groupBy(*by, BUCKET).agg(F.sum(weight).alias("_span"))
        earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.select(
            *[F.col(k).alias(f"_s_{k}") for k in by], F.col(BUCKET).alias("_s_at"), "_span",
            F.coalesce(F.sum("_span").over(earlier), F.lit(0)).alias("_before"), F.sum("_span").over(group).alias("_all"),
        )
        rows = ranged(out)
        met = rows[BUCKET] == spans["_s_at"]
        for k in by:
            met = met & rows[k].eqNullSafe(spans[f"_s_{k}"])
        dealt = F.when(F.col("_alone"), F.pmod(F.xxhash64(*df.columns), F.lit(buckets))).otherwise(F.lit(0))
        rows = rows.join(F.broadcast(spans), met, "left").withColumn("_dealt", dealt)
        own = Window.partitionBy(*by, BUCKET, "_dealt")
        upto = F.sum(weight).over(own.orderBy(v).rangeBetween(Window.unboundedPreceding, Window.currentRow))
        tied = F.sum(weight).over(Window.partitionBy(*by, BUCKET, "_dealt", v))
        # In a small group the one range is the group.
        rows = rows.withColumns({"_upto": upto, "_tied": tied, "_held": F.sum(weight).over(own)})
        before = F.coalesce("_before", F.lit(0))
        last, ties = (F.when(F.col("_alone"), F.col("_span")).otherwise(F.col(c)) for c in ("_upto", "_tied"))
        rank = (before + last - (ties - F.lit(1)) / F.lit(2)).cast("double")
        out = rows.select(
            *[c for c in out.columns if c != "_of"], rank.alias(f"{v}_rank"), F.coalesce("_all", "_held").alias("_of")
        )
    return out


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles as rows (by, prob, quantile).

    NULL and NaN are left out. First only counts per range are shuffled; they say which
    ranges hold the wanted ranks, and only rows of those ranges are shuffled and ordered.
    ``few_groups`` promises that the number of groups does not grow with the data.
    """
    by = list(by)
    probs = sorted({float(p) for p in probs})
    spark = df.sparkSession
    buckets = buckets or max(QUANTILE_BUCKETS, default_buckets(df))
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    edges = group_cuts(rows, ["_v"], by, buckets).edges["_v"] if by else value_edges(rows, "_v", buckets)
    binned = with_bucket(rows, "_v", edges)

    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        binned.groupBy(*by, BUCKET)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_all", F.sum("_n").over(group))
    )
    position = lambda q: (F.col("_all") - 1).cast("double") * q
    both_sides = F.flatten(
        F.transform(
            F.array(*[F.lit(p) for p in probs]),
            lambda q: F.array(
                F.struct(q.alias("prob"), F.floor(position(q)).alias("place")),
                F.struct(q.alias("prob"), F.ceil(position(q)).alias("place")),
            ),
        )
    )
    in_span = lambda s: (
        (s["place"] >= F.col("_start")) & (s["place"] < F.col("_start") + F.col("_n"))
    )
    wanted = (
        spans.withColumn("_w", F.explode(F.array_distinct(F.filter(both_sides, in_span))))
        .select(
            *[F.col(k).alias(f"_w_{k}") for k in [*by, BUCKET]],
            F.col("_w.prob").alias("prob"),
            (F.col("_w.place") - F.col("_start")).alias("_place"),
            position(F.col("_w.prob")).alias("_pos"),
            F.col("_w.place").alias("_rank"),
        )
    )
    # Two ranks per group and step: bounded if the groups are, else counted.
    is_small = few_groups or not by
    if not is_small:
        wanted, is_small = small_table(spark, wanted)
    hint = F.broadcast if is_small else (lambda x: x)

    spans_needed = wanted.select(*[f"_w_{k}" for k in [*by, BUCKET]])
    meets = binned[BUCKET] == F.col(f"_w_{BUCKET}")
    for k in by:
        meets = meets & binned[k].eqNullSafe(F.col(f"_w_{k}"))
    inside = (
        Window.partitionBy(*by, BUCKET)
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cells = (
        binned.join(hint(spans_needed), meets, "left_semi")
        .groupBy(*by, BUCKET, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(inside))
    )
    hit = (
        (cells[BUCKET] == F.col(f"_w_{BUCKET}"))
        & (F.col("_place") < F.col("_upto"))
        & (F.col("_place") >= F.col("_upto") - F.col("_n"))
    )
    for k in by:
        hit = hit & cells[k].eqNullSafe(F.col(f"_w_{k}"))
    picked = cells.join(hint(wanted), hit)
    low = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col("_v")))
    high = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col("_v")))
    share = F.first("_pos") - F.floor(F.first("_pos"))
    return picked.groupBy(*by, "prob").agg((low + share * (high - low)).alias("quantile"))


def unpivot_numeric(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form (ids, feature, value) of numeric or boolean columns, value as double."""
    types = dict(df.dtypes)
    as_double = [
        (F.col(c).cast("int") if types[c] == "boolean" else F.col(c)).cast("double").alias(c)
        for c in columns
    ]
    wide = df.select(*ids, *as_double)
    return wide.unpivot(list(ids), list(columns), "feature", "value")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of many columns in one pass: rows (by, feature, prob, quantile)."""
    return quantiles(
        unpivot_numeric(df, columns, by), "value", probs, [*by, "feature"], few_groups=not by
    )
