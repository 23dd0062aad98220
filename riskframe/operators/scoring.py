"""Projection of the next period into a ranked list, and checks on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.joins import side_by_side
from riskframe.operators.models import score
from riskframe.operators.profile import spearman
from riskframe.sources.io import shared_folder

# monotonically_increasing_id: partition number above, row number in it below.
SLOT_BITS = 33


def with_position(df: DataFrame, order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """``df`` with the 1-based place of each row in a total order.

    One range-partitioned sort, written to the checkpoint folder; the places then follow
    from the row counts of the sorted partitions. The order must have no ties.
    """
    shared_folder(df.sparkSession)
    slots = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_slot", SLOT_BITS)
    placed = slots.withColumn("_part", part).withColumn("_row", F.col("_slot") - F.shiftleft(part, SLOT_BITS))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sorted partition.
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    ranked = placed.join(F.broadcast(starts), ["_part"])
    return ranked.withColumn(out, F.col("_start") + F.col("_row") + 1).drop("_slot", "_part", "_row", "_start")


def risk_ranking(df: DataFrame, key: str, risk: str, out: str = "position") -> DataFrame:
    """All rows by falling risk, then key, with their place."""
    return with_position(df, [F.desc_nulls_last(risk), F.col(key)], out)


def top_risk(df: DataFrame, key: str, risk: str, k: int = 10) -> DataFrame:
    """The ``k`` rows of greatest risk."""
    return df.orderBy(F.desc_nulls_last(risk), F.col(key)).limit(k)


def concentration(df: DataFrame, key: str, risk: str, group: str, k: int = 100) -> DataFrame:
    """Rows (group, n, share) of the ``k`` rows of greatest risk."""
    top = top_risk(df, key, risk, k)
    counts = top.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    all_rows = F.sum("n").over(Window.partitionBy(F.lit(0)))  # at most k groups
    return counts.withColumn("share", F.col("n") / all_rows)


def project(
    model: PipelineModel, matrix: DataFrame, key: str, name: str, group: str
) -> DataFrame:
    """Risk of missing the goal in the projected year, one row per entity."""
    scored = score(model, matrix, "_p")
    return scored.select(
        key, name, group,
        (1 - F.col("_p")).alias("risk"),
        F.col("goal_t").alias("goal"), F.col("outcome_t1").alias("last_outcome"),
        F.col("effort_t").alias("effort"), F.col("reached_t1").cast("int").alias("reached_last"),
    )


def ranking_sanity(ranking: DataFrame, risk: str = "risk", effort: str = "effort", reached: str = "reached_last") -> DataFrame:
    """One row: Spearman of risk and effort, mean risk of those that missed and met the last goal."""
    means = ranking.agg(
        F.avg(F.when(F.col(reached) == 0, F.col(risk))).alias("risk_missed"),
        F.avg(F.when(F.col(reached) == 1, F.col(risk))).alias("risk_met"),
    )
    rho = spearman(ranking, risk, effort).select(F.col("rho").alias("spearman_risk_effort"))
    return side_by_side(rho, means)
