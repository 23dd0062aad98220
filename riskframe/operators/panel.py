"""Yearly history in terms relative to a target year.

The same model then trains on one year and projects the next: ``outcome_t1`` is the outcome
one year before the target year t, ``goal_t`` the goal of that year, and so on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.scalar import reached
from riskframe.operators.joins import checked_join, lookup_join, require_unique
from riskframe.operators.roles import Roles, drop_dated

HISTORY = ["outcome_t1", "outcome_t2", "delta_t1", "goal_t", "effort_t", "reached_t1"]


def relative_matrix(
    features: DataFrame,
    targets: DataFrame,
    key: str,
    t: int,
    base_year: int,
    roles: Roles,
    names: Sequence[str] = (),
    allow: Sequence[str] = (),
    null_as_false: bool = False,
) -> DataFrame:
    """One row per entity with the history block relative to target year ``t``.

    ``features`` holds outcomes up to ``base_year - 1`` and all goals, ``targets`` the
    outcome and the flag ``reached_<base_year>`` of ``base_year``. ``t = base_year`` trains
    and carries that flag as label; ``t = base_year + 1`` projects and has no label. Rows of
    the two tables meet on the key. Columns naming a year are dropped.
    """
    if t not in (base_year, base_year + 1):
        raise ValueError(f"unsupported target year: {t}")
    label = f"reached_{base_year}"
    if t == base_year:
        known = targets.select(key, label)
        joined = checked_join(features, known, [key], "left", "1:1")
        last, before = F.col(f"outcome_{t - 1}"), F.col(f"outcome_{t - 2}")
        hit = reached(last, F.col(f"goal_{t - 1}"), null_as_false)
    else:
        known = targets.select(key, F.col(f"outcome_{base_year}").alias("_last"), F.col(label).alias("_hit"))
        joined = checked_join(features, known, [key], "left", "1:1")
        last, before, hit = F.col("_last"), F.col(f"outcome_{t - 2}"), F.col("_hit").cast("double")
    goal = F.col(f"goal_{t}")
    out = joined.withColumns(
        {
            "outcome_t1": last,
            "outcome_t2": before,
            "delta_t1": last - before,
            "goal_t": goal,
            "effort_t": goal - last,
            "reached_t1": hit,
        }
    ).drop("_last", "_hit")
    kept = [*HISTORY, *([label] if t == base_year else [])]
    out = drop_dated(out, ["outcome_", "goal_", "delta_", "gap_", "effort_", "ambition_", "reached_"], names, kept)
    roles.assert_no_leakage(out.columns, allow=[key, *allow, *([label] if t == base_year else [])])
    return out


def dense_panel(long: DataFrame, key: str, year: str, years: Sequence[int]) -> DataFrame:
    """Every key at every listed year; years without a row have NULL values.

    A row of another year fails the job that reads the panel. The list of years is short, so spreading
    keys over it multiplies rows by its length only.
    """
    text = F.concat(F.lit(f"{year} outside the panel's years: "), F.coalesce(F.col(year).cast("string"), F.lit("NULL")))
    listed = F.coalesce(F.col(year).isin(*years), F.lit(False))
    long = long.withColumn(year, F.when(listed, F.col(year)).otherwise(F.raise_error(text).cast(long.schema[year].dataType)))
    spine = long.select(key).distinct().withColumn(year, F.explode(F.array(*[F.lit(y) for y in years])))
    return spine.join(long, [key, year], "left")


def yoy_delta(long: DataFrame, key: str, year: str, value: str, years: Sequence[int]) -> DataFrame:
    """Value, last year's value and their difference over a dense panel.

    ``years`` must be consecutive. A key has one row per year, so its window is short.
    """
    panel = dense_panel(require_unique(long.select(key, year, value), [key, year]), key, year, years)
    last = F.lag(value).over(Window.partitionBy(key).orderBy(year))
    return panel.withColumn("previous", last).withColumn("delta", F.col(value) - F.col("previous"))


def region_lookup(df: DataFrame, group: str, regions: DataFrame) -> DataFrame:
    """``df`` with the columns of a (group, region) table; NULL for an unknown group.

    Few groups hold all rows, so this is a lookup join that spreads hot keys.
    """
    return lookup_join(df, regions, [group], "left", pin=True)
