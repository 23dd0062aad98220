"""Entity feature store: goals, ratios, sizes and places as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import ratio, reached, size_band


def goal_features(
    df: DataFrame, year: int, outcome: str = "outcome", goal: str = "goal", horizon: int | None = None
) -> DataFrame:
    """History and goal columns around ``year``, from columns named ``outcome_<year>`` etc.

    ``delta`` is the change over the last year, ``gap`` the distance to this year's goal,
    ``reached`` whether it was met, ``effort`` the way to next year's goal and ``ambition``
    the way to the goal of ``horizon``.
    """
    now, last = F.col(f"{outcome}_{year}"), F.col(f"{outcome}_{year - 1}")
    derived = {
        f"delta_{year - 1}_{year}": now - last,
        f"gap_{year}": now - F.col(f"{goal}_{year}"),
        f"reached_{year}": reached(now, F.col(f"{goal}_{year}")),
        f"effort_{year + 1}": F.col(f"{goal}_{year + 1}") - now,
    }
    if horizon is not None:
        derived[f"ambition_{horizon}"] = F.col(f"{goal}_{horizon}") - now
    return df.withColumns(derived)


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Quotients ``name: (numerator, denominator)``; NULL over zero."""
    return df.withColumns({name: ratio(a, b) for name, (a, b) in ratios.items()})


def size_features(df: DataFrame, size: str, log_name: str, band_name: str) -> DataFrame:
    """Log of a size and its band."""
    return df.withColumns({log_name: F.log1p(F.col(size).cast("double")), band_name: size_band(size)})


def spread_years(
    long: DataFrame, key: str, year: str, years: Sequence[int], columns: Mapping[str, Column],
    totals: Sequence[Column] = (),
) -> DataFrame:
    """Long yearly table to one row per key with ``<name>_<year>`` columns, and totals over years.

    The (key, year) pairs are unique. One aggregation, so one shuffle for any number of
    years; a year without a row gives NULL.
    """
    wide = [
        F.max(F.when(F.col(year) == y, value)).alias(f"{name}_{y}")
        for name, value in columns.items()
        for y in years
    ]
    return long.groupBy(key).agg(*wide, *totals)
