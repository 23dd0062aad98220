"""Validated equi-joins that stay even under hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A lookup side is broadcast only after it was measured and found to hold at most this
# many rows and bytes; a bigger one is shuffled.
SMALL_ROWS = 50_000
SMALL_BYTES = 16 << 20
# Keys treated apart in a shuffled lookup join. The sketch tracks HOT_TRACKED keys.
HOT_KEYS = 256
HOT_TRACKED = 10_000


def small_table(spark: SparkSession, df: DataFrame, limit: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Computed copy of ``df`` if it has at most ``limit`` rows, else ``df`` itself.

    For narrow tables whose rows count groups, ranges or categories. The second value says
    whether the table was small, that is whether it may be broadcast.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, False
    return spark.createDataFrame(rows, df.schema), True


def is_small(df: DataFrame, limit: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> bool:
    """True if ``df`` has at most ``limit`` rows of ``most_bytes`` in all, measured in one aggregation."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= limit and total <= most_bytes


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], side: str = "table") -> DataFrame:
    """``df`` itself; the job that reads it fails if a key occurs twice.

    The check runs inside the plan: rows are numbered within their key, on the partitioning
    that a join or aggregation on the key needs anyway, so nothing is read twice.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    text = F.concat(F.lit(f"{side} is not unique on {list(keys)}: "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col("_place") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_place", place).where(unique).drop("_place")


def _common_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> dict[str, str]:
    """Types under which the two sides' keys are compared."""
    return dict(left.select(*on).unionByName(right.select(*on)).dtypes)


def key_hash(types: Mapping[str, str]) -> Column:
    """Hash that is equal wherever the keys join: same type, one zero."""
    parts = []
    for name, kind in types.items():
        c = F.col(name).cast(kind)
        parts.append(c + F.lit(0.0).cast(kind) if kind in ("double", "float") else c)
    return F.xxhash64(*parts)


def hot_key_hashes(df: DataFrame, types: Mapping[str, str], hot: int = HOT_KEYS, share: float | None = None) -> list[int]:
    """Hashes of the key values that hold at least ``share`` of the rows (by default half of a
    shuffle task's share), from one bounded sketch over the key columns."""
    share = share if share is not None else 0.5 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = df.select(key_hash(types).alias("h")).agg(
        F.expr(f"approx_top_k(h, {hot}, {HOT_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return [r["item"] for r in row["top"] if r["count"] >= share * row["n"]]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small_rows: int = SMALL_ROWS,
    pin: bool = False,
    nulls_match: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """m:1 join onto ``right``, which is unique on ``on`` (``how`` is left or inner).

    A small right side is broadcast. Otherwise the left rows of the most frequent keys
    meet a broadcast of just their lookup rows (one per key, so at most HOT_KEYS), and
    only the remaining, thinly spread keys are shuffled. Every row is kept either way.
    ``pin`` keeps the rows read for the size check, for a right side that is costly to
    compute and narrow. ``nulls_match`` lets NULL keys meet, as in a group table. ``measured``
    is a table of the same rows as the right side that is cheaper to measure.
    """
    on = list(on)
    if nulls_match:
        # Structs are equal where their NULL fields coincide.
        keyed = left.withColumn("_key", F.struct(*on))
        table = right.select(F.struct(*on).alias("_key"), *[c for c in right.columns if c not in on])
        return lookup_join(keyed, table, ["_key"], how, small_rows, pin).drop("_key")
    if pin:
        right, small = small_table(left.sparkSession, right, small_rows)
    else:
        small = is_small(right if measured is None else measured, small_rows)
    if small:
        return left.join(F.broadcast(right), on, how)
    types = _common_types(left, right, on)
    hot = hot_key_hashes(left, types)
    if not hot:
        return left.join(right, on, how)
    is_hot = key_hash(types).isin(hot)
    hot_rows = left.where(is_hot).join(F.broadcast(right.where(is_hot)), on, how)
    other_rows = left.where(~is_hot).join(right.where(~is_hot), on, how)
    return hot_rows.unionByName(other_rows)


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "1:1",
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Equi-join that fails where the promised cardinality ("1:1" or "m:1") does not hold."""
    if validate not in ("1:1", "m:1"):
        raise ValueError(f"unsupported cardinality: {validate}")
    unique = require_unique(right, on, "right side")
    if validate == "1:1":
        return require_unique(left, on, "left side").join(unique, list(on), how)
    return lookup_join(left, unique, on, how, small_rows, measured=right)


def side_by_side(*tables: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def join_drop_report(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: rows before and after an inner m:1 join, and the share dropped in percent."""
    keys = right.select(*on).distinct().withColumn("_met", F.lit(True))
    joined = lookup_join(left.select(*on), keys, on, "left", pin=True)
    before, after = F.count(F.lit(1)), F.count("_met")
    return joined.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (100 * (1 - F.try_divide(after, before))).alias("dropped_pct"),
    )


def enrich(base: DataFrame, key: str, slices: Sequence[DataFrame]) -> DataFrame:
    """Distinct keys of ``base`` with the columns of every slice left-joined on.

    Slices are already filtered and projected, and must be unique on the key.
    """
    out = base.select(key).distinct()
    for part in slices:
        out = out.join(require_unique(part, [key], "slice"), [key], "left")
    return out


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows with a value, one row (source, coverage) per column, in one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "source", "coverage")
