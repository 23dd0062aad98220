"""Reproducible samples, holdouts and folds.

A row's place is the md5 of seed and key, so a result depends on nothing but the data and
the seed. The key names one row. Hash prefixes cut the order into equal ranges whatever
the keys look like, so no stratum, however large, is ordered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.joins import lookup_join

STRATUM, HASH, RANGE = "_stratum", "_hash", "_range"
# Rows of a hash range, about: a stratum has as many ranges as its table needs.
RANGE_ROWS = 50_000


def hash_of(seed: int | str, key: Column | str) -> Column:
    """Text hash that orders rows: md5 of ``seed:key``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def stratum_of(by: Sequence[str]) -> Column:
    """One non-NULL text per stratum; a NULL part is its own stratum."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by]
    return F.concat_ws("\u0001", *parts) if parts else F.lit("")


def range_digits(rows: int) -> int:
    """Hash digits that cut that many rows into ranges of at most RANGE_ROWS or so."""
    digits = 1
    while 16**digits * RANGE_ROWS < rows:
        digits += 1
    return digits


def _with_place(df: DataFrame, key: str, seed: int | str, by: Sequence[str]) -> DataFrame:
    digits = range_digits(df.select(key).count())
    return df.withColumns({STRATUM: stratum_of(by), HASH: hash_of(seed, key)}).withColumn(
        RANGE, F.substring(HASH, 1, digits)
    )


def _range_starts(placed: DataFrame) -> DataFrame:
    """Per (stratum, hash range): rows, rows before it, and rows of the stratum."""
    stratum = Window.partitionBy(STRATUM)
    earlier = stratum.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.groupBy(STRATUM, RANGE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(stratum))
    )


def hash_rank(df: DataFrame, key: str, seed: int | str, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """``df`` with each row's 1-based place in the hash order of its stratum."""
    placed = _with_place(df, key, seed, by)
    starts = _range_starts(placed).select(STRATUM, RANGE, "_start")
    local = F.row_number().over(Window.partitionBy(STRATUM, RANGE).orderBy(HASH, key))
    ranked = placed.withColumn("_local", local).join(starts, [STRATUM, RANGE])
    return ranked.withColumn(out, F.col("_start") + F.col("_local")).drop(
        STRATUM, RANGE, HASH, "_local", "_start"
    )


def first_by_hash(
    df: DataFrame,
    key: str,
    take: Callable[[Column], Column],
    seed: int | str,
    by: Sequence[str] = (),
    out: str = "taken",
) -> DataFrame:
    """``df`` with a flag on the first ``take(stratum size)`` rows of each stratum.

    Only counts per hash range and the one range in which the cut falls are shuffled; the
    cut then is a (hash, key) pair per stratum against which every row is compared, so the
    full rows never move.
    """
    placed = _with_place(df, key, seed, by)
    narrow = placed.select(STRATUM, RANGE, HASH, key)
    wanted = (
        _range_starts(narrow)
        .withColumn("_take", F.least(take(F.col("_total")).cast("long"), F.col("_total")))
        .where((F.col("_start") < F.col("_take")) & (F.col("_take") <= F.col("_start") + F.col("_n")))
        .select(STRATUM, RANGE, (F.col("_take") - F.col("_start")).alias("_place"))
    )
    order = Window.partitionBy(STRATUM).orderBy(HASH, key)
    cuts = (
        lookup_join(narrow, wanted, [STRATUM, RANGE], "inner", pin=True)
        .withColumn("_local", F.row_number().over(order))
        .where(F.col("_local") == F.col("_place"))
        .select(STRATUM, F.col(HASH).alias("_cut_hash"), F.col(key).alias("_cut_key"))
    )
    at_or_before = (F.col(HASH) < F.col("_cut_hash")) | (
        (F.col(HASH) == F.col("_cut_hash")) & (F.col(key) <= F.col("_cut_key"))
    )
    flagged = lookup_join(placed, cuts, [STRATUM], "left", pin=True)
    return flagged.withColumn(out, F.coalesce(at_or_before, F.lit(False))).drop(
        STRATUM, RANGE, HASH, "_cut_hash", "_cut_key"
    )


def labelled_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.na.drop(subset=list(columns))


def stratified_holdout(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42, out: str = "split"
) -> DataFrame:
    """``df`` (rows without a label dropped) with 'train' or 'test', balanced over the label."""
    flagged = first_by_hash(
        labelled_only(df, [label]), key, lambda n: F.round(n * F.lit(test_share)), seed, [label], "_test"
    )
    return flagged.withColumn(out, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def split_summary(df: DataFrame, split: str, label: str) -> DataFrame:
    """Rows and positive share per part."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate")
    )


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """``df`` with a fold number 0..k-1, each class dealt out evenly."""
    ranked = hash_rank(df, key, seed, [label], "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def group_folds(df: DataFrame, group: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """One row (group, n, fold) per non-NULL group: groups by falling size, dealt back and forth.

    Sizes are ordered among themselves and groups of one size by hash, so the group table
    is never ordered as a whole.
    """
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    # Distinct sizes: sizes that differ add up to at most the row count, so there are at
    # most sqrt(2 * rows) of them.
    larger = Window.partitionBy(F.lit(0)).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.groupBy("n").agg(F.count(F.lit(1)).alias("_groups")).select(
        "n", F.coalesce(F.sum("_groups").over(larger), F.lit(0)).alias("_before")
    )
    ranked = hash_rank(sizes, group, seed, ["n"], "_rank")
    placed = lookup_join(ranked, starts, ["n"], "inner", pin=True)
    place = F.col("_before") + F.col("_rank") - 1
    step, lap = F.pmod(place, F.lit(k)), F.floor(place / F.lit(k))
    fold = F.when(lap % 2 == 0, step).otherwise(F.lit(k - 1) - step)
    return placed.select(group, "n", fold.cast("int").alias(out))


def with_group_folds(df: DataFrame, group: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """``df`` with the fold of its group; rows without a group are left out."""
    return lookup_join(df, group_folds(df, group, k, seed, out).drop("n"), [group], "inner")


def fold_group_overlap(df: DataFrame, group: str, fold: str) -> DataFrame:
    """Groups found in more than one fold; empty when the folds are sound."""
    spread = df.groupBy(group).agg(
        (F.max(fold) != F.min(fold)).alias("_split"), F.min(fold).alias("min_fold"), F.max(fold).alias("max_fold")
    )
    return spread.where("_split").drop("_split")


def stratified_sample(
    df: DataFrame, key: str, n: int, strata: Sequence[str], seed: int = 42, keep_null_strata: bool = True
) -> DataFrame:
    """About ``n`` rows, the same share from every stratum; all rows if there are no more."""
    total = df.count()
    if n >= total:
        return df
    if not keep_null_strata:
        df = labelled_only(df, strata)
    share = n / total
    flagged = first_by_hash(df, key, lambda size: F.round(size * F.lit(share)), seed, strata, "_taken")
    return flagged.where("_taken").drop("_taken")


def subsample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the first in hash order."""
    return first_by_hash(df, key, lambda _: F.lit(n), seed, (), "_taken").where("_taken").drop("_taken")
