"""Columns that repeat what another column says: copies, copies with gaps, and monotone copies (a logarithm, a rank, a unit change).

Every pair of comparable columns is judged, but only pairs that a first look cannot rule out cost a pass: hashes of (key, value),
added up and combined by exclusive or in one aggregation for all columns, tell copies in any order of rows; the ``LOOK`` rows of
smallest key hash tell that a pair is neither equal nor monotone, since what holds on all rows holds on those. What is left is
confirmed on all rows, equality in one aggregation and order by average ranks, all pairs at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordered import average_ranks
from riskframe.operators.roles import numeric_columns

LOOK = 1_000
FOUND = "left_column string, right_column string, kind string, n_both long"


def column_prints(df: DataFrame, key: str, columns: Sequence[str]) -> dict[str, tuple]:
    """Print of each column's values by key: count, sum and exclusive or of hashes; one aggregation for all columns."""
    numeric = set(numeric_columns(df))
    value = lambda c: F.col(c).cast("double") + F.lit(0.0) if c in numeric else F.col(c).cast("string")
    seen = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(key, value(c)))
    parts = [F.struct(F.count(c), F.sum(seen(c).cast("decimal(38,0)")), F.bit_xor(seen(c))).alias(c) for c in columns]
    row = df.agg(*parts).first()
    return {c: (c in numeric, *row[c]) for c in columns}


def _may_be(a: pd.Series, b: pd.Series, ordered: bool) -> set[str]:
    """What the looked-at rows do not rule out: 'same', 'increasing', 'decreasing'."""
    both = a.notna() & b.notna()
    x, y = a[both].to_numpy(), b[both].to_numpy()
    kinds = {"same"} if (x == y).all() else set()
    if ordered and len(x):
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        up, tied = x[1:] > x[:-1], x[1:] == x[:-1]
        if (y[1:][tied] == y[:-1][tied]).all():
            kinds |= {"increasing"} if (y[1:][up] > y[:-1][up]).all() else set()
            kinds |= {"decreasing"} if (y[1:][up] < y[:-1][up]).all() else set()
    elif ordered:
        kinds |= {"increasing", "decreasing"}
    return kinds


def _candidates(df: DataFrame, key: str, columns: Sequence[str]) -> dict[tuple[str, str], set[str]]:
    numeric = set(numeric_columns(df))
    looked = df.select(*[F.col(c).cast("double" if c in numeric else "string").alias(c) for c in columns], F.xxhash64(key).alias("_h"))
    rows = looked.orderBy("_h").limit(LOOK).toPandas()
    pairs = [(a, b) for a, b in combinations(columns, 2) if (a in numeric) == (b in numeric)]
    found = {(a, b): _may_be(rows[a], rows[b], a in numeric) for a, b in pairs}
    return {p: kinds for p, kinds in found.items() if kinds}


def _equality(df: DataFrame, pairs: Sequence[tuple[str, str]], numeric: set[str]) -> dict[tuple[str, str], tuple[int, int, int]]:
    """For each pair: rows where both are present, where they then differ, and where only one is present."""
    if not pairs:
        return {}
    as_one = lambda c: F.col(c).cast("double") if c in numeric else F.col(c).cast("string")
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    counts = [
        F.struct(F.count_if(both(a, b)), F.count_if(both(a, b) & (as_one(a) != as_one(b))), F.count_if(F.col(a).isNull() != F.col(b).isNull())).alias(f"_{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    return dict(zip(pairs, map(tuple, df.agg(*counts).first())))


def _order(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """The pairs whose average ranks agree on all rows where both are present ('increasing'), or are opposite ('decreasing')."""
    if not pairs:
        return {}
    told = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")) for i, (a, b) in enumerate(pairs)])
    long = df.select(F.inline(told)).where(F.col("a").isNotNull() & F.col("b").isNotNull()).checkpoint()
    met = long.distinct()
    left = average_ranks(long, "a", ["pair"], "ra").drop("ra_of")
    right = average_ranks(long, "b", ["pair"], "rb")
    ranked = met.join(left, ["pair", "a"]).join(right, ["pair", "b"])
    same, opposite = F.bool_and(F.col("ra") == F.col("rb")), F.bool_and(F.col("ra") + F.col("rb") == F.col("rb_of") + 1)
    rows = ranked.groupBy("pair").agg(F.count(F.lit(1)).alias("values"), same.alias("same"), opposite.alias("opposite")).where("values > 1 AND (same OR opposite)")
    return {pairs[r["pair"]]: "increasing" if r["same"] else "decreasing" for r in rows.collect()}


def duplicate_columns(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (left_column, right_column, kind, n_both) of pairs of columns that repeat each other, in the order of the columns.

    ``kind`` is 'copy' (equal in every row, NULL with NULL), 'copy_where_present' (equal wherever both are present, but not
    missing together), or 'increasing' / 'decreasing' (one is a strictly monotone function of the other where both are present).
    The first that holds is told. Pairs that are never present together, and order among fewer than two values, are no evidence.
    Columns are compared as numbers or as text; a number is not compared with a text.
    """
    columns = [c for c in (columns or df.columns) if c != key]
    numeric = set(numeric_columns(df))
    prints = column_prints(df, key, columns)
    copies = {(a, b) for a, b in combinations(columns, 2) if prints[a] == prints[b]}
    maybe = _candidates(df, key, columns)
    equal = _equality(df, [p for p, kinds in maybe.items() if "same" in kinds or p in copies], numeric)
    kinds: dict[tuple[str, str], tuple[str, int]] = {}
    for pair, (both, differ, single) in equal.items():
        if both and not differ:
            kinds[pair] = ("copy_where_present" if single else "copy", both)
    open_ = [p for p, found in maybe.items() if p not in kinds and found & {"increasing", "decreasing"}]
    ordered = _order(df, open_)
    both = _equality(df, list(ordered), numeric)
    kinds |= {p: (kind, both[p][0]) for p, kind in ordered.items()}
    rows = [(*p, *kinds[p]) for p in combinations(columns, 2) if p in kinds]
    return df.sparkSession.createDataFrame(rows, FOUND)
