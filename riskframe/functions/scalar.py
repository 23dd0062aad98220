"""Scalar expressions. Columns in, columns out, NULL wherever an input is NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds (inclusive) and names of the population bands.
SIZE_BOUNDS = [5_000, 20_000, 100_000, 500_000]
SIZE_BANDS = ["pequeno_1", "pequeno_2", "medio", "grande", "metropole"]

# Two-digit state codes of each macro-region.
REGION_CODES = {
    "N": ["11", "12", "13", "14", "15", "16", "17"],
    "NE": ["21", "22", "23", "24", "25", "26", "27", "28", "29"],
    "CO": ["50", "51", "52", "53"],
    "SE": ["31", "32", "33", "35"],
    "S": ["41", "42", "43"],
}

# Names of the network codes.
NETWORK_NAMES = {1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (NaN compares as the largest number)."""
    fix = {c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(fix) if fix else df


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; NULL over a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def symlog(c: Column | str) -> Column:
    """sign(x) * ln(1 + |x|): log scale for counts that may be negative."""
    x = _col(c).cast("double")
    return F.signum(x) * F.log1p(F.abs(x))


def size_band(
    c: Column | str,
    bounds: Sequence[float] = SIZE_BOUNDS,
    names: Sequence[str] = SIZE_BANDS,
) -> Column:
    """Band name of a positive size; bands are closed on the right. NULL at or below zero."""
    x = _col(c)
    band = F.when(x <= 0, F.lit(None).cast("string"))
    for bound, name in zip(bounds, names):
        band = band.when(x <= bound, name)
    return band.when(x.isNotNull(), names[-1])


def band_rank(c: Column | str, names: Sequence[str] = SIZE_BANDS) -> Column:
    """Place of a band name in its order, for sorting."""
    return lookup(c, {n: i for i, n in enumerate(names)})


def lookup(c: Column | str, table: Mapping) -> Column:
    """Value of ``table`` under the column's value; NULL for an unknown key."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(pairs, _col(c))


def padded_code(c: Column | str, width: int = 2) -> Column:
    """Integer code as text, zero-filled on the left."""
    return F.lpad(_col(c).cast("int").cast("string"), width, "0")


def region_of(code: Column | str, regions: Mapping[str, Sequence[str]] = REGION_CODES) -> Column:
    """Region that lists the two-digit code; NULL if none does."""
    return lookup(padded_code(code), {k: r for r, codes in regions.items() for k in codes})


def reached(value: Column | str, goal: Column | str, null_as_false: bool = False) -> Column:
    """1.0 where ``value >= goal``, 0.0 where not; NULL (or 0.0 on request) where unknown."""
    flag = (_col(value) >= _col(goal)).cast("double")
    return F.coalesce(flag, F.lit(0.0)) if null_as_false else flag


def decide(p: Column | str, threshold: float = 0.5) -> Column:
    """1 where the score reaches the threshold, else 0."""
    return (_col(p) >= F.lit(float(threshold))).cast("int")


def md5_number(c: Column) -> Column:
    """First 32 bits of the md5 of the value's text, as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def in_hash_sample(key: Column | str, modulus: int = 20) -> Column:
    """True for the fixed 1-in-``modulus`` sample of keys chosen by hash."""
    return md5_number(_col(key)) % modulus == 0


def segment_name(level_is_high: Column, rural_share: Column | str, size: Column | str) -> Column:
    """Name of a segment from its level, rurality and size.

    The words and the limits 0.5, 100000 and 20000 are fixed values.
    """
    level = F.when(level_is_high, "alto desempenho").otherwise("baixo desempenho")
    rural = F.when(_col(rural_share) >= 0.5, "rural").otherwise("urbano")
    mass = (
        F.when(_col(size) >= 100_000, "grande").when(_col(size) >= 20_000, "médio").otherwise("pequeno")
    )
    return F.concat_ws(" ", level, rural, mass)
