"""Data profiling: rates, correlations, variance shares, distributions and quality gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.joins import lookup_join, side_by_side
from riskframe.operators.ordered import (
    column_quantiles, companion_ranks, default_buckets, group_cuts, quantiles, unpivot_numeric,
)


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over complete pairs; NULL where a side is constant."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = a.isNotNull() & b.isNotNull()
    u, v = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(u, v), F.stddev_pop(u) * F.stddev_pop(v))


def rate_by(df: DataFrame, keys: Sequence[str], label: str, out: str = "rate") -> DataFrame:
    """Rows and mean of a 0/1 (or any numeric) column per key; NULL labels do not count."""
    return df.groupBy(*keys).agg(
        F.count(label).alias("n"), F.avg(F.col(label).cast("double")).alias(out)
    )


def mean_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of several columns per key."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def medians_by(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group with the exact median of each column."""
    long = column_quantiles(df, columns, [0.5], by)
    return long.groupBy(*by).pivot("feature", list(columns)).agg(F.max("quantile"))


def describe_by(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a column per group."""
    x = F.col(column).cast("double")
    basic = df.groupBy(*by).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"),
    )
    cuts = quantiles(df, column, [0.25, 0.5, 0.75], by)
    wide = cuts.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(name)
            for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    wide = wide.select(*[F.col(k).alias(f"_{k}") for k in by], "q25", "q50", "q75")
    met = F.lit(True)
    for k in by:
        met = met & basic[k].eqNullSafe(wide[f"_{k}"])
    return basic.join(wide, met, "left").select(
        *by, "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def box_stats(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Quartiles, the outermost values within 1.5 quartile distances, and outliers per group."""
    cuts = describe_by(df, by, column).select(*by, "q25", "q50", "q75")
    x, reach = F.col(column), 1.5 * (F.col("q75") - F.col("q25"))
    inside = (x >= F.col("q25") - reach) & (x <= F.col("q75") + reach)
    seen = lookup_join(df.select(*by, column).where(x.isNotNull()), cuts, by, "inner", pin=True, nulls_match=True)
    return seen.groupBy(*by).agg(
        F.first("q25").alias("q25"), F.first("q50").alias("q50"), F.first("q75").alias("q75"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outliers"),
    )


def missingness(df: DataFrame) -> DataFrame:
    """Columns with missing values and their missing share, in one pass over the table."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], list(df.columns), "feature", "missing").where("missing > 0")


def listed_values(df: DataFrame, column: str, limit: int = 1_000) -> list:
    """Distinct non-NULL values in order; ValueError if there are more than a table can have columns."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    return sorted(r[0] for r in rows)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Row counts per (row, column value), one column per listed value, 0 where empty."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0, list(values))


def spearman_pairs(long: DataFrame, by: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Spearman correlation of x and y per group over complete pairs, mean ranks on ties.

    Equal pairs are counted first. Each pair carries its other side along while a side is
    ranked, so no join on a value is needed and a hot value stays spread over many tasks.
    """
    # One struct column, so that NULL groups are a group.
    group = ["_g"]
    base = long.withColumn("_g", F.struct(*by) if by else F.struct(F.lit(0)))
    pairs = (
        base.select(*group, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    )
    counted = pairs.groupBy(*group, "_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
    ranked = companion_ranks(counted, ["_x", "_y"], group, "_n", group_cuts(pairs, ["_x", "_y"], group, default_buckets(pairs)))
    # The mean of n ranks is (n + 1) / 2 whatever the ties; centring by it keeps digits that
    # raw products of large ranks would lose.
    middle = (F.col("_of") + 1) / 2
    dx, dy = F.col("_x_rank") - middle, F.col("_y_rank") - middle
    out = ranked.groupBy(*group).agg(
        F.first("_of").alias("n"),
        F.try_divide(
            F.sum(F.col("_n") * dx * dy),
            F.sqrt(F.sum(F.col("_n") * dx * dx)) * F.sqrt(F.sum(F.col("_n") * dy * dy)),
        ).alias("rho"),
    )
    return out.select(*[F.col("_g")[b].alias(b) for b in by], "n", "rho")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, rho) for two columns."""
    return spearman_pairs(df, [], x, y)


def spearman_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Spearman correlation of every column with the target: rows (feature, n, rho), one job."""
    long = unpivot_numeric(df, columns, [target])
    return spearman_pairs(long, ["feature"], "value", target)


def strongest(correlations: DataFrame, n: int = 18) -> DataFrame:
    """The ``n`` features of greatest absolute correlation."""
    return correlations.orderBy(F.desc_nulls_last(F.abs("rho")), "feature").limit(n)


def icc(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: share of variance between groups (one-way ANOVA), with its mean squares."""
    x = F.col(value).cast("double")
    groups = df.where(x.isNotNull()).groupBy(group).agg(
        F.count(x).alias("n"), F.avg(x).alias("m"), F.coalesce(F.var_samp(x), F.lit(0.0)).alias("v")
    )
    # Group means are centred on the grand mean before squaring: values far from zero keep their digits.
    grand = groups.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand")).scalar()
    off = F.col("m") - F.col("grand")
    sums = groups.withColumn("grand", grand).agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("total"), F.sum(F.col("n") * off * off).alias("between"),
        F.sum((F.col("n") - 1) * F.col("v")).alias("within"),
    )
    between = F.col("between")
    means = sums.select(
        F.col("g").alias("n_groups"), F.col("total").alias("n"),
        (F.col("total") / F.col("g")).alias("mean_size"),
        F.try_divide(between, F.col("g") - 1).alias("msb"),
        F.try_divide(F.col("within"), F.col("total") - F.col("g")).alias("msw"),
    )
    share = F.try_divide(
        F.col("msb") - F.col("msw"), F.col("msb") + (F.col("mean_size") - 1) * F.col("msw")
    )
    return means.withColumn("icc", share)


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Row counts in equal-width bins over the column's range: rows (by, bin, n), empty bins included.

    The range is that of all rows, or of each group when grouped; the last bin is closed. Without
    values there are no bins.
    """
    x = F.col(column).cast("double")
    rows = df.select(*by, x.alias("_x")).where(x.isNotNull())
    ends = rows.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    if by:
        ranged = lookup_join(rows, ends, by, "inner", pin=True, nulls_match=True)
    else:
        ranged = rows.withColumns({c: ends.select(c).scalar() for c in ("_lo", "_hi")})
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width)), F.lit(0))
    binned = ranged.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    # A group has at most ``bins`` rows here: they become one row and are spread over all bins.
    held = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    spread = held.where(F.size("_n") > 0).select(*by, "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spread.select(*by, "bin", F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).cast("long").alias("n"))


def quantile_band(df: DataFrame, column: str, bands: int = 5, out: str = "band") -> DataFrame:
    """``df`` with 1..bands by quantile of the column; bands are closed on the right.

    NULL outside the column's values. Equal edges merge, so there may be fewer bands.
    """
    probs = [i / bands for i in range(bands + 1)]
    edges = sorted({r["quantile"] for r in quantiles(df, column, probs).select("quantile").collect()})
    x = F.col(column)
    band = F.when(x.isNull(), F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:-1], start=1):
        band = band.when(x <= F.lit(edge), F.lit(i))
    return df.withColumn(out, band.otherwise(F.lit(max(1, len(edges) - 1))))


def rate_by_quantile(df: DataFrame, column: str, label: str, bands: int = 5) -> DataFrame:
    """Rate of the label per quantile band of a context column."""
    banded = quantile_band(df, column, bands).where(F.col("band").isNotNull())
    return rate_by(banded, ["band"], label)


def entity_aggregate(scored: DataFrame, entity: str, group: str, y: str = "y", p: str = "p") -> DataFrame:
    """Per entity: group, rows, observed and predicted rate, and their difference."""
    agg = scored.groupBy(entity).agg(
        F.min(group).alias(group), F.count(F.lit(1)).alias("n"),
        F.avg(F.col(y).cast("double")).alias("observed"), F.avg(p).alias("predicted"),
    )
    return agg.withColumn("error", F.col("predicted") - F.col("observed"))


def entity_correlations(agg: DataFrame, min_rows: int = 30) -> DataFrame:
    """One row: agreement of predicted and observed rates, over all entities and the larger ones."""
    large = F.col("n") >= min_rows
    only_large = lambda c: F.when(large, F.col(c))
    n_large = F.sum(large.cast("long"))
    linear = agg.agg(
        F.count(F.lit(1)).alias("n_entities"), n_large.alias("n_large"),
        correlation("predicted", "observed").alias("pearson"),
        F.when(n_large > 2, correlation(only_large("predicted"), only_large("observed"))).alias("pearson_large"),
        F.avg(F.abs("error")).alias("mae"), F.avg("error").alias("mean_error"),
    )
    ranked = spearman(agg, "predicted", "observed").select(F.col("rho").alias("spearman"))
    return side_by_side(linear, ranked)


def quality_gates(
    df: DataFrame,
    key: str,
    covered: Sequence[str] = (),
    min_coverage: float = 0.98,
    median_between: Mapping[str, tuple[float, float]] | None = None,
    p99_at_most: Mapping[str, float] | None = None,
    identities: Mapping[str, tuple[Column, float]] | None = None,
    domains: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows (check, value, passed): unique grain, null columns, coverage, scale, identities, domains.

    Every check but the quantile bounds is one aggregate in a single pass.
    """
    median_between, p99_at_most = median_between or {}, p99_at_most or {}
    identities, domains = identities or {}, domains or {}
    aggs: dict[str, Column] = {}
    for c in df.columns:
        aggs[f"filled:{c}"] = F.count(c).cast("double")
    for c in covered:
        aggs[f"coverage:{c}"] = F.avg(F.col(c).isNotNull().cast("double"))
    for name, (gap, _) in identities.items():
        aggs[f"identity:{name}"] = F.coalesce(F.max(F.abs(gap)), F.lit(0.0))
    for c, allowed in domains.items():
        aggs[f"domain:{c}"] = F.sum((~F.coalesce(F.col(c).isin(*allowed), F.lit(False))).cast("double"))
    one_pass = df.agg(*[v.alias(f"_a{i}") for i, v in enumerate(aggs.values())]).first()
    got = dict(zip(aggs, one_pass))
    repeated = df.groupBy(key).count().where("count > 1").count()

    rows = [("unique_grain", float(repeated), repeated == 0)]
    empty = sum(1 for c in df.columns if got[f"filled:{c}"] == 0)
    rows.append(("all_null_columns", float(empty), empty == 0))
    rows += [(f"coverage:{c}", got[f"coverage:{c}"], got[f"coverage:{c}"] >= min_coverage) for c in covered]
    bounded = [*median_between, *p99_at_most]
    cuts = {}
    if bounded:
        table = column_quantiles(df, list(dict.fromkeys(bounded)), [0.5, 0.99])
        cuts = {(r["feature"], r["prob"]): r["quantile"] for r in table.collect()}
    for c, (low, high) in median_between.items():
        mid = cuts.get((c, 0.5))
        rows.append((f"median:{c}", mid, mid is not None and low < mid < high))
    for c, bound in p99_at_most.items():
        top = cuts.get((c, 0.99))
        rows.append((f"p99:{c}", top, top is not None and top <= bound))
    rows += [(f"identity:{k}", got[f"identity:{k}"], got[f"identity:{k}"] < tol) for k, (_, tol) in identities.items()]
    rows += [(f"domain:{c}", got[f"domain:{c}"], got[f"domain:{c}"] == 0) for c in domains]
    return df.sparkSession.createDataFrame(rows, "check string, value double, passed boolean")
