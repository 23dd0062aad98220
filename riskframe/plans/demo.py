"""The operators bound to the star-schema test tables.

Entities are customers, units are their orders. A unit's label is whether its total price
reaches 250000 and its leaked score is that price. The yearly outcome of an entity is the
percentage of its present units with label 1; the target year is 2000.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.scalar import md5_number
from riskframe.operators.features import goal_features, ratio_features, size_features, spread_years
from riskframe.operators.joins import checked_join, enrich, lookup_join
from riskframe.operators.panel import region_lookup, relative_matrix
from riskframe.operators.roles import Roles, split_targets
from riskframe.plans.training import Task
from riskframe.sources.io import materialize, read_table, shared_folder

BASE_YEAR = 2000
CUT = 250_000
TARGETS = ["reached_2000", "outcome_2000", "gap_2000"]
DATED = ["units_2000"]
ROLES = Roles(
    forbidden=frozenset(
        ["unit_id", "entity_id", "entity_name", "raw_score", "status", *TARGETS, *DATED]
    ),
    categorical=("group_name", "region_name", "size_band", "hub", "network"),
    descriptive=("segment",),
    log_scaled=("population", "output", "n_sites", "va", "va_agro", "va_industry", "va_services", "balance"),
)
ENTITY_TASK = Task("entity_id", "reached_2000", "entity", ROLES, extra_drop=("group_code",), group="group_name")
UNIT_TASK = Task(
    "unit_id", "label", "unit", ROLES, extra_drop=("group_code",), entity="entity_id", entity_group="group_name"
)


# The latest plans are kept per session and folder, so that schemas are read once; no data is kept.
plan = lru_cache(maxsize=64)


@plan
def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    whole = table(spark, sf, name) if columns else None
    return whole.select(*columns) if columns else read_table(spark, f"{sf}/{name}.parquet")


def in_year(c: str, year: int) -> Column:
    """Date range of one year, in a form that reaches the scan."""
    return (F.col(c) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (
        F.col(c) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    )


@plan
def units(spark: SparkSession, sf: str, year: int | None = None) -> DataFrame:
    """All units, or those of one year, with label and leaked score."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate")
    return (orders.where(in_year("o_orderdate", year)) if year else orders).select(
        F.col("o_orderkey").alias("unit_id"),
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderpriority").alias("network"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("raw_score"),
        (F.col("o_totalprice") >= CUT).cast("int").alias("label"),
        F.year("o_orderdate").alias("yr"),
    )


@plan
def present_units(spark: SparkSession, sf: str) -> DataFrame:
    """Units that were present, with a label."""
    return units(spark, sf).where((F.col("status") != "P") & F.col("raw_score").isNotNull())


@plan
def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Present units with label ``y`` and a fixed score ``p`` on a grid of 1/1000, so ties occur."""
    noise = (md5_number(F.col("unit_id")) % 1000).cast("double")
    raw = F.lit(0.5) * F.least(F.col("raw_score") / F.lit(5e5), F.lit(1.0)) + F.lit(0.5) * noise / F.lit(1000.0)
    p = F.floor(raw * F.lit(1000.0) + F.lit(0.5)).cast("double") / F.lit(1000.0)
    return present_units(spark, sf).select("unit_id", "entity_id", "network", F.col("label").alias("y"), p.alias("p"))


@plan
def yearly(spark: SparkSession, sf: str, year: int | None = None) -> DataFrame:
    """Outcome per entity and year (or that year only), with unit counts."""
    here, one = F.col("status") != "P", lambda c: c.cast("long")
    return units(spark, sf, year).groupBy("entity_id", "yr").agg(
        (100 * F.avg(F.when(here, F.col("label").cast("double")))).alias("outcome"),
        F.sum(one(here)).alias("n_present"),
        F.count(F.lit(1)).alias("n_sites"),
        F.sum(one(F.col("status") == "F")).alias("n_rural"),
        F.sum(one(F.col("network") == "1-URGENT")).alias("n_private"),
        F.sum("raw_score").alias("output"),
        F.sum(F.when(F.col("network") == "1-URGENT", F.col("raw_score"))).alias("va_agro"),
        F.sum(F.when(F.col("network") == "2-HIGH", F.col("raw_score"))).alias("va_industry"),
    )


@plan
def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Long panel (entity_id, yr, outcome) of the years with present units."""
    return yearly(spark, sf).where(F.col("outcome").isNotNull()).select("entity_id", "yr", "outcome")


def goal(year: int) -> Column:
    return (F.lit(45) + F.col("entity_id") % 11 + F.lit(2 * (year - 1998))).cast("double")


@plan
def gold(spark: SparkSession, sf: str) -> DataFrame:
    """One row per entity: names, outcomes, goals, site counts up to 1999 and columns dated 2000."""
    customer = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    base = customer.select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity_name"),
        F.col("c_nationkey").alias("group_code"), F.col("c_mktsegment").alias("segment"),
    )
    until = lambda c, out: F.sum(F.when(F.col("yr") <= 1999, F.col(c))).alias(out)
    history = spread_years(
        yearly(spark, sf), "entity_id", "yr", (1998, 1999, 2000), {"outcome": F.col("outcome")},
        totals=[
            until("n_sites", "n_sites"), until("n_rural", "n_sites_rural"), until("n_private", "n_sites_private"),
            F.sum(F.when(F.col("yr") == 2000, F.col("n_present"))).alias("units_2000"),
        ],
    )
    out = checked_join(base, history, ["entity_id"], "left", "1:1")
    out = out.withColumns({f"goal_{y}": goal(y) for y in range(1999, 2004)})
    return out.withColumns(
        {
            "gap_2000": F.col("outcome_2000") - F.col("goal_2000"),
            "reached_2000": (F.col("outcome_2000") >= F.col("goal_2000")).cast("int"),
        }
    )


@plan
def groups(spark: SparkSession, sf: str) -> DataFrame:
    """(group_code, group_name, region_name)."""
    nation = table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf, "region", "r_regionkey", "r_name")
    named = region_lookup(nation.withColumnRenamed("n_regionkey", "r_regionkey"), "r_regionkey", region)
    return named.select(
        F.col("n_nationkey").alias("group_code"), F.col("n_name").alias("group_name"), F.col("r_name").alias("region_name")
    )


def external_slices(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Outside sources, each filtered to its year and unique on the entity."""
    in_1999 = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate").where(in_year("o_orderdate", 1999))
    # Lines of that year's orders, summed per order before they move: an order with very many is one row.
    wanted = in_1999.select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_quantity").join(wanted, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("items"), F.count(F.lit(1)).alias("lines")
    )
    size = (
        in_1999.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("entity_id"))
        .agg(F.sum("items").alias("items"), F.sum("lines").alias("lines"))
        .withColumn("population", F.col("items") * 1000)
    )
    output = yearly(spark, sf, 1999).select("entity_id", "output")
    sectors = yearly(spark, sf, 1998).select(
        "entity_id", F.col("output").alias("va"), "va_agro", "va_industry",
        (F.col("output") - F.coalesce("va_agro", F.lit(0.0)) - F.coalesce("va_industry", F.lit(0.0))).alias("va_services"),
    )
    customer = table(spark, sf, "customer", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    place = region_lookup(customer.withColumnRenamed("c_nationkey", "group_code"), "group_code", groups(spark, sf))
    profile = place.select(
        F.col("c_custkey").alias("entity_id"), F.col("c_acctbal").alias("balance"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("hub"), "group_name", "region_name",
    )
    return [size, output, sectors, profile]


@plan
def externals(spark: SparkSession, sf: str) -> DataFrame:
    """Outside sources per distinct entity key."""
    keys = table(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "entity_id")
    return enrich(keys, "entity_id", external_slices(spark, sf))


RATIOS = {
    "share_rural": ("n_sites_rural", "n_sites"),
    "share_private": ("n_sites_private", "n_sites"),
    "items_per_line": ("items", "lines"),
    "output_per_capita": ("output", "population"),
    "share_agro": ("va_agro", "va"),
}


@plan
def store(spark: SparkSession, sf: str) -> DataFrame:
    """Entity table with derived features, targets not yet taken out."""
    joined = checked_join(gold(spark, sf), externals(spark, sf), ["entity_id"], "left", "1:1")
    derived = goal_features(joined, 1999, horizon=2003)
    derived = ratio_features(derived, RATIOS)
    return size_features(derived, "population", "log_population", "size_band")


@plan
def saved_store(spark: SparkSession, sf: str) -> DataFrame:
    """The store written once per application to the shared folder and read back.

    Fits and profiles pass over it several times.
    """
    name = f"store-{md5(sf.encode()).hexdigest()[:8]}-{spark.sparkContext.applicationId}"
    return materialize(spark, lambda: store(spark, sf), f"{shared_folder(spark)}/riskframe/{name}")


@plan
def features_and_targets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return split_targets(saved_store(spark, sf), "entity_id", TARGETS, DATED, ROLES, allow=["entity_name"])


def features(spark: SparkSession, sf: str) -> DataFrame:
    return features_and_targets(spark, sf)[0]


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return features_and_targets(spark, sf)[1]


@plan
def matrix(spark: SparkSession, sf: str, t: int) -> DataFrame:
    """Relative matrix for target year ``t`` (2000 with label, 2001 for projection)."""
    feats, tgts = features_and_targets(spark, sf)
    return relative_matrix(feats, tgts, "entity_id", t, BASE_YEAR, ROLES, allow=["entity_name"])


@plan
def unit_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Present units with the context of their entity."""
    rows = present_units(spark, sf).select("unit_id", "entity_id", "network", "label")
    return checked_join(rows, features(spark, sf), ["entity_id"], "inner", "m:1")


@plan
def projected(spark: SparkSession, sf: str) -> DataFrame:
    """The projection matrix with a fixed risk on a grid of 1/1000 in place of a model's."""
    m = matrix(spark, sf, 2001)
    effort = F.least(F.greatest(F.coalesce("effort_t", F.lit(50.0)), F.lit(0.0)), F.lit(100.0)) / F.lit(100.0)
    noise = (md5_number(F.col("entity_id")) % 1000).cast("double")
    raw = F.lit(0.5) * effort + F.lit(0.5) * noise / F.lit(1000.0)
    risk = F.floor(raw * F.lit(1000.0) + F.lit(0.5)).cast("double") / F.lit(1000.0)
    return m.select(
        "entity_id", "entity_name", "group_name", risk.alias("risk"), F.col("goal_t").alias("goal"),
        F.col("outcome_t1").alias("last_outcome"), F.col("effort_t").alias("effort"),
        F.col("reached_t1").cast("int").alias("reached_last"),
    )


def with_group(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    """Rows with group and region of their entity."""
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey").toDF("entity_id", "group_code")
    return lookup_join(rows, region_lookup(customer, "group_code", groups(spark, sf)), ["entity_id"], "inner")

