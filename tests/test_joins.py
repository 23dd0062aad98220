import pytest
from pyspark.sql import functions as F

from riskframe.operators import joins as J
from riskframe.operators.panel import yoy_delta


@pytest.fixture(scope="module")
def fact(spark):
    """1000 rows, 40 % on key 0, some on no key, some unmatched."""
    key = F.when(F.col("id") % 10 < 4, F.lit(0)).when(F.col("id") % 10 == 4, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(1000).select("id", key.cast("long").alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("pin", [True, False])
def test_lookup_join_gives_the_same_rows_on_every_path(fact, dim, how, pin):
    want = sorted(map(str, fact.join(dim, ["k"], how).collect()))
    small = J.lookup_join(fact, dim, ["k"], how, pin=pin)
    shuffled = J.lookup_join(fact, dim, ["k"], how, small_rows=5, pin=pin)
    assert sorted(map(str, small.collect())) == want
    assert sorted(map(str, shuffled.collect())) == want


def test_hot_keys_found(fact):
    types = {"k": "bigint"}
    zero = fact.where("k = 0").select(J.key_hash(types).alias("h")).first()["h"]
    assert zero in J.hot_key_hashes(fact, types, hot=3)


def test_hot_keys_of_other_types_still_meet(fact, dim):
    """Keys of another width, and negative zero, must not be lost between hot and other rows."""
    narrow = fact.withColumn("k", F.col("k").cast("int"))
    assert J.lookup_join(narrow, dim, ["k"], "inner", small_rows=5).count() == fact.join(dim, ["k"]).count()
    signed = fact.withColumn("k", F.when(F.col("id") % 2 == 0, -F.col("k").cast("double")).otherwise(F.col("k").cast("double")))
    wide = dim.withColumn("k", F.col("k").cast("double"))
    assert J.lookup_join(signed, wide, ["k"], "inner", small_rows=5).count() == signed.join(wide, ["k"]).count()


def test_checked_join_fails_on_repeated_keys(fact, dim):
    twice = dim.unionByName(dim.where("k = 3"))
    with pytest.raises(Exception, match="right side is not unique"):
        J.checked_join(fact, twice, ["k"], "inner", "m:1").collect()
    with pytest.raises(Exception, match="left side is not unique"):
        J.checked_join(fact, dim, ["k"], "inner", "1:1").collect()
    with pytest.raises(ValueError):
        J.checked_join(fact, dim, ["k"], "inner", "1:m")


def test_unique_check_costs_no_second_exchange(fact, dim):
    grouped = fact.groupBy("k").count()
    plan = J.require_unique(grouped, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_drop_report(fact, dim):
    r = J.join_drop_report(fact, dim, ["k"]).first()
    kept = fact.join(dim, ["k"]).count()
    assert (r["rows_before"], r["rows_after"]) == (1000, kept)
    assert r["dropped_pct"] == pytest.approx(100 * (1 - kept / 1000))


def test_duplicate_keys(dim):
    assert J.duplicate_keys(dim, ["k"]).count() == 0
    assert J.duplicate_keys(dim.unionByName(dim.where("k = 3")), ["k"]).first()["n"] == 2


def test_enrich_and_coverage(spark, dim):
    base = spark.createDataFrame([(1,), (1,), (99,)], "k long")
    out = J.enrich(base, "k", [dim.where("k < 10")])
    assert out.count() == 2
    assert J.coverage(out, ["v"]).first()["coverage"] == 0.5


def test_small_table_reports_size(spark, dim):
    assert J.small_table(spark, dim, 40)[1]
    assert not J.small_table(spark, dim, 39)[1]


def test_delta_needs_the_year_before(spark):
    df = spark.createDataFrame([(1, 2000, 5.0), (1, 2002, 9.0)], "k long, yr int, x double")
    rows = {r["yr"]: r["delta"] for r in yoy_delta(df, "k", "yr", "x", [2000, 2001, 2002]).collect()}
    assert rows == {2000: None, 2001: None, 2002: None}


def test_foreign_years_raise(spark):
    df = spark.createDataFrame([(1, 1994, 5.0), (1, 1995, 9.0)], "k long, yr int, x double")
    with pytest.raises(Exception, match="yr outside the panel's years: 1994"):
        yoy_delta(df, "k", "yr", "x", [1995, 1996]).collect()


def test_size_is_measured_in_rows_and_bytes(spark):
    df = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert J.is_small(df) and not J.is_small(df, limit=9) and not J.is_small(df, most_bytes=5_000)
    plan = df.agg(F.sum(F.octet_length(F.to_json(F.struct("id", "t")))))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_even_keys_are_not_hot(spark):
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert J.hot_key_hashes(even, {"k": "bigint"}) == []
    third = even.unionByName(spark.range(5_000).select(F.lit(7).cast("long").alias("k")))
    assert len(J.hot_key_hashes(third, {"k": "bigint"})) == 1
