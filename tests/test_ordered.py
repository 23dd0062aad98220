"""Order statistics against brute force, with ties, hot values and hot groups."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from riskframe.operators import ordered as O
from riskframe.operators.profile import medians_by, spearman, spearman_pairs


@pytest.fixture(scope="module")
def skewed():
    """3000 rows; a third in one group, and in it most rows share one value."""
    rng = np.random.default_rng(7)
    group = np.where(rng.random(3000) < 0.4, "hot", rng.choice(list("abc"), 3000))
    value = np.round(rng.normal(size=3000), 2)
    value[(group == "hot") & (rng.random(3000) < 0.8)] = 0.5
    return pd.DataFrame({"g": group, "v": value, "w": rng.integers(0, 5, 3000)})


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_running_totals(spark, skewed, buckets):
    got = O.running_totals(spark.createDataFrame(skewed), "v", ["w"], ["g"], buckets).toPandas()
    want = skewed.groupby(["g", "v"])["w"].sum().reset_index()
    want["w_upto"] = want.groupby("g")["w"].cumsum()
    want["w_all"] = want.groupby("g")["w"].transform("sum")
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_running_totals_null_group(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 1), ("a", 1.0, 1)], "g string, v double, w long")
    rows = {(r["g"], r["v"]): r["w_upto"] for r in O.running_totals(df, "v", ["w"], ["g"]).collect()}
    assert rows == {(None, 1.0): 1, (None, 2.0): 2, ("a", 1.0): 1}


@pytest.mark.parametrize("buckets", [2, 9, 256])
def test_quantiles(spark, skewed, buckets):
    probs = [0.0, 0.005, 0.25, 0.5, 0.77, 1.0]
    got = O.quantiles(spark.createDataFrame(skewed), "v", probs, ["g"], buckets).collect()
    assert len(got) == 4 * len(probs)
    for r in got:
        want = np.quantile(skewed.loc[skewed["g"] == r["g"], "v"], r["prob"])
        assert r["quantile"] == pytest.approx(want, abs=1e-12)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert [r["quantile"] for r in O.quantiles(df, "v", [0.5]).collect()] == [2.0]


def test_medians_of_many_columns(spark, skewed):
    got = medians_by(spark.createDataFrame(skewed), ["g"], ["v", "w"]).toPandas().set_index("g").sort_index()
    pd.testing.assert_frame_equal(got[["v", "w"]], skewed.groupby("g")[["v", "w"]].median().astype(float), check_like=True)


def test_average_ranks(spark, skewed):
    got = {r["v"]: r["rank"] for r in O.average_ranks(spark.createDataFrame(skewed), "v").collect()}
    want = skewed["v"].rank()
    assert all(got[v] == r for v, r in zip(skewed["v"], want))


def test_spearman_with_ties_and_missing(spark, skewed):
    df = skewed.copy()
    df["u"] = df["v"] * 2 + df["w"]
    df.loc[::7, "u"] = np.nan
    got = spearman(spark.createDataFrame(df).replace(float("nan"), None), "v", "u").first()
    pair = df[["v", "u"]].dropna()
    assert got["n"] == len(pair)
    assert got["rho"] == pytest.approx(pair["v"].rank().corr(pair["u"].rank()))


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0)], "g string, x double, y double")
    assert spearman_pairs(df, ["g"]).first()["rho"] is None


def test_null_groups_are_kept(spark):
    from riskframe.operators.profile import box_stats, describe_by, histogram

    rows = [(None, 1.0, 1.0), (None, 2.0, 4.0), (None, 3.0, 9.0), ("a", 1.0, 2.0), ("a", 2.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    assert {r["g"]: r["rho"] for r in spearman_pairs(df, ["g"]).collect()} == pytest.approx({None: 1.0, "a": -1.0})
    assert {r["g"]: r["q50"] for r in box_stats(df, ["g"], "x").collect()} == {None: 2.0, "a": 1.5}
    assert {r["g"]: r["q50"] for r in describe_by(df, ["g"], "x").collect()} == {None: 2.0, "a": 1.5}
    assert sum(r["n"] for r in histogram(df, "x", 2, ["g"]).collect()) == 5
    assert {r["g"]: r["x"] for r in medians_by(df, ["g"], ["x"]).collect()} == {None: 2.0, "a": 1.5}


def test_plans_have_no_python_and_no_bare_cross_join(spark, skewed):
    df = spark.createDataFrame(skewed)
    for out in (O.quantiles(df, "v", [0.5], ["g"]), O.running_totals(df, "v", ["w"]), O.average_ranks(df, "v")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ranges_follow_the_scale_of_each_column(spark):
    """Columns of scales 1 and 1e9 in one pass: no range holds more than twice its share."""
    rng = np.random.default_rng(3)
    wide = pd.DataFrame({"small": rng.random(4000), "large": rng.random(4000) * 1e9})
    long = O.unpivot_numeric(spark.createDataFrame(wide), ["small", "large"])
    cuts = O.group_cuts(long, ["value"], ["feature"], 16)
    held = O.with_bucket(long, "value", cuts.edges["value"]).groupBy("feature", O.BUCKET).count().collect()
    assert {r["feature"] for r in held} == {"small", "large"} and len(held) >= 16
    assert max(r["count"] for r in held) <= 2 * 8000 / 16
    medians = {r["feature"]: r["quantile"] for r in O.column_quantiles(spark.createDataFrame(wide), ["small", "large"], [0.5]).collect()}
    assert medians == pytest.approx(wide.median().to_dict(), rel=1e-12)


def test_only_large_groups_cut(spark):
    rows = [("hot", float(i)) for i in range(900)] + [(f"g{i}", 5000.0 + i) for i in range(100)]
    cuts = O.group_cuts(spark.createDataFrame(rows, "g string, v double"), ["v"], ["g"], 8)
    assert [r["g"] for r in cuts.large.collect()] == ["hot"]
    assert 7 <= len(cuts.edges["v"]) <= 16 and max(cuts.edges["v"]) < 900


def test_companion_ranks_of_groups(spark, skewed):
    df = skewed.assign(u=(skewed["v"] * 3 + skewed["w"]).round(), id=range(len(skewed)))
    df.loc[df.index[-3:], "g"] = "tiny"
    got = O.companion_ranks(spark.createDataFrame(df.assign(n=1)), ["v", "u"], ["g"], "n").toPandas().set_index("id").sort_index()
    for c in ("v", "u"):
        assert (got[f"{c}_rank"].to_numpy() == df.groupby("g")[c].rank().to_numpy()).all()
    assert (got["_of"].to_numpy() == df.groupby("g")["v"].transform("size").to_numpy()).all()


def test_a_hot_value_is_ranked_in_many_tasks(spark):
    """Two values on one side, all different on the other: no join on a value, no task with half the rows."""
    n = 4000
    df = spark.createDataFrame([(float(i % 2), float(i * 7919 % n)) for i in range(n)], "x double, y double")
    counted = df.groupBy("x", "y").agg(F.count("*").alias("n")).withColumn("g", F.lit(1))
    ranked = O.companion_ranks(counted, ["x"], ["g"], "n")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        sizes = [r["count"] for r in ranked.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    finally:
        spark.conf.unset(merging)
    assert len(sizes) >= 3 and max(sizes) <= 0.6 * n
    assert {(r["x"], r["x_rank"]) for r in ranked.select("x", "x_rank").distinct().collect()} == {(0.0, 1000.5), (1.0, 3000.5)}
    plan = spearman(df, "x", "y")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(f"({c}#" in line or f" {c}#" in line for line in joins for c in ("_x", "_y"))
    pandas = df.toPandas()
    assert spearman(df, "x", "y").first()["rho"] == pytest.approx(pandas["x"].rank().corr(pandas["y"].rank()))
