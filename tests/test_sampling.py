import pytest
from pyspark.sql import functions as F

from riskframe.operators import sampling as S


@pytest.fixture(scope="module")
def rows(spark):
    """2000 rows, label 1 for 30 %, a third of the rows in one group, some without a group."""
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(2000).select(F.col("id"), ((F.col("id") * 7) % 10 < 3).cast("int").alias("y"), g.alias("g")).cache()


def test_hash_rank_is_the_global_order(rows):
    got = S.hash_rank(rows, "id", 42, ["y"]).withColumn("h", S.hash_of(42, "id")).toPandas()
    for _, part in got.groupby("y"):
        part = part.sort_values(["h", "id"])
        assert part["rank"].tolist() == list(range(1, len(part) + 1))


def test_holdout_is_exact_and_stratified(rows):
    got = S.stratified_holdout(rows, "id", "y").groupBy("y", "split").count().collect()
    n = {(r["y"], r["split"]): r["count"] for r in got}
    assert n == {(0, "train"): 1120, (0, "test"): 280, (1, "train"): 480, (1, "test"): 120}


def test_holdout_drops_rows_without_label(rows):
    some = rows.withColumn("y", F.when(F.col("id") % 4 > 0, F.col("y")))
    assert S.stratified_holdout(some, "id", "y").count() == 1500


def test_holdout_moves_no_full_rows(rows):
    wide = rows.withColumn("payload", F.repeat(F.lit("x"), 100))
    plan = S.stratified_holdout(wide, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_same_seed_same_rows_other_seed_other_rows(rows):
    picks = [set(r["id"] for r in S.subsample(rows, "id", 100, seed).collect()) for seed in (1, 1, 2)]
    assert picks[0] == picks[1] != picks[2]
    assert len(picks[0]) == 100


def test_subsample_of_more_than_all(rows):
    assert S.subsample(rows, "id", 5000).count() == 2000


def test_folds_are_even(rows):
    n = S.stratified_folds(rows, "id", "y", 5).groupBy("y", "fold").count().collect()
    assert sorted((r["y"], r["count"]) for r in n) == [(0, 280)] * 5 + [(1, 120)] * 5


def test_group_folds_never_split_a_group(rows):
    folded = S.with_group_folds(rows, "g", 4)
    assert S.fold_group_overlap(folded, "g", "fold").count() == 0
    assert folded.count() == rows.where("g is not null").count()
    groups = S.group_folds(rows.where("g is not null"), "g", 4).toPandas()
    counts = groups.groupby("fold").size()
    assert counts.max() - counts.min() <= 1


def test_overlap_is_found(rows):
    assert S.fold_group_overlap(S.stratified_folds(rows, "id", "y", 2), "g", "fold").where("g = 'hot'").count() == 1


def test_stratified_sample(rows):
    got = S.stratified_sample(rows, "id", 400, ["g", "y"])
    assert abs(got.count() - 400) <= 45
    assert S.stratified_sample(rows, "id", 5000, ["g", "y"]).count() == 2000
    without = S.stratified_sample(rows, "id", 1500, ["g", "y"], keep_null_strata=False)
    assert without.where("g is null").count() == 0
    kept = S.stratified_sample(rows, "id", 1500, ["g", "y"])
    assert kept.where("g is null").count() > 0


def test_split_summary(rows):
    r = {x["split"]: x for x in S.split_summary(S.stratified_holdout(rows, "id", "y"), "split", "y").collect()}
    assert r["train"]["n"] == 1600 and r["test"]["positive_rate"] == pytest.approx(0.3)
