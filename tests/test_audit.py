"""Facts of fits: true for a sound fit, false for one that is spoilt; curves by prefixes of one fit."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import audit, evaluate as E, models as M

SMALL = {M.LOGREG: dict(iterations=500), M.GBT: dict(iterations=12, rate=0.3, leaves=7, min_rows=10), M.FOREST: dict(trees=9, min_rows=10, depth=4)}
SMALL[M.GBT_SUB] = {**SMALL[M.GBT], "rows": 0.9, "columns": 0.8}


@pytest.fixture(scope="module")
def df(spark):
    rows = spark.range(800).select("id", (F.rand(3) * 10).alias("a"), F.rand(4).alias("b"), F.element_at(F.array(F.lit("x"), F.lit("y")), (F.col("id") % 2 + 1).cast("int")).alias("c"))
    return rows.withColumn("y", (F.col("a") + 4 * F.rand(5) + (F.col("c") == "x").cast("int") > 7).cast("int")).cache()


@pytest.fixture(scope="module")
def made():
    return M.make_candidates(["a", "b"], ["c"], "y", "entity", smaller=SMALL)


@pytest.mark.parametrize("grain", ["entity", "unit"])
def test_gradient_tells_the_penalty(df, grain):
    """``unit`` weighs the classes."""
    candidate = M.make_candidates(["a", "b"], ["c"], "y", grain, smaller=SMALL)[M.LOGREG]
    model = candidate.fit(df)
    assert audit.linear_facts(candidate, model, df) == {"gradient_is_zero": True}
    other = candidate.copy({candidate.param("inversePenalty"): 0.5})
    assert audit.linear_facts(other, model, df) == {"gradient_is_zero": False}
    assert audit.linear_facts(candidate, model, df.where("id < 700")) == {"gradient_is_zero": False}


@pytest.mark.parametrize("name", [M.GBT, M.GBT_SUB, M.FOREST])
def test_tree_facts(df, made, name):
    candidate = made[name]
    model = candidate.fit(df)
    facts = audit.tree_facts(candidate, model, df)
    assert all(facts.values()) and set(facts) == {"leaves_add_up"} | ({"leaves_are_full", "loss_falls"} if name != M.FOREST else set())
    if name == M.FOREST:
        return
    # Opposite labels: the loss rises. Settings that ask for more rows: leaves are not full.
    assert not audit.tree_facts(candidate, model, df.withColumn("y", 1 - F.col("y")))["loss_falls"]
    stricter = candidate.copy({candidate.param("minInstancesPerNode"): 300})
    assert not audit.tree_facts(stricter, model, df)["leaves_are_full"]


def test_leaves_count_every_row(df, made):
    model = made[M.GBT].fit(df)
    rows = audit.fitted_rows(made[M.GBT], model, df)
    counts = audit.leaf_rows(model.stages[-1], rows).groupBy("tree").agg(F.sum("n").alias("n")).collect()
    assert [r["n"] for r in counts] == [800] * 12
    losses = audit.loss_by_round(model.stages[-1], rows)
    assert len(losses) == 12 and losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("name", [M.GBT, M.GBT_SUB])
def test_a_prefix_is_a_refit(df, made, name):
    """The first n rounds of a fit score as a fit of n rounds."""
    candidate = made[name]
    state = M.fit_state(candidate, df)
    whole = candidate.fit_with(df, state)
    encoded = whole.stages[0].transform(df)
    encoded = whole.stages[1].transform(encoded).select("id", "features")
    prefix = M.prefix_scores(whole.stages[-1], encoded, [3, 5, 12, 40], ["id"])
    assert {r["size"] for r in prefix.select("size").distinct().collect()} == {3, 5, 12}
    for n in (3, 5, 12):
        refit = candidate.copy({candidate.param("maxIter"): n}).fit_with(df, state)
        both = M.score(refit, df).select("id", F.col("p").alias("q")).join(prefix.where(F.col("size") == n), ["id"])
        assert both.count() == 800 and both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9


def test_a_forest_prefix_is_the_mean_of_its_trees(df, made):
    model = made[M.FOREST].fit(df)
    encoded = model.stages[1].transform(model.stages[0].transform(df)).select("id", "features")
    got = {(r["id"], r["size"]): r["p"] for r in M.prefix_scores(model.stages[-1], encoded, [4, 9], ["id"]).where("id < 50").collect()}
    trees = encoded.where("id < 50")
    for i, tree in enumerate(model.stages[-1].trees):
        tree.setProbabilityCol(f"t{i}").setRawPredictionCol("").setPredictionCol("")
        trees = tree.transform(trees)
    for r in trees.select("id", *[vector_to_array(f"t{i}")[1].alias(f"t{i}") for i in range(9)]).collect():
        assert got[r["id"], 9] == pytest.approx(sum(r[f"t{i}"] for i in range(9)) / 9)
        assert got[r["id"], 4] == pytest.approx(sum(r[f"t{i}"] for i in range(4)) / 4)


def test_curve(df, made):
    train, test = df.where("id % 4 > 0").withColumn("split", F.lit("train")), df.where("id % 4 = 0").withColumn("split", F.lit("test"))
    candidate = made[M.GBT]
    curve = {r["size"]: r for r in M.learning_curve(candidate, train, test, [2, 8]).collect()}
    assert set(curve) == {2, 8} and (curve[2]["n_train"], curve[2]["n_test"]) == (600, 200)
    refit = M.score(candidate.copy({candidate.param("maxIter"): 8}).fit(train), test)
    assert curve[8]["test_auc"] == pytest.approx(E.ranking_metrics(refit).first()["roc_auc"], abs=1e-9)
    assert curve[8]["train_auc"] >= curve[2]["train_auc"] > 0.5
