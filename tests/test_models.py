"""Preprocessing, classifiers, selection, segments and explanation on synthetic data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskframe.operators import encode, evaluate as E, explain, models as M, scoring, segments
from riskframe.operators.roles import Roles
from riskframe.plans.training import Task, TrainConfig, train_entities, train_units
from riskframe.sources import io

ROLES = Roles(forbidden={"id", "name", "entity"}, categorical=("band", "grp"), log_scaled=("size",))
SMALL = {
    M.LOGREG: dict(iterations=30),
    M.GBT: dict(iterations=5, rate=0.3, leaves=7, min_rows=10),
    M.FOREST: dict(trees=8, min_rows=10, depth=4),
}
TASK = Task("id", "y", "entity", ROLES, extra_drop=("split",), entity="entity", entity_group="grp")
FAST = TrainConfig(
    cv_folds=2, n_iter=2, group_folds=2, curve_sizes=(2, 4), smaller=SMALL, min_frequency=5,
    candidates=(M.DUMMY, M.LOGREG, M.GBT),
    grids={M.LOGREG: {"inversePenalty": [0.1, 1.0]}, M.GBT: {"maxIter": [3, 5], "leaves": [7]}},
)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(13)
    n = 600
    last, ctx = rng.normal(55, 15, n), rng.beta(4, 3, n)
    goal = 45 + 25 * rng.random(n)
    p = 1 / (1 + np.exp(-(0.12 * (last - goal) + 5.0 * (ctx - ctx.mean()))))
    df = pd.DataFrame({
        "id": np.arange(n), "name": [f"m{i}" for i in range(n)], "entity": rng.integers(0, 40, n),
        "outcome_t1": last, "goal_t": goal, "effort_t": goal - last, "ctx": ctx,
        "size": rng.integers(1000, 2_000_000, n).astype(float),
        "band": rng.choice(["s", "m", "l"], n), "grp": rng.choice(list("ABCDE"), n), "y": rng.binomial(1, p),
    })
    for c in ("ctx", "size", "band"):
        df.loc[rng.random(n) < 0.08, c] = None
    df["empty"] = np.nan
    return df


@pytest.fixture(scope="module")
def df(spark, pdf):
    io.shared_folder(spark)
    clean = pdf.astype(object).where(pdf.notna(), None)
    schema = (
        "id long, name string, entity long, outcome_t1 double, goal_t double, effort_t double, ctx double, size double,"
        " band string, grp string, y int, empty double"
    )
    return spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], schema).checkpoint()


NUM, CAT = ["outcome_t1", "ctx", "size", "empty"], ["band", "grp"]


def test_encoder_matches_pandas(df, pdf):
    fitted = encode.fit_encoder(df, NUM, CAT, ["size"], True, 5)
    assert fitted.numeric == ["outcome_t1", "ctx", "size"]
    got = fitted.columns(df, ["id"]).toPandas().sort_values("id")
    for c in ("outcome_t1", "ctx", "size"):
        x = pdf[c].astype(float).fillna(pdf[c].astype(float).median())
        x = np.log1p(x) if c == "size" else x
        assert np.allclose(got[c], (x - x.mean()) / x.std(ddof=0))
    band = pdf["band"].fillna(pdf["band"].mode()[0])
    assert (got["band_m"].to_numpy() == (band == "m").to_numpy()).all()
    assert not got.isna().any().any()
    assert fitted.unscaled().columns(df, ["id"]).select(F.max("size")).first()[0] < 16


def test_unknown_and_rare_categories(df):
    fitted = encode.fit_encoder(df, [], ["grp"], min_frequency=10_000)
    assert fitted.feature_names() == ["grp_infrequent"]
    fitted = encode.fit_encoder(df, [], ["grp"], min_frequency=1)
    odd = df.limit(3).withColumn("grp", F.lit("ZZ"))
    assert fitted.columns(odd, []).select(sum(F.col(f"`{c}`") for c in fitted.feature_names())).distinct().first()[0] == 0.0


def test_encoder_text_with_quotes_survives(spark):
    rows = spark.createDataFrame([("it's",), ("a\\b",), ("it's",)], "c string")
    fitted = encode.fit_encoder(rows, [], ["c"], min_frequency=1)
    again = encode.encoder_from_json(encode.encoder_to_json(fitted))
    got = again.columns(rows, ["c"]).toPandas()
    assert (got["c_it's"] == (got["c"] == "it's")).all() and (got["c_a\\b"] == (got["c"] == "a\\b")).all()


def test_modes_take_the_smallest_on_ties(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert encode.modes(rows, ["c"]).first()["mode"] == "a"
    assert encode.impute_mode(rows, ["c"]).where("c = 'a'").count() == 3


def _candidates(df, names=(M.DUMMY, M.LOGREG, M.GBT, M.FOREST)):
    made = M.make_candidates(["outcome_t1", "goal_t", "effort_t", "ctx", "size"], CAT, "y", "unit", ["size"], smaller=SMALL, min_frequency=5)
    return {n: made[n] for n in names}


def test_candidates_beat_the_majority(df):
    report = M.cross_validate(_candidates(df), df, "id", "y", 2)
    auc = {(r["candidate"], r["part"]): r["mean"] for r in report.where("metric = 'roc_auc'").collect()}
    assert auc[(M.DUMMY, "test")] == pytest.approx(0.5)
    assert all(auc[(n, "test")] > 0.75 for n in (M.LOGREG, M.GBT, M.FOREST))
    assert M.best_candidate(report.where("part = 'test'")).first()["candidate"] != M.DUMMY


def test_logistic_regression_is_at_the_optimum(df, pdf):
    """The gradient of sum of loss * C + half the squared weights vanishes."""
    made = M.make_candidates(["outcome_t1", "goal_t", "ctx"], [], "y", "entity", smaller={M.LOGREG: dict(iterations=500)})[M.LOGREG]
    state = M.fit_state(made, df)
    model = made.fit_with(df, state).stages[-1]
    x = state.columns(df, ["id"]).toPandas().sort_values("id").drop(columns="id").to_numpy()
    y, w = pdf["y"].to_numpy(), model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.abs(x.T @ (p - y) + w).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_balanced_weights_add_up(df):
    rows = M.class_weights(df, "y").collect()
    assert sum(r["n"] * r["weight"] for r in rows) == pytest.approx(600)


def test_saved_model_scores_the_same(spark, df, tmp_path):
    model = _candidates(df)[M.LOGREG].fit(df)
    io.save_model(model, str(tmp_path / "m"), {"cost": 0.7})
    loaded, info = io.load_model(spark, str(tmp_path / "m"))
    a = M.score(model, df).select("id", "p").collect()
    assert a == M.score(loaded, df).select("id", "p").collect() and info == {"cost": 0.7}
    assert all(0 <= r["p"] <= 1 for r in a)


def test_projection_job_writes_and_checks(spark, df, tmp_path):
    from riskframe.plans.training import projection_job

    io.save_model(_candidates(df)[M.LOGREG].fit(df), str(tmp_path / "m"), {})
    ahead = df.withColumn("reached_t1", (F.col("id") % 2).cast("double"))
    checks = projection_job(spark, str(tmp_path / "m"), ahead, "id", "name", "grp", str(tmp_path / "r")).first()
    assert checks["spearman_risk_effort"] > 0.5
    lines = spark.read.option("header", True).csv(str(tmp_path / "r")).toPandas()
    assert sorted(lines["position"].astype(int)) == list(range(1, 601))
    by_place = lines.assign(position=lines["position"].astype(int)).sort_values("position")["risk"].astype(float)
    assert by_place.is_monotonic_decreasing


def test_settings_are_drawn_reproducibly():
    grid = M.param_grid(M.GBT, "unit")
    assert M.draw_settings(grid, 5, 1) == M.draw_settings(grid, 5, 1)
    assert len(M.draw_settings({"a": [1, 2]}, 25, 1)) == 2
    assert M.param_grid("none") == {}
    assert [M.depth_for(n) for n in (7, 15, 31, 63)] == [3, 4, 5, 6]


def test_entity_run_with_ablation(df):
    from riskframe.operators.panel import HISTORY

    result = train_entities(df.drop("empty"), TASK, FAST)
    table = {r["name"]: r for r in result.holdout.collect()}
    assert table[result.best]["roc_auc"] > 0.75 > table[M.DUMMY]["roc_auc"]
    assert {f"{result.best}@f1", f"{result.best}@cost"} <= set(table)
    assert 0 < result.thresholds["cost"] < 1
    variants = {r["variant"]: r for r in result.ablation.collect()}
    assert variants["without_history"]["roc_auc"] <= variants["full"]["roc_auc"] + 0.05
    assert set(variants) == {"full", "without_history", "without_history_cv", "without_history_cv_sd"}
    assert variants["full"]["log_loss"] > 0 and variants["without_history_cv_sd"]["brier"] >= 0
    assert set(HISTORY) & set(df.columns)


def test_ablation_keeps_the_tuned_settings(df):
    from riskframe.plans.training import without_history

    settings = {"inversePenalty": 0.01}
    bare = without_history(df.drop("empty"), TASK, FAST, M.LOGREG, settings)
    assert bare.getOrDefault("inversePenalty") == 0.01 != M.make_candidates(NUM, CAT, "y")[M.LOGREG].getOrDefault("inversePenalty")
    assert "outcome_t1" not in bare.encoder.settings["numeric"]
    trees = without_history(df.drop("empty"), TASK, FAST, M.GBT, {"leaves": 31, "maxIter": 3})
    assert (trees.classifier.getMaxDepth(), trees.classifier.getMaxIter(), trees.classifier.getMaxBins()) == (5, 3, M.MAX_BINS)


def test_runs_leave_model_metrics_and_entities(spark, df, tmp_path):
    from dataclasses import replace

    out = str(tmp_path / "run")
    result = train_units(df.drop("empty"), replace(TASK, grain="unit"), replace(FAST, candidates=(M.DUMMY, M.LOGREG), curve_sizes=()), out)
    _, info = io.load_model(spark, f"{out}/model")
    assert info == {"best": result.best, "params": result.params, "thresholds": result.thresholds, "seed": FAST.seed}
    assert spark.read.json(f"{out}/metrics").where("metric = 'roc_auc'").count() >= 2
    assert spark.read.option("header", True).csv(f"{out}/entities").count() == result.entities.count()
    ranked = explain.explain_job(spark, f"{out}/model", df.drop("empty"), "id", f"{out}/explained")
    assert spark.read.option("header", True).csv(f"{out}/explained").count() == ranked.count() > 3


def test_attributions_of_a_saved_model_add_up_to_its_logit(spark, df, tmp_path):
    from riskframe.operators.encode import encoded_names

    M.make_candidates(NUM, CAT, "y")[M.LOGREG].fit(df).write().save(str(tmp_path / "m"))
    model = PipelineModel.load(str(tmp_path / "m"))
    names = encoded_names(model)
    assert names[:3] == ["outcome_t1", "ctx", "size"] and "band_s" in names
    phi = explain.model_shap(model, df, "id")
    assert {r["feature"] for r in phi.select("feature").distinct().collect()} == set(names)
    logit = M.score(model, df).select("id", F.log(F.col("p") / (1 - F.col("p"))).alias("z"))
    gap = phi.groupBy("id").agg(F.sum("phi").alias("s")).join(logit, ["id"]).select((F.col("z") - F.col("s")).alias("g"))
    assert gap.agg(F.max("g") - F.min("g")).first()[0] < 1e-6


def test_unit_run(df):
    from dataclasses import replace

    result = train_units(df.drop("empty"), replace(TASK, grain="unit"), replace(FAST, n_sample=500, cv_sample=300, threshold_on="validation"))
    assert result.entities.count() <= 40 and result.agreement.first()["n_entities"] > 10
    auc = result.group_cv.where("part = 'test' and metric = 'roc_auc'").first()["mean"]
    assert 0.6 < auc < 1
    if result.curve is not None:
        assert result.curve.count() == 2


def test_positions_with_heavy_ties(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 1000).alias("risk"))
    got = scoring.risk_ranking(rows, "id", "risk").toPandas().sort_values(["risk", "id"], ascending=[False, True])
    assert got["position"].tolist() == list(range(1, 1001))


def test_ranking_checks(spark):
    """Risk falls with the place in a list; whoever missed last year stands in its upper half."""
    rows = [(1 - i / 150, 40.0 - 0.2 * i + (i % 7), int(i > 70)) for i in range(150)]
    r = scoring.ranking_sanity(spark.createDataFrame(rows, "risk double, effort double, reached_last int")).first()
    ranks = pd.DataFrame(rows, columns=["risk", "effort", "met"])
    assert r["spearman_risk_effort"] == pytest.approx(ranks["risk"].rank().corr(ranks["effort"].rank()))
    assert r["risk_missed"] == pytest.approx(ranks.loc[ranks["met"] == 0, "risk"].mean()) and r["risk_missed"] > r["risk_met"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centers = np.array([[0, 0, 0], [6, 6, 0], [0, 6, 6]])
    owner = rng.integers(0, 3, 240)
    points = centers[owner] + rng.normal(0, 0.6, (240, 3))
    pdf = pd.DataFrame({"id": np.arange(240), "v": list(points), "own": owner})
    df = spark.createDataFrame([(int(i), [float(t) for t in v], int(o)) for i, v, o in pdf.itertuples(index=False)], "id long, v array<double>, own int")
    return pdf, df.withColumn("features", array_to_vector("v")).cache()


def test_silhouettes_by_brute_force(blobs):
    pdf, df = blobs
    x, own = np.stack(pdf["v"]), pdf["own"].to_numpy()

    def brute(d):
        out = []
        for i in range(len(x)):
            inner = d[i, own == own[i]].sum() / ((own == own[i]).sum() - 1)
            outer = min(d[i, own == k].mean() for k in set(own) - {own[i]})
            out.append((outer - inner) / max(outer, inner))
        return np.mean(out)

    d = ((x[:, None] - x[None, :]) ** 2).sum(-1)
    assert segments.silhouette_squared(df, "features", "own").first()[0] == pytest.approx(brute(d))
    centres = np.stack([x[own == k].mean(axis=0) for k in range(3)])
    away = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(-1))
    near = away[np.arange(len(x)), own]
    away[np.arange(len(x)), own] = np.inf
    other = away.min(axis=1)
    assert segments.silhouette_centroid(df, "v", "own").first()[0] == pytest.approx(((other - near) / np.maximum(other, near)).mean())
    assert segments.silhouette_centroid(df.where("own = 0"), "v", "own").first()[0] is None


def test_three_blobs_are_found(blobs):
    pdf, df = blobs
    choice = segments.select_k(df, (2, 3, 4), restarts=2, euclidean=True)
    assert choice.where("best").first()["k"] == 3
    placed = segments.kmeans_best_of(df, 3, 2).transform(df)
    assert placed.groupBy("own").agg(F.countDistinct("prediction").alias("n")).where("n > 1").count() == 0


def test_permutation_is_a_permutation(df):
    got = explain.permuted_column(df, "id", "outcome_t1").toPandas()
    assert len(got) == 600 and sorted(got["permuted"]) == sorted(got["outcome_t1"])
    assert (got["permuted"] != got["outcome_t1"]).mean() > 0.9


def test_importance_finds_the_driver(df):
    model = _candidates(df)[M.LOGREG].fit(df)
    rows = {r["feature"]: r for r in explain.permutation_importance(model, df, "id", "y", ["outcome_t1", "goal_t", "effort_t", "ctx", "size", "band", "grp"], 2).collect()}
    assert rows["size"]["importance_mean"] < 0.05
    assert max(rows, key=lambda f: rows[f]["importance_mean"]) in ("outcome_t1", "goal_t", "effort_t", "ctx")


def test_linear_attributions_add_up(df):
    rows = df.select("id", "outcome_t1", "goal_t")
    phi = explain.linear_shap(rows, "id", {"outcome_t1": 0.5, "goal_t": -0.25})
    mean = rows.agg(F.avg(0.5 * F.col("outcome_t1") - 0.25 * F.col("goal_t"))).first()[0]
    total = phi.groupBy("id").agg(F.sum("phi").alias("s")).join(rows, ["id"])
    gap = total.select(F.max(F.abs(F.col("s") + mean - (0.5 * F.col("outcome_t1") - 0.25 * F.col("goal_t")))))
    assert gap.first()[0] < 1e-9
    assert explain.shap_ranking(phi, 1).count() == 1
