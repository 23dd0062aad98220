"""Training, projection and segmentation jobs composed from the operators.

A training run is a row of stages, each kept in a ledger under the fingerprint of the run's rows and settings: a new run in the
same folder reads what an earlier one finished, down to single folds of single candidates, and repeats the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from hashlib import md5

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.encode import TabularEncoder
from riskframe.operators.evaluate import (
    CV_METRICS, METRIC_ORDER, best_threshold_cost, best_threshold_f1, evaluate, metrics_long,
)
from riskframe.operators.joins import small_table
from riskframe.operators.models import (
    DUMMY, FOREST, GBT, GBT_SUB, LOGREG, Candidate, as_params, best_candidate, cross_validate, holdout_table,
    learning_curve, make_candidates, param_grid, random_search, score,
)
from riskframe.operators.panel import HISTORY
from riskframe.operators.profile import (
    crosstab, entity_aggregate, entity_correlations, listed_values, medians_by,
)
from riskframe.operators.roles import Roles
from riskframe.operators.sampling import stratified_holdout, stratified_sample, subsample
from riskframe.operators.scoring import project, ranking_sanity, risk_ranking
from riskframe.operators.segments import (
    K_RANGE, RESTARTS, cluster_matrix, kmeans_best_of, segment_names, segment_outcome, select_k,
)
from riskframe.sources.io import load_model, save_model, shared_folder, write_csv, write_metrics
from riskframe.sources.ledger import Ledger, fingerprint


@dataclass(frozen=True)
class TrainConfig:
    """Settings of a training run. ``None`` for a sample means all rows."""

    n_sample: int | None = None
    cv_sample: int | None = None
    cv_folds: int = 5
    n_iter: int = 25
    group_folds: int = 5
    seed: int = 42
    curve_sizes: tuple[int, ...] = (50, 100, 200, 400, 600, 800)
    threshold_on: str = "holdout"
    candidates: tuple[str, ...] = (DUMMY, LOGREG, GBT, FOREST, GBT_SUB)
    min_frequency: int = 20
    smaller: Mapping[str, Mapping] = field(default_factory=dict)
    grids: Mapping[str, Mapping] = field(default_factory=dict)

    def fast(self) -> TrainConfig:
        """The short run: samples, fewer folds and settings."""
        # The settings of the short run.
        return replace(
            self, n_sample=60_000, cv_sample=30_000, cv_folds=3, n_iter=5, group_folds=3,
            curve_sizes=(50, 150, 400),
        )


@dataclass
class TrainResult:
    """What a training run found. Tables are small, except the scores per entity."""

    best: str
    params: dict
    model: PipelineModel
    thresholds: dict[str, float]
    cv: DataFrame
    search: DataFrame
    holdout: DataFrame
    group_cv: DataFrame | None = None
    curve: DataFrame | None = None
    ablation: DataFrame | None = None
    entities: DataFrame | None = None
    agreement: DataFrame | None = None


@dataclass(frozen=True)
class Task:
    """Columns of a classification task."""

    key: str
    label: str
    grain: str
    roles: Roles
    extra_drop: tuple[str, ...] = ()
    group: str | None = None
    entity: str | None = None
    entity_group: str | None = None


@dataclass
class Run:
    """The stages of one training run; ``source`` names its rows, task and settings."""

    ledger: Ledger
    source: str

    @staticmethod
    def of(df: DataFrame, task: Task, cfg: TrainConfig, folder: str | None = None) -> Run:
        settings = json.dumps([asdict(task), asdict(cfg)], sort_keys=True, default=sorted)
        source = md5((fingerprint(df) + settings).encode()).hexdigest()
        return Run(Ledger(df.sparkSession, folder), source)

    def _key(self, stage: str) -> dict:
        return {"stage": stage, "run": self.source}

    def table(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.ledger.table(self._key(stage), build)

    def model(self, stage: str, build: Callable[[], PipelineModel]) -> PipelineModel:
        return self.ledger.model(self._key(stage), build)

    def value(self, stage: str, build: Callable[[], object]):
        return self.ledger.value(self._key(stage), build)


def _candidates(df: DataFrame, task: Task, cfg: TrainConfig, drop: Sequence[str] = ()):
    extra = {*task.extra_drop, *drop, task.key, "split"}
    numeric, categorical = task.roles.feature_columns(df, task.label, extra)
    made = make_candidates(
        numeric, categorical, task.label, task.grain, task.roles.log_scaled, cfg.seed,
        cfg.min_frequency, cfg.smaller,
    )
    return {name: made[name] for name in cfg.candidates}


def pick_thresholds(scored: DataFrame, label: str) -> dict[str, float]:
    """Cuts of best F1 and of least 5:1 cost, and that cost."""
    f1 = best_threshold_f1(scored, y=label).first()
    cost = best_threshold_cost(scored, y=label).first()
    return {"f1": f1["threshold"], "cost": cost["threshold"], "mean_cost": cost["cost"]}


def _split(df: DataFrame, task: Task, cfg: TrainConfig, run: Run) -> tuple[DataFrame, DataFrame]:
    split = run.table("split", lambda: stratified_holdout(df, task.key, task.label, 0.2, cfg.seed))
    return split.where("split = 'train'"), split.where("split = 'test'")


def _compare_and_tune(train: DataFrame, task: Task, cfg: TrainConfig, run: Run):
    """(rows for folds, candidates, CV table, best name, tuned candidate, its settings, search table)."""
    pool = run.table("pool", lambda: subsample(train, task.key, cfg.cv_sample, cfg.seed)) if cfg.cv_sample else train
    candidates = _candidates(train, task, cfg)
    cv = run.table("compare", lambda: cross_validate(candidates, pool, task.key, task.label, cfg.cv_folds, cfg.seed, ledger=run.ledger))
    best = best_candidate(cv.where("part = 'test'")).first()["candidate"]
    grid = cfg.grids.get(best) or param_grid(best, task.grain)

    def search():
        _, settings, table = random_search(candidates[best], grid, pool, task.key, cfg.n_iter, cfg.cv_folds, cfg.seed, ledger=run.ledger)
        return {"settings": settings, "tried": [tuple(r) for r in table.collect()]}

    found = run.value("search", search)
    tuned = candidates[best].copy(as_params(candidates[best], found["settings"]))
    tried = train.sparkSession.createDataFrame(found["tried"], "setting int, params string, roc_auc double, best boolean")
    return pool, candidates, cv, best, tuned, found["settings"], tried


def _holdout(candidates, best: str, model: PipelineModel, train: DataFrame, test: DataFrame, task: Task, cfg: TrainConfig, run: Run):
    """(thresholds, metric table) on the held-out rows, baselines beside the best."""
    shown = [n for n in dict.fromkeys([DUMMY, LOGREG, best]) if n in candidates]

    def scores(name: str) -> DataFrame:
        fitted = model if name == best else candidates[name].fit(train)
        return score(fitted, test).select(F.lit(name).alias("candidate"), F.col(task.label).cast("int").alias("y"), "p")

    scored = run.table("holdout_scores", lambda: reduce(DataFrame.unionByName, map(scores, shown)))

    def inner_scores() -> DataFrame:
        inner = stratified_holdout(train.drop("split"), task.key, task.label, 0.2, cfg.seed + 1)
        refit = candidates[best].fit(inner.where("split = 'train'"))
        return score(refit, inner.where("split = 'test'")).select(F.col(task.label).cast("int").alias("y"), "p")

    held = scored.where(F.col("candidate") == best) if cfg.threshold_on == "holdout" else run.table("inner_scores", inner_scores)
    cuts = run.value("thresholds", lambda: pick_thresholds(held, "y"))
    named = {"f1": cuts["f1"], "cost": cuts["cost"]}
    return cuts, run.table("holdout", lambda: holdout_table(scored, shown, best, named))


def save_result(result: TrainResult, cfg: TrainConfig, out: str) -> None:
    """Write ``model`` (with thresholds, settings, seed), ``metrics`` as JSON, and the entity table as CSV if there is one."""
    info = {"best": result.best, "params": result.params, "thresholds": result.thresholds, "seed": cfg.seed}
    save_model(result.model, f"{out}/model", info)
    write_metrics(metrics_long(result.holdout, ["name"]), f"{out}/metrics")
    if result.entities is not None:
        write_csv(result.entities, f"{out}/entities", [result.entities.columns[0]])


def train_units(df: DataFrame, task: Task, cfg: TrainConfig, out: str | None = None, folder: str | None = None) -> TrainResult:
    """Unit-grain run: sample, split, compare, tune, learning curve, thresholds, group folds, entity rates.

    ``out`` names a folder for what ``save_result`` writes, ``folder`` one for the stages, from which a new run goes on.
    """
    shared_folder(df.sparkSession)
    run = Run.of(df, task, cfg, folder)
    if cfg.n_sample:
        df = run.table("sample", lambda: stratified_sample(df, task.key, cfg.n_sample, [task.entity_group, task.label], cfg.seed))
    train, test = _split(df, task, cfg, run)
    pool, candidates, cv, best, tuned, params, search = _compare_and_tune(train, task, cfg, run)
    model = run.model("model", lambda: tuned.fit(train))
    curve = None
    if best in (GBT, FOREST, GBT_SUB) and cfg.curve_sizes:
        curve = run.table("curve", lambda: learning_curve(tuned, train, test, cfg.curve_sizes))
    cuts, holdout = _holdout({**candidates, best: tuned}, best, model, train, test, task, cfg, run)
    by_group = run.table(
        "group_folds", lambda: cross_validate({best: tuned}, pool, task.key, task.label, cfg.group_folds, cfg.seed, task.entity, run.ledger)
    )

    def rates() -> DataFrame:
        scored = score(model, test).select(task.entity, task.entity_group, F.col(task.label).cast("int").alias("y"), "p")
        return entity_aggregate(scored, task.entity, task.entity_group)

    entities = run.table("entities", rates)
    result = TrainResult(
        best, params, model, cuts, cv, search, holdout, group_cv=by_group, curve=curve,
        entities=entities, agreement=entity_correlations(entities),
    )
    if out:
        save_result(result, cfg, out)
    return result


def train_entities(
    matrix: DataFrame, task: Task, cfg: TrainConfig, with_ablation: bool = True, out: str | None = None, folder: str | None = None
) -> TrainResult:
    """Entity-grain run on the relative matrix: split, compare, tune, thresholds, ablation.

    ``out`` names a folder for what ``save_result`` writes; ``projection_job`` reads its ``model``. ``folder`` names one
    for the stages, from which a new run goes on.
    """
    shared_folder(matrix.sparkSession)
    run = Run.of(matrix, task, cfg, folder)
    train, test = _split(matrix, task, cfg, run)
    _, candidates, cv, best, tuned, params, search = _compare_and_tune(train, task, cfg, run)
    model = run.model("model", lambda: tuned.fit(train))
    cuts, holdout = _holdout({**candidates, best: tuned}, best, model, train, test, task, cfg, run)
    result = TrainResult(best, params, model, cuts, cv, search, holdout)
    if with_ablation:
        result.ablation = run.table("ablation", lambda: ablate_history(train, test, task, cfg, best, params, model))
    if out:
        save_result(result, cfg, out)
    return result


def without_history(train: DataFrame, task: Task, cfg: TrainConfig, best: str, settings: Mapping) -> Candidate:
    """The best candidate with the same settings, on the features without the history block."""
    bare = _candidates(train, task, cfg, drop=HISTORY)[best]
    return bare.copy(as_params(bare, settings))


def ablate_history(train, test, task: Task, cfg: TrainConfig, best: str, settings: Mapping, model) -> DataFrame:
    """Rows (variant, metrics) of the best model with and without the history block, settings alike.

    ``variant`` is 'full', 'without_history' (both held-out, every metric), 'without_history_cv' or
    'without_history_cv_sd' (mean and spread over folds, the metrics of a cross-validation report).
    """
    bare = without_history(train, task, cfg, best, settings)
    rows = None
    for name, fitted in (("full", model), ("without_history", bare.fit(train))):
        part = score(fitted, test).select(
            F.lit(name).alias("variant"), F.col(task.label).cast("int").alias("y"), "p"
        )
        rows = part if rows is None else rows.unionByName(part)
    held = evaluate(rows.checkpoint(), by=["variant"]).select("variant", *METRIC_ORDER)
    report = cross_validate({best: bare}, train, task.key, task.label, cfg.cv_folds, cfg.seed).where("part = 'test'")
    named = F.inline(F.array(*[
        F.struct(F.lit(f"without_history_cv{end}").alias("variant"), "metric", F.col(c).alias("value"))
        for end, c in (("", "mean"), ("_sd", "sd"))
    ]))
    folds = report.select(named).groupBy("variant").pivot("metric", CV_METRICS).agg(F.max("value"))
    table, _ = small_table(train.sparkSession, held.unionByName(folds, allowMissingColumns=True))
    return table


def project_and_rank(model: PipelineModel, matrix: DataFrame, key: str, name: str, group: str) -> DataFrame:
    """Ranked risk list of the projected year."""
    return risk_ranking(project(model, matrix, key, name, group), key, "risk")


def projection_job(
    spark: SparkSession, model_path: str, matrix: DataFrame, key: str, name: str, group: str, out: str
) -> DataFrame:
    """Score with a saved model, write the ranked list as CSV, and return the checks on it."""
    model, _ = load_model(spark, model_path)
    ranking = project_and_rank(model, matrix, key, name, group).checkpoint()
    write_csv(ranking, out, ["position"])
    return ranking_sanity(ranking)


@dataclass
class Segmentation:
    """Segments per entity and the tables that describe them."""

    choice: DataFrame
    segments: DataFrame
    profile: DataFrame
    outcome: DataFrame
    by_region: DataFrame


def segment_entities(
    features: DataFrame,
    targets: DataFrame,
    key: str,
    name: str,
    label: str,
    drop: Sequence[str],
    categorical: Sequence[str],
    log_scaled: Sequence[str],
    region: str,
    level: str,
    rural: str,
    size: str,
    ks: Sequence[int] = K_RANGE,
    restarts: int = RESTARTS,
    seed: int = 42,
    min_frequency: int = 20,
    euclidean: bool = False,
    out: str | None = None,
) -> Segmentation:
    """Choose k, place entities in segments, name the segments and validate them on the outcome.

    ``out`` names a folder for the segments as CSV.
    """
    spark = features.sparkSession
    shared_folder(spark)
    matrix, numeric, cats = cluster_matrix(features, [key, name], drop, categorical)
    encoder = TabularEncoder(
        numeric=numeric, categorical=cats, log_scaled=[c for c in log_scaled if c in numeric],
        scale=True, min_frequency=min_frequency,
    )
    encoded = encoder.fit(matrix).transform(matrix).select(key, "features").checkpoint()
    choice = select_k(encoded, ks, restarts, seed, euclidean=euclidean)
    k = choice.where("best").first()["k"]
    placed = kmeans_best_of(encoded, k, restarts, seed).transform(encoded)
    segments = placed.select(key, F.col("prediction").alias("segment_id")).checkpoint()
    described = features.join(segments, [key])
    profile = medians_by(described, ["segment_id"], list(dict.fromkeys([level, rural, size, *numeric])))
    profile, _ = small_table(spark, profile)
    named = segment_names(profile, "segment_id", level, rural, size)
    regions = listed_values(features, region)
    placed_names = features.select(key, name).join(segments, [key]).join(F.broadcast(named), ["segment_id"])
    if out:
        write_csv(placed_names, f"{out}/segments", [key])
    return Segmentation(
        choice, placed_names, profile,
        segment_outcome(segments, targets, key, "segment_id", label),
        crosstab(described, "segment_id", region, regions),
    )
