"""Candidate classifiers, search grids, cross-validated scores and learning curves."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators import trees as local_trees
from riskframe.operators.encode import FittedEncoder, TabularEncoder, fit_encoder
from riskframe.operators.evaluate import cv_report, evaluate_at, ranking_metrics
from riskframe.operators.sampling import stratified_folds, with_group_folds
from riskframe.sources.io import shared_folder
from riskframe.sources.ledger import Ledger, fingerprint

TreeModel = GBTClassificationModel | RandomForestClassificationModel

DUMMY, LOGREG, GBT, FOREST, GBT_SUB = "dummy", "logreg", "hist_gb", "random_forest", "lgbm"

# Settings of the candidates at the two grains. ``leaves`` becomes a depth.
PRESETS = {
    "unit": {
        "balanced": True,
        LOGREG: dict(iterations=2000),
        GBT: dict(iterations=300, rate=0.08, leaves=31, min_rows=200),
        FOREST: dict(trees=300, min_rows=50),
        GBT_SUB: dict(iterations=400, rate=0.06, leaves=31, min_rows=200, rows=0.9, columns=0.8),
    },
    "entity": {
        "balanced": False,
        LOGREG: dict(iterations=2000),
        GBT: dict(iterations=300, rate=0.08, leaves=15, min_rows=50),
        FOREST: dict(trees=300, min_rows=20),
        GBT_SUB: dict(iterations=400, rate=0.06, leaves=15, min_rows=50, rows=0.9, columns=0.8),
    },
}
# Search grids. Penalties on leaf values have no counterpart in Spark's
# trees and are not searched.
GRIDS = {
    "unit": {
        LOGREG: {"inversePenalty": [float(c) for c in np.logspace(-3, 2, 12)]},
        GBT: {
            "maxIter": [200, 300, 400, 600],
            "stepSize": [0.02, 0.05, 0.08, 0.12],
            "leaves": [15, 31, 63],
            "minInstancesPerNode": [50, 100, 200, 400],
            "featureSubsetStrategy": [0.6, 0.8, 1.0],
        },
        FOREST: {
            "numTrees": [200, 300, 500],
            "minInstancesPerNode": [20, 50, 100, 200],
            "featureSubsetStrategy": ["sqrt", 0.3, 0.5],
            "maxDepth": [None, 8, 12, 20],
        },
        GBT_SUB: {
            "maxIter": [200, 300, 400, 600, 800],
            "stepSize": [0.02, 0.04, 0.06, 0.08, 0.12],
            "leaves": [15, 31, 63, 127],
            "minInstancesPerNode": [50, 100, 200, 400, 800],
            "featureSubsetStrategy": [0.6, 0.8, 1.0],
            "subsamplingRate": [0.7, 0.85, 1.0],
        },
    },
    "entity": {
        LOGREG: {"inversePenalty": [float(c) for c in np.logspace(-3, 2, 12)]},
        GBT: {
            "maxIter": [100, 200, 300, 400],
            "stepSize": [0.02, 0.05, 0.08, 0.12],
            "leaves": [7, 15, 31],
            "minInstancesPerNode": [20, 50, 100, 200],
            "featureSubsetStrategy": [0.6, 0.8, 1.0],
        },
        FOREST: {
            "numTrees": [200, 300, 500],
            "minInstancesPerNode": [10, 20, 50, 100],
            "featureSubsetStrategy": ["sqrt", 0.3, 0.5],
            "maxDepth": [None, 6, 10, 16],
        },
        GBT_SUB: {
            "maxIter": [100, 200, 300, 400, 600],
            "stepSize": [0.02, 0.04, 0.06, 0.1],
            "leaves": [7, 15, 31],
            "minInstancesPerNode": [20, 50, 100, 200],
            "featureSubsetStrategy": [0.6, 0.8, 1.0],
            "subsamplingRate": [0.7, 0.85, 1.0],
        },
    },
}
# Spark's trees grow no deeper than this; "no limit" means this depth.
DEEPEST = 30
# Distinct split points per numeric column, as in histogram boosting with 255 bins.
MAX_BINS = 256


def depth_for(leaves: int) -> int:
    """Depth at which a level-wise tree can have that many leaves."""
    return max(1, math.ceil(math.log2(leaves)))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows (label, n, weight) with weight n_total / (2 n_class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("int").alias(label)).agg(
        F.count(F.lit(1)).alias("n")
    )
    # Two classes, so the total is a scalar subquery over two rows.
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("weight", total / (2 * F.col("n")))


def majority_scores(df: DataFrame, label: str, out: str = "p") -> DataFrame:
    """``df`` with the constant score 1.0 or 0.0 of its more frequent class (0 on a tie)."""
    share = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumn(out, F.when(share > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


class Candidate(Estimator):
    """Preprocessing plus classifier; fits to a plain PipelineModel.

    The encoder is fitted on the rows given to ``fit``.
    ``inversePenalty`` is the inverse L2 strength relative to the sum of the loss.
    """

    inversePenalty = Param(
        Params._dummy(), "inversePenalty", "inverse L2 strength", TypeConverters.toFloat
    )

    def __init__(self, encoder: TabularEncoder, classifier: Estimator | None, label: str, balanced: bool = False):
        super().__init__()
        self.encoder, self.classifier, self.label, self.balanced = encoder, classifier, label, balanced
        self._setDefault(inversePenalty=1.0)

    def copy(self, extra=None) -> Candidate:
        extra = extra or {}
        inner = self.classifier.copy(extra) if self.classifier is not None else None
        that = Candidate(self.encoder, inner, self.label, self.balanced)
        that._resetUid(self.uid)
        for param, value in {**self._paramMap, **extra}.items():
            if param.parent == self.uid:
                that._paramMap[that.getParam(param.name)] = value
        return that

    def param(self, name: str) -> Param:
        """The tunable parameter of that name, own or of the classifier."""
        return self.getParam(name) if name == "inversePenalty" else self.classifier.getParam(name)

    def counts(self, df: DataFrame) -> dict[int, int]:
        """Rows per class."""
        return {r[self.label]: r["n"] for r in class_weights(df, self.label).collect()}

    def _weight(self, counts: Mapping[int, int]) -> Column:
        if not self.balanced or len(counts) < 2:
            return F.lit(1.0)
        n = sum(counts.values())
        heavy = F.when(F.col(self.label).cast("int") == 1, n / (2 * counts[1]))
        return heavy.otherwise(n / (2 * counts[0]))

    def penalty(self, counts: Mapping[int, int]) -> float:
        """L2 strength relative to the mean loss; weights of either kind add up to the row count."""
        return 1.0 / (self.getOrDefault("inversePenalty") * sum(counts.values()))

    def training_rows(self, rows: DataFrame, counts: Mapping[int, int]) -> DataFrame:
        """(features, _label, _weight) of encoded rows."""
        return rows.select(
            "features", F.col(self.label).cast("double").alias("_label"), self._weight(counts).alias("_weight")
        )

    def fit_encoded(self, rows: DataFrame, counts: Mapping[int, int]):
        """Classifier fitted on rows that hold the feature vector and the label already."""
        classifier = self.classifier.copy()
        if isinstance(classifier, LogisticRegression):
            classifier.setRegParam(self.penalty(counts))
        classifier.setFeaturesCol("features").setLabelCol("_label").setWeightCol("_weight")
        training = self.training_rows(rows, counts)
        if set(counts) == {0, 1} and local_trees.covered(classifier, training, sum(counts.values())):
            return local_trees.fit(classifier, training)
        return classifier.fit(training)

    def fit_with(self, df: DataFrame, state: FittedEncoder) -> PipelineModel:
        """Fit with preprocessing that was fitted on the same rows, with scaling."""
        encoder = (state if self.scaled else state.unscaled()).model()
        return PipelineModel([*encoder.stages, self.fit_encoded(encoder.transform(df), self.counts(df))])

    def settings(self) -> dict:
        """All that a fit depends on beside its rows, as plain values."""
        inner = {p.name: v for p, v in self.classifier.extractParamMap().items()} if self.classifier is not None else {}
        kind = type(self.classifier).__name__
        return {"kind": kind, "classifier": inner, "encoder": self.encoder.settings, "label": self.label, "balanced": self.balanced, "inverse": self.getOrDefault("inversePenalty")}

    @property
    def scaled(self) -> bool:
        return self.encoder.settings["scale"]

    def constant(self, counts: Mapping[int, int]) -> float:
        """Score of the majority classifier: 1.0 if class 1 is the more frequent one."""
        return 1.0 if counts.get(1, 0) > counts.get(0, 0) else 0.0

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        if self.classifier is None:
            p = self.constant(self.counts(dataset))
            return PipelineModel([SQLTransformer(statement=f"SELECT *, {p!r}D AS p FROM __THIS__")])
        return self.fit_with(dataset, fit_state(self, dataset))


def fit_state(candidate: Candidate, df: DataFrame) -> FittedEncoder:
    """Fitted preprocessing with scaling; ``unscaled`` gives the form for trees."""
    return fit_encoder(df, **{**candidate.encoder.settings, "scale": True})


def score(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """``df`` with the probability of class 1, without the model's helper columns."""
    scored = model.transform(df)
    p = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("p")
    return scored.select(*df.columns, p.alias(out))


def boosted(seed: int, iterations: int, rate: float, leaves: int, min_rows: int, rows: float = 1.0, columns: float = 1.0):
    return GBTClassifier(
        maxIter=iterations, stepSize=rate, maxDepth=depth_for(leaves), minInstancesPerNode=min_rows,
        subsamplingRate=rows, featureSubsetStrategy=_subset(columns), maxBins=MAX_BINS, seed=seed,
    )


def _subset(share) -> str:
    return "all" if share == 1.0 else str(share)


def make_candidates(
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    grain: str = "entity",
    log_scaled: Sequence[str] = (),
    seed: int = 42,
    min_frequency: int = 20,
    smaller: Mapping[str, Mapping] | None = None,
) -> dict[str, Candidate]:
    """Unfitted candidates by name: majority, logistic regression, boosting, forest, second boosting.

    Linear models get scaled inputs, trees do not. ``smaller`` overrides settings by name,
    for short runs.
    """
    preset = {k: ({**v, **(smaller or {}).get(k, {})} if isinstance(v, dict) else v) for k, v in PRESETS[grain].items()}

    def encoder(scale: bool) -> TabularEncoder:
        return TabularEncoder(
            numeric=numeric, categorical=categorical, log_scaled=[c for c in log_scaled if c in numeric],
            scale=scale, min_frequency=min_frequency,
        )

    balanced = preset["balanced"]
    forest = preset[FOREST]
    linear = LogisticRegression(maxIter=preset[LOGREG]["iterations"], tol=1e-6, elasticNetParam=0.0, standardization=False)
    trees = RandomForestClassifier(
        numTrees=forest["trees"], minInstancesPerNode=forest["min_rows"], maxDepth=forest.get("depth", DEEPEST),
        featureSubsetStrategy="sqrt", maxBins=MAX_BINS, seed=seed,
    )
    return {
        DUMMY: Candidate(encoder(False), None, label),
        LOGREG: Candidate(encoder(True), linear, label, balanced),
        GBT: Candidate(encoder(False), boosted(seed, **preset[GBT]), label, balanced),
        FOREST: Candidate(encoder(False), trees, label, balanced),
        GBT_SUB: Candidate(encoder(False), boosted(seed, **preset[GBT_SUB]), label, balanced),
    }


def param_grid(name: str, grain: str = "entity") -> dict[str, list]:
    """Searched settings of a candidate; empty for a name without any."""
    return GRIDS[grain].get(name, {})


def draw_settings(grid: Mapping[str, list], n: int, seed: int) -> list[dict]:
    """``n`` distinct settings drawn from the grid, or all of them if there are no more."""
    everything = [dict(zip(grid, values)) for values in product(*grid.values())]
    return everything if len(everything) <= n else random.Random(seed).sample(everything, n)


def as_params(candidate: Candidate, setting: Mapping) -> dict[Param, object]:
    """A drawn setting as parameters of the candidate."""
    params = {}
    for name, value in setting.items():
        if name == "leaves":
            name, value = "maxDepth", depth_for(value)
        elif name == "maxDepth":
            value = min(value or DEEPEST, DEEPEST)
        elif name == "featureSubsetStrategy" and not isinstance(value, str):
            value = _subset(value)
        params[candidate.param(name)] = value
    return params


def random_search(
    candidate: Candidate, grid: Mapping[str, list], df: DataFrame, key: str,
    n_iter: int = 25, folds: int = 5, seed: int = 42, parallelism: int = 4, ledger: Ledger | None = None,
) -> tuple[Candidate, dict, DataFrame]:
    """(candidate with the best settings, those settings, table of all settings with mean AUC)."""
    shared_folder(df.sparkSession)
    settings = draw_settings(grid, n_iter, seed) if grid else [{}]
    maps = [as_params(candidate, s) for s in settings]
    folded = stratified_folds(df, key, candidate.label, folds, seed, "_fold").checkpoint()
    tried = {str(i): candidate.copy(m) for i, m in enumerate(maps)}
    oof = out_of_fold(tried, folded, "_fold", folds, ["test"], parallelism, ledger)
    means = ranking_metrics(oof, by=["candidate", "fold"]).groupBy("candidate").agg(F.avg("roc_auc").alias("auc"))
    aucs = {int(r["candidate"]): r["auc"] for r in means.collect()}
    best = max(range(len(settings)), key=lambda i: aucs[i])
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in s.items()), float(aucs[i]), i == best) for i, s in enumerate(settings)
    ]
    table = df.sparkSession.createDataFrame(rows, "setting int, params string, roc_auc double, best boolean")
    return candidate.copy(maps[best]), settings[best], table


def out_of_fold(
    candidates: Mapping[str, Candidate], df: DataFrame, fold: str, folds: int,
    parts: Sequence[str] = ("test", "train"), parallelism: int = 4, ledger: Ledger | None = None,
) -> DataFrame:
    """Scores (candidate, fold, part, y, p) of every fold by models fitted on the others.

    The candidates have the same columns, so preprocessing is fitted once per fold, on the
    rows outside it. ``part`` is 'test' for the held-out fold and 'train' for the rows
    fitted on. At most ``parallelism`` fits run at a time, of one fold or of several.

    Scores are written to the checkpoint folder, so metrics do not score again. With a ``ledger`` each candidate's scores of a fold
    are a part of it, named by the rows, the fold and the candidate's settings, and a part that is there is not fitted again.
    """
    spark = df.sparkSession
    shared_folder(spark)
    any_one = next(iter(candidates.values()))
    label, source = any_one.label, fingerprint(df) if ledger else ""
    in_thread = inheritable_thread_target(spark)

    def key_of(i: int, candidate: Candidate) -> dict:
        return {"input": source, "fold": i, "of": fold, "parts": sorted(parts), "settings": candidate.settings()}

    def fold_scores(i: int) -> DataFrame:
        missing = {n: c for n, c in candidates.items() if not (ledger and ledger.done(key_of(i, c)))}
        fitted = [c for c in missing.values() if c.classifier is not None]
        encoded, counts = {}, {}
        if missing:
            train = df.where(F.col(fold) != i)
            counts = any_one.counts(train)
        if fitted:
            state = fit_state(fitted[0], train)
            for scaled in {c.scaled for c in fitted}:
                encoder = (state if scaled else state.unscaled()).model()
                encoded[scaled] = encoder.transform(df).select(fold, label, "features").persist()

        def scores_of(candidate: Candidate) -> DataFrame:
            if candidate.classifier is None:
                rows, p = df, F.lit(candidate.constant(counts))
            else:
                rows = encoded[candidate.scaled]
                rows = candidate.fit_encoded(rows.where(F.col(fold) != i), counts).transform(rows)
                p = vector_to_array("probability")[1]
            part = F.when(F.col(fold) == i, "test").otherwise("train")
            return rows.select(part.alias("part"), F.col(label).cast("int").alias("y"), p.alias("p")).where(F.col("part").isin(*parts))

        def found_of(item) -> DataFrame:
            name, candidate = item
            rows = ledger.table(key_of(i, candidate), lambda: scores_of(candidate)) if ledger else scores_of(candidate)
            return rows.select(F.lit(name).alias("candidate"), F.lit(i).alias("fold"), "part", "y", "p")

        with ThreadPool(min(parallelism, len(candidates))) as pool:
            found = pool.map(in_thread(found_of), candidates.items())
        scores = reduce(DataFrame.unionByName, found)
        scores = scores if ledger else scores.checkpoint()
        for rows in encoded.values():
            rows.unpersist()
        return scores

    with ThreadPool(max(1, min(folds, parallelism // len(candidates)))) as pool:
        return reduce(DataFrame.unionByName, pool.map(in_thread(fold_scores), range(folds)))


def cross_validate(
    candidates: Mapping[str, Candidate], df: DataFrame, key: str, label: str,
    folds: int = 5, seed: int = 42, group: str | None = None, ledger: Ledger | None = None,
) -> DataFrame:
    """Rows (candidate, part, metric, mean, sd) over stratified folds, or whole-group folds."""
    if group is None:
        folded = stratified_folds(df, key, label, folds, seed, "_fold")
    else:
        folded = with_group_folds(df, group, folds, seed, "_fold")
    oof = out_of_fold(candidates, folded.checkpoint(), "_fold", folds, ledger=ledger)
    return cv_report(oof, "y", "p", "fold", ["candidate", "part"])


def best_candidate(report: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """One row (candidate, mean): greatest mean of the metric, majority left out, first name on ties."""
    rows = report.where((F.col("metric") == metric) & (F.col("candidate") != DUMMY))
    return rows.orderBy(F.desc_nulls_last("mean"), "candidate").limit(1).select("candidate", "mean")


def holdout_table(
    scores: DataFrame, names: Sequence[str], best: str, cuts: Mapping[str, float], y: str = "y", p: str = "p"
) -> DataFrame:
    """Rows (name, metrics): every named candidate at 0.5, the best one at each named cut too.

    ``scores`` holds rows (candidate, y, p).
    """
    wanted = [(n, n, 0.5) for n in names] + [(best, f"{best}@{cut}", t) for cut, t in cuts.items()]
    return evaluate_at(scores, "candidate", wanted, y, p).withColumnRenamed("label", "name")


def tree_slice(model: TreeModel, low: int, high: int) -> TreeModel:
    """The model of the trees from ``low`` to ``high``, under the same column names."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml

    def part_of(values, kind):
        taken = gateway.new_array(kind, high - low)
        for i in range(low, high):
            taken[i - low] = values[i]
        return taken

    if isinstance(model, GBTClassificationModel):
        trees = part_of(java.trees(), ml.regression.DecisionTreeRegressionModel)
        weights = part_of(java.treeWeights(), gateway.jvm.double)
        part = GBTClassificationModel(ml.classification.GBTClassificationModel(model.uid, trees, weights, model.numFeatures, 2))
    else:
        trees = part_of(java.trees(), ml.classification.DecisionTreeClassificationModel)
        part = RandomForestClassificationModel(ml.classification.RandomForestClassificationModel(model.uid, trees, model.numFeatures, model.numClasses))
    return part.setFeaturesCol(model.getFeaturesCol())


def prefix_scores(model: TreeModel, rows: DataFrame, sizes: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """Rows (keep, size, p): scores of the first ``size`` trees of one fitted model, each tree evaluated once.

    Boosting adds up its trees' margins, so the first n rounds of a fit score as a fit of n rounds does; a forest adds up its
    trees' votes. The trees between two sizes are a model of their own, and its sums are added to those before.
    """
    cuts = sorted({min(int(n), len(model.treeWeights)) for n in sizes})
    raw = []
    for i, (low, high) in enumerate(zip([0, *cuts], cuts)):
        name = f"_raw{i}"
        part = tree_slice(model, low, high).setRawPredictionCol(name).setProbabilityCol("").setPredictionCol("")
        rows = part.transform(rows)
        raw.append(vector_to_array(name))
    scores, for_, against = [], F.lit(0.0), F.lit(0.0)
    for n, votes in zip(cuts, raw):
        against, for_ = against + votes[0], for_ + votes[1]
        p = 1 / (1 + F.exp(-2 * for_)) if isinstance(model, GBTClassificationModel) else for_ / (for_ + against)
        scores.append(F.struct(F.lit(n).alias("size"), p.alias("p")))
    return rows.select(*keep, F.inline(F.array(*scores)))


def learning_curve(
    candidate: Candidate, train: DataFrame, test: DataFrame, sizes: Sequence[int],
) -> DataFrame:
    """Rows (size, train_auc, test_auc) for a growing number of trees, all of one fit with the most of them."""
    shared_folder(train.sparkSession)
    name = "maxIter" if candidate.classifier.hasParam("maxIter") else "numTrees"
    largest = candidate.copy({candidate.param(name): max(int(n) for n in sizes)}).fit(train)
    return ranking_curve(largest, candidate.label, train, test, sizes)


def ranking_curve(fitted: PipelineModel, label: str, train: DataFrame, test: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Rows (size, n_train, n_test, train_auc, test_auc) of the first trees of a fitted pipeline."""
    encoder = PipelineModel(fitted.stages[:-1])
    parts = [
        encoder.transform(rows).select("features", F.lit(part).alias("part"), F.col(label).cast("int").alias("y"))
        for part, rows in (("train", train), ("test", test))
    ]
    scores = prefix_scores(fitted.stages[-1], parts[0].unionByName(parts[1]), sizes, ["part", "y"]).checkpoint()
    aucs = ranking_metrics(scores, by=["size", "part"]).join(scores.groupBy("size", "part").agg(F.count(F.lit(1)).alias("rows")), ["size", "part"])
    at = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c)))
    return aucs.groupBy("size").agg(
        at("train", "rows").alias("n_train"), at("test", "rows").alias("n_test"),
        at("train", "roc_auc").alias("train_auc"), at("test", "roc_auc").alias("test_auc"),
    )
