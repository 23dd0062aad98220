"""Registered queries: every operator over the whole test tables.

Results are rounded and widened by ``tidy`` so that they can be compared as values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from hashlib import md5
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions import scalar as S
from riskframe.operators import audit, duplicates, encode, evaluate as ev, explain, features as feat, joins, models
from riskframe.operators import panel, profile as prof, roles, sampling, scoring, segments
from riskframe.plans import demo, training
from riskframe.sources import io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to 6 places (no negative zero), integers to BIGINT.

    The shift by 1e-9 makes exact halves in the seventh place round the same way whatever
    the order in which an average was summed.
    """
    def fix(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return (F.round(F.col(name).cast("double") + F.lit(1e-9), 6) + F.lit(0.0)).alias(name)
        if kind in ("int", "smallint", "tinyint", "bigint"):
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*[fix(n, k) for n, k in df.dtypes])


def query(f: Query) -> Query:
    """Register under the function's name."""
    @wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return tidy(f(spark, sf))

    QUERIES[f.__name__] = run
    return run


def _numeric(df: DataFrame) -> list[str]:
    """Every numeric feature."""
    return [c for c in roles.numeric_columns(df) if c != "entity_id"]


def _folder(spark: SparkSession, sf: str, name: str) -> str:
    return f"{io.shared_folder(spark)}/riskframe/{md5(sf.encode()).hexdigest()[:8]}/{name}"


# -- sources and sinks -------------------------------------------------------------------


@query
def scan_entity(spark, sf):
    return demo.table(spark, sf, "customer")


@query
def scan_units_present(spark, sf):
    return demo.present_units(spark, sf).select("unit_id", "entity_id", "network", "label")


@query
def enrich_slices(spark, sf):
    return demo.externals(spark, sf).withColumns(
        {c: F.round(c, 2) for c in ("output", "va", "va_agro", "va_industry", "va_services")}
    )


@query
def coverage(spark, sf):
    return joins.coverage(demo.externals(spark, sf), ["population", "output", "va", "balance", "region_name"])


@query
def materialize_once(spark, sf):
    path = _folder(spark, sf, f"outcomes-{uuid4().hex}")
    io.materialize(spark, lambda: demo.outcomes(spark, sf), path)
    return io.materialize(spark, lambda: demo.outcomes(spark, sf).limit(0), path)


@query
def publish_table(spark, sf):
    name = f"riskframe_targets_{uuid4().hex[:8]}"
    return io.publish_table(demo.targets(spark, sf), name, _folder(spark, sf, name))


@query
def metrics_long(spark, sf):
    rows = demo.scored(spark, sf).withColumn("name", F.col("network"))
    return ev.metrics_long(ev.evaluate(rows, 0.5, by=["name"]), ["name"])


@query
def model_roundtrip(spark, sf):
    df, candidate = _small_entity_model(spark, sf)
    model = candidate.fit(df)
    path = _folder(spark, sf, f"model-{uuid4().hex}")
    io.save_model(model, path, {"cost": 0.5, "seed": 42})
    loaded, info = io.load_model(spark, path)
    before = models.score(model, df, "p1").select("entity_id", "p1")
    after = models.score(loaded, df, "p2").select("entity_id", "p2")
    return before.join(after, ["entity_id"]).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_difference"),
        F.lit(info["seed"]).alias("seed"),
    )


# -- schema and projections --------------------------------------------------------------


@query
def normalize_names(spark, sf):
    upper = demo.units(spark, sf).select("unit_id", "entity_id", "label").toDF("UNIT_ID", "Entity_Id", "LABEL")
    return roles.lower_names(upper)


@query
def drop_dated_columns(spark, sf):
    kept = ["goal_2001"]
    return roles.drop_dated(demo.gold(spark, sf), ["outcome_", "goal_"], ["units_2000", "gap_2000", "reached_2000"], kept)


@query
def split_targets(spark, sf):
    return demo.targets(spark, sf)


@query
def leakage_scan(spark, sf):
    df = demo.present_units(spark, sf)
    return roles.leakage_scan(df, "label", [c for c in roles.numeric_columns(df) if c != "label"])


CLUSTER_DROP = [
    "group_code", "group_name", "region_name", "gap_1999", "effort_2000", "ambition_2003", "reached_1999",
    *[f"goal_{y}" for y in range(1999, 2004)],
]


@query
def cluster_matrix(spark, sf):
    ids = ["entity_id", "entity_name"]
    out, _, _ = segments.cluster_matrix(demo.features(spark, sf), ids, CLUSTER_DROP, ["size_band", "hub"])
    return out.withColumns({c: F.round(c, 2) for c in ("output", "va", "va_agro", "va_industry", "va_services")})


# -- filters -----------------------------------------------------------------------------


@query
def labelled_only(spark, sf):
    return sampling.labelled_only(demo.matrix(spark, sf, 2000).select("entity_id", "reached_2000", "outcome_t1"), ["reached_2000", "outcome_t1"])


@query
def hash_sample(spark, sf):
    return demo.present_units(spark, sf).where(S.in_hash_sample("unit_id", 20)).select("unit_id", "raw_score", "label")


@query
def decide_at_threshold(spark, sf):
    return demo.scored(spark, sf).select("unit_id", "p", S.decide("p", 0.5).alias("decision"))


# -- joins -------------------------------------------------------------------------------


@query
def join_one_to_one(spark, sf):
    out = joins.checked_join(demo.gold(spark, sf), demo.externals(spark, sf), ["entity_id"], "left", "1:1")
    return out.select("entity_id", "entity_name", "n_sites", "population", "region_name")


def _sized(spark, sf):
    return demo.features(spark, sf).where(F.col("population").isNotNull())


@query
def join_units_to_entity(spark, sf):
    units = demo.present_units(spark, sf).select("unit_id", "entity_id", "network", "label")
    out = joins.checked_join(units, _sized(spark, sf), ["entity_id"], "inner", "m:1")
    return out.select("unit_id", "entity_id", "network", "label", "region_name", "size_band", "share_rural")


@query
def join_drop_report(spark, sf):
    return joins.join_drop_report(demo.present_units(spark, sf), _sized(spark, sf), ["entity_id"])


@query
def duplicate_keys(spark, sf):
    return joins.duplicate_keys(demo.table(spark, sf, "lineitem", "l_orderkey", "l_partkey"), ["l_orderkey", "l_partkey"])


@query
def region_lookup(spark, sf):
    customer = demo.table(spark, sf, "customer", "c_custkey", "c_nationkey").toDF("entity_id", "group_code")
    out = panel.region_lookup(customer, "group_code", demo.groups(spark, sf))
    return out.select(
        "entity_id", S.padded_code("group_code").alias("code"), S.region_of("group_code").alias("macro_region"),
        "group_name", "region_name",
    )


# -- panel -------------------------------------------------------------------------------

MATRIX_COLUMNS = ["entity_id", *panel.HISTORY, "share_rural", "size_band", "region_name"]


@query
def relative_matrix_train(spark, sf):
    return demo.matrix(spark, sf, 2000).select(*MATRIX_COLUMNS, "reached_2000")


@query
def relative_matrix_project(spark, sf):
    return demo.matrix(spark, sf, 2001).select(*MATRIX_COLUMNS)


@query
def yoy_delta(spark, sf):
    return panel.yoy_delta(demo.outcomes(spark, sf), "entity_id", "yr", "outcome", list(range(1995, 2002)))


# -- scalar features ---------------------------------------------------------------------


@query
def ratio_features(spark, sf):
    return demo.store(spark, sf).select("entity_id", *demo.RATIOS)


@query
def goal_features(spark, sf):
    names = ["delta_1998_1999", "gap_1999", "reached_1999", "effort_2000", "ambition_2003"]
    return demo.store(spark, sf).select("entity_id", *names)


@query
def size_features(spark, sf):
    return demo.store(spark, sf).select("entity_id", "population", "log_population", "size_band")


@query
def symlog(spark, sf):
    customer = demo.table(spark, sf, "customer", "c_custkey", "c_acctbal")
    return customer.select("c_custkey", S.symlog("c_acctbal").alias("log_balance"))


@query
def size_band(spark, sf):
    prices = demo.table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    band = S.size_band("o_totalprice")
    return prices.select("o_orderkey", band.alias("band"), S.band_rank(band).alias("band_rank"))


# -- aggregates --------------------------------------------------------------------------


@query
def leakage_evidence(spark, sf):
    return roles.leakage_evidence(demo.present_units(spark, sf), "label", "raw_score")


@query
def rate_by_group(spark, sf):
    rows = demo.with_group(spark, sf, demo.present_units(spark, sf))
    code = F.substring("network", 1, 1).cast("int")
    named = rows.withColumn("network_name", S.lookup(code, S.NETWORK_NAMES))
    return prof.rate_by(named, ["group_name", "network_name"], "label")


@query
def rate_by_band(spark, sf):
    out = prof.rate_by(demo.store(spark, sf), ["size_band"], "reached_2000")
    return out.withColumn("band_rank", S.band_rank("size_band"))


@query
def evolution_by_region(spark, sf):
    return prof.mean_by(demo.store(spark, sf), ["region_name"], ["outcome_1998", "outcome_1999", "outcome_2000"])


@query
def describe_by_group(spark, sf):
    return prof.describe_by(demo.saved_store(spark, sf), ["region_name"], "outcome_2000")


@query
def effort_by_outcome(spark, sf):
    known = sampling.labelled_only(demo.saved_store(spark, sf), ["reached_2000"])
    return prof.describe_by(known, ["reached_2000"], "effort_2000")


@query
def gap_by_group(spark, sf):
    return prof.mean_by(demo.store(spark, sf), ["group_name"], ["gap_2000"]).orderBy("gap_2000", "group_name")


@query
def missingness(spark, sf):
    return prof.missingness(demo.features(spark, sf))


@query
def entity_aggregate(spark, sf):
    return prof.entity_aggregate(demo.with_group(spark, sf, demo.scored(spark, sf)), "entity_id", "group_name")


@query
def entity_correlations(spark, sf):
    io.shared_folder(spark)
    agg = prof.entity_aggregate(demo.with_group(spark, sf, demo.scored(spark, sf)), "entity_id", "group_name")
    # Read several times, so written once.
    return prof.entity_correlations(agg.checkpoint())


@query
def spearman_pair(spark, sf):
    return prof.spearman(demo.scored(spark, sf), "p", "y")


@query
def spearman_vs_target(spark, sf):
    columns = _numeric(demo.features(spark, sf))
    return prof.strongest(prof.spearman_vs_target(demo.saved_store(spark, sf), columns, "outcome_2000"), len(columns))


@query
def icc(spark, sf):
    return prof.icc(demo.present_units(spark, sf), "entity_id", "label")


@query
def histogram(spark, sf):
    return prof.histogram(demo.store(spark, sf), "outcome_2000", 50)


@query
def histogram_by_class(spark, sf):
    return prof.histogram(demo.present_units(spark, sf), "raw_score", 60, ["label"])


@query
def box_stats(spark, sf):
    return prof.box_stats(demo.saved_store(spark, sf), ["region_name"], "output_per_capita")


@query
def rate_by_quintile(spark, sf):
    balance = demo.table(spark, sf, "customer", "c_custkey", "c_acctbal").toDF("entity_id", "balance")
    rows = joins.lookup_join(demo.present_units(spark, sf), balance, ["entity_id"], "inner")
    return prof.rate_by_quantile(rows, "balance", "label", 5)


@query
def quality_gates(spark, sf):
    df = demo.features(spark, sf)
    gap = F.col("delta_1998_1999") - (F.col("outcome_1999") - F.col("outcome_1998"))
    return prof.quality_gates(
        df, "entity_id", covered=["population", "va", "balance"],
        median_between={"population": (10_000, 1_000_000)}, p99_at_most={"share_agro": 1.0, "share_rural": 0.9},
        identities={"delta": (gap, 1e-6)}, domains={"region_name": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]},
    )


@query
def duplicate_columns(spark, sf):
    """All features, with a copy, a copy with gaps and a reversed copy of the population beside them."""
    df = demo.features(spark, sf).withColumns(
        {
            "planted_copy": F.col("population").cast("double"), "planted_gaps": F.when(F.col("entity_id") % 7 > 0, F.col("population")),
            "planted_reverse": -F.col("population"), "planted_miss": F.when(F.col("entity_id") % 50 > 0, F.col("population")).otherwise(F.col("population") + 1),
            "planted_name": F.col("group_name"),
        }
    )
    return duplicates.duplicate_columns(df, "entity_id")


# -- preprocessing -----------------------------------------------------------------------


@query
def impute_median(spark, sf):
    df = demo.features(spark, sf)
    df = df.select("entity_id", *_numeric(df))
    return encode.impute_median(df, _numeric(df))


@query
def impute_mode(spark, sf):
    return encode.impute_mode(demo.features(spark, sf).select("entity_id", "size_band", "hub"), ["size_band", "hub"])


@query
def standardize(spark, sf):
    df = demo.features(spark, sf)
    df = df.select("entity_id", *_numeric(df))
    return encode.standardize(df, _numeric(df))


@query
def one_hot_counts(spark, sf):
    return encode.one_hot_vocabulary(demo.features(spark, sf), ["group_name", "size_band"], 20)


def _preprocessed(spark, sf, scale):
    """All numeric and categorical features; a category needs 20 rows."""
    df = demo.features(spark, sf)
    numeric, categorical = [c for c in _numeric(df) if c != "hub"], ["group_name", "region_name", "size_band", "hub"]
    log_scaled = [c for c in demo.ROLES.log_scaled if c in numeric]
    fitted = encode.fit_encoder(df, numeric, categorical, log_scaled, scale, 20)
    return encode.matrix_long(df, "entity_id", fitted)


@query
def preprocess_matrix(spark, sf):
    return _preprocessed(spark, sf, True)


@query
def preprocess_matrix_unscaled(spark, sf):
    return _preprocessed(spark, sf, False)


# -- samples, holdouts, folds ------------------------------------------------------------


def _unit_labels(spark, sf):
    return demo.present_units(spark, sf).select("unit_id", "entity_id", "network", "label")


@query
def stratified_holdout(spark, sf):
    return sampling.stratified_holdout(_unit_labels(spark, sf), "unit_id", "label").select("unit_id", "label", "split")


@query
def split_summary(spark, sf):
    return sampling.split_summary(sampling.stratified_holdout(_unit_labels(spark, sf), "unit_id", "label"), "split", "label")


@query
def stratified_folds(spark, sf):
    return sampling.stratified_folds(_unit_labels(spark, sf), "unit_id", "label").select("unit_id", "label", "fold")


@query
def group_folds(spark, sf):
    return sampling.group_folds(_unit_labels(spark, sf), "entity_id")


@query
def fold_group_overlap(spark, sf):
    """Entities split by label folds; whole-entity folds add none."""
    by_label = sampling.stratified_folds(_unit_labels(spark, sf), "unit_id", "label", 2)
    by_group = sampling.with_group_folds(_unit_labels(spark, sf), "entity_id", 2)
    found = [
        sampling.fold_group_overlap(df, "entity_id", "fold").withColumn("folds", F.lit(name))
        for name, df in (("label", by_label), ("group", by_group))
    ]
    return found[0].unionByName(found[1])


@query
def stratified_sample(spark, sf):
    return sampling.stratified_sample(_unit_labels(spark, sf), "unit_id", 3000, ["network", "label"])


@query
def subsample_n(spark, sf):
    return sampling.subsample(_unit_labels(spark, sf), "unit_id", 2000).select("unit_id", "label")


# -- evaluation --------------------------------------------------------------------------


@query
def score_violations(spark, sf):
    """Raw prices beside valid scores: prices are far outside [0, 1]."""
    rows = demo.scored(spark, sf).select("y", "p")
    prices = demo.units(spark, sf).select(F.col("label").alias("y"), (F.col("raw_score") / 4e5).alias("p"))
    return ev.score_violations(rows.unionByName(prices))


@query
def confusion(spark, sf):
    return ev.confusion(demo.scored(spark, sf), 0.5)


@query
def confusion_pct(spark, sf):
    return ev.confusion_pct(ev.confusion(demo.scored(spark, sf), 0.5))


@query
def binary_metrics(spark, sf):
    return ev.evaluate(demo.scored(spark, sf), 0.5)


@query
def roc_auc(spark, sf):
    return ev.ranking_metrics(demo.scored(spark, sf), by=["network"]).select("network", "roc_auc")


@query
def average_precision(spark, sf):
    return ev.ranking_metrics(demo.scored(spark, sf)).select("pr_auc")


@query
def average_precision_risk(spark, sf):
    return ev.ranking_metrics(demo.scored(spark, sf)).select("pr_auc_risk")


@query
def brier_logloss(spark, sf):
    return ev.brier_logloss(demo.scored(spark, sf))


@query
def threshold_f1(spark, sf):
    return ev.best_threshold_f1(demo.scored(spark, sf))


@query
def threshold_f1_risk(spark, sf):
    return ev.best_threshold_f1(demo.scored(spark, sf), "risk")


@query
def threshold_cost(spark, sf):
    return ev.best_threshold_cost(demo.scored(spark, sf))


@query
def calibration_table(spark, sf):
    return ev.calibration_table(demo.scored(spark, sf))


@query
def calibration_uniform(spark, sf):
    return ev.calibration_table(demo.scored(spark, sf), 10, "uniform")


@query
def ece(spark, sf):
    return ev.calibration_error(demo.scored(spark, sf))


@query
def roc_curve(spark, sf):
    return ev.roc_curve(demo.scored(spark, sf))


@query
def pr_curve(spark, sf):
    return ev.pr_curve(demo.scored(spark, sf))


OPERATING_CUTS = [0.3, 0.5, 0.6, 0.696, 0.8]


@query
def operating_points(spark, sf):
    return ev.operating_points(demo.scored(spark, sf), OPERATING_CUTS)


# -- scores, reports, selection ----------------------------------------------------------


@query
def dummy_scores(spark, sf):
    return models.majority_scores(_unit_labels(spark, sf), "label").select("unit_id", "p")


@query
def class_weights(spark, sf):
    return models.class_weights(_unit_labels(spark, sf), "label")


def _folded_scores(spark, sf):
    """Three fixed scores per unit with its fold: constant, mixed, and mostly noise."""
    rows = sampling.stratified_folds(demo.scored(spark, sf), "unit_id", "y", 5)
    noise = (S.md5_number(F.concat(F.lit("n"), F.col("unit_id").cast("string"))) % 1000).cast("double") / F.lit(1000.0)
    named = F.explode(
        F.array(
            F.struct(F.lit("dummy").alias("candidate"), F.lit(1.0).alias("p")),
            F.struct(F.lit("mixed").alias("candidate"), F.col("p").alias("p")),
            F.struct(F.lit("noisy").alias("candidate"), noise.alias("p")),
        )
    )
    return rows.select("unit_id", "fold", "y", named.alias("_s")).select("unit_id", "fold", "y", "_s.candidate", "_s.p")


@query
def cv_report(spark, sf):
    return ev.cv_report(_folded_scores(spark, sf), by=["candidate"])


@query
def best_candidate(spark, sf):
    return models.best_candidate(ev.cv_report(_folded_scores(spark, sf), by=["candidate"]))


HOLDOUT_CUTS = {"f1": 0.45, "cost": 0.7}


@query
def holdout_table(spark, sf):
    return models.holdout_table(_folded_scores(spark, sf), ["dummy", "mixed", "noisy"], "mixed", HOLDOUT_CUTS)


@query
def risk_ranking(spark, sf):
    return scoring.risk_ranking(demo.projected(spark, sf), "entity_id", "risk").select("position", "entity_id", "risk")


@query
def top_k_risk(spark, sf):
    return scoring.top_risk(demo.projected(spark, sf), "entity_id", "risk", 10)


@query
def topk_concentration(spark, sf):
    return scoring.concentration(demo.projected(spark, sf), "entity_id", "risk", "group_name", 100)


@query
def ranking_sanity(spark, sf):
    return scoring.ranking_sanity(demo.projected(spark, sf))


# -- segments ----------------------------------------------------------------------------

def _profile(spark, sf):
    df = demo.features(spark, sf)
    return prof.medians_by(df, ["segment"], _numeric(df))


@query
def segment_profile(spark, sf):
    return _profile(spark, sf)


@query
def segment_names(spark, sf):
    return segments.segment_names(_profile(spark, sf), "segment", "outcome_1999", "share_rural", "population")


@query
def segment_outcome(spark, sf):
    feats, targets = demo.features_and_targets(spark, sf)
    return segments.segment_outcome(feats, targets, "entity_id", "segment", "reached_2000")


@query
def segment_by_region(spark, sf):
    df = demo.features(spark, sf)
    return prof.crosstab(df, "segment", "region_name", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@query
def silhouette_centroid(spark, sf):
    vectors = demo.table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return segments.silhouette_centroid(vectors, "embedding", "label")


@query
def silhouette_squared(spark, sf):
    df = demo.table(spark, sf, "embeddings").withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    return segments.silhouette_squared(df, "features", "label")


# -- explanation -------------------------------------------------------------------------

SHAP_WEIGHTS = {"outcome_1999": 0.05, "share_rural": -1.5, "log_population": 0.25, "balance": 0.0002, "items_per_line": -0.1}


def _shap(spark, sf):
    df = demo.features(spark, sf).select("entity_id", *SHAP_WEIGHTS)
    return explain.linear_shap(encode.impute_median(df, list(SHAP_WEIGHTS)), "entity_id", SHAP_WEIGHTS)


@query
def linear_shap(spark, sf):
    return _shap(spark, sf)


@query
def shap_ranking(spark, sf):
    return explain.shap_ranking(_shap(spark, sf), 15)


@query
def permuted_column(spark, sf):
    return explain.permuted_column(demo.present_units(spark, sf), "unit_id", "raw_score", 0)


IMPORTANCE_WEIGHTS = {"effort_2000": -0.04, "share_rural": 1.5, "items_per_line": -0.05}


@query
def permutation_importance(spark, sf):
    """A fixed linear score, on a grid of 1/1000, in place of a fitted model."""
    io.shared_folder(spark)
    columns = list(IMPORTANCE_WEIGHTS)
    known = sampling.labelled_only(demo.saved_store(spark, sf), ["reached_2000"])
    rows = encode.impute_median(known.select("entity_id", "reached_2000", *columns), columns)
    logit = " + ".join(f"{w!r}D * {c}" for c, w in IMPORTANCE_WEIGHTS.items())
    scorer = PipelineModel(
        [SQLTransformer(statement=f"SELECT *, floor(1e3D / (1D + exp(-({logit}))) + 5e-1D) / 1e3D AS p FROM __THIS__")]
    )
    return explain.permutation_importance(scorer, rows.checkpoint(), "entity_id", "reached_2000", columns, repeats=3)


# -- fitted models -------------------------------------------------------------------------
# Nothing is cut: published settings, whole grids, five folds. A fit has no SQL counterpart, so these
# queries return facts about it that SQL can state. Comparing all candidates over folds, the learning curve
# and the two whole training runs take hours at these settings; they are library functions without a query.


def _entity_rows(spark, sf):
    """Labelled training matrix, written once to the checkpoint folder."""
    io.shared_folder(spark)
    return sampling.labelled_only(demo.matrix(spark, sf, 2000), ["reached_2000"]).checkpoint()


def _halves(spark, sf):
    """(training rows, held-out rows) of the labelled matrix."""
    split = sampling.stratified_holdout(_entity_rows(spark, sf), "entity_id", "reached_2000").checkpoint()
    return split.where("split = 'train'"), split.where("split = 'test'")


def _candidate(df, name, cfg=training.TrainConfig()):
    return training._candidates(df, demo.ENTITY_TASK, cfg)[name]


def _facts(spark, **values) -> DataFrame:
    """One row of a fit's facts."""
    kinds = {bool: "boolean", int: "long", str: "string"}
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))


def _fit_and_evaluate(spark, sf, name):
    """Fitted on the training rows, audited on them, evaluated on the held-out ones; ``evaluate`` refuses invalid scores."""
    train, test = _halves(spark, sf)
    candidate = _candidate(train, name)
    model = candidate.fit(train)
    scored = lambda rows: models.score(model, rows).select(F.col("reached_2000").cast("int").alias("y"), "p").checkpoint()
    found = ev.evaluate(scored(test)).first()
    # The held-out AUC says as much about the data as about the fit; on its own rows a sound fit beats the majority's 0.5.
    auc = ev.ranking_metrics(scored(train)).first()["roc_auc"]
    facts = audit.linear_facts if name == models.LOGREG else audit.tree_facts
    return _facts(
        spark, n_train=train.count(), n_test=found["n"], positives=found["fn"] + found["tp"],
        train_auc_above_majority=auc > 0.5, **facts(candidate, model, train),
    )


@query
def fit_logreg(spark, sf):
    return _fit_and_evaluate(spark, sf, models.LOGREG)


@query
def fit_forest(spark, sf):
    return _fit_and_evaluate(spark, sf, models.FOREST)


@query
def fit_gbt(spark, sf):
    return _fit_and_evaluate(spark, sf, models.GBT)


@query
def fit_gbt_subsampled(spark, sf):
    return _fit_and_evaluate(spark, sf, models.GBT_SUB)


@query
def learning_curve(spark, sf):
    """Six sizes of one boosting fit at published settings with 800 rounds; the largest is the fit itself."""
    train, test = _halves(spark, sf)
    sizes = training.TrainConfig().curve_sizes
    candidate = _candidate(train, models.GBT)
    fitted = candidate.copy({candidate.param("maxIter"): max(sizes)}).fit(train)
    curve = models.ranking_curve(fitted, candidate.label, train, test, sizes)
    whole = models.score(fitted, test).select(F.col("reached_2000").cast("int").alias("y"), "p").checkpoint()
    auc = ev.ranking_metrics(whole).first()["roc_auc"]
    # What SQL can state: rows of either part, the train curve above the majority, the last point that of the fit itself.
    return curve.select(
        "size", "n_train", "n_test", (F.col("train_auc") > 0.5).alias("train_above_majority"),
        ((F.col("size") < max(sizes)) | (F.abs(F.col("test_auc") - F.lit(auc)) < 1e-9)).alias("last_is_the_fit"),
    )


@query
def random_search(spark, sf):
    """The whole grid of the linear model over five folds."""
    df = _entity_rows(spark, sf)
    _, best, table = models.random_search(_candidate(df, models.LOGREG), models.param_grid(models.LOGREG), df, "entity_id")
    rows = table.collect()
    top = [r for r in rows if r["best"]]
    return _facts(
        spark, n_settings=len(rows), n_best=len(top), best_is_greatest=top[0]["roc_auc"] == max(r["roc_auc"] for r in rows),
        best_is_returned=top[0]["params"] == f"inversePenalty={best['inversePenalty']}",
    )


@query
def ablation(spark, sf):
    """The tuned penalty holds for the model without history too."""
    train, test = _halves(spark, sf)
    cfg, settings = training.TrainConfig(), {"inversePenalty": 0.01}
    plain = _candidate(train, models.LOGREG)
    tuned = plain.copy(models.as_params(plain, settings))
    bare = training.without_history(train, demo.ENTITY_TASK, cfg, models.LOGREG, settings)
    table = training.ablate_history(train, test, demo.ENTITY_TASK, cfg, models.LOGREG, settings, tuned.fit(train))
    gone = set(tuned.encoder.settings["numeric"] + tuned.encoder.settings["categorical"]) - set(
        bare.encoder.settings["numeric"] + bare.encoder.settings["categorical"]
    )
    return _facts(
        spark, n_test=test.count(), n_dropped=len(gone), n_variants=table.count(),
        same_settings=bare.getOrDefault("inversePenalty") == tuned.getOrDefault("inversePenalty") == 0.01,
    )


@query
def project_and_rank(spark, sf):
    """Facts of the list that a model fitted on all labelled rows gives for the next year."""
    df = _entity_rows(spark, sf)
    ranked = training.project_and_rank(
        _candidate(df, models.LOGREG).fit(df), demo.matrix(spark, sf, 2001), "entity_id", "entity_name", "group_name"
    ).checkpoint()
    risk = F.col("risk").between(0, 1)
    return ranked.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("entity_id").alias("n_entities"), F.min("position").alias("first"),
        F.max("position").alias("last"), F.min(risk).alias("valid"),
    )


@query
def train_save_rank(spark, sf):
    """The short training run saves its model, metrics and thresholds; the projection job loads and ranks."""
    out = _folder(spark, sf, f"run-{uuid4().hex}")
    cfg = training.TrainConfig(candidates=(models.DUMMY, models.LOGREG)).fast()
    result = training.train_entities(_entity_rows(spark, sf), demo.ENTITY_TASK, cfg, with_ablation=False, out=out)
    training.projection_job(spark, f"{out}/model", demo.matrix(spark, sf, 2001), "entity_id", "entity_name", "group_name", f"{out}/ranking")
    _, info = io.load_model(spark, f"{out}/model")
    ranking = spark.read.option("header", True).csv(f"{out}/ranking")
    return _facts(
        spark, n_ranked=ranking.count(), n_positions=ranking.select("position").distinct().count(), seed=info["seed"],
        same_thresholds=info["thresholds"] == result.thresholds and info["params"] == result.params,
        has_metrics=spark.read.json(f"{out}/metrics").where("name = 'logreg' and metric = 'roc_auc'").count() == 1,
    )


def _shared_model(spark, sf):
    """(pipeline, training rows, held-out rows) of the linear model."""
    train, test = _halves(spark, sf)
    return _candidate(train, models.LOGREG).fit(train), train, test


@query
def fitted_shap(spark, sf):
    """Attributions of a fitted model to its encoded features add up to its logit."""
    model, train, test = _shared_model(spark, sf)
    phis = explain.model_shap(model, test, "entity_id").checkpoint()
    total = phis.groupBy("entity_id").agg(F.sum("phi").alias("s"), F.count(F.lit(1)).alias("k"))
    p = models.score(model, test).select("entity_id", F.log(F.col("p") / (1 - F.col("p"))).alias("logit"))
    both = total.join(p, ["entity_id"]).withColumn("base", F.col("logit") - F.col("s"))
    found = both.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"), (F.max("base") - F.min("base")).alias("gap")).first()
    return _facts(spark, n=found["n"], adds_up=found["gap"] < 1e-6, named=found["k"] == len(encode.encoded_names(model)))


@query
def fitted_importance(spark, sf):
    """Five permutations of every column that a fitted model reads, on held-out rows."""
    model, train, test = _shared_model(spark, sf)
    numeric, categorical = demo.ENTITY_TASK.roles.feature_columns(
        train, "reached_2000", {*demo.ENTITY_TASK.extra_drop, "entity_id", "split"}
    )
    found = explain.permutation_importance(model, test, "entity_id", "reached_2000", [*numeric, *categorical]).collect()
    return _facts(
        spark, n_columns=len({r["feature"] for r in found} & {*numeric, *categorical}) - len({*numeric, *categorical}),
        bounded=all(-1 <= r["importance_mean"] <= 1 and r["importance_sd"] >= 0 for r in found),
    )


def _small_entity_model(spark, sf):
    df = _entity_rows(spark, sf)
    return df, _candidate(df, models.LOGREG)


def _encoded(spark, sf):
    io.shared_folder(spark)
    ids = ["entity_id", "entity_name"]
    m, nums, cats = segments.cluster_matrix(demo.features(spark, sf), ids, CLUSTER_DROP, ["size_band", "hub"])
    encoder = encode.TabularEncoder(numeric=nums, categorical=cats, log_scaled=[c for c in demo.ROLES.log_scaled if c in nums])
    return encoder.fit(m).transform(m).select("entity_id", "features").checkpoint()


@query
def select_k(spark, sf):
    """Every k from 3 to 8, ten starts each."""
    rows = segments.select_k(_encoded(spark, sf)).collect()
    best = [r for r in rows if r["best"]]
    return _facts(
        spark, n_k=len(rows), n_best=len(best), best_is_greatest=best[0]["silhouette"] == max(r["silhouette"] for r in rows),
        in_range=all(-1 <= r["silhouette"] <= 1 and r["inertia"] > 0 for r in rows),
    )


@query
def kmeans_segments(spark, sf):
    """The inertia of the best of ten starts, computed again from the placed rows."""
    df = _encoded(spark, sf)
    model = segments.kmeans_best_of(df, 3)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    squares = F.zip_with(vector_to_array("features"), F.element_at(centres, F.col("prediction") + 1), lambda x, m: (x - m) * (x - m))
    found = model.transform(df).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("prediction").alias("k"), F.sum(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)).alias("cost")
    ).first()
    return _facts(spark, n=found["n"], k=found["k"], same_inertia=abs(found["cost"] / model.summary.trainingCost - 1) < 1e-6)


@query
def segment_entities(spark, sf):
    """The whole segmentation job: k from 3 to 8, ten starts, names, outcome, sink."""
    feats, targets = demo.features_and_targets(spark, sf)
    out = _folder(spark, sf, f"segments-{uuid4().hex}")
    found = training.segment_entities(
        feats.checkpoint(), targets, "entity_id", "entity_name", "reached_2000", CLUSTER_DROP, ["size_band", "hub"],
        demo.ROLES.log_scaled, "region_name", "outcome_1999", "share_rural", "population", out=out,
    )
    lines = spark.read.option("header", True).csv(f"{out}/segments")
    return _facts(
        spark, n=lines.count(), n_entities=lines.select("entity_id").distinct().count(), named=lines.where("segment_name is null").count() == 0,
        chosen=lines.select("segment_id").distinct().count() == found.choice.where("best").first()["k"],
    )
