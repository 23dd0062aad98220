"""What drives a model: permutation importance and linear attributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.encode import encoded_columns, encoded_names
from riskframe.operators.evaluate import ranking_metrics
from riskframe.operators.models import score
from riskframe.operators.sampling import hash_rank
from riskframe.sources.io import load_model, shared_folder, write_csv

# Fixed value: features listed in a report.
TOP_FEATURES = 15


def donors(df: DataFrame, key: str, columns: Sequence[str], repeat: int, seed: int = 42) -> DataFrame:
    """Columns of a random other row for each key, as ``_d_<column>``: one permutation of the rows.

    Rows are placed by two independent hashes and meet at equal places. Places are unique
    on both sides.
    """
    receivers = hash_rank(df.select(key), key, f"{seed}/to", out="_place")
    givers = hash_rank(df.select(key, *columns), key, f"{seed}/from/{repeat}", out="_place")
    renamed = givers.select("_place", *[F.col(c).alias(f"_d_{c}") for c in columns])
    return receivers.join(renamed, ["_place"]).drop("_place")


def permuted_column(df: DataFrame, key: str, column: str, repeat: int = 0, seed: int = 42) -> DataFrame:
    """Rows (key, column, permuted): the column with its values dealt to other rows."""
    dealt = donors(df, key, [column], repeat, seed).withColumnRenamed(f"_d_{column}", "permuted")
    return df.select(key, column).join(dealt, [key])


def permutation_importance(
    model: PipelineModel, df: DataFrame, key: str, label: str, columns: Sequence[str],
    repeats: int = 5, seed: int = 42,
) -> DataFrame:
    """Rows (feature, importance_mean, importance_sd): drop in AUC when a column is permuted.

    All copies (column x repeat) are scored in one pass and evaluated in one job. The sd is
    the population one over the repeats.
    """
    shared_folder(df.sparkSession)
    base = df.select(key, label, *columns)
    copies = None
    for r in range(repeats):
        dealt = donors(base, key, columns, r, seed).withColumn("repeat", F.lit(r))
        copies = dealt if copies is None else copies.unionByName(dealt)
    stacked = base.join(copies, [key]).withColumn("feature", F.explode(F.array(*[F.lit(c) for c in columns])))
    swapped = stacked.withColumns(
        {c: F.when(F.col("feature") == c, F.col(f"_d_{c}")).otherwise(F.col(c)) for c in columns}
    ).drop(*[f"_d_{c}" for c in columns])
    whole = base.withColumns({"feature": F.lit(""), "repeat": F.lit(-1)})
    scored = score(model, whole.unionByName(swapped.select(*whole.columns)))
    scores = scored.select("feature", "repeat", F.col(label).cast("int").alias("y"), "p").checkpoint()
    aucs = ranking_metrics(scores, by=["feature", "repeat"]).select("feature", "repeat", "roc_auc")
    full = aucs.where("feature = ''").agg(F.max("roc_auc")).scalar()
    drops = aucs.where("feature <> ''").withColumn("_drop", full - F.col("roc_auc"))
    return drops.groupBy("feature").agg(
        F.avg("_drop").alias("importance_mean"), F.stddev_pop("_drop").alias("importance_sd")
    )


def linear_shap(df: DataFrame, key: str, weights: Mapping[str, float]) -> DataFrame:
    """Rows (key, feature, phi): weight times distance from the column mean, on the logit scale."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in weights]).first()
    phis = [(F.lit(float(w)) * (F.col(c).cast("double") - F.lit(means[c]))).alias(c) for c, w in weights.items()]
    return df.select(key, *phis).unpivot([key], list(weights), "feature", "phi")


def model_shap(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Rows (key, feature, phi) for a fitted or loaded linear pipeline, over its encoded features.

    Averages are those of ``df``; attributions of a row and the mean logit add up to the row's logit.
    """
    weights = [float(w) for w in model.stages[-1].coefficients]
    phis = linear_shap(encoded_columns(model, df, [key]), key, {f"_{i}": w for i, w in enumerate(weights)})
    names = F.array(*[F.lit(n) for n in encoded_names(model)])
    place = F.substring("feature", 2, 10).cast("int")
    return phis.withColumn("feature", F.element_at(names, place + 1))


def explain_job(spark: SparkSession, model_path: str, df: DataFrame, key: str, out: str, n: int = TOP_FEATURES) -> DataFrame:
    """Load a saved linear model, write its ranked attributions as CSV, and return them."""
    model, _ = load_model(spark, model_path)
    ranked = shap_ranking(model_shap(model, df, key), n)
    write_csv(ranked, out, ["mean_abs"])
    return ranked


def shap_ranking(phis: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Rows (feature, mean_abs): the ``n`` features of greatest mean absolute attribution."""
    sizes = phis.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    return sizes.orderBy(F.desc("mean_abs"), "feature").limit(n)
