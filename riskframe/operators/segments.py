"""Segmentation: k-means with restarts, silhouettes, profiles, names and outside validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import segment_name
from riskframe.operators.joins import checked_join, small_table
from riskframe.operators.kmeans import best_models
from riskframe.operators.ordered import quantiles
from riskframe.operators.profile import rate_by
from riskframe.operators.roles import numeric_columns

# Candidate numbers of segments, restarts, rounds of a start at most.
K_RANGE = range(3, 9)
RESTARTS = 10
ROUNDS = 300


def cluster_matrix(
    df: DataFrame, ids: Sequence[str], drop: Sequence[str], categorical: Sequence[str]
) -> tuple[DataFrame, list[str], list[str]]:
    """(ids and structural features, numeric names, categorical names): no goals, no geography."""
    cats = [c for c in df.columns if c in categorical and c not in drop]
    nums = [c for c in numeric_columns(df) if c not in {*drop, *ids, *cats}]
    return df.select(*ids, *nums, *cats), nums, cats


def kmeans_best_of(
    df: DataFrame, k: int, restarts: int = RESTARTS, seed: int = 42, features: str = "features"
) -> KMeansModel:
    """The model of lowest within-segment cost over several seeded starts."""
    return best_models(df, [k], restarts, seed, features, ROUNDS)[k]


def silhouette_squared(df: DataFrame, features: str = "features", segment: str = "segment") -> DataFrame:
    """One row (silhouette) under squared Euclidean distance; linear time, all rows."""
    value = ClusteringEvaluator(
        featuresCol=features, predictionCol=segment, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(df)
    return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")


def silhouette_centroid(df: DataFrame, vector: str, segment: str) -> DataFrame:
    """One row (silhouette) under Euclidean distance to segment centres; all rows, linear time.

    A row's own distance is that to the centre of its segment, its other distance that to the nearest
    other centre. ``vector`` is an array column. Segments are few: their centres are plain numbers in the plan.
    """
    places = df.select(segment, F.posexplode(vector).alias("_i", "_x"))
    means = places.groupBy(segment, "_i").agg(F.avg("_x").alias("_m"))
    centres = {r[segment]: [m for _, m in sorted(r["_c"])] for r in means.groupBy(segment).agg(
        F.collect_list(F.struct("_i", "_m")).alias("_c")
    ).collect()}
    if len(centres) < 2:
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")

    def distance(centre: list[float]) -> Column:
        squares = F.zip_with(vector, F.array(*[F.lit(float(m)) for m in centre]), lambda x, m: (x - m) * (x - m))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))

    away = F.array(*[F.struct(F.lit(k).alias("k"), distance(c).alias("d")) for k, c in centres.items()])
    placed = df.select(F.col(segment).alias("_own"), away.alias("_away"))
    near = lambda keep: F.array_min(F.transform(F.filter("_away", keep), lambda a: a["d"]))
    own, other = near(lambda a: a["k"] == F.col("_own")), near(lambda a: a["k"] != F.col("_own"))
    width = F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0))
    return placed.agg(F.avg(width).alias("silhouette"))


def select_k(
    df: DataFrame, ks: Sequence[int] = K_RANGE, restarts: int = RESTARTS, seed: int = 42,
    features: str = "features", euclidean: bool = False,
) -> DataFrame:
    """Rows (k, silhouette, inertia, best): the k of greatest silhouette is marked. All starts of all k share their passes.

    ``euclidean`` takes the distance to centres in place of the mean squared distance to rows.
    """
    rows, models = [], best_models(df, list(ks), restarts, seed, features, ROUNDS)
    for k, model in models.items():
        placed = model.transform(df)
        if euclidean:
            value = silhouette_centroid(placed.withColumn("_v", vector_to_array(features)), "_v", "prediction").first()[0]
        else:
            value = silhouette_squared(placed, features, "prediction").first()[0]
        rows.append((int(k), float(value), float(model.summary.trainingCost)))
    best = max(rows, key=lambda r: (r[1], -r[0]))[0]
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, silhouette double, inertia double, best boolean"
    )


def segment_names(profile: DataFrame, segment: str, level: str, rural: str, size: str) -> DataFrame:
    """Rows (segment, segment_name) from a profile with one row per segment.

    A segment is of high level at or above the median over the segments.
    """
    # One row per segment; computed once for its median and its names.
    profile, _ = small_table(profile.sparkSession, profile.select(segment, level, rural, size))
    middle = quantiles(profile, level, [0.5]).select("quantile").first()
    high = F.col(level) >= F.lit(middle["quantile"] if middle else None)
    return profile.select(segment, segment_name(high, rural, size).alias("segment_name"))


def segment_outcome(segments: DataFrame, targets: DataFrame, key: str, segment: str, label: str) -> DataFrame:
    """Outcome rate by segment; the outcome was never part of the fit."""
    known = targets.select(key, label).where(F.col(label).isNotNull())
    joined = checked_join(segments.select(key, segment), known, [key], "inner", "1:1")
    return rate_by(joined, [segment], label)
