"""K-means of many starts: Spark's end points, as good as Spark's fits, in a number of jobs that does not grow with the starts."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import kmeans as K, segments as S


@pytest.fixture(scope="module")
def df(spark):
    at = F.floor(F.rand(1) * 4)
    rows = spark.range(0, 4000, 1, 3).withColumn("g", at).select(
        "id", (F.col("g") * 3 + F.randn(2)).alias("a"), ((F.col("g") % 2) * 4 + F.randn(3)).alias("b"), (F.randn(4) * 0.5 + 1000).alias("c")
    )
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).select("id", "features").cache()


def jobs(spark, run):
    sc, group = spark.sparkContext, f"kmeans-{id(run)}"
    sc.setJobGroup(group, "")
    found = run()
    n = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return found, n


def test_as_good_as_sparks_starts(df):
    for k in (2, 4):
        theirs = min((KMeans(k=k, seed=42 + i, maxIter=300).fit(df) for i in range(3)), key=lambda m: m.summary.trainingCost)
        ours = S.kmeans_best_of(df, k, restarts=3)
        assert ours.summary.trainingCost == pytest.approx(theirs.summary.trainingCost, rel=1e-3)
        a, b = (np.array(sorted(c.tolist() for c in m.clusterCenters())) for m in (ours, theirs))
        assert np.abs(a - b).max() < 0.05 and ours.getK() == ours.summary.k == k


def test_centres_stand_and_the_cost_is_theirs(df):
    """Each centre is the mean of its rows, and the cost is that of the placed rows."""
    model = S.kmeans_best_of(df, 4, restarts=2)
    rows = [(r["prediction"], r["features"].toArray()) for r in model.transform(df).select("prediction", "features").collect()]
    own, x = np.array([p for p, _ in rows]), np.array([v for _, v in rows])
    centers = np.array(model.clusterCenters())
    assert (own == ((x[:, None] - centers) ** 2).sum(2).argmin(1)).all()
    for j in range(4):
        assert np.abs(x[own == j].mean(0) - centers[j]).max() < 1e-3
    assert ((x - centers[own]) ** 2).sum() == pytest.approx(model.summary.trainingCost, rel=1e-9)
    assert sum(model.summary.clusterSizes) == 4000


def test_few_jobs_however_many_starts(spark, df):
    """Spark's fits of 3 k and 10 starts run over 300 jobs."""
    choice, n = jobs(spark, lambda: S.select_k(df, (2, 3, 4), restarts=10))
    assert n < 200 and choice.count() == 3
    again = S.select_k(df, (2, 3, 4), restarts=10).collect()
    assert [r["inertia"] for r in again] == pytest.approx([r["inertia"] for r in choice.collect()])
    for r in again:
        assert S.kmeans_best_of(df, r["k"], restarts=10).summary.trainingCost == pytest.approx(r["inertia"])


def test_partitions_do_not_matter_to_the_rest(spark):
    """Empty partitions, blocks smaller than a piece, and no more different rows than centres."""
    few = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.range(0, 40, 1, 7).select((F.col("id") % 2).cast("double").alias("a")).where("a = 0 or rand(1) < 2"))
    model = S.kmeans_best_of(few.repartition(9), 3, restarts=2)
    assert sorted(c[0] for c in model.clusterCenters()) == [0.0, 1.0] and model.summary.trainingCost == pytest.approx(0, abs=1e-9)


def test_wide_vectors_are_left_to_spark(df, monkeypatch):
    monkeypatch.setattr(K, "WIDEST", 2)
    monkeypatch.setattr(K, "packed", None)
    assert len(S.kmeans_best_of(df, 2, restarts=1).clusterCenters()) == 2


def test_first_nearest_centre_on_ties():
    far = np.array([[1.0, 2.0], [1.0, 1.0], [1.0, 1.0]])
    assert K.one_of(far, far.min(0)).tolist() == [[True, False], [False, True], [False, False]]


def test_sums_of_placed_rows():
    """Against a plain count, with two equal centres and a row between two others."""
    random = np.random.default_rng(1)
    x = np.concatenate([random.normal(size=(1300, 2)), [[0.0, 5.0]]])
    centers, ends = np.array([[1.0, 0.0], [-1.0, 0.0], [0.5, 0.5], [0.5, 0.5], [0.0, -1.0]]), [2, 5]
    sums, costs = K.placed_sums(x, centers, ends)
    for i, (a, b) in enumerate(((0, 2), (2, 5))):
        far = ((x[:, None] - centers[a:b]) ** 2).sum(2)
        assert costs[i] == pytest.approx(far.min(1).sum())
        for j in range(a, b):
            own = x[far.argmin(1) == j - a]
            assert sums[j] == pytest.approx([*own.sum(0), len(own)])
