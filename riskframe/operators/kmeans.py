"""K-means from many starts in shared passes over the rows.

Spark's KMeans runs some ten jobs to find first centres and one for each round, for every start of every k. Here all starts
take part in the same pass: the rows are packed once as blocks of numbers and kept, and a pass places each block against the
centres of every start that still moves. First centres are found as in k-means|| (two rounds, then k-means++ on the weighted
candidates), a start ends as Spark's does, and the result is Spark's model with its training cost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns up to which vectors are packed; wider ones may be sparse and are left to Spark's fit.
WIDEST = 512
# Numbers in a block (8 bytes each), and rows that are placed together.
BLOCK, TOGETHER = 2**17, 512
# As in Spark: rounds of k-means||, rounds of its last step, and how far a centre may still move.
SEEDING, LOCAL, TOLERANCE = 2, 30, 1e-4
# Above so many partitions their sums are added up by tasks.
DIRECT = 64


@dataclass
class Run:
    """One start: centres relative to the mean of all rows, with what the last pass said of them."""

    k: int
    seed: int
    centers: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    cost: float = float("inf")
    rounds: int = 0
    moving: bool = True
    done: bool = False


def width_of(df: DataFrame, features: str) -> int:
    known = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    return known or len(df.select(features).first()[0])


def best_models(df: DataFrame, ks: Sequence[int], restarts: int, seed: int, features: str, rounds: int) -> dict[int, KMeansModel]:
    """By k, the model of lowest cost over ``restarts`` starts from ``seed`` on."""
    width = width_of(df, features)
    plain = {(k, i): KMeans(k=k, seed=seed + i, initMode="k-means||", featuresCol=features, maxIter=rounds) for k in ks for i in range(restarts)}
    if width > WIDEST:
        return {k: min((plain[k, i].fit(df) for i in range(restarts)), key=lambda m: m.summary.trainingCost) for k in ks}
    blocks = packed(df, features, width)
    try:
        mean, runs = seeded(blocks, [(k, seed + i) for k in ks for i in range(restarts)], width)
        moved(blocks, runs, mean, rounds)
    finally:
        blocks.unpersist()
    best = {k: min((r for r in runs if r.k == k), key=lambda r: r.cost) for k in ks}
    return {k: as_model(df, plain[k, r.seed - seed], r, mean) for k, r in best.items()}


def packed(df: DataFrame, features: str, width: int) -> RDD:
    """Blocks ((part, at), rows as bytes), kept; those of fewer partitions than cores are dealt over the cores."""
    rows = max(1, BLOCK // width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, at = [], 0, 0
        for batch in batches:
            if batch.column(1).null_count:
                raise ValueError("k-means needs a vector in every row")
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8")
            if not np.isfinite(x).all():
                raise ValueError("k-means needs finite vectors")
            if not len(batch):
                continue
            part, held, n = batch.column(0)[0].as_py(), [*held, x], n + len(batch)
            if n >= rows:
                yield one(part, at, held)
                held, n, at = [], 0, at + 1
        if held:
            yield one(part, at, held)

    def one(part: int, at: int, held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([np.concatenate(held).tobytes()], pa.binary())], ["part", "at", "x"])

    wide = df.select(F.spark_partition_id().alias("part"), vector_to_array(features).alias("x"))
    blocks = wide.mapInArrow(pack, "part int, at int, x binary").rdd.map(lambda r: ((r[0], r[1]), bytes(r[2])))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if blocks.getNumPartitions() < cores:
        blocks = blocks.partitionBy(cores, sum).mapPartitions(lambda held: iter(sorted(held)))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def each_block(blocks: RDD, of: Callable, add: Callable):
    """``of(part, at, rows)`` of every block, added up."""
    width = len(of.mean)

    def part_sum(held) -> list:
        total = None
        for (part, at), x in held:
            found = of(part, at, np.frombuffer(x).reshape(-1, width) - of.mean)
            total = found if total is None else add(total, found)
        return [] if total is None else [total]

    sums = blocks.mapPartitions(part_sum)
    if blocks.getNumPartitions() > DIRECT:
        return sums.treeReduce(add)
    total = None
    for found in sums.collect():
        total = found if total is None else add(total, found)
    return total


class Pass:
    """What a pass does with a block; ``mean`` is taken off the rows, so that distances keep their digits."""

    def __init__(self, mean: np.ndarray, work: Callable):
        self.mean, self.work = mean, work

    def __call__(self, part: int, at: int, x: np.ndarray):
        return self.work(part, at, x)


def added(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


def least(x: np.ndarray, centers: np.ndarray, ends: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(start, squared distances (centre, row) without the row's own square, their least by row) for each start."""
    far = (centers * centers).sum(1)[:, None] - 2 * (centers @ x.T)
    for i, (a, b) in enumerate(zip([0, *ends], ends)):
        yield i, far[a:b], far[a:b].min(0)


def distances(x: np.ndarray, centers: np.ndarray, ends: Sequence[int]) -> np.ndarray:
    """Squared distance to the nearest centre, by start and row."""
    own = (x * x).sum(1)
    return np.stack([np.maximum(own + near, 0) for _, _, near in least(x, centers, ends)])


def one_of(far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """True at the first nearest centre of each row."""
    found = far == near
    if np.count_nonzero(found) > found.shape[1]:
        found &= found.cumsum(0) == 1
    return found


def stacked(runs: Sequence[Run]) -> tuple[np.ndarray, list[int]]:
    return np.concatenate([r.centers for r in runs]), np.cumsum([len(r.centers) for r in runs]).tolist()


def seeded(blocks: RDD, starts: Sequence[tuple[int, int]], width: int) -> tuple[np.ndarray, list[Run]]:
    """(mean of all rows, starts with their first centres)."""
    counted = Pass(np.zeros(width), lambda part, at, x: ([(part, at, len(x))], x.sum(0)))
    sizes, total = each_block(blocks, counted, lambda a, b: (a[0] + b[0], a[1] + b[1])) or ([], None)
    if not sizes:
        raise ValueError("k-means needs rows")
    sizes = sorted(sizes)
    ends = np.cumsum([n for _, _, n in sizes])
    mean = total / ends[-1]
    wanted: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, (_, seed) in enumerate(starts):
        row = int(np.random.default_rng(seed % 2**64).integers(ends[-1]))
        block = int(np.searchsorted(ends, row, side="right"))
        wanted.setdefault(sizes[block][:2], []).append((i, row - int(ends[block]) + sizes[block][2]))
    first = dict(each_block(blocks, Pass(mean, lambda part, at, x: [(i, x[row]) for i, row in wanted.get((part, at), [])]), lambda a, b: a + b))
    runs = [Run(k, seed, first[i][None]) for i, (k, seed) in enumerate(starts)]
    seeds, sizes_k = [r.seed % 2**64 for r in runs], [r.k for r in runs]
    for step in range(SEEDING):
        centers, stops = stacked(runs)
        costs = each_block(blocks, Pass(mean, lambda part, at, x: sum(distances(p, centers, stops).sum(1) for p in pieces(x))), lambda a, b: a + b)

        def drawn(part: int, at: int, x: np.ndarray) -> list:
            found, random = [], [np.random.default_rng([s, step, part, at]) for s in seeds]
            for p in pieces(x):
                for i, far in enumerate(distances(p, centers, stops)):
                    if costs[i] > 0:
                        taken = np.flatnonzero(random[i].random(len(p)) < 2.0 * sizes_k[i] * far / costs[i])
                        found += [((part, at), i, p[taken])] if len(taken) else []
            return found

        for _, i, rows in sorted(each_block(blocks, Pass(mean, drawn), lambda a, b: a + b), key=lambda f: f[0]):
            runs[i].centers = np.concatenate([runs[i].centers, rows])
    for r in runs:
        r.centers = np.unique(r.centers, axis=0)
    centers, stops = stacked(runs)
    closest = Pass(mean, lambda part, at, x: sum(np.concatenate([one_of(far, near).sum(1) for _, far, near in least(p, centers, stops)]) for p in pieces(x)))
    weights = np.split(each_block(blocks, closest, lambda a, b: a + b), stops[:-1])
    for r, w in zip(runs, weights):
        if len(r.centers) > r.k:
            r.centers = plus_plus(r.centers, w.astype(float), r.k, np.random.default_rng(r.seed % 2**64))
    return mean, runs


def pieces(x: np.ndarray) -> Iterator[np.ndarray]:
    for a in range(0, len(x), TOGETHER):
        yield x[a : a + TOGETHER]


def plus_plus(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """K centres of weighted points: k-means++, then some rounds."""
    draw = lambda p: points[random.choice(len(points), p=p / p.sum())] if p.sum() > 0 else points[random.integers(len(points))]
    centers = draw(weights)[None]
    while len(centers) < k:
        centers = np.concatenate([centers, draw(weights * distances(points, centers, [len(centers)])[0])[None]])
    before = None
    for _ in range(LOCAL):
        (_, far, _), = least(points, centers, [k])
        own = far.argmin(0)
        if before is not None and (own == before).all():
            break
        before, sums = own, np.bincount(own, weights, k)
        for j in np.flatnonzero(sums > 0):
            centers[j] = weights[own == j] @ points[own == j] / sums[j]
    return centers


def placed_sums(x: np.ndarray, centers: np.ndarray, ends: Sequence[int]) -> list[np.ndarray]:
    """[sum and number of the rows of each centre, squared distances by start]; memory for a piece is taken once."""
    form, starts = np.column_stack([-2 * centers, (centers * centers).sum(1)]), [0, *ends[:-1]]
    rows = np.column_stack([x, np.ones(len(x))])
    sums, costs = np.zeros(form.shape), np.full(len(ends), (x * x).sum())
    room = np.empty((2, len(centers), min(TOGETHER, len(x))))
    for p in pieces(rows):
        far, mine = room[:, :, : len(p)]
        np.matmul(form, p.T, out=far)
        for i, (a, b) in enumerate(zip(starts, ends)):
            near = far[a:b].min(0)
            np.equal(far[a:b], near, out=mine[a:b], casting="unsafe")
            costs[i] += near.sum()
        found = mine @ p
        for i in np.flatnonzero(np.add.reduceat(found[:, -1], starts) > len(p)):  # a row as near to a second centre
            a, b = starts[i], ends[i]
            found[a:b] = one_of(far[a:b], far[a:b].min(0)).astype(float) @ p
        sums += found
    return [sums, costs]


def moved(blocks: RDD, runs: list[Run], mean: np.ndarray, rounds: int) -> None:
    """Rounds until no centre of a start moves; then one more pass for the cost of where they stand."""
    while active := [r for r in runs if not r.done]:
        centers, stops = stacked(active)

        placed = Pass(mean, lambda part, at, x: placed_sums(x, centers, stops))
        sums, costs = each_block(blocks, placed, added)
        for r, own, cost in zip(active, np.split(sums, stops[:-1]), costs):
            r.cost, n = max(float(cost), 0.0), own[:, -1:]
            r.done = not r.moving or r.rounds >= rounds
            if r.done:
                continue
            now = np.where(n > 0, own[:, :-1] / np.maximum(n, 1), r.centers)
            r.moving = bool((((now - r.centers) ** 2).sum(1) > TOLERANCE**2).any())
            r.centers, r.rounds = now, r.rounds + 1


def as_model(df: DataFrame, settings: KMeans, run: Run, mean: np.ndarray) -> KMeansModel:
    """Spark's model with these centres, and its summary."""
    sc = df.sparkSession.sparkContext
    inner = sc._jvm.org.apache.spark.mllib.clustering.KMeansModel(_py2java(sc, [Vectors.dense(c + mean) for c in run.centers]))
    java = sc._jvm.org.apache.spark.ml.clustering.KMeansModel(settings.uid, inner)
    model = settings._copyValues(KMeansModel(java))
    model._transfer_params_to_java()
    summary = sc._jvm.org.apache.spark.ml.clustering.KMeansSummary(
        java.transform(df._jdf), settings.getPredictionCol(), settings.getFeaturesCol(), settings.getK(), run.rounds, run.cost
    )
    java.setSummary(sc._jvm.scala.Some(summary))
    return model
