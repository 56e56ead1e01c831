"""Exact k-means on integer vectors, with heaps of bounds instead of full scans.

Of each vector the gap is known between the distance to its own centroid and that to the next one. While
centroids move, the gap shrinks by no more than the way of the own centroid and the longest way of
another one. So a vector is kept under the drift of its cluster, added up over all rounds, at which its gap
would be used up: its *expiry*. Below it the vector cannot have changed its cluster.

A cluster's heap is made of *runs*, tables sorted by cluster and expiry, one per round. What is popped in a round are
the heads of the runs: rows with an expiry between the cluster's drift of the round before and that of now. This is
a filter on sorted files, so the rest is not read. Popped vectors are compared with all centroids and go into a new run.
Nothing is deleted: a row below its cluster's drift is a popped one. Sums of a cluster change by the vectors that
left it or came to it only.

Centroids, their drift and their sums are k rows, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import Work
from orderlake.sources.work import written

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
# Components up to here have squared distances that fit 64 bits.
LARGEST = 2**27
# Expiries are compared with this margin; distances and ways are floating-point square roots. Centroids are
# whole numbers, so a drift that grows at all grows by far more.
MARGIN = 1e-3
# Vectors compared with all centroids at once.
BLOCK = 8192


def whole_vectors(
    vectors: DataFrame, size: int = SIZE, scale: int = SCALE, column: str = "embedding"
) -> DataFrame:
    """``(vec_id, vector)`` of complete finite vectors, each component as ``floor(scale * x)``."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    floors = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    # An array with a NULL component makes ``forall`` NULL or false.
    return vectors.where((F.size(column) == size) & F.coalesce(finite, F.lit(False))).select(
        "vec_id", floors.alias("vector")
    )


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hash of seed and id; equal ids by their components."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    best = kept.orderBy(F.sha2(spelled.cast("binary"), 256), "vec_id", "vector").limit(clusters)
    return np.array([row["vector"] for row in best.select("vector").collect()], np.int64)


@dataclass(frozen=True)
class State:
    """Centroids, the vectors' sums and counts per cluster, and each cluster's drift so far."""

    centroids: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    drift: np.ndarray

    @classmethod
    def begin(cls, centroids: np.ndarray) -> State:
        k = len(centroids)
        return cls(centroids, np.zeros_like(centroids, object), np.zeros(k, np.int64), np.zeros(k))

    def moved(self, changes: DataFrame) -> State:
        """After a round: sums change by the rescanned vectors, non-empty centroids move to their floors."""
        sums, counts = self.sums.copy(), self.counts.copy()
        for c, at, total in changes.collect():
            if at < 0:
                counts[c] += int(total)
            else:
                sums[c, at] += int(total)
        centroids = self.centroids.copy()
        for c in np.flatnonzero(counts):
            centroids[c] = [s // int(counts[c]) for s in sums[c]]
        way = np.sqrt(((centroids - self.centroids).astype(np.float64) ** 2).sum(1))
        others = np.array([max(np.delete(way, c), default=0.0) for c in range(len(way))])
        return State(centroids, sums, counts, self.drift + way + others)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, its squared distance, and the gap to the next one; of equals the first."""
    squared = np.empty((len(vectors), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        apart = vectors - centroid
        squared[:, c] = np.einsum("ij,ij->i", apart, apart)
    cluster = squared.argmin(1)
    rows = np.arange(len(vectors))
    own = squared[rows, cluster]
    squared[rows, cluster] = np.iinfo(np.int64).max
    beyond = np.sqrt(squared.min(1).astype(np.float64)) if len(centroids) > 1 else np.inf
    return cluster, own, beyond - np.sqrt(own.astype(np.float64))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _rescan(state: State):
    """Rows with ``vector`` and the ``cluster`` they had get the cluster they have now, its distance, and their expiry."""
    centroids, drift = state.centroids, state.drift

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                vectors = _matrix(batch["vector"], centroids.shape[1])
                if np.abs(vectors).max(initial=0) > LARGEST:
                    raise OverflowError(f"a component beyond {LARGEST} has distances beyond 64 bits")
                cluster, distance, gap = nearest(vectors, centroids)
                # An expiry within the margin would count as popped already.
                expiry = drift[cluster] + np.maximum(gap, 2 * MARGIN)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["vec_id"],
                        batch["vector"],
                        batch["cluster"],
                        pa.array(cluster.astype(np.int32)),
                        pa.array(expiry),
                        pa.array(distance),
                    ],
                    ["vec_id", "vector", "was", "cluster", "expiry", "distance"],
                )

    return scan


PARTIAL = "cluster int, n long, total array<long>"


def _partial(size: int):
    """Per task what came to each cluster less what left it."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = np.column_stack([np.ones(batch.num_rows, np.int64), _matrix(batch["vector"], size)])
            now, was = batch["cluster"].to_numpy(), batch["was"].fill_null(-1).to_numpy(zero_copy_only=False)
            for sign, side in ((1, now), (-1, was)):
                for c in np.unique(side[side >= 0]).tolist():
                    totals[c] = totals.get(c, 0) + sign * vectors[side == c].sum(0)
        keys = sorted(totals)
        if keys:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int32()),
                    pa.array([int(totals[c][0]) for c in keys], pa.int64()),
                    pa.array([totals[c][1:].tolist() for c in keys], pa.list_(pa.int64())),
                ],
                ["cluster", "n", "total"],
            )

    return summed


def _changes(run: DataFrame, size: int) -> DataFrame:
    """``(cluster, at, total)``: change of the vectors' number (at -1) and of each component's sum."""
    moved = run.where(~F.col("was").eqNullSafe(F.col("cluster"))).select("vector", "was", "cluster")
    each = F.concat(F.array("n"), "total")
    long = moved.mapInArrow(_partial(size), PARTIAL).select("cluster", F.posexplode(each).alias("at", "total"))
    return long.groupBy("cluster", (F.col("at") - 1).alias("at")).agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def _held(runs: DataFrame, at: np.ndarray) -> DataFrame:
    """Rows of the runs that were not popped up to the drift ``at``."""
    return runs.where(
        _any([(F.col("cluster") == c) & (F.col("expiry") > float(d) + MARGIN) for c, d in enumerate(at)])
    )


def _popped(runs: DataFrame, since: np.ndarray, now: np.ndarray) -> DataFrame:
    """The heads of the runs: rows whose gap was used up between two drifts."""
    return runs.where(
        _any(
            [
                (F.col("cluster") == c)
                & (F.col("expiry") > float(a) + MARGIN)
                & (F.col("expiry") <= float(b) + MARGIN)
                for c, (a, b) in enumerate(zip(since, now))
            ]
        )
    )


RUN = ["vec_id", "vector", "cluster", "expiry"]
SCANNED = "vec_id {kind}, vector array<long>, was int, cluster int, expiry double, distance long"
MEASURED = "vec_id {kind}, cluster int, distance long"


def _kind(vectors: DataFrame) -> str:
    return vectors.schema["vec_id"].dataType.simpleString()


@dataclass(frozen=True)
class Clustering:
    """Runs that hold each vector once above the last drift, and the last centroids."""

    runs: list[DataFrame]
    heaps: DataFrame
    state: State

    def scanned(self) -> list[int]:
        """How many vectors were compared with all centroids in each round."""
        return [run.count() for run in self.runs]

    def assigned(self) -> DataFrame:
        """``(vec_id, vector, cluster)`` of every vector."""
        return _held(self.heaps, self.state.drift).select("vec_id", "vector", "cluster")


def fit(
    kept: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, work: Work | None = None
) -> Clustering | None:
    """Cluster ``(vec_id, vector)`` rows; None where there are none.

    Each round assigns every vector to its nearest centroid, of equally near ones the first, and moves each centroid that
    has vectors to the floor of their mean. After the last round vectors are assigned once more. Repeated
    ids, NULL too, are vectors of their own. Fewer vectors than clusters make as many clusters as vectors.
    """
    work = work or Work(kept.sparkSession)
    begin = first_centroids(kept, clusters, seed)
    if not len(begin):
        return None
    state = State.begin(begin)
    due, runs = kept.withColumn("cluster", F.lit(None).cast("int")), []
    folder, spark = work.path("heaps"), kept.sparkSession
    for nth in range(rounds + 1):
        scanned = due.mapInArrow(_rescan(state), SCANNED.format(kind=_kind(kept)))
        run = written(scanned.sortWithinPartitions("cluster", "expiry"), f"{folder}/run{nth:03}")
        runs.append(run)
        # One scan of all runs: a union of scans would have tasks, and then files, for each of them.
        heaps = spark.read.schema(run.schema).parquet(*(f"{folder}/run{k:03}" for k in range(nth + 1)))
        if nth == rounds:
            return Clustering(runs, heaps, state)
        before, state = state.drift, state.moved(_changes(run, begin.shape[1]))
        due = _popped(heaps.select(*RUN), before, state.drift).drop("expiry")


def _measure(centroids: np.ndarray):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(first, BLOCK)
                own = centroids[batch["cluster"].to_numpy()]
                apart = _matrix(batch["vector"], centroids.shape[1]) - own
                distance = pa.array(np.einsum("ij,ij->i", apart, apart))
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["cluster"], distance], ["vec_id", "cluster", "distance"]
                )

    return measured


def _per_cluster(values: Sequence) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)


def clusters(
    vectors: DataFrame, count: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE, scale: int = SCALE
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid.

    Vectors that are NULL, of another length or with a NULL, NaN or infinite component are left out. Other columns are
    ignored. No vectors give no rows. A component beyond ``LARGEST`` is an error, as squared distances would not fit 64 bits.
    """
    kept = whole_vectors(vectors, size, scale)
    work = Work(vectors.sparkSession)
    found = fit(kept, count, rounds, seed, work)
    if found is None:
        none = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid": "array<long>"}
        return kept.select("vec_id", *(F.lit(None).cast(kind).alias(name) for name, kind in none.items())).where("false")
    centroids = found.state.centroids
    scanned = found.assigned().mapInArrow(_measure(centroids), MEASURED.format(kind=_kind(kept)))
    measured = work.table(scanned, "measured")
    sums = measured.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    inertia = [0] * len(centroids)
    for row in sums.collect():
        inertia[row["cluster"]] = int(row["total"])
    return measured.select(
        "vec_id",
        "cluster",
        "distance",
        _per_cluster(inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        F.element_at(F.array(*(F.array(*map(F.lit, c)) for c in centroids.tolist())), F.col("cluster") + 1).alias("centroid"),
    )
