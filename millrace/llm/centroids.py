"""Centroid clustering that skips most distances by geometric bounds.

Components become whole numbers, floor(scale * x); distances, sums and centroids are exact. Each
round assigns every vector to its nearest centroid and moves centroids to the floored mean of
their vectors.

A vector carries its cluster, its exact distance to that centroid and a lower bound of its distance
to all others. When centroids move, the bound must fall. The vectors of a cluster lie in a sphere
around its old centroid, up to the farthest of them. For another centroid that moves from p to q, what
the distance of any vector in that sphere can lose is bounded in the plane through the sphere's middle, p and q:
the vectors that lose more than v lie inside one branch of a hyperbola with foci p and q, so inside
the cone of its asymptotes, and the least v whose cone the sphere does not touch is D cos(a - b), where D
is the drift, a the angle at the midpoint of p and q between the drift and the sphere's middle,
and b the angle under which the sphere is seen from there. It is at most D, and 0 where the
sphere lies wholly on p's side. Bounds fall by the largest such loss. A vector whose distance to
its own moved centroid stays below its bound keeps its cluster; only the others are compared with all centroids.

One pass over the table per round, in the tasks that read it; what is shuffled or sent to the driver is
sums by cluster and component. The state of a round is written to the shared folder, so a lost
executor costs the tasks it was running.

Defined results: rows whose vector is null, has not exactly ``width`` components, or a null or
non-finite one are left out. Ties go to the smaller number. Rows that share a vec_id are assigned
each; as start vectors they count each, in the order of their vectors. A null vec_id is assigned but is no
start. With fewer vectors than ``k`` there are that many centroids. An empty cluster keeps its
centroid. Empty tables give an empty result. Whole numbers beyond 10^15 count as 10^15, distances
and sums of them beyond a long as its largest value. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import vectors
from millrace.llm.common import pick, saved
from millrace.llm.vectors import HIGHEST

SCALE = 64
K = 16
ROUNDS = 3
WIDTH = 64
#: Bounds leave room for rounding, as a share and as a length.
SHARE, LENGTH = 1e-9, 1e-6


def squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, as exact numbers."""
    reach = np.abs(x).max(initial=0) + np.abs(centroids).max(initial=0)
    if reach**2 * max(1, x.shape[1]) >= float(1 << 53):
        x, centroids = vectors.whole(x), vectors.whole(centroids)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1)[None, :]


def own_squares(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its own centroid."""
    reach = np.abs(x).max(initial=0) + np.abs(centroids).max(initial=0)
    if reach**2 * max(1, x.shape[1]) >= float(1 << 53):
        x, centroids = vectors.whole(x), vectors.whole(centroids)
    away = x - centroids[cluster]
    return (away * away).sum(axis=1)


def loss(middle: np.ndarray, radius: float, p: np.ndarray, q: np.ndarray) -> float:
    """The most that the distance of a vector within ``radius`` of ``middle`` to a centroid can fall as it moves from p to q."""
    drift = float(np.linalg.norm(q - p))
    if drift == 0:
        return 0.0
    away = middle - (p + q) / 2
    far = float(np.linalg.norm(away))
    if far <= radius:
        return drift
    angle = np.arccos(np.clip(away @ (q - p) / (far * drift), -1, 1)) - np.arcsin(radius / far)
    return drift * float(np.cos(np.clip(angle, 0, np.pi / 2)))


def losses(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For the vectors of each cluster, by how much the distance to any other centroid can fall."""
    k = len(old)
    found = [max((loss(old[i], radius[i], old[j], new[j]) for j in range(k) if j != i), default=0.0) for i in range(k)]
    return np.array(found) * (1 + SHARE) + LENGTH


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, squared distance to it, and a lower bound of the distance to the others."""
    found = squares(x, centroids)
    cluster = found.argmin(axis=1).astype(np.int64)
    rows = np.arange(len(x))
    least = found[rows, cluster].copy()
    if len(centroids) == 1:
        return cluster, least, np.full(len(x), np.inf)
    found[rows, cluster] = float("inf")
    second = np.sqrt(found.min(axis=1).astype(np.float64))
    return cluster, least, second * (1 - SHARE) - LENGTH


def _reassigned(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray, bound: np.ndarray):
    """The same after a move, with ``bound`` already lowered; and how many rows were compared with all centroids."""
    own = own_squares(x, centroids, cluster)
    doubtful = np.flatnonzero(np.sqrt(own.astype(np.float64)) * (1 + SHARE) + LENGTH >= bound)
    if len(doubtful):
        cluster, bound = cluster.copy(), bound.copy()
        cluster[doubtful], least, bound[doubtful] = _nearest(x[doubtful], centroids)
        own[doubtful] = least
    return cluster, own, bound, len(doubtful)


def _as_long(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64) if values.dtype != object else np.minimum(values, HIGHEST).astype(np.int64)


class Clustering:
    """The rounds over a table; ``state`` holds vec_id, embedding, cluster, distance and bound of each vector."""

    def __init__(self, rows: DataFrame, k: int, scale: int, width: int, seed: int):
        rows = pick(rows, "vec_id", "embedding")
        finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        self.rows = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") == width) & finite)
        self.scale, self.width = scale, width
        self.kind = rows.schema["embedding"].dataType.simpleString()
        self.id_kind = rows.schema["vec_id"].dataType.simpleString()
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
        starts = self.rows.filter("vec_id is not null").orderBy(order, "embedding").limit(k).select("embedding").toArrow()
        self.centroids = vectors.matrix(starts.column("embedding"), scale)
        self.state: DataFrame | None = None
        self.compared = self.rows.sparkSession.sparkContext.accumulator(0)

    def assign(self, lowered: np.ndarray | None = None) -> None:
        """Assign all vectors; after the first time only doubtful ones meet all centroids, with bounds ``lowered`` by cluster."""
        scale, compared = self.scale, self.compared
        known = self.rows.sparkSession.sparkContext.broadcast((self.centroids, lowered))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, falls = known.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = vectors.matrix(batch.column("embedding"), scale)
                if falls is None:
                    cluster, own, bound = _nearest(x, centroids)
                    compared.add(len(x))
                else:
                    cluster, bound = batch.column("cluster").to_numpy().astype(np.int64), batch.column("bound").to_numpy()
                    cluster, own, bound, n = _reassigned(x, centroids, cluster, bound - falls[cluster])
                    compared.add(n)
                arrays = [pa.array(cluster.astype(np.int32)), pa.array(_as_long(own)), pa.array(bound)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("embedding"), *arrays], ["vec_id", "embedding", "cluster", "distance", "bound"]
                )

        before = self.rows if self.state is None else self.state
        schema = f"vec_id {self.id_kind}, embedding {self.kind}, cluster int, distance long, bound double"
        self.state = saved(before.mapInArrow(run, schema))

    def move(self) -> np.ndarray:
        """Move the centroids to the means of their vectors; returns by how much the bounds of each cluster fall."""
        scale, k, width = self.scale, len(self.centroids), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts, far = [[0] * width for _ in range(k)], [0] * k, [0] * k
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, cluster = vectors.matrix(batch.column("embedding"), scale), batch.column("cluster").to_numpy()
                if float(np.abs(x).max(initial=0)) * len(x) >= float(1 << 53):
                    x = vectors.whole(x)
                distance = batch.column("distance").to_numpy()
                for i in np.unique(cluster).tolist():
                    own = cluster == i
                    sums[i] = [a + int(b) for a, b in zip(sums[i], x[own].sum(axis=0))]
                    counts[i] += int(own.sum())
                    far[i] = max(far[i], int(distance[own].max()))
            at = [i for i in range(k) if counts[i]]
            if at:
                totals = pa.array([[Decimal(v) for v in sums[i]] for i in at], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array([counts[i] for i in at]), pa.array([far[i] for i in at]), totals],
                    ["cluster", "n", "far", "sums"],
                )

        parts = self.state.select("embedding", "cluster", "distance").mapInArrow(
            run, "cluster int, n long, far long, sums array<decimal(38,0)>"
        )
        wide = parts.select("cluster", "n", "far", F.posexplode("sums").alias("at", "v"))
        found = wide.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.sum("v").alias("total"))
        moved, radius = self.centroids.copy(), np.zeros(k)
        for row in found.collect():
            moved[row.cluster, row["at"]] = int(row.total) // row.n
            radius[row.cluster] = float(row.far) ** 0.5 * (1 + SHARE) + LENGTH
            if row.far == HIGHEST:
                radius[row.cluster] = np.inf
        falls = losses(self.centroids, moved, radius)
        self.centroids = moved
        return falls


def clustered(
    rows: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = 1
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector.

    ``rows`` has vec_id and embedding. The ``k`` vectors with the smallest sha256 of
    ``seed:vec_id`` are the first centroids; ``rounds`` rounds move them, and a last one assigns.
    """
    found = run(rows, k, rounds, scale, width, seed)
    sums = found.state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    total = min(sum(int(row.own) for row in sums), HIGHEST)
    described = [
        (row.cluster, min(int(row.own), HIGHEST), total, hashlib.sha256(",".join(str(int(v)) for v in found.centroids[row.cluster]).encode()).hexdigest())
        for row in sums
    ]
    by_cluster = rows.sparkSession.createDataFrame(
        described, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.state.join(F.broadcast(by_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def run(rows: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = 1) -> Clustering:
    """The clustering after ``rounds`` rounds and the last assignment."""
    found = Clustering(rows, k, scale, width, seed)
    found.assign()
    for _ in range(rounds):
        found.assign(found.move())
    return found
