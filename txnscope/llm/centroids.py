"""Centroid clustering: integer k-means whose comparisons are filtered by N-simplex projection.

Some of the starting centroids are pivots. Their mutual distances span a simplex; the distances of a vector to the
pivots place it as the apex of a simplex over that base. The Euclidean distance of two apexes never exceeds the
distance of their vectors, and the distance to the apex mirrored at the base is never below it. Vectors do not
move, so their apexes are computed once and stored with them; each round computes those of the centroids only.
A centroid whose lower bound passes the least upper bound cannot be nearest; the others are compared exactly, in
integers. Sums for the new centroids are made per task before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm.integers import exact_sums, first_rows, lists, matrix, scaled
from txnscope.session import scratch_path

WIDTH = 64  # components of a vector that takes part
SCALE = 64
LARGEST = 1 << 27  # of a scaled component: squared distances then fit 63 bits
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 10
FLAT = 1e-4  # a pivot whose squared height over the others' simplex is below this share of the widest is no use
SLACK = 1e-9  # relative error allowed for in the bounds


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to one point."""
    diff = x - c
    return np.einsum("ij,ij->i", diff, diff)


class Simplex:
    """A base simplex of pivots, and apexes over it.

    With the first pivot as origin, pivot j has the coordinates of row j - 1 of the triangular ``base``; an apex's
    coordinates over the base solve a triangular system in its squared distances to the pivots, and what is left
    of its distance to the origin is its height.
    """

    def __init__(self, points: np.ndarray, count: int = PIVOTS):
        self.pivots, self.base = points[:1], np.zeros((0, 0))
        widest = max((float(squared(points, p).max()) for p in points), default=0.0)
        self.widest = widest or 1.0
        while len(self.pivots) < min(count, len(points)):
            apexes = self.apexes(points)
            far = int(apexes[:, -1].argmax())
            if apexes[far, -1] ** 2 <= FLAT * self.widest:
                break
            k = len(self.base)
            base = np.zeros((k + 1, k + 1))
            base[:k, :k] = self.base
            base[k] = apexes[far]
            self.pivots, self.base = np.vstack([self.pivots, points[far : far + 1]]), base

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Coordinates over the base, and the height, of each row."""
        s = np.stack([squared(x, p) for p in self.pivots], axis=1).astype(np.float64)
        k = len(self.base)
        out = np.zeros((len(x), k + 1))
        for j in range(k):
            b = (s[:, 0] + self.base[j] @ self.base[j] - s[:, j + 1]) / 2
            out[:, j] = (b - out[:, :j] @ self.base[j, :j]) / self.base[j, j]
        out[:, k] = np.sqrt(np.maximum(s[:, 0] - np.einsum("ij,ij->i", out[:, :k], out[:, :k]), 0))
        return out

    def possible(self, apexes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` (columns) can be nearest to each of ``apexes`` (rows), by their bounds."""
        flat = np.zeros((len(apexes), len(others)))
        for j in range(others.shape[1] - 1):
            flat += (apexes[:, j, None] - others[None, :, j]) ** 2
        h, g = apexes[:, -1, None], others[None, :, -1]
        lower, upper = flat + (h - g) ** 2, flat + (h + g) ** 2
        # rounding errors grow with the distance from the base, relative to its width
        away = np.maximum(np.einsum("ij,ij->i", apexes, apexes)[:, None], np.einsum("ij,ij->i", others, others)[None, :])
        slack = SLACK * (away + self.widest) * np.maximum(1, away / self.widest)
        return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid, the smaller number if equal; compared pairs."""
    may = simplex.possible(apexes, simplex.apexes(centroids))
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(may[:, c])
        d = squared(x[rows], centroids[c])
        closer = d < best[rows]
        best[rows[closer]], at[rows[closer]] = d[closer], c
    return at, best, int(may.sum())


def _placed(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = lists(simplex.apexes(matrix(batch.column(1), WIDTH)), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, apexes], names=["vec_id", "x", "apex"])

    return vectors.mapInArrow(run, "vec_id long, x array<int>, apex array<double>")


def _apexes(column: pa.ListArray, simplex: Simplex) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(simplex.base) + 1)


def _sums(placed: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """(c, n, far, sums) of the vectors that each task assigns to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, far = np.zeros(len(centroids), np.int64), np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), WIDTH), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), WIDTH)
                at, d, _ = nearest(x, _apexes(batch.column(1), simplex), centroids, simplex)
                for c in np.unique(at):
                    sums[c] += x[at == c].sum(axis=0)
                    far[c] = max(far[c], d[at == c].max())
                count += np.bincount(at, minlength=len(centroids))
        used = np.flatnonzero(count)
        columns = [pa.array(used), pa.array(count[used]), pa.array(far[used]), lists(sums[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "n", "far", "sums"])

    return placed.select("x", "apex").mapInArrow(run, "c long, n long, far long, sums array<long>")


def _assigned(placed: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, d, _ = nearest(matrix(batch.column(1), WIDTH), _apexes(batch.column(2), simplex), centroids, simplex)
                columns = [batch.column(0), pa.array(at.astype(np.int32)), pa.array(d)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return placed.mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(
    spark: SparkSession, rows: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept row.

    Kept are vectors of exactly 64 components, none null or non-finite, and none above 2,097,152 in size (whose
    squared distances would not fit a long). Every kept row counts, rows given twice too. Rows without an id are
    assigned but never start a centroid; equal ids start in the order of their components. With fewer vectors than
    ``count`` each starts one. Equally near centroids: the smaller number. Sums past a long are null. An empty
    table, or one without such vectors, gives no rows; other columns are ignored.
    """
    kept = scaled(rows, SCALE, LARGEST, F.col("vec_id").cast("bigint").alias("vec_id")).where(F.size("x") == WIDTH)
    named = kept.where("vec_id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    starts = first_rows(named, [F.col("h"), F.col("x")], count).collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], result)
    centroids = np.array([r["x"] for r in starts], np.int64)
    simplex = Simplex(centroids, pivots)
    path = scratch_path(spark, "apexes")
    _placed(kept, simplex).write.parquet(path)
    placed = spark.read.parquet(path)
    for _ in range(rounds):
        for (c,), (n, total, _) in exact_sums(_sums(placed, centroids, simplex), ["c"]).items():
            centroids[c] = [s // n for s in total]
    path = scratch_path(spark, "clusters")
    _assigned(placed, centroids, simplex).write.parquet(path)
    assigned = spark.read.parquet(path)
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(inertia.values())
    # one row a centroid
    facts = spark.createDataFrame(
        [
            (c, inertia.get(c), whole, hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest())
            for c, x in enumerate(centroids)
        ],
        "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string",
    )
    fits = [F.expr(f"try_cast({c} AS BIGINT)").alias(c) for c in ("cluster_inertia", "inertia")]
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *fits, "centroid_sha256")
