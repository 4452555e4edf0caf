"""Vector code compression: 16 codebooks fitted by ball k-means.

Every entry of a codebook is the centre of a ball that holds its parts; the ball's radius is that of its farthest
part, carried over to the moved centre by the centre's shift. Only entries whose centres lie within two radii of a
centre can take parts from its ball: its neighbours. A part nearer to its centre than half the distance of the
nearest neighbour lies in the stable core and keeps its entry unseen; the others lie in a ring between two
neighbours' half distances and are compared with the neighbours inside that ring only. All comparisons are between
exact integers, and a neighbour at exactly twice a part's distance is still compared, so ties are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm.integers import exact_sums, first_rows, lists, matrix, scaled
from txnscope.session import scratch_path

SCALE = 256
LARGEST = 1 << 24  # of a scaled component: squared distances of up to 4,096 components then fit 63 bits
SMALL = 1 << 20  # up to this size double precision holds all products and sums exactly
PARTS = 16
ENTRIES = 64
ROUNDS = 2
FEW_LABELS = 10_000  # up to so many labels their sums are broadcast
SALTS = 32  # rows of a label are dealt out to so many groups otherwise


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    if max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) <= SMALL:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
    d = (x * x).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :] - 2 * (x @ entries.T)
    return d.astype(np.int64)


def own(x: np.ndarray, entries: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its entry."""
    diff = x - entries[at]
    return np.einsum("ij,ij->i", diff, diff)


@dataclass(frozen=True)
class Balls:
    """A codebook's entries with each one's neighbours, nearest first, as far as its radius asks for them."""

    entries: np.ndarray
    order: np.ndarray  # neighbour t of entry e
    apart: np.ndarray  # its squared distance; neighbours out of reach are infinitely far

    @classmethod
    def around(cls, entries: np.ndarray, radius: np.ndarray) -> Balls:
        d = distances(entries, entries)
        np.fill_diagonal(d, -1)
        order = np.argsort(d, axis=1, kind="stable")[:, 1:]
        apart = np.take_along_axis(d, order, axis=1)
        reach = 4 * (radius * (1 + 1e-9) + 1e-6) ** 2
        return cls(entries, order, np.where(apart <= reach[:, None], apart, np.iinfo(np.int64).max))

    def rings(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How many neighbours of its entry each part must be compared with; none in the stable core."""
        ring = np.zeros(len(at), np.int64)
        by = np.argsort(at, kind="stable")
        for rows in np.split(by, np.flatnonzero(np.diff(at[by])) + 1):
            if len(rows):
                ring[rows] = np.searchsorted(self.apart[at[rows[0]]], 4 * d[rows], side="right")
        return ring

    def moved(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each part's nearest entry, the lower index if equal, its squared distance, and the compared pairs."""
        best, now = own(x, self.entries, at), at.copy()
        ring = self.rings(at, best)
        live, compared = np.flatnonzero(ring), 0
        for t in range(int(ring.max(initial=0))):
            live = live[ring[live] > t]
            other = self.order[at[live], t]
            d = own(x[live], self.entries, other)
            compared += len(live)
            closer = (d < best[live]) | ((d == best[live]) & (other < now[live]))
            best[live[closer]], now[live[closer]] = d[closer], other[closer]
        return now, best, compared


def _first(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return distances(x, entries).argmin(axis=1)


def _parts(x: np.ndarray) -> list[np.ndarray]:
    return np.split(x, PARTS, axis=1)


def _coded(rows: DataFrame, width: int, step) -> DataFrame:
    """(vec_id, label, x, code) with each part's code from ``step(part position, part rows, codes or None)``."""
    has = "code" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _parts(matrix(batch.column(2), width))
                codes = matrix(batch.column(3), PARTS) if has else None
                code = np.stack([step(p, x[p], None if codes is None else codes[:, p]) for p in range(PARTS)], axis=1)
                columns = [*batch.columns[:3], lists(code.astype(np.int32), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "code"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {label}, x array<int>, code array<int>")


def _sums(coded: DataFrame, width: int, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, far, sums) of the parts that a task holds of each entry."""
    size, entries = width // PARTS, len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, far = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries), np.int64)
        sums = np.zeros((PARTS, entries, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, codes = _parts(matrix(batch.column(0), width)), matrix(batch.column(1), PARTS)
            for p in range(PARTS):
                at = codes[:, p]
                count[p] += np.bincount(at, minlength=entries)
                np.maximum.at(far[p], at, own(x[p], books[p], at))
                for i in range(size):
                    # sums of a batch stay far below 2**53
                    sums[p, :, i] += np.bincount(at, weights=x[p][:, i], minlength=entries).astype(np.int64)
        p, e = np.nonzero(count)
        columns = [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(far[p, e]), lists(sums[p, e], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "far", "sums"])

    return coded.select("x", "code").mapInArrow(run, "part long, entry long, n long, far long, sums array<long>")


def _updated(coded: DataFrame, width: int, books: list[np.ndarray]) -> list[Balls]:
    """The codebooks moved to their parts' means, as balls."""
    new, radius = [b.copy() for b in books], np.zeros((PARTS, len(books[0])))
    for (p, e), (n, total, far) in exact_sums(_sums(coded, width, books), ["part", "entry"]).items():
        new[p][e] = [s // n for s in total]
        radius[p, e] = np.sqrt(far) + np.sqrt(float(((new[p][e] - books[p][e]) ** 2).sum()))
    return [Balls.around(b, r) for b, r in zip(new, radius, strict=True)]


def _errors(coded: DataFrame, width: int, books: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, codes = _parts(matrix(batch.column(2), width)), matrix(batch.column(3), PARTS)
                error = sum(own(x[p], books[p], codes[:, p]) for p in range(PARTS))
                code = [bytes(row).hex() for row in codes.astype(np.uint8)]
                columns = [*batch.columns[:2], pa.array(code), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    label = coded.schema["label"].dataType.simpleString()
    return coded.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def with_label_error(spark: SparkSession, coded: DataFrame, few: int = FEW_LABELS) -> DataFrame:
    """``coded`` with the errors summed over its label; a label of any share of the rows is split."""
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    sums = _stored(spark, sums.select(F.col("label").alias("same"), F.expr("try_cast(s AS BIGINT)").alias("label_error")), "labels")
    if sums.count() <= few:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("same"))).drop("same")
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("same")) & (F.col("salt") == F.col("copy"))
    return dealt.join(sums, same).drop("same", "copy", "salt")


def codes(spark: SparkSession, rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, few: int = FEW_LABELS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each kept row.

    Dropped are rows whose vector is null or holds null or non-finite components, and vectors that the codebooks
    cannot code: of a length that 16 does not divide, of another length than most of the rest have (the smaller of
    two equally common lengths), or with a component above 65,536 in size (distances would not fit a long). Every
    kept row counts, rows given twice too. Rows without an id are coded but start no entry; equal ids start in the
    order of their components. With fewer vectors than ``entries`` each starts one. Equally near entries: the lower
    index. Sums past a long are null. An empty table, or one without such vectors, gives no rows; other columns
    are ignored, and a table without labels has one label, null.
    """
    label = F.col("label") if "label" in rows.columns else F.lit(None).cast("int").alias("label")
    kept = scaled(rows, SCALE, LARGEST, F.col("vec_id").cast("bigint").alias("vec_id"), label)
    sizes = kept.where(f"size(x) > 0 AND size(x) % {PARTS} = 0").groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    width = common["size"] if common else -1
    kept = kept.where(F.size("x") == width)
    starts = first_rows(kept.where("vec_id IS NOT NULL").select("vec_id", "x"), [F.col("vec_id"), F.col("x")], entries).collect()
    if not starts:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = _parts(np.array([r["x"] for r in starts], np.int64))
    coded = _stored(spark, _coded(kept, width, lambda p, x, _: _first(x, books[p])), "codes")
    for _ in range(rounds):
        balls = _updated(coded, width, books)
        coded = _stored(spark, _coded(coded, width, lambda p, x, at, balls=balls: balls[p].moved(x, at)[0]), "codes")
        books = [b.entries for b in balls]
    digest = hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()
    coded = _stored(spark, _errors(coded, width, books), "errors")
    return with_label_error(spark, coded, few).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
