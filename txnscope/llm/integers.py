"""Integer vectors: filtering and scaling of embeddings, and the few first rows of a large table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 64  # groups that the tasks' first rows are merged in before the driver merges the groups'


def scaled(rows: DataFrame, scale: int, largest: int, *keep: Column, vector_col: str = "embedding") -> DataFrame:
    """``keep`` and x: each component times ``scale``, rounded down.

    Rows whose vector is null or holds null or non-finite components, or whose scaled components pass ``largest``
    in size, are left out.
    """
    v = rows.select(*keep, F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where(f"v IS NOT NULL AND forall(v, e -> e IS NOT NULL AND abs(e) * {scale} <= double('{largest}'))")
    # later filters on x may move ahead of this one, so that it meets all vectors: it must not fail
    return v.select(*v.columns[:-1], F.expr(f"transform(v, e -> try_cast(floor(e * {scale}) AS INT))").alias("x"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The lists of a column, all of one length, as rows of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as a column of lists."""
    ends = np.arange(0, x.size + 1, x.shape[1] or 1, dtype=np.int32)[: len(x) + 1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.ravel(), kind))


def first_rows(rows: DataFrame, order: list[Column], count: int) -> DataFrame:
    """The ``count`` first rows by ``order``.

    Each task's first rows are merged in FAN groups before the last merge, so that however many tasks there are,
    FAN x ``count`` rows at most reach the driver.
    """
    group = Window.partitionBy("_group").orderBy(*order)
    firsts = rows.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    firsts = firsts.withColumn("_place", F.row_number().over(group)).where(F.col("_place") <= count)
    return firsts.drop("_group", "_place").orderBy(*order).limit(count)


def exact_sums(partials: DataFrame, keys: list[str]) -> dict[tuple, tuple[int, list[int], int]]:
    """(count, summed components, largest far) by ``keys`` of the tasks' partial rows (keys, n, far, sums)."""
    long = partials.select(*keys, "n", "far", F.posexplode("sums").alias("at", "s"))
    total = long.groupBy(*keys, "at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"), F.max("far").alias("far")
    )
    found: dict[tuple, tuple[int, list[int], int]] = {}
    for r in total.orderBy(*keys, "at").collect():
        found.setdefault(tuple(r[k] for k in keys), (int(r["n"]), [], int(r["far"])))[1].append(int(r["s"]))
    return found
