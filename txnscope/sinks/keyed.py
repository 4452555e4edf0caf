"""Keyed latest-wins tables on plain Parquet (upsert without a table format).

A table is a folder::

    <root>/checkpoint/   streaming checkpoint of the query that feeds it
    <root>/log/batch_id=N/part-*.parquet

Each micro-batch is written to its own ``batch_id`` partition with dynamic partition
overwrite, so a replayed batch (after a failure, same ``batch_id``) replaces exactly its
own files: writes are idempotent. The *latest view* keeps, per key, the row of the highest
``batch_id``; the *live view* also drops rows whose ``ttl`` (epoch seconds) has passed.
Log and checkpoint share one root because a fresh checkpoint restarts ``batch_id`` at 0.

Compaction is a plain job: it reads the latest rows, drops those that nobody needs any more
and writes the rest to a new catalogue table, bucketed and sorted by the key. The caller
switches to the :class:`KeyedTable` it returns, which reads that base and the batches after
it; nothing that others read is changed. The base is never shuffled for the latest view:
the newer batches are, to its buckets, and take the place of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

BATCH = "batch_id"


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _batch_ids(spark: SparkSession, log: str) -> list[int]:
    """Partition folder names (metadata listing only, no data read)."""
    p, fs = hadoop_path(spark, log)
    if not fs.exists(p):
        return []
    ids = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{BATCH}="):
            ids.append(int(name.split("=", 1)[1]))
    return sorted(ids)


def _last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """Highest batch id in the streaming checkpoint's commit log (None: no stream)."""
    p, fs = hadoop_path(spark, f"{checkpoint}/commits")
    if not fs.exists(p):
        return None
    ids = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()]
    return max(ids) if ids else -1


def _latest(log: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``row_number() = 1`` per key by descending batch: Spark inserts a partial per-key
    group limit before the shuffle, so superseded versions are dropped map-side."""
    w = Window.partitionBy(*[F.col(k) for k in key]).orderBy(F.col(BATCH).desc())
    return log.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def unexpired(rows: DataFrame, expiry: str, as_of: Column | str | None = None) -> DataFrame:
    """Rows whose expiry (a SQL expression in epoch seconds) is after ``as_of``, by default now."""
    if as_of is None:
        at = F.current_timestamp()
    elif isinstance(as_of, Column):
        at = as_of
    else:
        at = F.lit(as_of).cast("timestamp")
    return rows.filter(F.expr(expiry) > F.unix_timestamp(at))


@dataclass(frozen=True)
class Base:
    """Rows of all batches up to ``upto``, in a catalogue table bucketed by the key."""

    table: str
    upto: int


@dataclass(frozen=True)
class KeyedTable:
    root: str
    key: tuple[str, ...]
    schema: T.StructType  # row schema without batch_id
    ttl_column: str = "ttl"
    # SQL expression of the epoch second until which compaction keeps a row, where a view over
    # the rows outlives them; the expiry column if unset.
    kept_until: str | None = None
    base: Base | None = None

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    # ---------------------------------------------------------------- write side
    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Idempotent write of one batch (safe to call again with the same id)."""
        out = rows.select(*[F.col(f.name) for f in self.schema.fields])
        (
            self._sized(out).withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.log)
        )

    def _sized(self, rows: DataFrame) -> DataFrame:
        """Files sized by their data where the plan may adapt; a micro-batch of a stateful query may
        not, and writes its state partitions as they are."""
        adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        return rows.hint("rebalance", *self.key) if adaptive else rows

    # ----------------------------------------------------------------- read side
    def log_rows(self, spark: SparkSession) -> DataFrame:
        """All rows of the batches after the base, with their batch ids."""
        schema = T.StructType(self.schema.fields + [T.StructField(BATCH, T.LongType(), True)])
        try:
            rows = spark.read.schema(schema).parquet(self.log)
        except AnalysisException as err:  # nothing written yet
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return rows.where(F.col(BATCH) > F.lit(self.base.upto)) if self.base else rows

    def latest(self, spark: SparkSession) -> DataFrame:
        """Newest row per key."""
        return self._newest(spark, self.log_rows(spark))

    def _newest(self, spark: SparkSession, log: DataFrame) -> DataFrame:
        newest = _latest(log, self.key).drop(BATCH)
        if self.base is None:
            return newest
        # keys are never null: a missing user has a key text of its own
        unchanged = spark.table(self.base.table).join(newest.select(*self.key), list(self.key), "left_anti")
        return unchanged.select(*[f.name for f in self.schema.fields]).unionByName(newest)

    def live(self, spark: SparkSession, as_of: Column | str | None = None) -> DataFrame:
        """Latest rows whose expiry is still ahead of ``as_of`` (default: now; a string
        is a timestamp literal such as ``'2024-02-15 00:00:00'``)."""
        return unexpired(self.latest(spark), self.ttl_column, as_of)

    # ---------------------------------------------------------------- maintenance
    def compact(
        self, spark: SparkSession, table: str, path: str, as_of: Column | str | None = None, buckets: int | None = None
    ) -> KeyedTable:
        """Write the latest rows of all committed batches to the new catalogue table ``table`` at ``path``.

        Returns the table to switch to. Batches after the stream's last commit may still be replayed and are left to
        the log. Rows past ``kept_until`` go. ``buckets`` stay fixed for the table; with fewer than the shuffle
        partitions (the default) readers may prefer to shuffle the base for its parallelism.
        Nothing is deleted: batches and bases that no reader uses any more are the caller's to remove.
        """
        ids = _batch_ids(spark, self.log)
        committed = _last_committed(spark, self.checkpoint)
        if committed is not None:
            ids = [i for i in ids if i <= committed]
        if not ids or self.base is not None and ids[-1] <= self.base.upto:
            return self
        upto, buckets = ids[-1], buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = self._newest(spark, self.log_rows(spark).where(F.col(BATCH) <= F.lit(upto)))
        kept = unexpired(rows, self.kept_until or self.ttl_column, as_of)
        (
            kept.repartition(buckets, *self.key)
            .write.bucketBy(buckets, *self.key)
            .sortBy(*self.key)
            .option("path", path)
            .saveAsTable(table)
        )
        return replace(self, base=Base(table, upto))
