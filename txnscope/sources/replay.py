"""Replays: a table of transactions dealt out over files, streamed one file a batch.

A replay's order is fixed by the data alone, so lateness can be computed in SQL: transactions go to equal steps of
the event-time range, and a delay expression moves some of them to later steps, out of order. Each step is one file;
the files' modification times, which file sources follow, ascend by step. Without delays, files of equal row counts in
event-time order do (:func:`deal_in_order`): a stream over them holds the state of a batch or so, however large the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.schemas import TRANSACTION, TRANSACTION_COLUMNS
from txnscope.sources.payload import with_category

STEP = "step"
LEAST_STEPS = 6
ROWS_PER_STEP = 1_000_000  # a step is one task's file
_FIRST_MILLIS = 1_700_000_000_000


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def with_steps(txns: DataFrame, delay_sql: str = "0") -> DataFrame:
    """Add ``step``: the row's place in the event-time range, moved on by ``delay_sql`` steps at most to the last.

    The number of steps follows the row count. Rows without an event time come first.
    """
    bounds = txns.agg(
        F.min(F.expr("unix_micros(event_timestamp)")).alias("low"),
        F.max(F.expr("unix_micros(event_timestamp)")).alias("high"),
        F.expr(f"greatest({LEAST_STEPS}, CAST(ceil(count(1) / {ROWS_PER_STEP}) AS BIGINT))").alias("steps"),
    ).first()
    low, high, steps = bounds["low"] or 0, bounds["high"] or 0, bounds["steps"]
    own = f"coalesce(({steps}L * (unix_micros(event_timestamp) - {low}L)) div ({high - low + 1}L), 0L)"
    return txns.withColumn(STEP, F.expr(f"CAST(least({steps - 1}L, {own} + ({delay_sql})) AS INT)"))


def deal_out(stepped: DataFrame, path: str) -> list[int]:
    """Write each step as one file under ``path``, in ascending modification times; the steps that have rows."""
    spark = stepped.sparkSession
    rows = with_category(stepped).select(STEP, *TRANSACTION_COLUMNS)
    rows.repartition(STEP).write.partitionBy(STEP).parquet(path)
    root, fs = _file_system(spark, path)
    steps = []
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if name.startswith(f"{STEP}="):
            step = int(name.split("=", 1)[1])
            steps.append(step)
            for file in fs.listStatus(folder.getPath()):
                fs.setTimes(file.getPath(), _FIRST_MILLIS + 1000 * step, -1)
    return sorted(steps)


def deal_in_order(txns: DataFrame, path: str) -> None:
    """Write the rows under ``path`` in event-time order, about ROWS_PER_STEP a file, in ascending modification times.

    A later file holds no earlier time, so no row is late. Rows without an event time come first.
    """
    spark = txns.sparkSession
    files = max(1, -(-txns.count() // ROWS_PER_STEP))
    rows = with_category(txns).select(*TRANSACTION_COLUMNS)
    rows.repartitionByRange(files, "event_timestamp", "user_id", "transaction_id").write.parquet(path)
    root, fs = _file_system(spark, path)
    for file in fs.listStatus(root):
        name = file.getPath().getName()
        if name.startswith("part-"):
            fs.setTimes(file.getPath(), _FIRST_MILLIS + 1000 * int(name.split("-")[1]), -1)


def hold_back(spark: SparkSession, path: str, held: str, steps: list[int]) -> None:
    """Move the folders of ``steps`` to ``held``, out of the stream's sight; :func:`release` brings them in."""
    _move(spark, path, held, steps)


def release(spark: SparkSession, held: str, path: str, steps: list[int]) -> None:
    _move(spark, held, path, steps)


def _move(spark: SparkSession, source: str, target: str, steps: list[int]) -> None:
    to, fs = _file_system(spark, target)
    fs.mkdirs(to)
    for step in steps:
        a, _ = _file_system(spark, f"{source}/{STEP}={step}")
        b, _ = _file_system(spark, f"{target}/{STEP}={step}")
        if not fs.rename(a, b):
            raise OSError(f"could not move {a} to {b}")


def replay_stream(spark: SparkSession, path: str) -> DataFrame:
    """The dealt-out transactions as a stream, one step a batch."""
    reader = spark.readStream.schema(TRANSACTION).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1")
    return reader.parquet(path)
