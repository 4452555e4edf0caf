"""Late transactions as an output of their own.

A windowed aggregation drops rows whose window had ended by the watermark of the batch before, and reports only how
many (after partial aggregation). This query finds those rows: it keeps, for each of its batches, the newest event
time seen up to it, derives the same watermark, and appends the rows behind it to a table. Batches are the query's
own: with the same source, options and starting point as the hot path's, its rows are the ones that the hot path
drops; with other triggers they are late by this query's clock.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnscope.config import ANOMALY, COLD_TRIGGER, RuleProfile
from txnscope.operators.windows import EVENT_TIME
from txnscope.schemas import TRANSACTION, TRANSACTION_COLUMNS
from txnscope.sources.payload import with_category

BATCH = "batch_id"
LATE = T.StructType(
    [
        *TRANSACTION.fields,
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("window_end", T.TimestampType(), True),
        T.StructField("watermark", T.TimestampType(), True),
        T.StructField(BATCH, T.LongType(), True),
    ]
)
# Newest event times are kept for so many batches: a replayed batch needs the two before it.
KEPT_MARKS = 4


def _mark(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Newest event time (microseconds) up to a batch, None if there was none."""
    if batch_id < 0:
        return None
    try:
        row = spark.read.parquet(f"{root}/marks/slot={batch_id % KEPT_MARKS}").where(F.col(BATCH) == batch_id).first()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row["high"] if row else None


def _keep_mark(spark: SparkSession, root: str, batch_id: int, high: int | None) -> None:
    rows = spark.createDataFrame([(batch_id, high)], f"{BATCH} long, high long")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/slot={batch_id % KEPT_MARKS}")


def late_rows(txns: DataFrame, high: int | None, profile: RuleProfile = ANOMALY, window: str | None = None) -> DataFrame:
    """Rows whose window ends at or before the watermark that follows from the newest event time ``high``
    (microseconds; watermarks are whole milliseconds).

    Rows without an event time have no window and are never late; without ``high`` there is no watermark.
    """
    millis = None if high is None else high // 1000
    mark = F.timestamp_millis(F.lit(millis).cast("long")) - F.expr(f"INTERVAL {profile.watermark}")
    placed = with_category(txns).where(F.col(EVENT_TIME).isNotNull()).select(
        *TRANSACTION_COLUMNS, F.window(EVENT_TIME, window or profile.window).alias("window"), mark.alias("watermark")
    )
    rows = placed.selectExpr(*TRANSACTION_COLUMNS, "window.start AS window_start", "window.end AS window_end", "watermark")
    return rows.where("window_end <= watermark")


def start_late_rows(
    txns: DataFrame,
    root: str,
    profile: RuleProfile = ANOMALY,
    window: str | None = None,
    available_now: bool = False,
    trigger: str = COLD_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Late rows, appended under ``root/late/batch_id=N``; a batch that runs again replaces its own rows.

    One pass over each batch: its newest event time is observed while its late rows are written.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, previous = _mark(spark, root, batch_id - 2), _mark(spark, root, batch_id - 1)
        newest = F.max(F.unix_micros(EVENT_TIME)).alias("high")
        if before is None:  # no watermark yet: nothing is late
            high = batch.agg(newest).first()["high"]
        else:
            seen = Observation(f"late-{batch_id}")
            (
                late_rows(batch.observe(seen, newest), before, profile, window)
                .withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BATCH)
                .parquet(f"{root}/late")
            )
            high = seen.get["high"]
        highs = [h for h in (previous, high) if h is not None]
        _keep_mark(spark, root, batch_id, max(highs, default=None))

    writer = txns.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint")
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def read_late(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LATE).parquet(f"{root}/late")
    except AnalysisException as err:  # nothing late yet
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LATE)
