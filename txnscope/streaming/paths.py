"""Streaming queries: hot paths (keyed upsert, rule sets A and B), final path (sealed
windows), cold path (every transaction) and quarantine (routed payloads).

They take streaming frames and reuse the batch operators unchanged. Each query has its own checkpoint; the hot path's checkpoint lives next to its
log table (see :mod:`txnscope.sinks.keyed`).

Triggers default to the original processing-time intervals; pass ``available_now=True``
for tests and backfills (process what is there, then stop).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from txnscope.config import ANOMALY, COLD_TRIGGER, COUNT, FRAUD, HOT_TRIGGER, MAX_AMOUNT, RuleProfile
from txnscope.operators.records import alert_expiry_sql, anomaly_records, fraud_aggregates, fraud_alerts
from txnscope.operators.windows import aggregate, sliding_stream
from txnscope.schemas import ANOMALY_RECORD, FRAUD_AGGREGATE, PARTITION_COLUMNS, TRANSACTION_COLUMNS
from txnscope.sinks.keyed import KeyedTable, unexpired
from txnscope.sinks.lake import SCREENED_SCHEMA, with_partition_columns
from txnscope.sources.payload import STATUS_REJECTED, STATUS_VALID, classify_payloads, valid_payloads, with_category


def _trigger(writer: DataStreamWriter, interval: str, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


@contextmanager
def _set(spark, **settings: str):
    """Session settings for a query being started, which keeps its own copy; they are restored afterwards."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _starting(spark, state_partitions: int | None = None, update: bool = False):
    """Settings of a stateful query's start: its state partitions; in ``update`` mode no batches without data.

    A stateful query fixes its state partition count at its first start (later starts
    read it from the checkpoint). Batch jobs want thousands of shuffle partitions at 100 TB,
    but a 10-second micro-batch with thousands of state-store tasks is mostly overhead,
    so streaming queries take their own count.

    A batch without data only evicts windows that the watermark has passed. In update mode it
    emits nothing, so its empty write is spared: the next batch with data evicts them.
    """
    settings = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if update:
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    return _set(spark, **settings)


def observe_windows(windows: DataFrame, profile: RuleProfile) -> DataFrame:
    """Per-batch counts of emitted and flagged windows, reported with each progress event
    (``observedMetrics['<profile>_windows']``) without a second pass over the batch."""
    return windows.observe(
        f"{profile.name}_windows",
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col(profile.flagged)).alias("flagged"),
    )


def anomaly_table(root: str) -> KeyedTable:
    return KeyedTable(root=root, key=("transaction_id",), schema=ANOMALY_RECORD)


def fraud_table(root: str) -> KeyedTable:
    """Aggregate rows; flagged ones are kept as long as their alerts live."""
    kept = f"CASE WHEN {FRAUD.flagged} THEN greatest(ttl, {alert_expiry_sql(FRAUD)}) ELSE ttl END"
    return KeyedTable(root=root, key=("pk", "sk"), schema=FRAUD_AGGREGATE, kept_until=kept)


def live_alerts(spark, table: KeyedTable, as_of: str | None = None, profile: RuleProfile = FRAUD) -> DataFrame:
    """Alerts of the latest aggregate rows whose own expiry is still ahead, which may be past the rows' own."""
    return unexpired(fraud_alerts(table.latest(spark), profile), "ttl", as_of)


def start_hot(
    txns: DataFrame,
    table: KeyedTable,
    profile: RuleProfile = ANOMALY,
    window: str | None = None,
    as_of: str | None = None,
    available_now: bool = False,
    trigger: str = HOT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Rule set A hot path: update-mode windowed aggregate -> flagged records -> keyed log.

    Update mode re-emits a window whenever a batch touches it; the keyed log plus the
    latest view turn those re-emissions into an upsert. For this profile count and max
    only grow, so filtering flagged rows per batch equals filtering the final state. Profiles
    with rules on other metrics are refused: their windows may lose a flag again.
    """
    if any(r.metric not in (COUNT, MAX_AMOUNT) for r in profile.rules):
        raise ValueError(f"{profile.name}: flags can be withdrawn, use start_fraud_hot")
    windows = observe_windows(aggregate(txns, profile, window), profile)

    def sink(batch, batch_id: int) -> None:
        table.write_batch(anomaly_records(batch, profile, as_of), batch_id)

    writer = (
        windows.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", table.checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _starting(txns.sparkSession, state_partitions, update=True):
        return _trigger(writer, trigger, available_now).start()


def start_fraud_hot(
    txns: DataFrame,
    table: KeyedTable,
    profile: RuleProfile = FRAUD,
    window: str | None = None,
    as_of: str | None = None,
    available_now: bool = False,
    trigger: str = HOT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Rule set B hot path: every updated window -> aggregate log (one write per batch).

    Alerts are a view over the latest aggregate rows (``records.fraud_alerts``), so a
    window un-flagged by a later refund no longer shows an alert.
    """
    windows = observe_windows(aggregate(txns, profile, window), profile)

    def sink(batch, batch_id: int) -> None:
        table.write_batch(fraud_aggregates(batch, profile, as_of), batch_id)

    writer = (
        windows.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", table.checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _starting(txns.sparkSession, state_partitions, update=True):
        return _trigger(writer, trigger, available_now).start()


def start_final(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    profile: RuleProfile = ANOMALY,
    window: str | None = None,
    as_of: str | None = None,
    available_now: bool = False,
    trigger: str = HOT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Sealed windows only: append mode emits each flagged window once, after the
    watermark passes its end, into a Parquet folder (no upsert needed)."""
    windows = aggregate(txns, profile, window)
    records = anomaly_records(windows, profile, as_of)
    writer = (
        records.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _starting(txns.sparkSession, state_partitions):
        return _trigger(writer, trigger, available_now).start()


def start_cold(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str = COLD_TRIGGER,
    query_name: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Every transaction, appended to the date-partitioned Parquet table.

    By default there is no shuffle: each source partition's task writes one file per date
    it holds per trigger. With many source partitions and short triggers that is many
    small files; ``files_per_batch`` spreads rows round-robin over that many writers (no
    key, so a date holding a third of the rows cannot overload one task), and
    ``sinks.lake.compact_days`` rewrites closed days later.
    """
    rows = with_partition_columns(with_category(txns).select(*TRANSACTION_COLUMNS))
    if files_per_batch:
        rows = rows.repartition(files_per_batch)
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLUMNS)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger, available_now).start()


def start_quarantine(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str = COLD_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Classify every payload once and append it under ``path/status=valid|rejected``.

    Valid rows and the quarantine are then partition-pruned reads of one table
    (``sinks.lake``-style readers or ``spark.read.parquet(path).where("status = 'valid'")``).
    """
    classified = classify_payloads(envelope).withColumn(
        "status",
        F.when(F.col("reject_reason").isNull(), F.lit(STATUS_VALID)).otherwise(F.lit(STATUS_REJECTED)),
    )
    writer = (
        classified.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("status")
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger, available_now).start()


def start_intake(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str = COLD_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Screen every payload once and append it to the screened lake
    ``path/status=valid|rejected/year=Y/month=M/day=D``.

    One parse serves three readers: the cold table (``sinks.lake.read_valid``), the quarantine
    (``sinks.lake.read_rejects``) and, as a stream, the hot path (:func:`screened_stream`). Dates are those of the
    event time, of the arrival for rejects, whose event time may be anything. There is no shuffle.
    """
    classified = classify_payloads(envelope)
    valid = F.col("reject_reason").isNull()
    rows = classified.withColumn("status", F.when(valid, F.lit(STATUS_VALID)).otherwise(F.lit(STATUS_REJECTED)))
    rows = rows.withColumn("_day", F.when(valid, F.col("event_timestamp")).otherwise(F.col("arrival_time")))
    # the text of a valid record is in its fields
    rows = rows.withColumn("raw", F.when(~valid, F.col("raw")))
    writer = (
        with_partition_columns(rows, "_day")
        .select(*[f.name for f in SCREENED_SCHEMA.fields])
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy("status", *PARTITION_COLUMNS)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger, available_now).start()


def screened_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Valid transactions of a screened lake as a stream: what the intake has committed, in its order.

    Rejects' files are pruned by their partition, and no record is parsed again. ``path`` must be there, if empty.
    """
    reader = spark.readStream.schema(SCREENED_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return valid_payloads(reader.parquet(path).where(F.col("status") == STATUS_VALID))


def start_sliding(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    profile: RuleProfile,
    window: str,
    slide: str,
    available_now: bool = False,
    trigger: str = HOT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Sealed sliding windows (``operators.windows.sliding_stream``), appended to a Parquet folder."""
    writer = (
        sliding_stream(txns, profile, window, slide)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _starting(txns.sparkSession, state_partitions):
        return _trigger(writer, trigger, available_now).start()
