"""Named queries over a test-data folder: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the folder's ``events`` table (through the transaction adapter) in
full and derives everything else from it with Spark. Compared outputs are normalised:
timestamps as ``TIMESTAMP_NTZ`` (time-zone free values) and flag lists joined with ``,``.
Detection/processing times use ``window_end`` so results are reproducible.

Streaming queries run with ``availableNow`` and write their tables and checkpoints under
the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnscope.config import ANOMALY, FRAUD
from txnscope.functions.rules import flag_list_sql
from txnscope.operators import analytics, serving
from txnscope.operators.records import anomaly_records, fraud_aggregates, fraud_alerts
from txnscope.operators.windows import aggregate
from txnscope.schemas import ANOMALY_RECORD, PAYLOAD, PAYLOAD_FIELDS
from txnscope.session import pin_utc, scratch_path
from txnscope.sinks.keyed import hadoop_path
from txnscope.sinks.lake import read_catalog, read_cold, read_rejects, register_table, write_cold
from txnscope.sources.events import (
    events_as_transactions,
    load_transactions,
    read_events_stream,
)
from txnscope.sources.payload import (
    classify_payloads,
    decode_payload,
    encode_payload,
    ROUTED,
    quarantined_payloads,
    read_routed,
    valid_payloads,
)
from txnscope.sources.replay import deal_in_order, deal_out, hold_back, release, replay_stream, with_steps
from txnscope.streaming.late import read_late, start_late_rows
from txnscope.streaming.paths import (
    anomaly_table,
    fraud_table,
    live_alerts,
    start_cold,
    start_final,
    start_fraud_hot,
    start_hot,
    start_quarantine,
    start_sliding,
)
from txnscope.streaming.progress import ProgressCollector, attach_collector, observe_transactions
from txnscope.streaming.runner import PipelineRoots, run_screened
from txnscope.streaming.state import open_windows

Query = Callable[[SparkSession, str], DataFrame]

DAY = "1 day"
MINUTE = "1 minute"
# Reporting month of the cold-table analytics (the fixture covers January 2024).
REPORT_YEAR, REPORT_MONTH = 2024, 1
# Read time of the live (unexpired) anomaly view.
LIVE_AS_OF = "2024-02-15 00:00:00"
# Compaction before that, when the fixture's aggregates have expired and half of its alerts have not.
COMPACTED_AS_OF = "2024-02-12 00:00:00"
# Sliding windows for bursts: 5 minutes long, advancing by 1 minute.
SLIDING_WINDOW, SLIDING_SLIDE = "5 minutes", "1 minute"


def _state_partitions(spark: SparkSession) -> int | None:
    """State partitions for the catalogue's streaming runs: the session's parallelism
    (a full-table replay), not the batch shuffle-partition setting."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no driver-side context: keep the session setting
        return None


def for_compare(df: DataFrame, ntz: tuple[str, ...] = (), joined: tuple[str, ...] = ()) -> DataFrame:
    """Timestamps -> TIMESTAMP_NTZ (UTC wall time), string arrays -> comma-joined text."""
    changes = {c: F.col(c).cast("timestamp_ntz") for c in ntz}
    changes.update({c: F.array_join(c, ",") for c in joined})
    return df.withColumns(changes)


WINDOW_TS = ("window_start", "window_end")
TXN_TS = ("arrival_time", "event_timestamp")


def _txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return load_transactions(spark, sf_dir)


def _records(spark: SparkSession, sf_dir: str, window: str = DAY) -> DataFrame:
    return anomaly_records(aggregate(_txns(spark, sf_dir), ANOMALY, window), ANOMALY, as_of="window_end")


def _fraud_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_aggregates(aggregate(_txns(spark, sf_dir), FRAUD, DAY), FRAUD, as_of="window_end")


# The cold table is written once per session and state of the events files, and reused by the analytics queries.
_COLD_TABLES: dict[tuple, str] = {}


def _files_state(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of each file under a path (metadata listing only)."""
    p, fs = hadoop_path(spark, path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def cold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.conf.get("spark.app.id", ""), _files_state(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    path = _COLD_TABLES.get(key)
    if path is not None:
        try:
            pin_utc(spark)
            return read_cold(spark, path)
        except AnalysisException:  # scratch folder removed since: write it again
            pass
    path = scratch_path(spark, "cold")
    write_cold(_txns(spark, sf_dir), path, mode="overwrite")
    _COLD_TABLES[key] = path
    return read_cold(spark, path)


# ------------------------------------------------------------------- windows & records
def q_anomaly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(aggregate(_txns(spark, sf_dir), ANOMALY, DAY), WINDOW_TS)


def q_anomaly_windows_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(aggregate(_txns(spark, sf_dir), ANOMALY, MINUTE), WINDOW_TS)


def q_anomaly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(_records(spark, sf_dir), joined=("anomaly_flags",))


def q_anomaly_records_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(_records(spark, sf_dir, MINUTE), joined=("anomaly_flags",))


def q_fraud_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = aggregate(_txns(spark, sf_dir), FRAUD, DAY)
    return for_compare(w.withColumn("total_amount", F.round("total_amount", 2)), WINDOW_TS)


def q_fraud_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(_fraud_aggregates(spark, sf_dir), joined=("fraud_flags",))


def q_fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(fraud_alerts(_fraud_aggregates(spark, sf_dir)), joined=("fraud_flags",))


def q_fraud_alerts_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "fraud")
    table = fraud_table(root)
    table.write_batch(_fraud_aggregates(spark, sf_dir), 0)
    table = table.compact(spark, "fraud_base_" + root.rsplit("-", 1)[1], f"{root}/base", COMPACTED_AS_OF)
    return for_compare(live_alerts(spark, table, LIVE_AS_OF), joined=("fraud_flags",))


def q_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = aggregate(_txns(spark, sf_dir), ANOMALY, SLIDING_WINDOW, slide=SLIDING_SLIDE)
    return for_compare(
        w.selectExpr(
            "window_start",
            "window_end",
            "user_id",
            "transaction_count",
            "max_amount",
            f"{flag_list_sql(ANOMALY)} AS anomaly_flags",
            "is_anomaly",
        ),
        WINDOW_TS,
        ("anomaly_flags",),
    )


def q_fraud_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = aggregate(_txns(spark, sf_dir), FRAUD, SLIDING_WINDOW, slide=SLIDING_SLIDE)
    return for_compare(w, WINDOW_TS)


# ------------------------------------------------------------------------- cold table
def q_cold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(cold_table(spark, sf_dir), TXN_TS)


def q_cold_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.partition_counts(cold_table(spark, sf_dir))


def q_high_value_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cold = cold_table(spark, sf_dir)
    return for_compare(analytics.high_value_txns(cold, year=REPORT_YEAR, month=REPORT_MONTH), ("event_timestamp",))


def q_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_users(cold_table(spark, sf_dir), year=REPORT_YEAR, month=REPORT_MONTH)


def q_hourly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    cold = cold_table(spark, sf_dir)
    return for_compare(analytics.hourly_volume(cold, year=REPORT_YEAR, month=REPORT_MONTH), ("hour_bucket",))


def q_top_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_merchants(cold_table(spark, sf_dir), year=REPORT_YEAR)


def q_txn_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stream_stats(_txns(spark, sf_dir))


def q_cold_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cold table by its catalog name; its last day is added after the table was registered."""
    root = scratch_path(spark, "catalog")
    txns = _txns(spark, sf_dir)
    day = F.to_date("event_timestamp")
    last = txns.agg(F.max(day).alias("d")).first()["d"]
    write_cold(txns.where(day.isNull() | (day < F.lit(last))), f"{root}/lake")
    database = "txns_" + root.rsplit("-", 1)[1]
    table = register_table(spark, f"{root}/lake", database=database, database_location=f"{root}/database")
    write_cold(txns.where(day == F.lit(last)), f"{root}/lake")
    return for_compare(read_catalog(spark, table), TXN_TS)


# ---------------------------------------------------------------------------- serving
def q_serving_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(
        serving.serving_feed(_records(spark, sf_dir)), ("detected_at", *WINDOW_TS), ("anomaly_flags",)
    )


# Read time of the stored feed, when no record has expired.
FEED_AS_OF = "2024-01-31 00:00:00"


def q_serving_feed_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of the stored hot table: a replay re-emits its windows, half of its batches are compacted."""
    path, steps = _dealt(spark, sf_dir, ONE_STEP_LATE_SQL)
    root, held, later = scratch_path(spark, "feed-hot"), scratch_path(spark, "held"), steps[len(steps) // 2 :]
    table = anomaly_table(root)

    def run() -> None:
        start_hot(
            replay_stream(spark, path), table, ANOMALY, window=DAY, as_of="window_end", available_now=True,
            state_partitions=_state_partitions(spark),
        ).awaitTermination()

    hold_back(spark, path, held, later)
    run()
    compacted = table.compact(spark, "anomalies_base_" + root.rsplit("-", 1)[1], f"{root}/base", FEED_AS_OF)
    release(spark, held, path, later)
    run()
    feed = serving.serving_feed(compacted.live(spark, FEED_AS_OF))
    return for_compare(feed, ("detected_at", *WINDOW_TS), ("anomaly_flags",))


def q_kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(serving.kpi_summary(_records(spark, sf_dir)), ("latest_detected_at",))


def q_flag_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.flag_breakdown(serving.newest(_records(spark, sf_dir)))


def q_flag_breakdown_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.flag_breakdown(_records(spark, sf_dir))


def q_amount_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.amount_by_window(_records(spark, sf_dir))


def q_live_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = anomaly_table(scratch_path(spark, "anomalies"))
    table.write_batch(_records(spark, sf_dir), 0)
    return for_compare(table.live(spark, LIVE_AS_OF), joined=("anomaly_flags",))


# ----------------------------------------------------------------------------- ingest
def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded events as a stream envelope; arrival time is the event time."""
    enc = encode_payload(_txns(spark, sf_dir), keep=("arrival_time",))
    return enc.selectExpr("CAST(value AS BINARY) AS data", "arrival_time")


def q_encode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = encode_payload(_txns(spark, sf_dir))
    parsed = enc.selectExpr("key", f"from_json(value, '{PAYLOAD.simpleString()}') AS p")
    return parsed.selectExpr("key", *[f"p.{f} AS {f}" for f in PAYLOAD_FIELDS])


def q_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(decode_payload(_envelope(spark, sf_dir)), TXN_TS)


# Some records are damaged, by their number: cut off, without fields, with an amount that does not fit.
DAMAGED_SQL = """CASE CAST(transaction_id AS BIGINT) % 17
  WHEN 3 THEN left(value, 20)
  WHEN 5 THEN concat('{"transaction_id":"', transaction_id, '"}')
  WHEN 7 THEN concat('{"transaction_id":"', transaction_id, '","user_id":"u","amount":1e20,"timestamp":"2024-01-01T00:00:00Z"}')
  ELSE value END"""


def _damaged_envelope(txns: DataFrame) -> DataFrame:
    encoded = encode_payload(txns, keep=("arrival_time", "transaction_id"))
    return encoded.selectExpr(f"CAST({DAMAGED_SQL} AS BINARY) AS data", "arrival_time")


# Malformed and edge-case payloads mixed into the encoded events for the quarantine check.
BAD_AND_EDGE_PAYLOADS = (
    '{"transaction_id":"a","user_id":"u1","amount":12.5,"merchant":"m","timestamp":"2026-05-28T12:00:00.123456+00:00"}',
    "not json",
    '{"transaction_id":"b","user_id":"u1","amount":"oops","merchant":"m","timestamp":"2026-05-28T12:00:00+00:00"}',
    '{"transaction_id":"c","amount":5,"timestamp":"garbage"}',
    None,
    '{"transaction_id":"d","user_id":"u1","amount":3,"timestamp":"2026-05-28T12:00:00Z","extra":1}',
    '{"transaction_id":"f","user_id":"u1","amount":"7.5","timestamp":"2026-05-28T12:00:00Z"}',
    "{}",
)
EDGE_ARRIVAL = "2026-05-28 12:00:05"


def _mixed_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = spark.createDataFrame(
        [(p,) for p in BAD_AND_EDGE_PAYLOADS], "raw string"
    ).select(
        F.col("raw").cast("binary").alias("data"),
        F.lit(EDGE_ARRIVAL).cast("timestamp").alias("arrival_time"),
    )
    return _damaged_envelope(_txns(spark, sf_dir)).unionByName(edge)


def q_valid_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(valid_payloads(classify_payloads(_mixed_envelope(spark, sf_dir))), TXN_TS)


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(quarantined_payloads(classify_payloads(_mixed_envelope(spark, sf_dir))), ("arrival_time",))


# -------------------------------------------------------------------------- streaming
def q_stream_cold_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    root = scratch_path(spark, "stream-cold")
    txns = events_as_transactions(read_events_stream(spark, sf_dir))
    q = start_cold(txns, f"{root}/table", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    return for_compare(read_cold(spark, f"{root}/table"), TXN_TS)


def q_stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    table = anomaly_table(scratch_path(spark, "stream-hot"))
    txns = events_as_transactions(read_events_stream(spark, sf_dir))
    q = start_hot(
        txns, table, ANOMALY, window=DAY, as_of="window_end", available_now=True,
        state_partitions=_state_partitions(spark),
    )
    q.awaitTermination()
    return for_compare(table.latest(spark), joined=("anomaly_flags",))


def q_stream_anomalies_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    root = scratch_path(spark, "stream-final")
    txns = events_as_transactions(read_events_stream(spark, sf_dir))
    q = start_final(
        txns, f"{root}/table", f"{root}/checkpoint", ANOMALY, window=DAY, as_of="window_end", available_now=True,
        state_partitions=_state_partitions(spark),
    )
    q.awaitTermination()
    return for_compare(spark.read.schema(ANOMALY_RECORD).parquet(f"{root}/table"), joined=("anomaly_flags",))


def q_stream_fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    table = fraud_table(scratch_path(spark, "stream-fraud"))
    txns = events_as_transactions(read_events_stream(spark, sf_dir))
    q = start_fraud_hot(
        txns, table, FRAUD, window=DAY, as_of="window_end", available_now=True,
        state_partitions=_state_partitions(spark),
    )
    q.awaitTermination()
    return for_compare(fraud_alerts(table.latest(spark)), joined=("fraud_flags",))


def q_stream_valid_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    root = scratch_path(spark, "stream-quarantine")
    events = events_as_transactions(read_events_stream(spark, sf_dir))
    q = start_quarantine(_damaged_envelope(events), f"{root}/table", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    valid, _ = read_routed(spark, f"{root}/table", ROUTED)
    return for_compare(valid, TXN_TS)


def q_stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that the cold path's batches report while they run."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-stats")
    txns = observe_transactions(events_as_transactions(read_events_stream(spark, sf_dir)))
    with _collected(spark) as collector:
        collector.wait(start_cold(txns, f"{root}/table", f"{root}/checkpoint", available_now=True))
        return collector.frame(spark)


@contextmanager
def _collected(spark: SparkSession) -> Iterator[ProgressCollector]:
    collector = attach_collector(spark)
    try:
        yield collector
    finally:
        spark.streams.removeListener(collector)


# Screening and replays. The damaged records of the screened runs are those of DAMAGED_SQL.
def _screened(spark: SparkSession, sf_dir: str) -> PipelineRoots:
    """The pipeline job's screened run over the damaged payloads."""
    pin_utc(spark)
    root = scratch_path(spark, "screened")
    roots = PipelineRoots(hot=f"{root}/hot", cold=f"{root}/lake", cold_checkpoint=f"{root}/lake-checkpoint")
    run_screened(
        spark, lambda s: _damaged_envelope(events_as_transactions(read_events_stream(s, sf_dir))), roots,
        ANOMALY.with_window(DAY), available_now=True, state_partitions=_state_partitions(spark), as_of="window_end",
    )
    return roots


def q_stream_anomalies_screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = _screened(spark, sf_dir)
    return for_compare(anomaly_table(roots.hot).latest(spark), joined=("anomaly_flags",))


def q_stream_screened_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(read_rejects(spark, _screened(spark, sf_dir).cold), ("arrival_time",))


# Out-of-order replays, by record number: some a step late, which windows still take, some two, behind the watermark.
ONE_STEP_LATE_SQL = "CASE WHEN CAST(transaction_id AS BIGINT) % 13 = 6 THEN 1 ELSE 0 END"
TWO_STEPS_LATE_SQL = "CASE CAST(transaction_id AS BIGINT) % 13 WHEN 6 THEN 1 WHEN 5 THEN 2 ELSE 0 END"


def _dealt(spark: SparkSession, sf_dir: str, delay_sql: str) -> tuple[str, list[int]]:
    path = scratch_path(spark, "replay")
    return path, deal_out(with_steps(_txns(spark, sf_dir), delay_sql), path)


def q_stream_anomalies_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _dealt(spark, sf_dir, ONE_STEP_LATE_SQL)
    table = anomaly_table(scratch_path(spark, "replayed-hot"))
    start_hot(
        replay_stream(spark, path), table, ANOMALY, window=DAY, as_of="window_end", available_now=True,
        state_partitions=_state_partitions(spark),
    ).awaitTermination()
    return for_compare(table.latest(spark), joined=("anomaly_flags",))


def _replayed_final(spark: SparkSession, sf_dir: str) -> str:
    path, _ = _dealt(spark, sf_dir, TWO_STEPS_LATE_SQL)
    root = scratch_path(spark, "replayed-final")
    start_final(
        replay_stream(spark, path), f"{root}/table", f"{root}/checkpoint", ANOMALY, window=DAY, as_of="window_end",
        available_now=True, state_partitions=_state_partitions(spark),
    ).awaitTermination()
    return root


def q_stream_final_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _replayed_final(spark, sf_dir)
    return for_compare(spark.read.schema(ANOMALY_RECORD).parquet(f"{root}/table"), joined=("anomaly_flags",))


def q_stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(open_windows(spark, f"{_replayed_final(spark, sf_dir)}/checkpoint", ANOMALY), WINDOW_TS)


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _dealt(spark, sf_dir, TWO_STEPS_LATE_SQL)
    root = scratch_path(spark, "late")
    start_late_rows(replay_stream(spark, path), root, ANOMALY, window=DAY, available_now=True).awaitTermination()
    return for_compare(read_late(spark, root), (*TXN_TS, *WINDOW_TS, "watermark"))


def q_stream_batch_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _dealt(spark, sf_dir, TWO_STEPS_LATE_SQL)
    table = anomaly_table(scratch_path(spark, "flags-hot"))
    with _collected(spark) as collector:
        collector.wait(
            start_hot(
                replay_stream(spark, path), table, ANOMALY, window=DAY, as_of="window_end", available_now=True,
                query_name="batch_flags_" + table.root.rsplit("-", 1)[1], state_partitions=_state_partitions(spark),
            )
        )
        return collector.batches_frame(spark, f"{ANOMALY.name}_windows").drop("query")


def _resumed(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Two starts on one checkpoint: the second finds the later half of the files as well."""
    path, steps = _dealt(spark, sf_dir, ONE_STEP_LATE_SQL)
    held, later = scratch_path(spark, "held"), steps[len(steps) // 2 :]
    hold_back(spark, path, held, later)
    start(replay_stream(spark, path)).awaitTermination()
    release(spark, held, path, later)
    start(replay_stream(spark, path)).awaitTermination()


def q_stream_cold_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "resumed-cold")
    _resumed(spark, sf_dir, lambda txns: start_cold(txns, f"{root}/table", f"{root}/checkpoint", available_now=True))
    return for_compare(read_cold(spark, f"{root}/table"), TXN_TS)


def q_stream_anomalies_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = anomaly_table(scratch_path(spark, "resumed-hot"))
    _resumed(
        spark,
        sf_dir,
        lambda txns: start_hot(
            txns, table, ANOMALY, window=DAY, as_of="window_end", available_now=True, state_partitions=_state_partitions(spark)
        ),
    )
    return for_compare(table.latest(spark), joined=("anomaly_flags",))


def q_stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    root = scratch_path(spark, "stream-sliding")
    deal_in_order(_txns(spark, sf_dir), f"{root}/replay")
    start_sliding(
        replay_stream(spark, f"{root}/replay"), f"{root}/table", f"{root}/checkpoint", ANOMALY, SLIDING_WINDOW, SLIDING_SLIDE, available_now=True,
        state_partitions=_state_partitions(spark),
    ).awaitTermination()
    w = spark.read.parquet(f"{root}/table")
    columns = ("window_start", "window_end", "user_id", "transaction_count", "max_amount")
    return for_compare(w.selectExpr(*columns, f"{flag_list_sql(ANOMALY)} AS anomaly_flags", "is_anomaly"), WINDOW_TS, ("anomaly_flags",))


QUERIES: dict[str, Query] = {
    "anomaly_windows": q_anomaly_windows,
    "anomaly_windows_1min": q_anomaly_windows_1min,
    "anomaly_records": q_anomaly_records,
    "anomaly_records_1min": q_anomaly_records_1min,
    "fraud_windows": q_fraud_windows,
    "fraud_aggregates": q_fraud_aggregates,
    "fraud_alerts": q_fraud_alerts,
    "fraud_alerts_live": q_fraud_alerts_live,
    "sliding_windows": q_sliding_windows,
    "cold_roundtrip": q_cold_roundtrip,
    "cold_partition_counts": q_cold_partition_counts,
    "high_value_txns": q_high_value_txns,
    "top_users": q_top_users,
    "hourly_volume": q_hourly_volume,
    "top_merchants": q_top_merchants,
    "txn_stats": q_txn_stats,
    "fraud_sliding_windows": q_fraud_sliding_windows,
    "cold_catalog_scan": q_cold_catalog_scan,
    "stream_stats": q_stream_stats,
    "serving_feed": q_serving_feed,
    "serving_feed_stored": q_serving_feed_stored,
    "kpi_summary": q_kpi_summary,
    "flag_breakdown": q_flag_breakdown,
    "flag_breakdown_all": q_flag_breakdown_all,
    "amount_by_window": q_amount_by_window,
    "live_anomalies": q_live_anomalies,
    "encode_payload": q_encode_payload,
    "decode_payload": q_decode_payload,
    "valid_txns": q_valid_txns,
    "quarantine": q_quarantine,
    "stream_cold_path": q_stream_cold_path,
    "stream_anomalies": q_stream_anomalies,
    "stream_anomalies_final": q_stream_anomalies_final,
    "stream_fraud_alerts": q_stream_fraud_alerts,
    "stream_valid_txns": q_stream_valid_txns,
    "stream_anomalies_screened": q_stream_anomalies_screened,
    "stream_screened_rejects": q_stream_screened_rejects,
    "stream_anomalies_replayed": q_stream_anomalies_replayed,
    "stream_final_replayed": q_stream_final_replayed,
    "stream_late_rows": q_stream_late_rows,
    "stream_open_windows": q_stream_open_windows,
    "stream_batch_flags": q_stream_batch_flags,
    "stream_cold_resumed": q_stream_cold_resumed,
    "stream_anomalies_resumed": q_stream_anomalies_resumed,
    "stream_sliding": q_stream_sliding,
}
