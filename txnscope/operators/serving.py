"""Serving views over the anomaly records table (the data behind a live dashboard).

Input is any frame of anomaly records; stored column types may be loose (text numbers,
text times), so values are coerced leniently: anything unparsable becomes NULL and is
sorted last or left out, never an error. Only columns that exist are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.functions.values import lenient_number, lenient_timestamp

FEED_LIMIT = 50
CHART_LIMIT = 20
FEED_COLUMNS = (
    "detected_at",
    "user_id",
    "window_start",
    "window_end",
    "transaction_count",
    "max_amount",
    "anomaly_flags",
)
_TIME_COLUMNS = ("window_start", "window_end", "detected_at")


def coerce_records(records: DataFrame) -> DataFrame:
    """Counts and amounts to numbers, ISO texts to UTC timestamps (bad -> NULL)."""
    present = set(records.columns)
    changes = {}
    if "transaction_count" in present:
        changes["transaction_count"] = lenient_number("transaction_count", "bigint")
    if "max_amount" in present:
        changes["max_amount"] = lenient_number("max_amount", "double")
    for c in _TIME_COLUMNS:
        if c in present:
            changes[c] = lenient_timestamp(c)
    return records.withColumns(changes) if changes else records


def _order(df: DataFrame) -> list:
    keys = []
    if "detected_at" in df.columns:
        keys.append(F.col("detected_at").desc_nulls_last())
    if "transaction_id" in df.columns:
        keys.append(F.col("transaction_id").asc_nulls_last())
    return keys


def newest(records: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    """Flagged records, coerced, newest ``limit`` by detection time (top-k, no full sort)."""
    live = records.filter(F.col("is_anomaly")) if "is_anomaly" in records.columns else records
    coerced = coerce_records(live)
    keys = _order(coerced)
    return (coerced.orderBy(*keys) if keys else coerced).limit(limit)


def serving_feed(records: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    """The live feed: newest flagged windows, display columns that exist."""
    top = newest(records, limit)
    return top.select(*[c for c in FEED_COLUMNS if c in top.columns])


def kpi_summary(records: DataFrame, limit: int = FEED_LIMIT) -> DataFrame:
    """One row: ``shown`` (feed size, capped), ``total`` flagged, latest detection (and its
    ``HH:mm:ss UTC`` label), and the most flagged user among the shown rows (ties ->
    smallest user id).

    ``total`` is a scalar subquery: a separate small aggregation, no join.
    """
    top = newest(records, limit)
    live = records.filter(F.col("is_anomaly")) if "is_anomaly" in records.columns else records
    total = live.agg(F.count(F.lit(1))).scalar()
    stats = top.agg(
        F.count(F.lit(1)).alias("shown"),
        F.max("detected_at").alias("latest_detected_at"),
        F.mode("user_id", deterministic=True).alias("most_flagged_user"),
    )
    return stats.select(
        "shown",
        total.alias("total"),
        "latest_detected_at",
        F.concat(F.date_format("latest_detected_at", "HH:mm:ss"), F.lit(" UTC")).alias("latest_label"),
        "most_flagged_user",
    )


def _flags_as_array(df: DataFrame, column: str):
    dtype = df.schema[column].dataType
    return F.col(column) if isinstance(dtype, T.ArrayType) else F.array(F.col(column))


def flag_breakdown(frame: DataFrame, column: str = "anomaly_flags") -> DataFrame:
    """Count of each fired rule; a scalar flag value counts as a one-element list."""
    return (
        frame.filter(F.col(column).isNotNull())
        .select(F.explode(_flags_as_array(frame, column)).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def amount_by_window(records: DataFrame, limit: int = FEED_LIMIT, chart_limit: int = CHART_LIMIT) -> DataFrame:
    """Chart data: first ``chart_limit`` feed rows that have an amount, labelled ``HH:mm``."""
    top = newest(records, limit).filter(F.col("max_amount").isNotNull())
    keys = _order(top)
    return (top.orderBy(*keys) if keys else top).limit(chart_limit).select(
        F.date_format("window_start", "HH:mm").alias("window_start_label"),
        "user_id",
        "max_amount",
    )
