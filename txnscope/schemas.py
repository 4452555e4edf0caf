"""Explicit schemas (never inferred) for envelopes, payloads and tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw stream envelope: any source is adapted to (data BINARY, arrival_time TIMESTAMP).
ENVELOPE = T.StructType(
    [
        T.StructField("data", T.BinaryType(), True),
        T.StructField("arrival_time", T.TimestampType(), True),
    ]
)

# JSON payload of one transaction. ``from_json`` makes every field nullable whatever the
# declaration says; required-ness is checked by the quarantine operator instead.
PAYLOAD_FIELDS = ("transaction_id", "user_id", "amount", "merchant", "timestamp", "merchant_category")
REQUIRED_FIELDS = ("transaction_id", "user_id", "amount", "timestamp")
PAYLOAD = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("merchant", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
    ]
)
CORRUPT_COLUMN = "_corrupt_record"
PAYLOAD_WITH_CORRUPT = T.StructType(
    PAYLOAD.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Parsed transaction, the core relation. merchant_category is nullable and only used by
# the fraud profile's distinct-category metric.
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("merchant", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("arrival_time", T.TimestampType(), True),
        T.StructField("event_timestamp", T.TimestampType(), True),
    ]
)
TRANSACTION_COLUMNS = tuple(f.name for f in TRANSACTION.fields)
PARTITION_COLUMNS = ("year", "month", "day")

# Driver-generated events table.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)

# Hot-table record of rule set A (one row per flagged window, keyed by transaction_id).
ANOMALY_RECORD_COLUMNS = (
    "transaction_id",
    "user_id",
    "window_start",
    "window_end",
    "transaction_count",
    "max_amount",
    "anomaly_flags",
    "is_anomaly",
    "detected_at",
    "ttl",
)
FRAUD_AGGREGATE_COLUMNS = (
    "pk",
    "sk",
    "user_id",
    "window_start",
    "window_end",
    "transaction_count",
    "total_amount",
    "max_amount",
    "min_amount",
    "distinct_categories",
    "is_fraud",
    "fraud_flags",
    "processed_at",
    "ttl",
)
FRAUD_ALERT_COLUMNS = (
    "alert_id",
    "user_id",
    "window_start",
    "window_end",
    "transaction_count",
    "total_amount",
    "max_amount",
    "fraud_flags",
    "severity",
    "status",
    "created_at",
    "ttl",
)

_MONEY = T.DecimalType(18, 2)
_FLAGS = T.ArrayType(T.StringType(), True)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ANOMALY_RECORD = _struct(
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("window_start", T.StringType()),
    ("window_end", T.StringType()),
    ("transaction_count", T.LongType()),
    ("max_amount", _MONEY),
    ("anomaly_flags", _FLAGS),
    ("is_anomaly", T.BooleanType()),
    ("detected_at", T.StringType()),
    ("ttl", T.LongType()),
)
FRAUD_AGGREGATE = _struct(
    ("pk", T.StringType()),
    ("sk", T.StringType()),
    ("user_id", T.StringType()),
    ("window_start", T.StringType()),
    ("window_end", T.StringType()),
    ("transaction_count", T.LongType()),
    ("total_amount", _MONEY),
    ("max_amount", _MONEY),
    ("min_amount", _MONEY),
    ("distinct_categories", T.LongType()),
    ("is_fraud", T.BooleanType()),
    ("fraud_flags", _FLAGS),
    ("processed_at", T.StringType()),
    ("ttl", T.LongType()),
)
