"""JSON payloads: decode (envelope -> transactions), encode, and quarantine of bad records.

Any source is first adapted to the envelope ``(data BINARY, arrival_time TIMESTAMP)``;
e.g. Kafka's ``value``/``timestamp`` columns. Parsing is PERMISSIVE: a non-JSON payload
becomes a row of NULLs, a field of the wrong type becomes NULL, extra keys are ignored,
and an unparsable time becomes a NULL event time (``try_to_timestamp``; plain
``to_timestamp`` would fail the whole query under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.functions.values import iso_utc_sql
from txnscope.schemas import (
    CORRUPT_COLUMN,
    PAYLOAD,
    PAYLOAD_FIELDS,
    PAYLOAD_WITH_CORRUPT,
    REQUIRED_FIELDS,
)

DECODED_COLUMNS = (
    "transaction_id", "user_id", "amount", "merchant", "merchant_category", "arrival_time", "event_timestamp",
)

# Quarantine reasons, checked in this order.
EMPTY_PAYLOAD = "EMPTY_PAYLOAD"
MALFORMED_JSON = "MALFORMED_JSON"
BAD_FIELD_TYPE = "BAD_FIELD_TYPE"
MISSING_FIELD = "MISSING_FIELD"
BAD_AMOUNT = "BAD_AMOUNT"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
QUALITY_METRICS = "payload_quality"
DECODE_METRICS = "decoded_payloads"
STATUS_VALID = "valid"
STATUS_REJECTED = "rejected"


def to_envelope(df: DataFrame, data: str = "value", arrival_time: str | None = "timestamp") -> DataFrame:
    """Adapt a source frame (Kafka: ``value``/``timestamp``) to the envelope contract.

    Sources without an arrival time (plain text files) get the batch's processing time.
    """
    arrival = F.col(arrival_time).cast("timestamp") if arrival_time else F.current_timestamp()
    return df.select(F.col(data).cast("binary").alias("data"), arrival.alias("arrival_time"))


# Schema of a routed folder (classified rows + status partition).
ROUTED = T.StructType(
    [
        T.StructField("raw", T.StringType(), True),
        *[T.StructField(f.name, f.dataType, True) for f in PAYLOAD.fields if f.name != "timestamp"],
        T.StructField("arrival_time", T.TimestampType(), True),
        T.StructField("event_timestamp", T.TimestampType(), True),
        T.StructField("reject_reason", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)
_PAYLOAD_DDL = PAYLOAD.simpleString()
_PAYLOAD_CORRUPT_DDL = PAYLOAD_WITH_CORRUPT.simpleString()
_TEXT = "CAST(data AS STRING)"
# A number that DECIMAL(18,2) can hold; false for NaN, which is larger than all numbers.
_AMOUNT_FITS = "abs(txn.amount) < 1e16D"


def decode_payload(envelope: DataFrame, metrics_name: str = DECODE_METRICS) -> DataFrame:
    """Envelope -> parsed transactions (keeps malformed rows as NULLs, like the source job).

    Amounts that are no number or too large for the records' money type become NULL as well.

    The observation counts payloads and those without a usable event time per batch (the
    windowed aggregation ignores the latter). It is also a plan boundary: windowing adds an
    ``event_timestamp IS NOT NULL`` filter that Catalyst would otherwise push below this
    projection with ``from_json`` inlined, parsing every record twice. Give each decode a
    distinct ``metrics_name`` when two are combined in one query.
    """
    parsed = envelope.selectExpr(f"from_json({_TEXT}, '{_PAYLOAD_DDL}') AS txn", "arrival_time")
    decoded = parsed.selectExpr(
        *[f"txn.{f} AS {f}" for f in ("transaction_id", "user_id", "merchant", "merchant_category")],
        f"CASE WHEN {_AMOUNT_FITS} THEN txn.amount END AS amount",
        "arrival_time",
        "try_to_timestamp(txn.timestamp) AS event_timestamp",
    )
    return decoded.observe(
        metrics_name,
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(F.col("event_timestamp").isNull()).alias("no_event_time"),
    )


def with_category(df: DataFrame) -> DataFrame:
    """Add a NULL ``merchant_category`` when the payload has none (fraud profile input)."""
    if "merchant_category" in df.columns:
        return df
    return df.withColumn("merchant_category", F.lit(None).cast("string"))


def encode_payload(txns: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transactions -> ``(key, value)``: per-user key and the JSON record, plus ``keep``.

    ``to_json`` omits NULL fields; the time is ISO-8601 with offset. Writing to a keyed
    log with ``key`` keeps each user's records on one partition of the log.
    """
    txns = with_category(txns)
    record = (
        "named_struct('transaction_id', transaction_id, 'user_id', user_id, 'amount', amount, "
        f"'merchant', merchant, 'timestamp', {iso_utc_sql('event_timestamp')}, "
        "'merchant_category', merchant_category)"
    )
    return txns.selectExpr("user_id AS key", f"to_json({record}) AS value", *keep)


def classify_payloads(envelope: DataFrame, metrics_name: str = QUALITY_METRICS) -> DataFrame:
    """Parse every payload and attach ``reject_reason`` (NULL for valid rows).

    Reasons, first match wins: empty payload; not JSON at all; a field of the wrong type
    (Spark records the text in the corrupt-record column); required fields missing or
    null (listed); an amount that is no number or does not fit; an unparsable event time.
    """
    parsed = envelope.selectExpr(
        f"{_TEXT} AS raw",
        "arrival_time",
        f"from_json({_TEXT}, '{_PAYLOAD_CORRUPT_DDL}', "
        f"map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '{CORRUPT_COLUMN}')) AS txn",
    )
    missing = "concat_ws(',', " + ", ".join(
        f"CASE WHEN txn.{f} IS NULL THEN '{f}' END" for f in REQUIRED_FIELDS
    ) + ")"
    corrupt = f"txn.{CORRUPT_COLUMN} IS NOT NULL"
    reason = (
        f"CASE WHEN raw IS NULL OR trim(raw) = '' THEN '{EMPTY_PAYLOAD}' "
        # get_json_object on the root is NULL exactly when the text is not JSON
        f"WHEN {corrupt} AND get_json_object(raw, '$') IS NULL THEN '{MALFORMED_JSON}' "
        f"WHEN {corrupt} THEN '{BAD_FIELD_TYPE}' "
        f"WHEN {missing} != '' THEN concat('{MISSING_FIELD}:', {missing}) "
        f"WHEN NOT ({_AMOUNT_FITS}) THEN '{BAD_AMOUNT}' "
        f"WHEN try_to_timestamp(txn.timestamp) IS NULL THEN '{BAD_TIMESTAMP}' END"
    )
    classified = parsed.selectExpr(
        "raw",
        *[f"txn.{f} AS {f}" for f in PAYLOAD_FIELDS if f != "timestamp"],
        "arrival_time",
        "try_to_timestamp(txn.timestamp) AS event_timestamp",
        f"{reason} AS reject_reason",
    )
    # The observation reports how many rows were seen and rejected per batch, and it is
    # also a plan boundary: without it Catalyst pushes a later ``reject_reason`` filter
    # below this projection and inlines the parse into every reference (about ten JSON
    # parses per row instead of one).
    return classified.observe(
        metrics_name,
        F.count(F.lit(1)).alias("payloads"),
        F.count("reject_reason").alias("rejected"),
    )


def valid_payloads(classified: DataFrame) -> DataFrame:
    """Rows that passed every check, as parsed transactions."""
    return classified.where("reject_reason IS NULL").select(*DECODED_COLUMNS)


def quarantined_payloads(classified: DataFrame) -> DataFrame:
    """Rejected rows: raw text, arrival time and the reason."""
    return classified.where("reject_reason IS NOT NULL").select("raw", "arrival_time", "reject_reason")


def split_payloads(envelope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) as two lazy frames; each parses the input once when run.

    On streams, write both from one ``foreachBatch`` (or use :func:`route_payloads` per
    batch) so the source is read once.
    """
    return valid_payloads(classify_payloads(envelope)), quarantined_payloads(classify_payloads(envelope))


def route_payloads(envelope: DataFrame, path: str, mode: str = "overwrite") -> tuple[DataFrame, DataFrame]:
    """Parse once, write every row once under ``path/status=valid|rejected``, and return
    the two sides as partition-pruned reads of that table.

    For large batch loads that need both outputs: one parse and one write instead of two
    parses, and the written table cuts the lineage (a lost executor re-reads files rather
    than re-parsing the input).
    """
    classified = classify_payloads(envelope).withColumn(
        "status",
        F.when(F.col("reject_reason").isNull(), F.lit(STATUS_VALID)).otherwise(F.lit(STATUS_REJECTED)),
    )
    classified.write.mode(mode).partitionBy("status").parquet(path)
    return read_routed(envelope.sparkSession, path, ROUTED)


def read_routed(spark, path: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) from a folder written by ``route_payloads`` or
    ``streaming.paths.start_quarantine``; each side reads only its partition."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    table = reader.parquet(path)
    return (
        valid_payloads(table.where(F.col("status") == STATUS_VALID)),
        quarantined_payloads(table.where(F.col("status") == STATUS_REJECTED)),
    )
