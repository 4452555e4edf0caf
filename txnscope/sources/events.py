"""Adapter: the driver's ``events`` table seen as parsed transactions.

Mapping (fixed so that the DuckDB oracle can reproduce it exactly):

* ``transaction_id``    = event_id as text
* ``user_id``           = ``user_%03d`` of the numeric user
* ``amount``            = round(value * 10, 2)   (so the $2,000/$1,000/$3,000 rules fire)
* ``merchant``          = ``m_`` + (props.k mod 15)
* ``merchant_category`` = event_type
* ``event_timestamp`` / ``arrival_time`` = ts as TIMESTAMP (LTZ; watermarks reject NTZ)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscope.schemas import EVENTS

MERCHANT_MODULUS = 15

ADAPTER_SQL = (
    "CAST(event_id AS STRING) AS transaction_id",
    # ``user_%03d``; lpad is ~5x cheaper per row than format_string and gives the same
    # text for non-negative ids (never truncates: the pad width grows with the number).
    "CASE WHEN user_id >= 0 THEN concat('user_', lpad(CAST(user_id AS STRING), "
    "greatest(3, length(CAST(user_id AS STRING))), '0')) "
    "WHEN user_id < 0 THEN format_string('user_%03d', user_id) END AS user_id",
    "round(value * 10, 2) AS amount",
    f"concat('m_', CAST(try_cast(get_json_object(props, '$.k') AS INT) % {MERCHANT_MODULUS} AS STRING)) AS merchant",
    "event_type AS merchant_category",
    "CAST(ts AS TIMESTAMP) AS arrival_time",
    "CAST(ts AS TIMESTAMP) AS event_timestamp",
)


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(events_path(sf_dir))


def read_events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream (only the ``events.parquet`` file of the folder)."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(sf_dir)


def events_as_transactions(events: DataFrame) -> DataFrame:
    """events -> parsed transactions (works on batch and streaming frames)."""
    return events.selectExpr(*ADAPTER_SQL)


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(read_events(spark, sf_dir))
