"""Cold lake: every transaction in a date-partitioned Parquet table.

Layout ``<path>/year=Y/month=M/day=D/part-*.parquet`` (snappy). Rows without an event
time land in the ``__HIVE_DEFAULT_PARTITION__`` folders, as Spark does by default.

Writes never shuffle: each task writes one file per date it holds. A backfill of a day
that holds a third of all rows therefore spreads over all input tasks instead of being
funnelled into one writer; ``max_records_per_file`` bounds file size.
"""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.schemas import PARTITION_COLUMNS, TRANSACTION, TRANSACTION_COLUMNS
from txnscope.sources.payload import with_category

COLD_SCHEMA = T.StructType(
    TRANSACTION.fields + [T.StructField(c, T.IntegerType(), True) for c in PARTITION_COLUMNS]
)


def with_partition_columns(df: DataFrame, time_column: str = "event_timestamp") -> DataFrame:
    """Add ``year``, ``month``, ``day`` of the event time (session time zone, UTC)."""
    ts = F.col(time_column)
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    )


def write_cold(
    df: DataFrame,
    path: str,
    mode: str = "append",
    max_records_per_file: int | None = None,
) -> None:
    """Batch write (backfill/compaction) of transactions into the cold table.

    ``mode="overwrite"`` replaces only the days present in ``df`` (dynamic partition
    overwrite), so re-running a backfill after a failure is idempotent and leaves other
    days alone. Write batch backfills to a batch-managed folder, not into a streaming
    sink's folder: readers of the latter only see files in its ``_spark_metadata`` log.
    """
    writer = (
        with_partition_columns(with_category(df).select(*TRANSACTION_COLUMNS))
        .write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)


def read_cold(spark: SparkSession, path: str) -> DataFrame:
    """Scan with the fixed schema; partition folders are discovered, typed INT.

    A folder written by the streaming sink carries a ``_spark_metadata`` log and only
    committed files are read.
    """
    return spark.read.schema(COLD_SCHEMA).parquet(path)


def read_catalog(spark: SparkSession, table: str) -> DataFrame:
    """The cold table by its catalog name (:func:`register_table`), after its partitions are found anew.

    Partition filters on the result are answered by the catalog, so only matching folders are listed.
    """
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table).select(*[f.name for f in COLD_SCHEMA.fields])


# Layout of a screened lake: valid transactions and rejects of one write, ``status`` above the date folders.
SCREENED_SCHEMA = T.StructType(
    [
        T.StructField("raw", T.StringType(), True),
        *TRANSACTION.fields,
        T.StructField("reject_reason", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        *[T.StructField(c, T.IntegerType(), True) for c in PARTITION_COLUMNS],
    ]
)


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    """Valid transactions of a screened lake, as :func:`read_cold` returns them; rejects' folders are not read."""
    table = spark.read.schema(SCREENED_SCHEMA).parquet(path)
    return table.where("status = 'valid'").select(*[f.name for f in COLD_SCHEMA.fields])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected payloads of a screened lake: raw text, arrival time and reason."""
    table = spark.read.schema(SCREENED_SCHEMA).parquet(path)
    return table.where("status = 'rejected'").select("raw", "arrival_time", "reject_reason")


def _as_date(value: date | datetime | str) -> Column:
    return F.to_date(F.lit(str(value)[:10]))


def cold_range(
    df: DataFrame,
    start: date | datetime | str,
    end: date | datetime | str,
    time_column: str = "event_timestamp",
) -> DataFrame:
    """Rows with ``start <= event time < end``, plus the matching partition predicate.

    The predicate over ``make_date(year, month, day)`` references only partition columns,
    so Spark prunes folders before listing files; the event-time filter keeps exact bounds.
    """
    part_date = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    pruned = df.filter((part_date >= _as_date(start)) & (part_date <= _as_date(end)))
    ts = F.col(time_column)
    return pruned.filter((ts >= F.lit(str(start)).cast("timestamp")) & (ts < F.lit(str(end)).cast("timestamp")))


def in_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Partition predicate for one calendar month (pruned at planning time)."""
    return df.filter((F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month)))


def register_table(
    spark: SparkSession,
    path: str,
    table: str = "transactions",
    database: str = "transaction_analytics",
    database_location: str | None = None,
) -> str:
    """Catalog table over the cold folder, then discover its partitions.

    Equivalent of an external-table DDL followed by a partition repair; re-run the repair
    whenever new date folders appear.
    """
    location = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{location}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COLD_SCHEMA.fields)
    name = f"{database}.{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) "
        f"LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def compact_days(
    spark: SparkSession,
    path: str,
    target: str,
    start: date | datetime | str,
    end: date | datetime | str,
    max_records_per_file: int | None = 5_000_000,
    screened: bool = False,
) -> None:
    """Rewrite closed days of a streaming cold table into fewer, larger files at ``target``.

    Streaming triggers leave many small files per day. The copy is range-partitioned on
    (date, event time) so a day with a third of all rows is split over many tasks by
    sampled boundaries rather than hashed into one. Only whole days are taken: a bound inside a
    day would replace that day's partition at ``target`` by a part of it. Rows without an event
    time belong to no day and stay where they are; of a ``screened`` lake valid rows are taken.
    """
    for bound in (start, end):
        if datetime.fromisoformat(str(bound)).time() != time.min:
            raise ValueError(f"compaction takes whole days, not {bound}")
    rows = cold_range(read_valid(spark, path) if screened else read_cold(spark, path), start, end)
    # Range partitions sized by AQE (advisory partition size), not a fixed count.
    laid_out = rows.repartitionByRange(*PARTITION_COLUMNS, "event_timestamp")
    write_cold(laid_out, target, mode="overwrite", max_records_per_file=max_records_per_file)
