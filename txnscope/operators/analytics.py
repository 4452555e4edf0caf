"""Analytical queries over the cold table (any frame with the transaction columns).

Each query optionally restricts to one calendar month through the ``year``/``month``
partition columns, which Spark turns into partition pruning at the scan. Limits carry a
unique trailing sort key so ties resolve the same way everywhere; with a limit Spark
plans a top-k (``TakeOrderedAndProject``) instead of a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.config import ANOMALY
from txnscope.sinks.lake import in_month

HIGH_VALUE_LIMIT = 50
TOP_USERS_LIMIT = 10
TOP_MERCHANTS_LIMIT = 20


def _period(df: DataFrame, year: int | None, month: int | None) -> DataFrame:
    if year is None and month is None:
        return df
    if year is None:
        raise ValueError("a month needs its year")
    if month is None:
        return df.filter(F.col("year") == F.lit(year))
    return in_month(df, year, month)


def high_value_txns(
    txns: DataFrame,
    threshold: float = ANOMALY.rules[0].threshold,
    limit: int = HIGH_VALUE_LIMIT,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Largest payments above the threshold, newest month by default in callers."""
    return (
        _period(txns, year, month)
        .filter(F.col("amount") > F.lit(threshold))
        .select("transaction_id", "user_id", "amount", "merchant", "event_timestamp")
        .orderBy(F.col("amount").desc(), F.col("transaction_id").asc())
        .limit(limit)
    )


def top_users(
    txns: DataFrame, limit: int = TOP_USERS_LIMIT, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Most active users: count, total spend, largest single payment."""
    return (
        _period(txns, year, month)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.round(F.sum("amount"), 2).alias("total_spend"),
            F.max("amount").alias("max_single_txn"),
        )
        .orderBy(F.col("txn_count").desc(), F.col("user_id").asc())
        .limit(limit)
    )


def hourly_volume(txns: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Transactions and amount per hour of event time, in time order."""
    return (
        _period(txns, year, month)
        .groupBy(F.date_trunc("hour", F.col("event_timestamp")).alias("hour_bucket"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
        )
        .orderBy("hour_bucket")
    )


def top_merchants(
    txns: DataFrame, limit: int = TOP_MERCHANTS_LIMIT, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Merchants by volume: count, rounded average, largest payment."""
    return (
        _period(txns, year, month)
        .groupBy("merchant")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            F.round(F.avg("amount"), 2).alias("avg_amount"),
            F.max("amount").alias("max_amount"),
        )
        .orderBy(F.col("txn_count").desc(), F.col("merchant").asc())
        .limit(limit)
    )


def partition_counts(cold: DataFrame) -> DataFrame:
    """Rows per date partition (reads no data columns, only partition values)."""
    return cold.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("txn_count"))


def stream_stats(txns: DataFrame, threshold: float = ANOMALY.rules[0].threshold) -> DataFrame:
    """Producer-style counters: total, above-threshold count and its percentage."""
    total = F.count(F.lit(1))
    high = F.count_if(F.col("amount") > F.lit(threshold))
    return txns.agg(
        total.alias("total_sent"),
        high.alias("total_anomalies"),
        F.round(F.lit(100.0) * high / F.nullif(total, F.lit(0)), 2).alias("pct_anomalies"),
    )
