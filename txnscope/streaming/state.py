"""The state of a windowed aggregation, read as a table from its checkpoint.

Shows what is still open: windows that the watermark has not passed, with the metrics gathered so far. The query may
be running or stopped; the table is that of the last committed batch (or of ``batch_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.config import COUNT, MAX_AMOUNT, MIN_AMOUNT, TOTAL_AMOUNT, RuleProfile
from txnscope.functions.rules import rule_columns_sql

# Metric -> its value in the aggregation's state. Approximate distinct counts are kept as registers only.
STATE_SQL = {
    COUNT: "value.count",
    MAX_AMOUNT: "value.max",
    MIN_AMOUNT: "value.min",
    TOTAL_AMOUNT: "CAST(CASE WHEN NOT value.isEmpty THEN value.sum END AS DOUBLE)",
}


def open_windows(
    spark: SparkSession, checkpoint: str, profile: RuleProfile, batch_id: int | None = None, operator_id: int = 0
) -> DataFrame:
    """window_start, window_end, user_id, the profile's metrics (but for distinct counts) and its rules' outcome so far."""
    reader = spark.read.format("statestore").option("operatorId", str(operator_id))
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    metrics = [f"{STATE_SQL[m]} AS {m}" for m in profile.metrics if m in STATE_SQL]
    rows = reader.load(checkpoint).selectExpr(
        "key.window.start AS window_start", "key.window.end AS window_end", "key.user_id AS user_id", *metrics
    )
    return rows.selectExpr("*", *rule_columns_sql(profile))


def state_size(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Windows in each state partition: a partition far above the others holds a hot key."""
    rows = spark.read.format("statestore").option("operatorId", str(operator_id)).load(checkpoint)
    return rows.groupBy("partition_id").agg(F.count(F.lit(1)).alias("windows"))
