"""Synthetic producer distribution; deterministic under any partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnscope.sources.synth import MERCHANTS, synth_transactions


def test_distribution_and_determinism(spark):
    driver = spark.range(0, 40_000).select(F.col("id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("t"))
    df = synth_transactions(driver, "id", "t")
    stats = df.agg(
        F.avg(F.col("is_anomaly").cast("int")).alias("rate"),
        F.min(F.when(F.col("is_anomaly"), F.col("amount"))).alias("min_spike"),
        F.max(F.when(F.col("is_anomaly"), F.col("amount"))).alias("max_spike"),
        F.percentile_approx(F.when(~F.col("is_anomaly"), F.col("amount")), 0.5).alias("median"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("merchant").alias("merchants"),
        F.count_distinct("transaction_id").alias("ids"),
    ).first()
    assert 0.04 < stats.rate < 0.06
    assert stats.min_spike >= 2001.0 and stats.max_spike <= 10000.0
    assert 28 < stats.median < 38  # lognormal(3.5, 1): median e^3.5 = 33.1
    assert stats.users == 50 and stats.merchants == len(MERCHANTS) and stats.ids == 40_000
    again = synth_transactions(driver.repartition(7), "id", "t")
    assert sorted(df.collect()) == sorted(again.collect())
    first = df.where("transaction_id IS NOT NULL").first()
    assert first.timestamp == "2024-01-01T00:00:00+00:00" and len(first.transaction_id) == 36
