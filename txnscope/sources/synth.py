"""Labelled synthetic transactions, one per row of a driving frame.

Distribution of the original point-of-sale producer: a share ``anomaly_rate`` of rows is
anomalous with amount ``uniform(T + 1, 5 T)``, the rest ``lognormal(mu=3.5, sigma=1)``;
users from a pool of 50, merchants from a list of 15, amounts to 2 decimals.

Randomness is a pure function of (seed, row id) through ``xxhash64``, not ``rand()``: a
recomputed partition (lost executor, speculative task) yields identical rows whatever the
partitioning, and there is no driver loop and no Python per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.config import ANOMALY
from txnscope.functions.values import iso_utc

# User pool size, merchant names, rates and distribution parameters of the
# original producer.
USER_POOL_SIZE = 50
MERCHANTS = (
    "Amazon", "Walmart", "Target", "Starbucks", "McDonald's",
    "Best Buy", "Costco", "Home Depot", "Uber", "Netflix",
    "Apple Store", "Nike", "Shell Gas", "Whole Foods", "CVS Pharmacy",
)
ANOMALY_RATE = 0.05
LOGNORMAL_MU = 3.5
LOGNORMAL_SIGMA = 1.0

_TWO_POW_53 = float(2**53)


def _uniform(row_id: Column, seed: int, stream: int) -> Column:
    """Uniform double in [0, 1) from 53 bits of a seeded hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(stream), row_id), 11)
    return bits.cast("double") / F.lit(_TWO_POW_53)


def _uuid_text(row_id: Column, seed: int) -> Column:
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")), 256)
    parts = [F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def synth_transactions(
    driver: DataFrame,
    row_id: str,
    event_time: str,
    seed: int = 42,
    anomaly_rate: float = ANOMALY_RATE,
    threshold: float = ANOMALY.rules[0].threshold,
    n_users: int = USER_POOL_SIZE,
) -> DataFrame:
    """Payload-shaped rows (D2 fields) plus the ground-truth ``is_anomaly`` label."""
    rid = F.col(row_id)
    is_anomaly = _uniform(rid, seed, 1) < F.lit(anomaly_rate)
    u1 = F.lit(1.0) - _uniform(rid, seed, 2)  # (0, 1], safe for log
    u2 = _uniform(rid, seed, 3)
    normal = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
    lognormal = F.exp(F.lit(LOGNORMAL_MU) + F.lit(LOGNORMAL_SIGMA) * normal)
    spike = F.lit(threshold + 1.0) + _uniform(rid, seed, 4) * F.lit(threshold * 5.0 - threshold - 1.0)
    user_no = F.floor(_uniform(rid, seed, 5) * F.lit(n_users)) + 1
    merchant_no = (F.floor(_uniform(rid, seed, 6) * F.lit(len(MERCHANTS))) + 1).cast("int")
    return driver.select(
        _uuid_text(rid, seed).alias("transaction_id"),
        F.format_string("user_%03d", user_no.cast("int")).alias("user_id"),
        F.round(F.when(is_anomaly, spike).otherwise(lognormal), 2).alias("amount"),
        F.element_at(F.array(*[F.lit(m) for m in MERCHANTS]), merchant_no).alias("merchant"),
        iso_utc(f"CAST({event_time} AS TIMESTAMP)").alias("timestamp"),
        is_anomaly.alias("is_anomaly"),
    )
