"""SURVEY §5.2: groups and rule counts per fixture, window and rule set."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txnscope.config import ANOMALY, FRAUD
from txnscope.operators.records import fraud_aggregates, fraud_alerts
from txnscope.operators.windows import aggregate
from txnscope.sources.events import load_transactions

# sf, window: groups, A (amount, freq, any), B (amount, freq, spend, any, severity HIGH)
EXPECTED = {
    ("sf0.001", "1 minute"): (998, (15, 0, 15), (136, 0, 1, 136, 1)),
    ("sf0.001", "1 day"): (397, (15, 81, 89), (118, 14, 21, 125, 22)),
    ("sf0.01", "1 minute"): (9993, (172, 0, 172), (1316, 0, 23, 1316, 23)),
    ("sf0.01", "1 day"): (4006, (170, 845, 956), (1145, 122, 263, 1192, 283)),
}


def _count(col):
    return F.count_if(F.col(col))


@pytest.mark.parametrize("sf,window", sorted(EXPECTED))
def test_rule_counts(spark, sf, window):
    groups, a, b = EXPECTED[(sf, window)]
    txns = load_transactions(spark, f"/root/testdata/{sf}")
    ra = aggregate(txns, ANOMALY, window).agg(
        F.count(F.lit(1)), _count("is_high_amount"), _count("is_high_frequency"), _count("is_anomaly")
    ).first()
    assert (ra[0], tuple(ra[1:])) == (groups, a)
    wb = aggregate(txns, FRAUD, window)
    rb = wb.agg(
        _count("is_high_amount"), _count("is_high_frequency"), _count("is_high_total_spend"), _count("is_fraud")
    ).first()
    high = fraud_alerts(fraud_aggregates(wb, FRAUD, "window_end")).where("severity = 'HIGH'").count()
    assert tuple(rb) + (high,) == b
