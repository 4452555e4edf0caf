"""window boundaries, strict thresholds, three-valued flags, NULL users; profile B."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from txnscope.config import ANOMALY, FRAUD
from txnscope.operators.records import anomaly_records, fraud_aggregates, fraud_alerts
from txnscope.operators.windows import aggregate

from tests.conftest import txn_frame

MIN = "1 minute"


def windows(spark, rows, profile=ANOMALY, window=MIN):
    return aggregate(txn_frame(spark, rows), profile, window)


def one(spark, rows, profile=ANOMALY):
    out = windows(spark, rows, profile).collect()
    assert len(out) == 1
    return out[0]


def test_boundary_time_two_windows(spark):
    out = windows(spark, [("1", "u", 1.0, "2024-01-01 12:00:59.999999"), ("2", "u", 1.0, "2024-01-01 12:01:00")]).collect()
    assert sorted(r.window_start for r in out) == [datetime(2024, 1, 1, 12, 0), datetime(2024, 1, 1, 12, 1)]


def test_strict_amount_threshold(spark):
    assert one(spark, [("1", "u", 2000.00, "2024-01-01 12:00:01")]).is_anomaly is False
    r = one(spark, [("1", "u", 2000.01, "2024-01-01 12:00:01")])
    assert r.is_high_amount and r.is_anomaly


def test_strict_count_threshold(spark):
    three = [(str(i), "u", 1.0, f"2024-01-01 12:00:0{i}") for i in range(3)]
    assert one(spark, three).is_anomaly is False
    four = [(str(i), "u", 1.0, f"2024-01-01 12:00:0{i}") for i in range(4)]
    assert one(spark, four).is_high_frequency is True


def test_both_flags_in_order(spark):
    rows = [(str(i), "u", 2500.0 if i == 0 else 1.0, f"2024-01-01 12:00:0{i}") for i in range(4)]
    (rec,) = anomaly_records(windows(spark, rows), ANOMALY, as_of="window_end").collect()
    assert rec.anomaly_flags == ["HIGH_AMOUNT", "HIGH_FREQUENCY"]
    assert rec.transaction_id == "u#2024-01-01T12:00:00"
    assert rec.window_start == "2024-01-01T12:00:00" and rec.window_end == "2024-01-01T12:01:00"
    assert rec.detected_at == "2024-01-01T12:01:00+00:00"
    assert rec.ttl == int(datetime(2024, 1, 31, 12, 1).timestamp() - datetime(1970, 1, 1).timestamp())
    assert rec.max_amount == Decimal("2500.00")


def test_null_amounts_three_valued(spark):
    rows = [(str(i), "u", None, f"2024-01-01 12:00:0{i}") for i in range(4)]
    w = one(spark, rows)
    assert w.is_high_amount is None and w.is_anomaly is True and w.max_amount is None
    (rec,) = anomaly_records(windows(spark, rows), ANOMALY, as_of="window_end").collect()
    assert rec.anomaly_flags == ["HIGH_FREQUENCY"] and rec.max_amount is None
    few = one(spark, [("1", "u", None, "2024-01-01 12:00:01")])
    assert few.is_anomaly is None
    assert anomaly_records(windows(spark, [("1", "u", None, "2024-01-01 12:00:01")]), ANOMALY).count() == 0


def test_null_user_own_group_and_key(spark):
    rows = [(str(i), None, 3000.0, f"2024-01-01 12:00:0{i}") for i in range(2)] + [("9", "u", 3000.0, "2024-01-01 12:00:09")]
    recs = anomaly_records(windows(spark, rows), ANOMALY, as_of="window_end").collect()
    keys = sorted(r.transaction_id for r in recs)
    assert keys == ["None#2024-01-01T12:00:00", "u#2024-01-01T12:00:00"]


def test_money_half_up(spark):
    rows = [("1", "a", 2.675, "2024-01-01 12:00:00"), ("2", "b", 1.005, "2024-01-01 12:00:00")]
    aggs = {r.user_id: r for r in fraud_aggregates(windows(spark, rows, FRAUD), FRAUD, "window_end").collect()}
    assert aggs["a"].max_amount == Decimal("2.68") and aggs["b"].max_amount == Decimal("1.01")


def test_fraud_profile_flags_and_severity(spark):
    rows = [(str(i), "u", 900.0, f"2024-01-01 12:00:0{i}", "shop" if i % 2 else "food") for i in range(6)]
    rows.append(("x", "v", 1500.0, "2024-01-01 12:00:00", "travel"))
    aggs = fraud_aggregates(windows(spark, rows, FRAUD), FRAUD, "window_end")
    by_user = {r.user_id: r for r in aggs.collect()}
    u = by_user["u"]
    assert u.fraud_flags == ["HIGH_FREQUENCY", "HIGH_TOTAL_SPEND"] and u.is_fraud
    assert u.total_amount == Decimal("5400.00") and u.distinct_categories == 2
    assert by_user["v"].fraud_flags == ["HIGH_SINGLE_TRANSACTION"]
    alerts = {r.user_id: r for r in fraud_alerts(aggs).collect()}
    assert alerts["u"].severity == "HIGH" and alerts["v"].severity == "MEDIUM"
    assert alerts["u"].status == "NEW" and alerts["u"].alert_id == "u#2024-01-01T12:00:00"
    assert alerts["u"].ttl - u.ttl == 23 * 86400  # 30-day alert vs 7-day aggregate expiry


def test_with_thresholds(spark):
    lowered = ANOMALY.with_thresholds(is_high_amount=10.0)
    assert one(spark, [("1", "u", 11.0, "2024-01-01 12:00:00")], lowered).is_anomaly is True
    assert ANOMALY.rules[0].threshold == 2000.0


def test_sliding_windows_membership(spark):
    rows = [("1", "u", 1.0, "2024-01-01 12:00:30")]
    out = aggregate(txn_frame(spark, rows), ANOMALY, "5 minutes", slide="1 minute").collect()
    starts = sorted(r.window_start for r in out)
    assert [(s.hour, s.minute) for s in starts] == [(11, 56), (11, 57), (11, 58), (11, 59), (12, 0)]
