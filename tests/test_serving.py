"""serving views over loosely typed anomaly records."""

from __future__ import annotations

from datetime import datetime

from txnscope.operators.serving import amount_by_window, flag_breakdown, kpi_summary, newest, serving_feed

LOOSE = (
    "transaction_id STRING, user_id STRING, window_start STRING, window_end STRING, transaction_count STRING, "
    "max_amount STRING, anomaly_flags ARRAY<STRING>, is_anomaly BOOLEAN, detected_at STRING, ttl BIGINT"
)


def row(i, user, detected, amount="2500.00", flags=("HIGH_AMOUNT",), anomaly=True):
    start = f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00"
    return (f"{user}#{start}", user, start, start, "4", amount, list(flags), anomaly, detected, 0)


def test_feed_cap_coercion_and_order(spark):
    rows = [row(i, f"user_{i % 3}", f"2024-01-02T00:{i % 60:02d}:00+00:00") for i in range(60)]
    rows.append(row(70, "user_bad", "not a time"))
    rows.append(row(71, "user_x", "2024-01-03T00:00:00+00:00", amount="n/a"))
    rows.append(row(72, "user_off", "2024-01-04T00:00:00+00:00", anomaly=False))
    rows.append(row(73, "user_null", "2024-01-04T00:00:00+00:00", anomaly=None))
    df = spark.createDataFrame(rows, LOOSE)
    feed = serving_feed(df).collect()
    assert len(feed) == 50
    assert feed[0].user_id == "user_x" and feed[0].max_amount is None
    assert feed[0].detected_at == datetime(2024, 1, 3)
    assert all(r.user_id not in ("user_off", "user_null", "user_bad") for r in feed)
    assert list(serving_feed(df).columns) == [
        "detected_at", "user_id", "window_start", "window_end", "transaction_count", "max_amount", "anomaly_flags",
    ]
    top = newest(df, limit=200).collect()
    assert top[-1].user_id == "user_bad" and top[-1].detected_at is None  # bad time sorts last
    chart = amount_by_window(df).collect()
    assert len(chart) == 20 and all(r.max_amount == 2500.0 for r in chart)
    assert chart[0].window_start_label == "00:59"


def test_kpi_and_flags(spark):
    rows = [
        row(1, "user_b", "2024-01-02T00:00:01+00:00", flags=("HIGH_AMOUNT", "HIGH_FREQUENCY")),
        row(2, "user_a", "2024-01-02T00:00:02+00:00"),
        row(3, "user_b", "2024-01-02T00:00:03+00:00"),
        row(4, "user_a", "2024-01-02T00:00:04+00:00", flags=("HIGH_FREQUENCY",)),
        row(5, "user_c", "2024-01-02T00:00:05+00:00", anomaly=False),
    ]
    df = spark.createDataFrame(rows, LOOSE)
    (k,) = kpi_summary(df).collect()
    assert (k.shown, k.total, k.most_flagged_user) == (4, 4, "user_a")  # tie -> smallest id
    assert k.latest_detected_at == datetime(2024, 1, 2, 0, 0, 4)
    (k2,) = kpi_summary(df, limit=2).collect()
    assert (k2.shown, k2.total) == (2, 4)
    counts = {r.flag: r["count"] for r in flag_breakdown(newest(df)).collect()}
    assert counts == {"HIGH_AMOUNT": 3, "HIGH_FREQUENCY": 2}


def test_scalar_flag_and_empty_table(spark):
    scalar = spark.createDataFrame([("HIGH_AMOUNT",), ("HIGH_AMOUNT",), (None,)], "anomaly_flags STRING")
    assert {r.flag: r["count"] for r in flag_breakdown(scalar).collect()} == {"HIGH_AMOUNT": 2}
    empty = spark.createDataFrame([], LOOSE)
    feed = serving_feed(empty)
    assert feed.count() == 0 and len(feed.columns) == 7
    (k,) = kpi_summary(empty).collect()
    assert (k.shown, k.total, k.latest_detected_at, k.most_flagged_user) == (0, 0, None, None)
