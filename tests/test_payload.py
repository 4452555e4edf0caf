"""JSON payloads, including bad ones; encode/decode round trip; quarantine."""

from __future__ import annotations

from datetime import datetime


from txnscope.config import ANOMALY
from txnscope.operators.windows import window_metrics
from txnscope.sources.payload import (
    classify_payloads,
    decode_payload,
    encode_payload,
    quarantined_payloads,
    route_payloads,
    split_payloads,
    to_envelope,
    valid_payloads,
)
from txnscope.schemas import ENVELOPE

OK = '{"transaction_id":"a","user_id":"u1","amount":12.5,"merchant":"m","timestamp":"2026-05-28T12:00:00.123456+00:00"}'
NOT_JSON = "not json"
WRONG_TYPE = '{"transaction_id":"b","user_id":"u1","amount":"oops","merchant":"m","timestamp":"2026-05-28T12:00:00+00:00"}'
BAD_TIME = '{"transaction_id":"c","amount":5,"timestamp":"garbage"}'
EXTRA_KEY = '{"transaction_id":"d","user_id":"u1","amount":3,"timestamp":"2026-05-28T12:00:00Z","extra":1}'
OTHER_OFFSET = '{"transaction_id":"e","user_id":"u1","amount":3,"timestamp":"2026-05-28T14:00:00+02:00"}'
NUMBER_TEXT = '{"transaction_id":"f","user_id":"u1","amount":"7.5","timestamp":"2026-05-28T12:00:00Z"}'
EMPTY_OBJECT = "{}"
ARRIVAL = datetime(2026, 5, 28, 12, 0, 5)


def envelope(spark, payloads):
    rows = [(None if p is None else bytearray(p.encode()), ARRIVAL) for p in payloads]
    return spark.createDataFrame(rows, ENVELOPE)


def by_id(rows):
    return {r.transaction_id: r for r in rows}


def test_decode_permissive(spark):
    rows = decode_payload(
        envelope(spark, [OK, NOT_JSON, WRONG_TYPE, BAD_TIME, None, EXTRA_KEY, OTHER_OFFSET, NUMBER_TEXT, EMPTY_OBJECT])
    ).collect()
    assert len(rows) == 9  # nothing dropped at decode time
    got = by_id(rows)
    assert got["a"].amount == 12.5 and got["a"].event_timestamp == datetime(2026, 5, 28, 12, 0, 0, 123456)
    assert got["b"].amount is None and got["b"].user_id == "u1"  # wrong type -> that field NULL
    assert got["c"].event_timestamp is None and got["c"].user_id is None  # bad time -> NULL, no failure
    assert got["d"].event_timestamp == datetime(2026, 5, 28, 12, 0) and got["d"].merchant is None
    assert got["e"].event_timestamp == datetime(2026, 5, 28, 12, 0)  # +02:00 -> 12:00 UTC
    assert got["f"].amount is None  # number as text is a type error
    nulls = [r for r in rows if r.transaction_id is None]
    assert len(nulls) == 3  # not JSON, NULL payload, {}
    assert all(r.arrival_time == ARRIVAL for r in rows)


def test_one_batch_groups_to_single_window(spark):
    env = envelope(spark, [OK, WRONG_TYPE, BAD_TIME, EXTRA_KEY, OTHER_OFFSET, NOT_JSON, None])
    rows = window_metrics(decode_payload(env), ANOMALY, "1 minute").collect()
    assert len(rows) == 1
    (w,) = rows
    assert (w.user_id, w.window_start, w.transaction_count, w.max_amount) == ("u1", datetime(2026, 5, 28, 12, 0), 4, 12.5)


def test_quarantine_reasons(spark):
    payloads = [OK, NOT_JSON, WRONG_TYPE, BAD_TIME, None, EXTRA_KEY, NUMBER_TEXT, EMPTY_OBJECT, "  "]
    classified = classify_payloads(envelope(spark, payloads)).collect()
    reasons = {r.raw: r.reject_reason for r in classified}
    assert reasons[OK] is None and reasons[EXTRA_KEY] is None
    assert reasons[NOT_JSON] == "MALFORMED_JSON"
    assert reasons[WRONG_TYPE] == "BAD_FIELD_TYPE"
    assert reasons[NUMBER_TEXT] == "BAD_FIELD_TYPE"
    assert reasons[BAD_TIME] == "MISSING_FIELD:user_id"
    assert reasons[EMPTY_OBJECT] == "MISSING_FIELD:transaction_id,user_id,amount,timestamp"
    assert reasons[None] == "EMPTY_PAYLOAD" and reasons["  "] == "EMPTY_PAYLOAD"
    bad_time_only = '{"transaction_id":"g","user_id":"u1","amount":1,"timestamp":"garbage"}'
    (r,) = classify_payloads(envelope(spark, [bad_time_only])).collect()
    assert r.reject_reason == "BAD_TIMESTAMP"


def test_split_and_route_agree(spark, tmp_path):
    env = envelope(spark, [OK, NOT_JSON, WRONG_TYPE, BAD_TIME, None, EXTRA_KEY, NUMBER_TEXT, EMPTY_OBJECT])
    valid, bad = split_payloads(env)
    assert sorted(r.transaction_id for r in valid.collect()) == ["a", "d"]
    assert bad.count() == 6
    rvalid, rbad = route_payloads(env, str(tmp_path / "routed"))
    assert sorted(r.transaction_id for r in rvalid.collect()) == ["a", "d"]
    assert sorted(r.reject_reason for r in rbad.collect()) == sorted(r.reject_reason for r in bad.collect())


def test_valid_filter_parses_once(spark):
    """The reject filter must stay above the parse (no JSON parse inlined into it)."""
    plan = valid_payloads(classify_payloads(envelope(spark, [OK])))._jdf.queryExecution().optimizedPlan().toString()
    filter_lines = [line for line in plan.splitlines() if "Filter" in line]
    assert filter_lines and all("from_json" not in line for line in filter_lines)


def test_encode_decode_round_trip(spark):
    from tests.conftest import txn_frame

    txns = txn_frame(
        spark,
        [("t1", "u1", 12.5, "2024-01-01 00:00:07.179575"), ("t2", "u2", 3.0, "2024-01-01 00:00:00"), ("t3", None, None, "2024-01-01 00:01:00")],
    )
    enc = encode_payload(txns, keep=("arrival_time",))
    values = {r.key: r.value for r in enc.collect()}
    assert '"timestamp":"2024-01-01T00:00:07.179575+00:00"' in values["u1"]
    assert '"timestamp":"2024-01-01T00:00:00+00:00"' in values["u2"]  # isoformat drops zero micros
    assert "user_id" not in values[None] and "amount" not in values[None]  # NULL fields omitted
    back = decode_payload(enc.selectExpr("CAST(value AS BINARY) AS data", "arrival_time"))
    a = sorted(txns.select("transaction_id", "user_id", "amount", "event_timestamp").collect())
    b = sorted(back.select("transaction_id", "user_id", "amount", "event_timestamp").collect())
    assert a == b


def test_kafka_style_envelope(spark):
    src = spark.createDataFrame([(OK, ARRIVAL)], "value string, timestamp timestamp")
    (r,) = decode_payload(to_envelope(src)).collect()
    assert r.transaction_id == "a" and r.arrival_time == ARRIVAL
    (r2,) = quarantined_payloads(classify_payloads(to_envelope(spark.createDataFrame([(NOT_JSON, ARRIVAL)], "value string, timestamp timestamp")))).collect()
    assert r2.reject_reason == "MALFORMED_JSON"



def test_window_path_parses_json_once(spark):
    """The window's NOT NULL event-time filter must not re-parse the payload."""
    from txnscope.config import ANOMALY
    from txnscope.operators.windows import aggregate

    env = envelope(spark, [OK, EXTRA_KEY, NOT_JSON])
    plan = aggregate(decode_payload(env), ANOMALY, "1 minute")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_amounts_that_do_not_fit(spark):
    text = '{"transaction_id":"%s","user_id":"u1","amount":%s,"timestamp":"2026-05-28T12:00:00Z"}'
    env = envelope(spark, [text % (i, a) for i, a in enumerate(["1e20", "NaN", "-Infinity", "9999999999999998"])])
    got = {r.transaction_id: r.reject_reason for r in classify_payloads(env).collect()}
    assert got == {"0": "BAD_AMOUNT", "1": "BAD_AMOUNT", "2": "BAD_AMOUNT", "3": None}
    assert {r.transaction_id: r.amount for r in decode_payload(env).collect()} == {"0": None, "1": None, "2": None, "3": 9999999999999998.0}


def test_category_reaches_the_fraud_metrics(spark):
    from txnscope.config import FRAUD

    text = '{"transaction_id":"%s","user_id":"u1","amount":1,"timestamp":"2026-05-28T12:00:00Z","merchant_category":"%s"}'
    env = envelope(spark, [text % (i, c) for i, c in enumerate(["food", "toys", "food"])])
    (w,) = window_metrics(decode_payload(env), FRAUD, "1 minute").collect()
    assert w.distinct_merchant_categories == 2
    valid = valid_payloads(classify_payloads(env))
    assert sorted(r.merchant_category for r in valid.collect()) == ["food", "food", "toys"]
