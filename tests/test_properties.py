"""Window operator and records against a brute-force Python model on random inputs."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txnscope.config import ANOMALY, FRAUD
from txnscope.operators.records import anomaly_records
from txnscope.operators.windows import aggregate
from txnscope.schemas import TRANSACTION

BASE = datetime(2024, 1, 1, 12, 0)
amounts = st.one_of(st.none(), st.sampled_from([0.0, 999.99, 1000.0, 1000.01, 1999.99, 2000.0, 2000.01, 3000.0, -50.0, 12.5]))
rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", None]),
        amounts,
        # microseconds over 4 minutes, including exact minute boundaries
        st.one_of(st.integers(0, 4 * 60 * 1_000_000), st.sampled_from([0, 59_999_999, 60_000_000, 120_000_000])),
    ),
    max_size=30,
)


def frame(spark, rows):
    data = []
    for i, (user, amount, micros) in enumerate(rows):
        t = BASE + timedelta(microseconds=micros)
        data.append((str(i), user, amount, "m", None, t, t))
    return spark.createDataFrame(data, TRANSACTION)


def model(rows, minutes=1, slide=None):
    """(window_start, user) -> (count, max or None, sum or None) by brute force.

    Windows advance by ``slide`` minutes (default: tumbling) from minute boundaries; the
    windows holding time t start at the last ``minutes // slide`` boundaries at or before t.
    """
    step = slide or minutes
    groups = defaultdict(list)
    for user, amount, micros in rows:
        t = BASE + timedelta(microseconds=micros)
        boundary = datetime(t.year, t.month, t.day, t.hour, t.minute)
        boundary -= timedelta(minutes=boundary.minute % step)
        for k in range(minutes // step):
            groups[(boundary - timedelta(minutes=k * step), user)].append(amount)
    out = {}
    for key, values in groups.items():
        present = [v for v in values if v is not None]
        out[key] = (len(values), max(present) if present else None, sum(present) if present else None)
    return out


def _gt(value, threshold):
    return None if value is None else value > threshold


def _or(*values):
    if any(v is True for v in values):
        return True
    if any(v is None for v in values):
        return None
    return False


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_tumbling_rules_match_model(spark, rows):
    got = {(r.window_start, r.user_id): r for r in aggregate(frame(spark, rows), FRAUD, "1 minute").collect()}
    want = model(rows)
    assert set(got) == set(want)
    for key, (count, mx, total) in want.items():
        r = got[key]
        assert (r.transaction_count, r.max_amount) == (count, mx)
        assert (r.total_amount is None) == (total is None)
        if total is not None:
            assert abs(r.total_amount - total) < 1e-6
        assert r.is_high_amount == _gt(mx, 1000.0)
        assert r.is_high_frequency == (count > 5)
        assert r.is_fraud == _or(_gt(mx, 1000.0), count > 5, None if total is None else total > 3000.0)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_records_match_model(spark, rows):
    recs = {r.transaction_id: r for r in anomaly_records(aggregate(frame(spark, rows), ANOMALY, "1 minute"), ANOMALY, "window_end").collect()}
    want = {}
    for (start, user), (count, mx, _) in model(rows).items():
        flags = [f for f, hit in (("HIGH_AMOUNT", _gt(mx, 2000.0)), ("HIGH_FREQUENCY", count > 3)) if hit]
        if flags:
            key = f"{user if user is not None else 'None'}#{start.isoformat()}"
            money = None if mx is None else Decimal(str(mx)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            want[key] = (count, money, flags)
    assert {k: (r.transaction_count, r.max_amount, r.anomaly_flags) for k, r in recs.items()} == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_sliding_windows_match_model(spark, rows):
    got = {
        (r.window_start, r.user_id): (r.transaction_count, r.max_amount)
        for r in aggregate(frame(spark, rows), ANOMALY, "5 minutes", slide="1 minute").collect()
    }
    want = {k: (c, m) for k, (c, m, _) in model(rows, minutes=5, slide=1).items()}
    assert got == want


# ----------------------------------------------------------------- payload quarantine
_MISSING = object()
text_values = st.one_of(st.just(_MISSING), st.none(), st.sampled_from(["a", "u1", "", 5, {"x": 1}]))
amount_values = st.one_of(
    st.just(_MISSING), st.none(), st.sampled_from([12.5, 3, -1.0, 0, "7.5", "oops", True, [1]])
)
time_values = st.one_of(
    st.just(_MISSING), st.none(),
    st.sampled_from(["2026-05-28T12:00:00Z", "2026-05-28T12:00:00.5+00:00", "2026-05-28 12:00:00", "garbage", "2026-13-45"]),
)
payload_strategy = st.one_of(
    st.fixed_dictionaries(
        {"transaction_id": text_values, "user_id": text_values, "amount": amount_values,
         "merchant": text_values, "timestamp": time_values, "extra": st.just(_MISSING) | st.integers(0, 3)}
    ),
    st.sampled_from([None, "", "   ", "not json", "{", '{"amount": 1', "[1, 2"]),
)


def _encode(p):
    import json

    if not isinstance(p, dict):
        return p
    return json.dumps({k: v for k, v in p.items() if v is not _MISSING})


def _expected_reason(p):
    from datetime import datetime as _dt

    if p is None or (isinstance(p, str) and p.strip() == ""):
        return "EMPTY_PAYLOAD"
    if not isinstance(p, dict):
        return "MALFORMED_JSON"
    amount = p["amount"]
    if amount is not _MISSING and amount is not None and (isinstance(amount, (bool, str, list)) or not isinstance(amount, (int, float))):
        return "BAD_FIELD_TYPE"
    missing = [f for f in ("transaction_id", "user_id", "amount", "timestamp") if p[f] is _MISSING or p[f] is None]
    if missing:
        return "MISSING_FIELD:" + ",".join(missing)
    ts = p["timestamp"].replace("Z", "+00:00")
    try:
        _dt.fromisoformat(ts)
    except ValueError:
        return "BAD_TIMESTAMP"
    return None


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(payloads=st.lists(payload_strategy, min_size=1, max_size=25))
def test_quarantine_reasons_match_model(spark, payloads):
    from txnscope.schemas import ENVELOPE
    from txnscope.sources.payload import classify_payloads

    texts = [_encode(p) for p in payloads]
    env = spark.createDataFrame(
        [(None if t is None else bytearray(t.encode()), BASE) for t in texts], ENVELOPE
    )
    got = [(r.raw, r.reject_reason) for r in classify_payloads(env).collect()]
    want = [(t, _expected_reason(p)) for t, p in zip(texts, payloads)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# --------------------------------------------------------------------------- serving feed
LOOSE_RECORDS = (
    "transaction_id STRING, user_id STRING, window_start STRING, window_end STRING, transaction_count STRING, "
    "max_amount STRING, anomaly_flags ARRAY<STRING>, is_anomaly BOOLEAN, detected_at STRING, ttl BIGINT"
)
record_strategy = st.tuples(
    st.sampled_from(["u1", "u2", "u3"]),
    st.integers(0, 59),  # window minute
    st.sampled_from(["4", "12", "x", None]),  # count text
    st.sampled_from(["2500.00", "1.5", "n/a", None]),  # amount text
    st.sampled_from([True, False, None]),
    st.one_of(st.integers(0, 20), st.sampled_from(["bad", None])),  # detection minute or junk
)


def _num(text, kind):
    try:
        return kind(text) if text is not None else None
    except ValueError:
        return None


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(record_strategy, max_size=70, unique_by=lambda r: (r[0], r[1])))
def test_serving_feed_matches_model(spark, records):
    from txnscope.operators.serving import serving_feed

    rows, model_rows = [], []
    for user, minute, count, amount, flagged, detected in records:
        start = f"2024-01-01T10:{minute:02d}:00"
        det = f"2024-01-02T00:{detected:02d}:00+00:00" if isinstance(detected, int) else detected
        tid = f"{user}#{start}"
        rows.append((tid, user, start, start, count, amount, ["HIGH_AMOUNT"], flagged, det, 0))
        if flagged:
            det_ts = datetime(2024, 1, 2, 0, detected) if isinstance(detected, int) else None
            model_rows.append((det_ts, tid, user, _num(count, int), _num(amount, float)))
    # newest first, unparsable times last, then by key; at most 50
    model_rows.sort(key=lambda r: (r[0] is None, -(r[0].timestamp()) if r[0] else 0, r[1]))
    want = [(r[0], r[2], r[3], r[4]) for r in model_rows[:50]]
    df = serving_feed(spark.createDataFrame(rows, LOOSE_RECORDS))
    got = [(r.detected_at, r.user_id, r.transaction_count, r.max_amount) for r in df.collect()]
    assert got == want  # the feed comes back newest first


# ------------------------------------------------------------------ keyed latest-wins
batch_strategy = st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.integers(1, 99), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    batches=st.lists(batch_strategy, min_size=1, max_size=5),
    replay=st.booleans(),
    compact_after=st.one_of(st.none(), st.integers(0, 4)),
)
def test_keyed_table_matches_latest_wins_model(spark, batches, replay, compact_after):
    import uuid
    from decimal import Decimal

    from txnscope.schemas import ANOMALY_RECORD
    from txnscope.session import shared_root
    from txnscope.sinks.keyed import KeyedTable

    table = KeyedTable(root=f"{shared_root(spark)}/prop-{uuid.uuid4().hex}", key=("transaction_id",), schema=ANOMALY_RECORD)

    def write(batch_id, batch):
        rows = [(k, "u", "s", "e", v, Decimal("1.00"), ["X"], True, "t", 4_000_000_000) for k, v in batch.items()]
        table.write_batch(spark.createDataFrame(rows, ANOMALY_RECORD), batch_id)

    model = {}
    for batch_id, batch in enumerate(batches):
        write(batch_id, batch)
        model.update(batch)
        if replay:  # a retried micro-batch writes the same rows again
            write(batch_id, batch)
        if compact_after == batch_id:
            name = "prop_" + uuid.uuid4().hex
            table = table.compact(spark, name, f"{table.root}/{name}", "2024-01-01 00:00:00", 2)
    got = {r.transaction_id: r.transaction_count for r in table.latest(spark).collect()}
    assert got == model


# ------------------------------------------------------------------------ cold lake
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    times=st.lists(
        st.one_of(
            st.none(),
            st.datetimes(min_value=datetime(2023, 12, 31, 23, 0), max_value=datetime(2024, 3, 1, 1, 0)),
            st.sampled_from([datetime(2023, 12, 31, 23, 59, 59, 999999), datetime(2024, 1, 1), datetime(2024, 2, 29, 23, 59)]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_cold_partitions_match_calendar(spark, times):
    import uuid
    from collections import Counter

    from txnscope.operators.analytics import partition_counts
    from txnscope.session import shared_root
    from txnscope.sinks.lake import read_cold, write_cold

    rows = [(str(i), "u", 1.0, "m", None, t, t) for i, t in enumerate(times)]
    path = f"{shared_root(spark)}/prop-cold-{uuid.uuid4().hex}"
    write_cold(spark.createDataFrame(rows, TRANSACTION), path)
    got = {(r.year, r.month, r.day): r.txn_count for r in partition_counts(read_cold(spark, path)).collect()}
    want = Counter((t.year, t.month, t.day) if t else (None, None, None) for t in times)
    assert got == dict(want)
