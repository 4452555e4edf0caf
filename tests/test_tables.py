"""Keyed latest-wins tables: idempotent batches, latest view, expiry, compaction."""

from __future__ import annotations

import uuid
from decimal import Decimal

from txnscope.schemas import ANOMALY_RECORD
from txnscope.sinks.keyed import KeyedTable


def rec(key, count, ttl):
    return (key, "u", "2024-01-01T00:00:00", "2024-01-02T00:00:00", count, Decimal("1.00"), ["HIGH_FREQUENCY"], True, "x", ttl)


def table(tmp_path):
    return KeyedTable(root=str(tmp_path / "t"), key=("transaction_id",), schema=ANOMALY_RECORD)


def frame(spark, rows):
    return spark.createDataFrame(rows, ANOMALY_RECORD)


def test_empty_table_has_schema(spark, tmp_path):
    t = table(tmp_path)
    latest = t.latest(spark)
    assert latest.count() == 0 and latest.columns == [f.name for f in ANOMALY_RECORD.fields]


def test_latest_wins_and_replay_is_idempotent(spark, tmp_path):
    t = table(tmp_path)
    t.write_batch(frame(spark, [rec("a", 4, 10**10), rec("b", 5, 10**10)]), 0)
    t.write_batch(frame(spark, [rec("a", 6, 10**10)]), 1)
    t.write_batch(frame(spark, [rec("a", 6, 10**10)]), 1)  # replay of batch 1
    assert t.log_rows(spark).count() == 3
    assert {r.transaction_id: r.transaction_count for r in t.latest(spark).collect()} == {"a": 6, "b": 5}


def test_live_view_drops_expired(spark, tmp_path):
    t = table(tmp_path)
    t.write_batch(frame(spark, [rec("old", 4, 1_000), rec("new", 4, 2_000_000_000)]), 0)
    assert [r.transaction_id for r in t.live(spark, "2024-02-15 00:00:00").collect()] == ["new"]


def compacted(spark, t, as_of="2024-02-15 00:00:00", buckets=3):
    name = "base_" + uuid.uuid4().hex
    return t.compact(spark, name, f"{t.root}/{name}", as_of, buckets)


def counts(spark, t):
    return {r.transaction_id: r.transaction_count for r in t.latest(spark).collect()}


def test_compaction_keeps_view_and_leaves_the_log(spark, tmp_path):
    t = table(tmp_path)
    assert compacted(spark, t) is t  # nothing to compact
    t.write_batch(frame(spark, [rec("a", 4, 2_000_000_000), rec("gone", 4, 1)]), 0)
    t.write_batch(frame(spark, [rec("a", 7, 2_000_000_000), rec("b", 4, 2_000_000_000)]), 1)
    before = sorted(t.live(spark, "2024-02-15 00:00:00").collect())
    c = compacted(spark, t)
    assert c.base.upto == 1 and sorted(c.latest(spark).collect()) == before
    assert c.log_rows(spark).count() == 0 and t.log_rows(spark).count() == 4  # readers of the old table see no change
    t.write_batch(frame(spark, [rec("b", 9, 2_000_000_000), rec("c", 1, 2_000_000_000)]), 2)
    assert counts(spark, c) == {"a": 7, "b": 9, "c": 1}
    again = compacted(spark, c)
    assert again.base.upto == 2 and counts(spark, again) == {"a": 7, "b": 9, "c": 1}
    assert compacted(spark, again) is again


def test_base_is_not_shuffled(spark, tmp_path):
    t = table(tmp_path)
    t.write_batch(frame(spark, [rec(f"k{i}", i, 2_000_000_000) for i in range(50)]), 0)
    c = compacted(spark, t, buckets=None)
    t.write_batch(frame(spark, [rec("k1", 99, 2_000_000_000)]), 1)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        plan = c.latest(spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    join = plan[plan.index("SortMergeJoin") :].splitlines()
    scan = next(i for i, line in enumerate(join) if "Bucketed: true" in line)
    assert not any("Exchange" in line for line in join[:scan])
    assert counts(spark, c)["k1"] == 99 and len(counts(spark, c)) == 50


def test_latest_view_limits_per_key_before_shuffle(spark, tmp_path):
    t = table(tmp_path)
    t.write_batch(frame(spark, [rec("a", 4, 10**10)]), 0)
    plan = t.latest(spark)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_compaction_stops_at_last_committed_batch(spark, tmp_path):
    import os

    t = table(tmp_path)
    t.write_batch(frame(spark, [rec("a", 4, 2_000_000_000)]), 0)
    t.write_batch(frame(spark, [rec("a", 5, 2_000_000_000)]), 1)
    t.write_batch(frame(spark, [rec("a", 6, 2_000_000_000)]), 2)  # written, not committed
    os.makedirs(os.path.join(t.checkpoint, "commits"))
    for i in (0, 1):
        open(os.path.join(t.checkpoint, "commits", str(i)), "w").close()
    c = compacted(spark, t)
    assert c.base.upto == 1
    assert [r.batch_id for r in c.log_rows(spark).collect()] == [2]
    assert [r.transaction_count for r in c.latest(spark).collect()] == [6]


def test_compaction_of_expired_rows_leaves_none(spark, tmp_path):
    t = table(tmp_path)
    t.write_batch(frame(spark, [rec("gone", 4, 1)]), 0)
    assert compacted(spark, t).latest(spark).count() == 0


def test_alerts_outlive_their_aggregates(spark, tmp_path):
    from txnscope.config import FRAUD
    from txnscope.operators.records import fraud_aggregates
    from txnscope.operators.windows import aggregate
    from txnscope.streaming.paths import fraud_table, live_alerts

    from tests.conftest import txn_frame

    t = fraud_table(str(tmp_path / "fraud"))
    txns = txn_frame(spark, [("1", "u1", 5000.0, "2024-01-01 00:00:00"), ("2", "u2", 1.0, "2024-01-01 00:00:00")])
    t.write_batch(fraud_aggregates(aggregate(txns, FRAUD), as_of="window_end"), 0)
    t = compacted(spark, t, "2024-01-11 00:00:00")
    assert [r.user_id for r in t.latest(spark).collect()] == ["u1"]
    assert t.live(spark, "2024-01-11 00:00:00").count() == 0
    assert [r.user_id for r in live_alerts(spark, t, "2024-01-30 00:00:00").collect()] == ["u1"]
    assert live_alerts(spark, t, "2024-02-01 00:00:00").count() == 0
