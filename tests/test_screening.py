"""Screened pipeline, late rows, open windows, observed metrics, sliding windows on streams, replays."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnscope import jobs
from txnscope.config import ANOMALY, FRAUD
from txnscope.operators.windows import aggregate
from txnscope.schemas import TRANSACTION
from txnscope.sinks.lake import read_catalog, read_cold, read_rejects, read_valid, register_table, write_cold
from txnscope.sources.payload import to_envelope
from txnscope.sources.replay import deal_out, hold_back, release, replay_stream, with_steps
from txnscope.streaming.late import late_rows, read_late, start_late_rows
from txnscope.streaming.paths import anomaly_table, start_hot, start_sliding
from txnscope.streaming.progress import attach_collector, observe_transactions
from txnscope.streaming.runner import PipelineRoots, run_screened
from txnscope.streaming.state import open_windows, state_size

from tests.conftest import txn_frame
from tests.test_streaming import at, payload, txn_stream, write_file

BAD = [
    "not json",
    '{"transaction_id":"x","user_id":"u1","amount":"9999","timestamp":"2026-05-28T12:00:01Z"}',
    '{"transaction_id":"y","user_id":"u1","amount":1e20,"timestamp":"2026-05-28T12:00:02Z"}',
    '{"transaction_id":"z","user_id":"u1","timestamp":"2026-05-28T12:00:03Z"}',
]


def envelope(folder):
    return lambda s: to_envelope(s.readStream.format("text").option("maxFilesPerTrigger", "1").load(folder), arrival_time=None)


def roots(tmp_path):
    return PipelineRoots(hot=str(tmp_path / "hot"), cold=str(tmp_path / "lake"), cold_checkpoint=str(tmp_path / "lake-ckpt"))


def test_rejected_records_reach_no_window(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    # three valid payments: with the four damaged ones the user would pass the frequency rule
    write_file(src, "a.json", [*BAD[:2], *[payload(str(i), "u1", f"12:00:0{i}") for i in range(3)], *BAD[2:]], 1)
    write_file(src, "b.json", [payload("big", "u2", "12:01:00", 5000.0)], 2)
    r = roots(tmp_path)
    run_screened(spark, envelope(src), r, available_now=True)
    assert [x.user_id for x in anomaly_table(r.hot).latest(spark).collect()] == ["u2"]
    assert read_valid(spark, r.cold).count() == 4
    reasons = sorted(x.reject_reason for x in read_rejects(spark, r.cold).collect())
    assert reasons == ["BAD_AMOUNT", "BAD_FIELD_TYPE", "MALFORMED_JSON", "MISSING_FIELD:amount"]
    # the same checkpoints, one more file: only it is read, and its record joins its window
    write_file(src, "c.json", [payload("more", "u1", "12:00:30"), "{}"], 3)
    run_screened(spark, envelope(src), r, available_now=True)
    assert read_valid(spark, r.cold).count() == 5 and read_rejects(spark, r.cold).count() == 5
    found = {x.user_id: x.transaction_count for x in anomaly_table(r.hot).latest(spark).collect()}
    assert found == {"u1": 4, "u2": 1}


def test_screened_run_without_records(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    r = roots(tmp_path)
    write_file(src, "a.json", BAD, 1)
    run_screened(spark, envelope(src), r, available_now=True)
    assert anomaly_table(r.hot).latest(spark).count() == 0
    assert read_valid(spark, r.cold).count() == 0 and read_rejects(spark, r.cold).count() == 4


def late_script(src):
    write_file(src, "a.json", [payload("1", "u1", "12:10:05")], 1)
    write_file(src, "b.json", [payload("2", "u1", "12:11:05")], 2)
    late = [payload("3", "u1", "12:11:06"), payload("4", "u1", "12:00:55"), payload("5", "u1", "12:09:30"), payload("6", "u1", "garbage")]
    write_file(src, "c.json", late, 3)


def test_late_rows_are_those_the_aggregation_drops(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "late")
    os.makedirs(src)
    late_script(src)
    start_late_rows(txn_stream(spark, src), root, ANOMALY, available_now=True).awaitTermination()
    (row,) = read_late(spark, root).collect()
    assert (row.transaction_id, row.batch_id, row.window_end) == ("4", 2, at(12, 1))
    assert row.watermark == datetime(2026, 5, 28, 12, 8, 5)
    # started again: the clock goes on from the kept event times
    write_file(src, "d.json", [payload("7", "u2", "12:08:59"), payload("8", "u2", "12:09:10"), payload("9", "u2", "12:30:00")], 4)
    write_file(src, "e.json", [payload("10", "u2", "12:09:59")], 5)
    start_late_rows(txn_stream(spark, src), root, ANOMALY, available_now=True).awaitTermination()
    assert sorted((r.transaction_id, r.batch_id) for r in read_late(spark, root).collect()) == [("4", 2), ("7", 3)]
    write_file(src, "f.json", [payload("11", "u2", "12:27:59"), payload("12", "u2", "12:28:00")], 6)
    start_late_rows(txn_stream(spark, src), root, ANOMALY, available_now=True).awaitTermination()
    assert sorted((r.transaction_id, r.batch_id) for r in read_late(spark, root).collect()) == [("11", 5), ("4", 2), ("7", 3)]


def test_late_rows_boundaries(spark, tmp_path):
    rows = txn_frame(spark, [("a", "u", 1.0, "2026-05-28 12:00:59.999"), ("b", "u", 1.0, "2026-05-28 12:01:00"), ("c", "u", 1.0, None)])
    high = int(datetime(2026, 5, 28, 12, 3, 0).timestamp()) * 1_000_000  # watermark 12:01:00
    assert [r.transaction_id for r in late_rows(rows, high).collect()] == ["a"]
    assert late_rows(rows, high - 1).collect() == []  # one microsecond: the watermark is a millisecond less
    assert late_rows(rows, None).collect() == []
    assert read_late(spark, str(tmp_path / "nothing")).count() == 0


def test_open_windows_are_the_state(spark, tmp_path):
    src = str(tmp_path / "src")
    os.makedirs(src)
    late_script(src)
    table = anomaly_table(str(tmp_path / "hot"))
    start_hot(txn_stream(spark, src), table, ANOMALY, available_now=True, state_partitions=3).awaitTermination()
    found = {(r.window_start, r.transaction_count, r.is_anomaly) for r in open_windows(spark, table.checkpoint, ANOMALY).collect()}
    assert found == {(at(12, 9), 1, False), (at(12, 10), 1, False), (at(12, 11), 2, False)}
    first = open_windows(spark, table.checkpoint, ANOMALY, batch_id=0).collect()
    assert [(r.window_start, r.transaction_count) for r in first] == [(at(12, 10), 1)]
    assert sum(r.windows for r in state_size(spark, table.checkpoint).collect()) == 3


def test_open_windows_of_rule_set_b(spark, tmp_path):
    rows = [("1", "u", 10.0, "2026-05-28 12:00:01", "a"), ("2", "u", None, "2026-05-28 12:00:02", "b"), ("3", None, None, "2026-05-28 12:00:03", None)]
    deal_out(with_steps(txn_frame(spark, rows).where("transaction_id IS NOT NULL")), str(tmp_path / "replay"))
    q = aggregate(replay_stream(spark, str(tmp_path / "replay")), FRAUD).writeStream.outputMode("update").format("noop")
    q.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    found = {r.user_id: (r.transaction_count, r.total_amount, r.max_amount, r.min_amount) for r in open_windows(spark, str(tmp_path / "ckpt"), FRAUD).collect()}
    assert found == {"u": (2, 10.0, 10.0, 10.0), None: (1, None, None, None)}


def test_metrics_by_batch_and_as_frame(spark, tmp_path):
    src, lines = str(tmp_path / "src"), []
    os.makedirs(src)
    write_file(src, "a.json", [payload("1", "u1", "12:00:05", 3000.0), payload("2", "u2", "12:00:10")], 1)
    write_file(src, "b.json", [payload("3", "u2", "12:04:30")], 2)
    collector = attach_collector(spark, lines.append)
    try:
        table = anomaly_table(str(tmp_path / "hot"))
        q = start_hot(observe_transactions(txn_stream(spark, src)), table, ANOMALY, available_now=True, query_name="metrics_hot")
        collector.wait(q)
    finally:
        spark.streams.removeListener(collector)
    batches = [tuple(r) for r in collector.batches_frame(spark, "anomaly_windows").collect()]
    assert batches == [("metrics_hot", 0, 2, 1), ("metrics_hot", 1, 1, 0)]
    assert "metrics_hot batch 0 anomaly_windows: windows=2 flagged=1" in lines
    assert [tuple(r) for r in collector.frame(spark).collect()] == [(3, 1, 33.33)]
    empty = type(collector)()
    assert [tuple(r) for r in empty.frame(spark).collect()] == [(0, 0, None)] and empty.batches_frame(spark, "x").count() == 0


def _scattered(spark, start, n=600):
    """Payments around several group boundaries of the pane plan."""
    rows = []
    for i in range(n):
        when = start + timedelta(seconds=(i * 7919) % 14_400, microseconds=i)
        user = None if i % 11 == 0 else f"u{i % 4}"
        rows.append((str(i), user, None if i % 13 == 0 else float(i % 700) * 7.1, when, None if i % 5 == 0 else f"c{i % 6}"))
    return txn_frame(spark, [(*r[:3], r[3], r[4]) for r in rows])


def _exact(txns, profile_metrics=True):
    grouped = txns.groupBy(F.window("event_timestamp", "5 minutes", "1 minute").alias("w"), "user_id").agg(
        F.count("*").alias("n"), F.sum(F.col("amount").cast("decimal(28,10)")).cast("double").alias("t"), F.max("amount").alias("x"),
        F.min("amount").alias("m"), F.count_distinct("merchant_category").alias("d"),
    )
    return {(r.w.start, r.w.end, r.user_id): (r.n, r.t, r.x, r.m, r.d) for r in grouped.collect()}


def _found(windows):
    return {
        (r.window_start, r.window_end, r.user_id): (r.transaction_count, r.total_amount, r.max_amount, r.min_amount, r.distinct_merchant_categories)
        for r in windows.collect()
    }


def test_pane_plan_with_sketches_equals_exact_counts(spark):
    txns = _scattered(spark, datetime(1969, 12, 31, 22, 40))  # before and after 1970
    assert _found(aggregate(txns, FRAUD, "5 minutes", slide="1 minute")) == _exact(txns)


def test_sliding_stream_seals_the_same_windows(spark, tmp_path):
    txns = _scattered(spark, datetime(2024, 3, 31, 22, 40))  # a stream's watermark starts at 1970
    path, root = str(tmp_path / "replay"), str(tmp_path / "sliding")
    deal_out(with_steps(txns), path)
    start_sliding(replay_stream(spark, path), f"{root}/t", f"{root}/c", FRAUD, "5 minutes", "1 minute", available_now=True,
                  state_partitions=2).awaitTermination()
    mark = txns.agg(F.max("event_timestamp")).first()[0] - timedelta(minutes=5)
    expected = {k: v for k, v in _exact(txns).items() if k[1] <= mark}
    assert expected and _found(spark.read.parquet(f"{root}/t")) == expected
    with pytest.raises(ValueError, match="whole number"):
        start_sliding(replay_stream(spark, path), "t", "c", FRAUD, "5 minutes", "2 minutes")


def test_replay_order_and_release(spark, tmp_path):
    rows = [(str(i), "u", 1.0, f"2026-05-28 12:{i:02d}:00") for i in range(60)] + [("n", "u", 1.0, None)]
    path, held = str(tmp_path / "replay"), str(tmp_path / "held")
    steps = deal_out(with_steps(txn_frame(spark, rows), "CASE WHEN transaction_id IN ('3', '59') THEN 2 ELSE 0 END"), path)
    assert steps == list(range(6))
    seen = []
    hold_back(spark, path, held, [4, 5])
    for _ in range(2):
        q = replay_stream(spark, path).writeStream.foreachBatch(lambda b, i: seen.append((i, sorted(r.transaction_id for r in b.collect()))))
        q.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
        if os.path.exists(held + "/step=4"):
            release(spark, held, path, [4, 5])
    assert [i for i, _ in seen] == list(range(6))
    assert "n" in seen[0][1] and "3" in seen[2][1] and "59" in seen[5][1]
    assert sum(len(ids) for _, ids in seen) == 61
    assert deal_out(with_steps(spark.createDataFrame([], TRANSACTION)), str(tmp_path / "none")) == []


def test_catalog_table_sees_days_added_later(spark, tmp_path):
    lake = str(tmp_path / "lake")
    write_cold(txn_frame(spark, [("1", "u", 1.0, "2026-05-28 12:00:00")]), lake)
    table = register_table(spark, lake, database="added_later", database_location=str(tmp_path / "db"))
    write_cold(txn_frame(spark, [("2", "u", 2.0, "2026-05-29 12:00:00"), ("3", "u", 3.0, None)]), lake)
    found = read_catalog(spark, table)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, read_cold(spark, lake).collect()), key=str)
    plan = found.where("day = 29")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and found.where("day = 29").count() == 1


def test_job_arguments(spark, tmp_path, capsys):
    src = str(tmp_path / "src")
    os.makedirs(src)
    write_file(src, "a.json", [payload("1", "u1", "12:00:05", 600.0), payload("2", "u1", "12:00:40", 5.0), "junk"], 1)
    hot, lake = str(tmp_path / "hot"), str(tmp_path / "lake")
    args = ["pipeline", "--source", "text", "--source-path", src, "--hot", hot, "--lake", lake, "--lake-checkpoint",
            str(tmp_path / "ckpt"), "--available-now", "--threshold", "is_high_amount=500", "--watermark", "30 seconds", "--window", "30 seconds"]
    assert jobs.main(args, spark) == 0
    (rec,) = anomaly_table(hot).latest(spark).collect()
    assert (rec.window_start, rec.window_end) == ("2026-05-28T12:00:00", "2026-05-28T12:00:30")
    out = capsys.readouterr().out
    assert "hot_path batch 0 anomaly_windows: windows=2 flagged=1" in out and "rejected=1" in out
    assert jobs.main(["late", "--source", "text", "--source-path", src, "--out", str(tmp_path / "late"), "--available-now"], spark) == 0
    assert jobs.main(["open", "--table", hot, "--out", str(tmp_path / "open")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "open")).count() == 2
    with pytest.raises(KeyError):
        jobs.main([*args, "--threshold", "nothing=1"], spark)
