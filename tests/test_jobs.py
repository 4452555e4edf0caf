"""Command-line jobs."""

from __future__ import annotations

import os

from txnscope import jobs
from txnscope.sinks.lake import read_cold, read_valid
from txnscope.streaming.paths import anomaly_table, fraud_table

from tests.test_streaming import payload, write_file


def test_pipeline_report_compact(spark, tmp_path, capsys):
    src = str(tmp_path / "src")
    os.makedirs(src)
    write_file(src, "a.json", [payload(str(i), "u1", f"12:00:0{i}", 2500.0 if i == 0 else 5.0) for i in range(5)], 1)
    write_file(src, "b.json", [payload("9", "u2", "12:03:00", 10.0)], 2)
    hot, lake = str(tmp_path / "hot"), str(tmp_path / "lake")
    args = ["pipeline", "--source", "text", "--source-path", src, "--option", "maxFilesPerTrigger=1",
            "--hot", hot, "--lake", lake, "--lake-checkpoint", str(tmp_path / "lake-ckpt"), "--available-now"]
    assert jobs.main(args, spark) == 0
    assert read_valid(spark, lake).count() == 6
    (rec,) = anomaly_table(hot).latest(spark).collect()
    assert rec.anomaly_flags == ["HIGH_AMOUNT", "HIGH_FREQUENCY"] and rec.transaction_count == 5
    out = str(tmp_path / "reports")
    assert jobs.main(["report", "--lake", lake, "--out", out, "--year", "2026", "--month", "5"], spark) == 0
    assert spark.read.parquet(f"{out}/high_value_txns").count() == 1
    assert spark.read.parquet(f"{out}/top_users").count() == 2
    plain = str(tmp_path / "plain")
    again = ["pipeline", "--unscreened", "--source", "text", "--source-path", src, "--hot", str(tmp_path / "hot2"), "--lake", plain,
             "--lake-checkpoint", str(tmp_path / "plain-ckpt"), "--available-now"]
    assert jobs.main(again, spark) == 0 and read_cold(spark, plain).count() == 6
    days = ["--start", "2026-05-28", "--end", "2026-05-29"]
    assert jobs.main(["compact", "--lake", lake, "--lake-out", str(tmp_path / "days"), *days], spark) == 0
    assert read_cold(spark, str(tmp_path / "days")).count() == 6
    compact = ["compact", "--table", hot, "--new-base", "jobs_base", "--new-base-path", str(tmp_path / "base"), "--buckets", "2"]
    assert jobs.main(compact, spark) == 0
    assert "--base jobs_base --base-batch 0" in capsys.readouterr().out
    feed = ["feed", "--table", hot, "--base", "jobs_base", "--base-batch", "0", "--out", str(tmp_path / "feed")]
    assert jobs.main(feed, spark) == 0
    assert spark.read.parquet(str(tmp_path / "feed" / "serving_feed")).count() == 1
    assert spark.read.parquet(str(tmp_path / "feed" / "kpi_summary")).first().total == 1
    assert jobs.main(["fraud", "--source", "text", "--source-path", src, "--table", str(tmp_path / "fraud"),
                      "--available-now"], spark) == 0
    assert fraud_table(str(tmp_path / "fraud")).latest(spark).count() == 2
