"""Command-line jobs (``spark-submit txnscope/jobs.py <job> ...`` or ``python -m txnscope.jobs``).

* ``pipeline``  payloads screened into the lake (valid rows and quarantine), hot path (keyed anomaly table) on the valid
  ones; ``--unscreened`` for hot and cold path straight from the source
* ``fraud``     rule set B hot path (aggregate table; alerts are a view over it)
* ``late``      rows that arrive behind the watermark, as a table
* ``open``      windows still open in a query's state, written as Parquet
* ``feed``      the dashboard's views of a stored anomaly table, written as Parquet
* ``report``    the four monthly analytics over the cold lake, written as Parquet
* ``compact``   write a keyed table's latest rows as a new base and/or rewrite closed lake days

Window, watermark, thresholds and triggers are arguments. Streaming jobs print the windows and flagged windows of each
batch, and rejected payloads, as the batches report them.

Paths must be on shared storage; the checkpoint folder comes from ``spark.checkpoint.dir``.
Only the driver runs Python: every plan is built from Spark SQL expressions (no UDFs) and
``foreachBatch`` bodies run on the driver, so executors need no Python package.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from txnscope.config import ANOMALY, COLD_TRIGGER, FRAUD, HOT_TRIGGER, RuleProfile  # noqa: E402
from txnscope.operators import analytics, serving  # noqa: E402
from txnscope.session import STREAMING_STATE_PARTITIONS, is_local, pin_utc, prepare_streaming  # noqa: E402
from txnscope.sinks.keyed import Base, KeyedTable  # noqa: E402
from txnscope.sinks.lake import compact_days, read_cold, read_valid  # noqa: E402
from txnscope.sources.stream import raw_stream, transaction_stream  # noqa: E402
from txnscope.streaming.late import start_late_rows  # noqa: E402
from txnscope.streaming.paths import anomaly_table, fraud_table, start_fraud_hot  # noqa: E402
from txnscope.streaming.progress import attach_collector  # noqa: E402
from txnscope.streaming.runner import PipelineRoots, run_both, run_screened  # noqa: E402
from txnscope.streaming.state import open_windows  # noqa: E402


def _source_kwargs(args) -> dict:
    options = dict(kv.split("=", 1) for kv in (args.option or []))
    return {"options": options, "path": args.source_path}


def _add_source(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source", default="kafka", help="stream format: kafka, text, ...")
    p.add_argument("--source-path", default=None, help="folder for file sources")
    p.add_argument("--option", action="append", help="source option key=value (repeatable)")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--state-partitions", type=int, default=None,
                   help="state-store partitions, fixed at the first start (e.g. 400)")


def _add_profile(p: argparse.ArgumentParser, profile: RuleProfile) -> None:
    p.add_argument("--window", default=profile.window)
    p.add_argument("--watermark", default=profile.watermark)
    p.add_argument("--threshold", action="append", metavar="INDICATOR=NUMBER",
                   help="one of " + ", ".join(f"{r.indicator}={r.threshold:g}" for r in profile.rules) + " (repeatable)")
    p.add_argument("--hot-trigger", default=HOT_TRIGGER)


def _add_table(p: argparse.ArgumentParser, required: bool = True) -> None:
    p.add_argument("--table", required=required, help="keyed table root")
    p.add_argument("--fraud", action="store_true", help="the table holds fraud aggregates")
    p.add_argument("--base", help="catalogue name of its compacted rows, as the compact job printed it")
    p.add_argument("--base-batch", type=int, help="highest batch that the base covers")


def _table(args) -> KeyedTable:
    table = fraud_table(args.table) if args.fraud else anomaly_table(args.table)
    return replace(table, base=Base(args.base, args.base_batch)) if args.base else table


def _profile(args, profile: RuleProfile) -> RuleProfile:
    thresholds = {k: float(v) for k, v in (kv.split("=", 1) for kv in (args.threshold or []))}
    return profile.with_window(args.window).with_watermark(args.watermark).with_thresholds(**thresholds)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="txnscope")
    sub = parser.add_subparsers(dest="job", required=True)

    p = sub.add_parser("pipeline")
    _add_source(p)
    p.add_argument("--hot", required=True, help="keyed anomaly table root")
    p.add_argument("--lake", required=True, help="cold table folder")
    p.add_argument("--lake-checkpoint", required=True)
    p.add_argument("--cold-trigger", default=COLD_TRIGGER)
    p.add_argument("--unscreened", action="store_true", help="no quarantine: damaged records count as they come")
    _add_profile(p, ANOMALY)

    p = sub.add_parser("fraud")
    _add_source(p)
    p.add_argument("--table", required=True, help="keyed aggregate table root")
    _add_profile(p, FRAUD)

    p = sub.add_parser("late")
    _add_source(p)
    p.add_argument("--out", required=True, help="root of the late rows' table")
    p.add_argument("--fraud", action="store_true", help="windows and watermark of rule set B")
    p.add_argument("--window")
    p.add_argument("--trigger", default=COLD_TRIGGER)

    p = sub.add_parser("open")
    _add_table(p)
    p.add_argument("--out", required=True)

    p = sub.add_parser("report")
    p.add_argument("--lake", required=True)
    p.add_argument("--unscreened", action="store_true", help="the lake was written by an unscreened pipeline")
    p.add_argument("--out", required=True)
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--month", type=int, required=True)

    p = sub.add_parser("feed")
    _add_table(p)
    p.add_argument("--as-of", help="time that records must not have expired at (default: now)")
    p.add_argument("--out", required=True)

    p = sub.add_parser("compact")
    _add_table(p, required=False)
    p.add_argument("--new-base", help="catalogue name for the compacted rows")
    p.add_argument("--new-base-path", help="folder for the compacted rows")
    p.add_argument("--buckets", type=int, default=None)
    p.add_argument("--lake", help="cold table folder to rewrite")
    p.add_argument("--lake-out", help="target folder for rewritten days")
    p.add_argument("--unscreened", action="store_true", help="the lake was written by an unscreened pipeline")
    p.add_argument("--start")
    p.add_argument("--end")

    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"txnscope-{args.job}").getOrCreate()
    pin_utc(spark)

    if args.job in ("pipeline", "fraud"):
        prepare_streaming(spark)
        if args.state_partitions is None and not is_local(spark):
            args.state_partitions = STREAMING_STATE_PARTITIONS
        collector = attach_collector(spark, lambda line: print(line, flush=True))

    if args.job == "pipeline":
        roots = PipelineRoots(hot=args.hot, cold=args.lake, cold_checkpoint=args.lake_checkpoint)
        settings = {
            "available_now": args.available_now, "state_partitions": args.state_partitions,
            "hot_trigger": args.hot_trigger, "cold_trigger": args.cold_trigger,
        }
        source = transaction_stream if args.unscreened else raw_stream
        run = run_both if args.unscreened else run_screened
        started = run(spark, lambda s: source(s, args.source, **_source_kwargs(args)), roots, _profile(args, ANOMALY), **settings)
        if args.available_now:
            for q in started:
                collector.wait(q)
    elif args.job == "fraud":
        q = start_fraud_hot(transaction_stream(spark, args.source, **_source_kwargs(args)), fraud_table(args.table),
                            _profile(args, FRAUD), available_now=args.available_now, trigger=args.hot_trigger,
                            query_name="fraud_hot", state_partitions=args.state_partitions)
        collector.wait(q)
    elif args.job == "late":
        profile = FRAUD if args.fraud else ANOMALY
        q = start_late_rows(transaction_stream(spark, args.source, **_source_kwargs(args)), args.out, profile, args.window,
                            available_now=args.available_now, trigger=args.trigger, query_name="late_rows")
        q.awaitTermination()
    elif args.job == "open":
        open_windows(spark, _table(args).checkpoint, FRAUD if args.fraud else ANOMALY).write.mode("overwrite").parquet(args.out)
    elif args.job == "feed":
        live = _table(args).live(spark, args.as_of)
        views = {
            "serving_feed": serving.serving_feed(live),
            "kpi_summary": serving.kpi_summary(live),
            "flag_breakdown": serving.flag_breakdown(serving.newest(live)),
            "amount_by_window": serving.amount_by_window(live),
        }
        for name, df in views.items():
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.job == "report":
        cold = read_cold(spark, args.lake) if args.unscreened else read_valid(spark, args.lake)
        reports = {
            "high_value_txns": analytics.high_value_txns(cold, year=args.year, month=args.month),
            "top_users": analytics.top_users(cold, year=args.year, month=args.month),
            "hourly_volume": analytics.hourly_volume(cold, year=args.year, month=args.month),
            "top_merchants": analytics.top_merchants(cold, year=args.year),
        }
        for name, df in reports.items():
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    elif args.job == "compact":
        if args.table:
            if not (args.new_base and args.new_base_path):
                parser.error("--table needs --new-base and --new-base-path")
            compacted = _table(args).compact(spark, args.new_base, args.new_base_path, buckets=args.buckets)
            if compacted.base:
                print(f"--base {compacted.base.table} --base-batch {compacted.base.upto}", flush=True)
        if args.lake:
            if not (args.lake_out and args.start and args.end):
                parser.error("--lake needs --lake-out, --start and --end")
            compact_days(spark, args.lake, args.lake_out, args.start, args.end, screened=not args.unscreened)
    return 0


if __name__ == "__main__":
    sys.exit(main())
