"""Physical plan shape: one shuffle per aggregate, partial aggregation, no broadcast, top-k."""

from __future__ import annotations

from txnscope.plans.catalog import QUERIES

from tests.conftest import SF001


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_aggregate_single_shuffle_with_partial_agg(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(QUERIES["anomaly_records"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "partial_max" in plan
    assert "Broadcast" not in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    read_schema = scan.split("ReadSchema:")[1]
    assert "props" not in read_schema and "event_type" not in read_schema


def test_topk_not_full_sort(spark):
    for name in ("high_value_txns", "top_users", "top_merchants", "serving_feed"):
        plan = physical(QUERIES[name](spark, SF001))
        assert "TakeOrderedAndProject" in plan, name


def test_no_python_udfs_anywhere(spark):
    for name, q in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = physical(q(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def _walk(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def test_hot_user_collapses_before_shuffle(spark):
    """A user with a third of all rows crosses the exchange as one row per map task."""
    from txnscope.config import ANOMALY
    from txnscope.operators.windows import aggregate

    tasks, n = 8, 120_000
    txns = spark.range(0, n, numPartitions=tasks).selectExpr(
        "CAST(id AS STRING) AS transaction_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('user_', CAST(id % 2000 AS STRING)) END AS user_id",
        "CAST(id % 997 AS DOUBLE) AS amount",
        "'m' AS merchant",
        "CAST(NULL AS STRING) AS merchant_category",
        "timestamp_seconds(1704067200 + id % 86400) AS arrival_time",
        "timestamp_seconds(1704067200 + id % 86400) AS event_timestamp",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = aggregate(txns, ANOMALY, "1 day")
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    partial = [
        node for node in _walk(plan)
        if node.nodeName() == "HashAggregate" and "partial_count" in node.simpleString(400)
    ]
    (node,) = partial
    shuffled = node.metrics().get("numOutputRows").get().value()
    assert shuffled <= len(rows) * tasks  # at most one row per group per map task
    assert [r.transaction_count for r in rows if r.user_id == "hot"] == [n // 3]


def test_sliding_windows_use_panes_on_batch(spark):
    """Batch sliding windows: exchange on (pane, user), exchange on user and group of window
    starts, then the window expansion and merge run without a third exchange."""
    from txnscope.config import ANOMALY, FRAUD
    from txnscope.operators.windows import aggregate
    from txnscope.sources.events import load_transactions

    txns = load_transactions(spark, SF001)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(aggregate(txns, ANOMALY, "5 minutes", slide="1 minute"))
        sketches = physical(aggregate(txns, FRAUD, "5 minutes", slide="1 minute"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line]
    generate = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert len(exchanges) == 2 and all(i > generate for i in exchanges)  # both below the expansion
    assert "user_id" in lines[exchanges[0]] and "starts" in lines[exchanges[0]]
    assert "Expand" not in sketches and sketches.count("Exchange") == 2
