"""Cold table: partition layout, pruning, pushdown, column pruning, catalog registration."""

from __future__ import annotations

import os

import pytest

from txnscope.operators.analytics import high_value_txns, partition_counts, top_users
from txnscope.sinks.lake import cold_range, read_cold, register_table, write_cold

from tests.conftest import SF001, txn_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_columns_and_null_time(spark, tmp_path):
    path = str(tmp_path / "cold")
    rows = [("1", "u", 5.0, "2024-01-01 10:00:00"), ("2", "u", 6.0, "2024-01-02 23:59:59")]
    txns = txn_frame(spark, rows).unionByName(
        spark.createDataFrame([("3", "u", 7.0, None, None, None, None)], txn_frame(spark, rows).schema)
    )
    write_cold(txns, path)
    cold = read_cold(spark, path)
    assert dict(cold.dtypes)["year"] == "int"
    assert sorted((r.year, r.month, r.day, r.txn_count) for r in partition_counts(cold).collect() if r.year) == [
        (2024, 1, 1, 1),
        (2024, 1, 2, 1),
    ]
    assert any(name == "year=__HIVE_DEFAULT_PARTITION__" for name in os.listdir(path))
    assert cold.where("year IS NULL").count() == 1


def test_month_query_prunes_and_pushes_down(spark, tmp_path):
    from txnscope.sources.events import load_transactions

    path = str(tmp_path / "cold")
    write_cold(load_transactions(spark, SF001), path)
    cold = read_cold(spark, path)
    plan = _plan(high_value_txns(cold, year=2024, month=1))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,2000.0)]" in plan
    assert "TakeOrderedAndProject" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "merchant_category" not in scan.split("ReadSchema:")[1]  # column pruning
    assert high_value_txns(cold, year=2023, month=1).count() == 0
    assert top_users(cold, year=2024, month=1).count() == 10


def test_cold_range_prunes(spark, tmp_path):
    path = str(tmp_path / "cold")
    rows = [(str(d), "u", 1.0, f"2024-01-{d:02d} 12:00:00") for d in range(1, 11)]
    write_cold(txn_frame(spark, rows), path)
    sel = cold_range(read_cold(spark, path), "2024-01-03", "2024-01-05")
    assert sorted(r.transaction_id for r in sel.collect()) == ["3", "4"]
    assert "PartitionFilters" in _plan(sel)


def test_register_table_and_repair(spark, tmp_path):
    path = str(tmp_path / "cold")
    write_cold(txn_frame(spark, [("1", "u", 5.0, "2024-01-01 10:00:00")]), path)
    name = register_table(spark, path, database="txn_test_db", database_location=str(tmp_path / "db"))
    assert spark.table(name).count() == 1
    write_cold(txn_frame(spark, [("2", "u", 5.0, "2024-01-03 10:00:00")]), path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert spark.table(name).count() == 2
    assert spark.sql(f"SELECT count(*) AS n FROM {name} WHERE day = 3").first().n == 1


def test_compact_days_rewrites_range(spark, tmp_path):
    from txnscope.sinks.lake import compact_days

    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    for d in range(1, 4):  # three separate small appends, as a streaming sink leaves them
        write_cold(txn_frame(spark, [(f"{d}{i}", "u", 1.0, f"2024-01-0{d} 0{i}:00:00") for i in range(3)]), src)
    compact_days(spark, src, dst, "2024-01-01", "2024-01-03")
    out = read_cold(spark, dst)
    assert sorted(r.transaction_id for r in out.collect()) == ["10", "11", "12", "20", "21", "22"]


def test_overwrite_replaces_only_present_days(spark, tmp_path):
    path = str(tmp_path / "cold")
    write_cold(txn_frame(spark, [("1", "u", 1.0, "2024-01-01 01:00:00"), ("2", "u", 1.0, "2024-01-02 01:00:00")]), path)
    rerun = txn_frame(spark, [("3", "u", 1.0, "2024-01-02 02:00:00")])
    write_cold(rerun, path, mode="overwrite")
    write_cold(rerun, path, mode="overwrite")  # a second re-run changes nothing
    assert sorted(r.transaction_id for r in read_cold(spark, path).collect()) == ["1", "3"]


def test_compact_days_refuses_part_of_a_day(spark, tmp_path):
    from txnscope.sinks.lake import compact_days

    with pytest.raises(ValueError, match="whole days"):
        compact_days(spark, str(tmp_path / "src"), str(tmp_path / "dst"), "2024-01-01", "2024-01-02 12:00:00")


def test_merchants_by_year_cover_all_its_months(spark):
    from txnscope.operators.analytics import top_merchants
    from txnscope.sinks.lake import with_partition_columns

    rows = [("a", "u", 1.0, "2023-12-31 00:00:00"), ("b", "u", 2.0, "2024-01-05 00:00:00"), ("c", "u", 4.0, "2024-07-05 00:00:00")]
    found = top_merchants(with_partition_columns(txn_frame(spark, rows)), year=2024).collect()
    assert [(r.txn_count, r.max_amount) for r in found] == [(2, 4.0)]
