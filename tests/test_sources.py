"""The source contract, and reads by day that the mark prunes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from creditflow.sources import tables
from tests import fixture_tables as FX


def test_contract_report_counts_lost_and_changed_values(spark):
    rows = [("1", 10.5, "2024-07-01 10:00:00", 7.0, None), ("x", 11.0, "never", 7.5, "b"), (None, None, None, None, "c"), ("99999999999999999999", 1.0, "2024-07-02", 1e30, "")]
    df = spark.createDataFrame(rows, "id string, subtotal double, created_at string, bid_user_id double, bid_chain_id string")
    report = {r.column_name: r for r in tables.contract_report(df, "orders").collect()}
    assert (report["id"].n_values, report["id"].n_lost, report["id"].n_changed) == (3, 2, 0)
    assert (report["created_at"].n_values, report["created_at"].n_lost) == (3, 1)
    assert (report["bid_user_id"].n_values, report["bid_user_id"].n_lost, report["bid_user_id"].n_changed) == (3, 1, 1)
    assert (report["subtotal"].n_lost, report["subtotal"].n_changed, report["bid_chain_id"].n_values) == (0, 0, 3)
    assert report["status"].is_missing and report["status"].n_values == 0 and report["id"].n_rows == 4
    kept = tables.conform(df, "orders").orderBy(F.col("subtotal")).collect()
    assert [r.id for r in kept] == [None, None, 1, None] and {r.status for r in kept} == {None}
    with pytest.raises(ValueError, match="id .string as bigint. loses 2.*status is missing"):
        tables.require_contract(df, "orders")
    tables.require_contract(FX.frames(spark)["orders"], "orders")
    assert tables.contract_report(df.limit(0), "orders").agg(F.sum("n_rows"), F.sum("n_lost")).first() == (0, 0)


def test_reads_by_day_are_pruned_by_the_mark(spark, scratch):
    frames = FX.frames(spark)
    for name in tables.BY_DAY:
        tables.write_by_day(frames[name], name, os.path.join(scratch, name))
    read = tables.read_root(spark, scratch, list(tables.BY_DAY), FX.MARK)
    for name, (column, windows) in tables.BY_DAY.items():
        since = FX.MARK - dt.timedelta(days=14 * windows)
        want = frames[name].where(F.col(column) > F.lit(since))
        assert sorted(map(repr, read[name].collect())) == sorted(map(repr, want.collect()))
        plan = read[name]._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.split("\n") if "FileScan" in x)
        assert "_day" in scan.split("PartitionFilters: [")[1].split("]")[0] and f"GreaterThan({column}" in scan
    whole = tables.read_table(spark, "sessions", os.path.join(scratch, "sessions"))
    assert whole.count() == frames["sessions"].count() and "_day" not in whole.columns
    flat = os.path.join(scratch, "flat")
    frames["orders"].write.parquet(flat)
    assert tables.read_table(spark, "orders", flat, FX.MARK).count() == read["orders"].count()
