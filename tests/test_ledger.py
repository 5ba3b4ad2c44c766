"""Ledger (S2, S3, D1, D2), the daily run (D3) and the delivery file."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from creditflow.plans.daily import run_delivery
from creditflow.schemas import LEDGER, LEDGER_COLUMNS
from creditflow.functions.timeutil import format_ts
from creditflow.sources import export, ledger as L
from creditflow.sources.export import number_text
from creditflow.sources.ledger import Ledger
from tests import fixture_tables as FX

T = dt.datetime.fromisoformat


def _rows(df):
    return sorted((tuple(r) for r in df.select(*LEDGER_COLUMNS).collect()), key=repr)


SEED = [("g1", "GCLID New Buyer MTA Trades", T("2024-07-01 10:00:00"), 1.0, 30.0, "USD", None),
        ("g2", "GCLID Repeat Buyer MTA Trades", T("2024-07-02 10:00:00"), 0.5, 15.0, "USD", False),
        ("g3", "GCLID New Buyer MTA Trades", T("2024-07-03 10:00:00"), 0.25, 7.5, "USD", True)]


def test_row_level_semantics(spark):
    df = spark.createDataFrame(SEED, LEDGER)
    inflight = L.mark_in_flight(df)
    assert sorted((r.gcl_id, r.sftp) for r in inflight.collect()) == [("g1", False), ("g2", False), ("g3", True)]
    done = L.mark_delivered(inflight)
    assert {r.sftp for r in done.collect()} == {True}
    und = L.undelivered(inflight).collect()
    assert sorted((r.gcl_id, r.conversion_time) for r in und) == [("g1", "2024-07-01 10:00:00"),
                                                                   ("g2", "2024-07-02 10:00:00")]


def test_persistent_ledger_matches_row_semantics(spark, scratch):
    seed = spark.createDataFrame(SEED, LEDGER)
    led = Ledger(spark, os.path.join(scratch, "ledger")).create(seed)
    assert _rows(led.read()) == _rows(seed)
    assert led.high_water_mark() == T("2024-07-03 10:00:00")
    new = spark.createDataFrame([("g4", "GCLID New Buyer MTA Trades", T("2024-07-05 09:00:00"), 0.5, 15.0,
                                  "USD", None)], LEDGER)
    batch = led.append(new)
    assert batch == 3
    expected = L.append_rows(seed, new)
    assert _rows(led.read()) == _rows(expected)
    led.mark_in_flight()
    expected = L.mark_in_flight(expected)
    assert _rows(led.read()) == _rows(expected)
    led.mark_delivered()
    expected = L.mark_delivered(expected)
    assert _rows(led.read()) == _rows(expected)
    assert led.high_water_mark() == T("2024-07-05 09:00:00")


def test_rows_of_a_crashed_insert_are_never_published(spark, scratch):
    led = Ledger(spark, os.path.join(scratch, "ledger")).create(spark.createDataFrame(SEED, LEDGER))
    new = spark.createDataFrame([("g9", "x", T("2024-07-06 00:00:00"), 1.0, 30.0, "USD", None)], LEDGER)
    led._write_batch(L.to_ledger_rows(new), 3)   # a crashed run wrote rows but no state
    assert led.read().count() == 3              # invisible without a state version
    led.append(new.limit(0))                    # the rerun finds nothing to insert
    assert _rows(led.read()) == _rows(spark.createDataFrame(SEED, LEDGER))
    assert led.append(new) == 4                 # a later insert has a number of its own
    assert led.read().where(F.col("gcl_id") == "g9").count() == 1


def test_number_text_keeps_all_digits(spark):
    values = [1 / 3, 1 / 7, 1e-5, -1.5e-7, 1e30, 1.25e7, 12345678.5, 1.7976931348623157e308, 0.5, 30.0, -2.0, 0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(number_text(F.col("v")).alias("s"))
    out = [r.s for r in df.collect()]
    assert out[:6] == ["0.3333333333333333", "0.14285714285714285", "0.00001", "-0.00000015", "1" + "0" * 30 + ".0", "12500000.0"]
    assert [None if s is None else float(s) for s in out] == values
    assert not any("E" in s for s in out if s)


def test_time_text_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(T("2024-03-31 02:30:00"),)], "t timestamp_ntz").select(format_ts("t").alias("s"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert df.collect()[0].s == "2024-03-31 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _read_delivery(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    return b"".join(open(p, "rb").read() for p in parts).decode()


def test_delivery_file_format(spark, scratch):
    rows = [("a,b", 'say "hi"', "2024-07-01 10:00:00", 0.00005, 0.0015, "USD"),
            ("g2", "GCLID New Buyer MTA Trades", "2024-07-02 10:00:00", 1.0 / 3, 10.0, None)]
    und = spark.createDataFrame(rows, "gcl_id string, conversion_name string, conversion_time string, "
                                      "attributed_credit double, conversion_value double, conversion_currency string")
    out = os.path.join(scratch, "delivery")
    assert export.write_delivery(und, out) == 2
    text = _read_delivery(out)
    lines = text.split("\r\n")
    assert lines[:3] == ["Parameters:Attribution Model = linear", "Parameters:TimeZone=America/Detroit",
                         "Google Click ID,Conversion Name,Conversion Time,Attributed Credit,Conversion Value,"
                         "Conversion Currency"]
    assert sorted(lines[3:5]) == ['"a,b","say ""hi""",2024-07-01 10:00:00,0.00005,0.0015,USD',
                                  "g2,GCLID New Buyer MTA Trades,2024-07-02 10:00:00,0.3333333333333333,10.0,"]
    assert lines[5:] == [""] and text.endswith("\r\n")
    # nothing to deliver: the previous file stays
    assert export.write_delivery(und.limit(0), out) == 0
    assert _read_delivery(out) == text


def test_daily_run_and_failed_export(spark, scratch):
    tables = FX.frames(spark)
    root = os.path.join(scratch, "ledger")
    Ledger(spark, root).create(tables["ledger"])

    def broken(df, path):
        raise IOError("upload failed")

    with pytest.raises(IOError):
        run_delivery(spark, tables, root, os.path.join(scratch, "out1"), export_fn=broken)
    led = Ledger(spark, root)
    states = {r.sftp: r.n for r in led.read().groupBy("sftp").agg(F.count("*").alias("n")).collect()}
    assert states == {True: 1, False: 5}         # inserted and marked, never finished
    # next run: nothing new (mark moved), the 5 in-flight rows go out again, then finish
    rep = run_delivery(spark, tables, root, os.path.join(scratch, "out2"))
    assert rep.exported_rows == 5
    assert {r.sftp for r in Ledger(spark, root).read().collect()} == {True}
    assert Ledger(spark, root).read().count() == 6
    # same-day rerun inserts nothing and exports nothing
    rep = run_delivery(spark, tables, root, os.path.join(scratch, "out3"))
    assert rep.exported_rows == 0 and Ledger(spark, root).read().count() == 6


def test_cold_start_with_bootstrap_mark(spark, scratch):
    tables = FX.frames(spark)
    root = os.path.join(scratch, "ledger")
    Ledger(spark, root).create()
    rep = run_delivery(spark, tables, root, os.path.join(scratch, "o0"))
    assert rep.exported_rows == 0 and Ledger(spark, root).read().count() == 0   # empty ledger: nothing
    rep = run_delivery(spark, tables, root, os.path.join(scratch, "o1"), bootstrap_mark=FX.MARK)
    assert rep.exported_rows == 5


def test_duplicate_country_keys_stop_the_run(spark, scratch):
    tables = FX.frames(spark)
    tables["iso_2_mapping"] = tables["iso_2_mapping"].unionByName(tables["iso_2_mapping"].limit(1))
    root = os.path.join(scratch, "ledger")
    Ledger(spark, root).create(tables["ledger"])
    with pytest.raises(ValueError, match="duplicate"):
        run_delivery(spark, tables, root, os.path.join(scratch, "o"))
