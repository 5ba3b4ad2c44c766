"""Conversions from narrow pairs equal those of the whole fact; rule chains lower a value once."""

import datetime as dt

import pytest

from creditflow.operators import linear, touches
from creditflow.plans.attribution import Attribution
from creditflow.sources import standin
from tests import fixture_tables as FX

T = dt.datetime.fromisoformat
SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("variant", ["all", "new"])
@pytest.mark.parametrize("source", ["fixture", "standin"])
def test_conversions_equal_those_of_the_whole_fact(spark, variant, source):
    a = Attribution(FX.frames(spark) if source == "fixture" else standin.load(spark, SF), variant=variant, checkpoint=True)
    whole = (linear.conversions_new_buyers if variant == "new" else linear.conversions_all_buyers)(a.fact)
    got = _rows(a.conversions)
    assert got and got == _rows(whole)
    for column in ("group_raw", "campaign_c", "keyword_c"):
        assert column not in _plan(a.conversions)  # neither grouped nor shuffled


def test_touches_without_a_click_id_are_only_counted(spark):
    at = T("2024-07-20 10:30:00")
    rows = [("u", "g", None, "a"), ("u", "g", "", "a"), ("u", "g", None, "a"), ("u", "g", "x", None), ("u", None, "x", "a"), ("u", None, "y", None), ("u", None, None, "b")]
    cols = touches.ENHANCED_COLUMNS
    data = [tuple({"user_uuid": u, "gcl_id": g, "campaign_c": c, "country_code_c": k, "date_c": at - dt.timedelta(days=3)}.get(x) for x in cols) for u, g, c, k in rows]
    seen = spark.createDataFrame(data, ", ".join(f"{c} {'timestamp_ntz' if c == 'date_c' else 'string'}" for c in cols))
    trades = linear.with_order_key(spark.createDataFrame([(1, "u", at)], "id long, uuid string, bid_date_time timestamp_ntz"))
    pairs = linear.touch_pairs(trades, linear.click_touches(seen), 14, linear.CLICK_ATTRS)
    assert sorted((r.gcl_id or "-", r.country_code_c or "-", r.m) for r in pairs.collect()) == [("-", "-", 3), ("g", "-", 1), ("g", "a", 1), ("g", "a", 2)]
    stats = linear.order_key_stats(trades, pairs).collect()
    assert [(r.r, r.t) for r in stats] == [(1, 7)] == [(r.r, r.t) for r in linear.order_key_stats(trades, linear.touch_pairs(trades, seen, 14)).collect()]


def test_rule_chains_lower_a_value_once(spark):
    a = Attribution(standin.load(spark, SF))
    assert _plan(a.session_touches).count("lower(source") <= 2
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000  # what the JVM still compiles
