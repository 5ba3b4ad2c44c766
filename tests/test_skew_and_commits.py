"""Skew on either side of the joins, key sets beyond a broadcast, commits that survive crashes and other writers."""

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from creditflow.operators import joins, linear, touches
from creditflow.plans import daily
from creditflow.plans.attribution import Attribution
from creditflow.schemas import LEDGER, LEDGER_COLUMNS
from creditflow.sources import export, standin
from creditflow.sources import ledger as L
from creditflow.sources.identity import IdentityMap
from creditflow.sources.ledger import Ledger
from creditflow.sources.versions import Folder, Versions
from tests import fixture_tables as FX

T = dt.datetime.fromisoformat
SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- joins --------------------------------------------------------------------

@pytest.mark.parametrize("heavy", ["left", "right", "both"])
def test_grid_join_cuts_the_longer_side(spark, heavy):
    n = {"left": (300, 4), "right": (4, 300), "both": (60, 60)}[heavy]
    left = spark.createDataFrame([("hot", i) for i in range(n[0])] + [("k", 1), ("only", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("hot", i) for i in range(n[1])] + [("k", 7), ("k", 8), (None, 9)], "k string, w int")
    cells = {r.k: (r._ls, r._rs) for r in joins.hot_cells(left, right, ["k"], pairs=50).collect()}
    assert set(cells) == {"hot"}
    ls, rs = cells["hot"]
    assert ls * rs >= n[0] * n[1] / 50 and (ls > 1) == (heavy != "right") and (rs > 1) == (heavy != "left")
    joined = joins.grid_join(left, right, ["k"], lambda a, b: a["v"] != b["w"], pairs=50)
    plain = left.join(right, "k").where("v <> w")
    assert _rows(joined.select("left.k", "left.v", "right.w")) == _rows(plain.select("k", "v", "w"))
    assert joins.hot_cells(left, right, ["k"]) is None
    assert joins.hot_cells(left.limit(0), right, ["k"]) is None


def test_a_long_side_without_enough_rows_is_cut_on_both(spark):
    left = spark.createDataFrame([("hot", i) for i in range(20)], "k string, v int")
    hot = joins.hot_cells(left, left, ["k"], pairs=4).first()
    assert hot._ls == 20 and hot._rs == 5
    joined = joins.grid_join(left, left.withColumnRenamed("v", "w"), ["k"], pairs=4)
    assert joined.count() == 400 and joined.select("left.v", "right.w").distinct().count() == 400


def _pairs(spark, trades, visits, window=14):
    """Plain Python counts of the touch attributes per order key."""
    out = {}
    for (i, u, bid), (user, at, src) in itertools.product(set(trades), visits):
        if u is not None and u == user and bid is not None and at is not None and bid - dt.timedelta(days=window) <= at <= bid:
            key = (i, src, at.date())
            out[key] = out.get(key, 0) + 1
    return sorted((*k, m) for k, m in out.items())


def _touches(spark, visits):
    cols = touches.ENHANCED_COLUMNS
    rows = [tuple({"user_uuid": u, "date_c": at, "source_c": src, "visit_id_c": str(k)}.get(c) for c in cols) for k, (u, at, src) in enumerate(visits)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'timestamp_ntz' if c == 'date_c' else 'string'}" for c in cols))


@pytest.mark.parametrize("window,pairs", [(14, None), (14, 3), (1, None), (0, None)])
def test_counted_inner_days_equal_the_plain_range_join(spark, monkeypatch, window, pairs):
    """Window edges to the second, a buyer with many orders on one day, one with many touches, NULL buyer and bid."""
    if pairs:
        monkeypatch.setattr(joins, "PAIRS_PER_CELL", pairs)
    base = T("2024-07-20 10:30:00")
    trades = [(i, "many", base + dt.timedelta(minutes=i)) for i in range(40)] + [(100, "few", base), (101, None, base), (102, "few", None), (100, "few", base)]
    edge = [base - dt.timedelta(days=window), base, base - dt.timedelta(days=window, seconds=1), base + dt.timedelta(seconds=1)]
    visits = [("few", at, "edge") for at in edge] + [("few", base - dt.timedelta(days=d, hours=3), f"s{d % 2}") for d in range(20)] * 3
    visits += [("many", base - dt.timedelta(days=d), "m") for d in range(3)] + [(None, base, "nobody"), ("few", None, "never")]
    t = spark.createDataFrame(trades, "id long, uuid string, bid_date_time timestamp_ntz")
    keyed = linear.with_order_key(t)
    got = linear.touch_pairs(keyed, _touches(spark, visits), window).join(keyed.select("okey", "id").distinct(), "okey")
    assert sorted(tuple(r) for r in got.select("id", "source_c", "date", "m").collect()) == _pairs(spark, trades, visits, window)
    exact = linear.order_touches(t, _touches(spark, visits), window)
    plain = _pairs(spark, trades, visits, window)
    assert exact.count() == sum(p[-1] for p in plain)


def test_a_hot_order_side_gets_several_salts(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_PER_CELL", 10)
    base = T("2024-07-20 10:30:00")
    orders = spark.createDataFrame([(i, "u", base) for i in range(200)], "id long, uuid string, bid_date_time timestamp_ntz")
    days = linear._windows(orders, ["id"], 14).select("id", "user_uuid", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    visit = _touches(spark, [("u", base - dt.timedelta(days=1), "s")]).withColumn("day", F.to_date("date_c"))
    hot = joins.hot_cells(visit, days, ["user_uuid", "day"]).collect()
    assert [(r._ls, r._rs) for r in hot] == [(1, 20)]
    assert linear.order_touches(orders, visit.drop("day")).count() == 200


def test_order_keys_tell_null_and_text_apart(spark):
    rows = [(1, None, None), (1, "", None), (1, "-", None), (1, "1:x", None), (11, "x", None), (1, "1x", None), (1, "x", T("2024-01-01 00:00:00"))]
    df = linear.with_order_key(spark.createDataFrame(rows, "id long, uuid string, bid_date_time timestamp_ntz"))
    assert df.where("okey is null").count() == 0 and df.select("okey").distinct().count() == len(rows)


def test_interval_join_buckets(spark):
    """Band edges of both widths, a wide and a narrow install near one visit, NULL names; no CASE in the join."""
    at = T("2024-07-14 12:00:00")
    visits = [("u", "(none)", "(direct)", at + dt.timedelta(seconds=s), s) for s in (-11, -10, 0, 10, 11)] + [("u", "(none)", "(direct)", at + dt.timedelta(days=d, seconds=s), 1000 + s)
                                                                                                  for d, s in ((-1, 0), (1, 0), (1, 1), (-1, -1))]
    installs = [("u", "criteo", None, at), ("u", None, "Facebook Ads", at), ("w", "criteo", None, at), ("u", None, None, at + dt.timedelta(seconds=20))]
    v = spark.createDataFrame(visits, "user_uuid string, medium string, source string, date timestamp_ntz, visit_id long")
    i = spark.createDataFrame(installs, "user_uuid string, af_source string, af_medium string, af_date timestamp_ntz")
    got = touches.install_matches(v, i)
    want = [(vis[4], ins[1], ins[2]) for vis in visits for ins in installs if vis[0] == ins[0]
            and abs(vis[3] - ins[3]) <= (dt.timedelta(days=1) if "facebook" in f"{ins[1]}{ins[2]}".lower() else dt.timedelta(seconds=10))]
    assert _rows(got.select("left.visit_id", "right.af_source", "right.af_medium")) == sorted(want, key=repr)
    join_line = next(x for x in _plan(got).split("\n") if "Join" in x)
    assert "CASE" not in join_line.upper()


# ---- key sets -------------------------------------------------------------------

def test_key_sets_beyond_a_broadcast_use_a_bloom_filter(spark, monkeypatch):
    big = spark.range(20_000).select(F.concat(F.lit("key-"), F.col("id")).alias("k"), "id")
    keys = spark.createDataFrame([(f"key-{i * 37}",) for i in range(300)] + [("elsewhere",), (None,)], "k string")
    small = joins.key_set(keys, "k")
    assert small.small and small.count == 301
    monkeypatch.setattr(joins, "KEYS_BROADCAST_MAX_BYTES", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.key_set(keys, "k")
        assert not large.small
        out = joins.semi_reduce(big, "k", large)
        plan = _plan(out)
        assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("BroadcastHashJoin")  # the filter sits below the shuffle
        assert _rows(out) == _rows(joins.semi_reduce(big, "k", small))
        passed = joins.bloom_reduce(big, F.col("k"), large).count()
        assert 300 <= passed < 300 + 0.03 * 20_000
        monkeypatch.setattr(joins, "FILTER_MAX_BYTES", 10)
        assert "BroadcastHashJoin" not in _plan(joins.semi_reduce(big, "k", large))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcasts_are_bounded_in_bytes(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.bounded_broadcast(wide, max_bytes=5_000) is wide
    assert joins.bounded_broadcast(wide, max_bytes=50_000) is not wide


# ---- fact plan ---------------------------------------------------------------------

def test_fact_plan_shuffles(spark):
    """At most eight hash exchanges of its own behind the cut tables, nothing null-safe in the order join."""
    a = Attribution(standin.load(spark, SF), checkpoint=True)
    local = lambda df: spark.createDataFrame(df.collect(), df.schema)
    a.keyed, a.pairs
    first, countries = local(a.first_orders), F.broadcast(local(a.countries))
    stats = linear.order_key_stats(a.keyed, a.pairs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = linear.linear_attribution(a.keyed, a.touches, first, countries, a.window_days, pairs=a.pairs, stats=a.order_stats)
        own = [x for plan in (_plan(stats), _plan(fact)) for x in plan.split("\n") if "Exchange hashpartitioning" in x]
        assert len(own) <= 8
        assert any("hashpartitioning(okey" in x for x in own) and "<=>" not in _plan(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- identity map ----------------------------------------------------------------------

def test_install_touches_are_written_once(spark):
    """Counts and joins of later stages read the written install touches, not the sources again."""
    a = Attribution(standin.load(spark, SF), checkpoint=True)
    assert a.install_touches.inputFiles() and all("/cut-" in f for f in a.install_touches.inputFiles())


def test_joined_rows_are_dealt_once(spark):
    """One order key an id: neither the fact's grouping nor the rank shuffles the joined rows again."""
    a = Attribution(standin.load(spark, SF), checkpoint=True)
    a.fact, a.touches
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange hashpartitioning(d_source_c" not in _plan(a.fact)
        ranked = linear.ranked_order_touches(a.trades, a.touches, a.window_days, a._cut)
        assert not [x for x in _plan(ranked).split("\n") if "Exchange hashpartitioning" in x and "_hour" in x.split("ENSURE")[0] and "okey" not in x]
        assert _plan(ranked).index("Window") < _plan(ranked).index("SortMergeJoin") < _plan(ranked).index("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("several", [False, True])
def test_ranks_and_credits_with_one_or_several_order_keys_an_id(spark, several):
    """Rows that share an id, with equal and (several) with different bid times; touches within an hour, none, NULL touch attributes."""
    base = T("2024-07-20 10:30:00")
    bids = [(1, "u", base), (1, "u", base), (2, "u", base + dt.timedelta(days=1)), (3, "w", base), (4, None, base), (5, "u", None)]
    bids += [(1, "u", base + dt.timedelta(days=2)), (2, "w", base)] if several else []
    trades = spark.createDataFrame([(*b, k % 3) for k, b in enumerate(bids)], "id long, uuid string, bid_date_time timestamp_ntz, fees int")
    visits = [("u", base - dt.timedelta(hours=h, minutes=m), s) for h in (0, 1, 30, 400) for m, s in ((1, "a"), (2, None), (2, "b"))]
    seen = _touches(spark, visits)
    keyed = linear.with_order_key(trades)
    assert linear.one_key_each(keyed) != several
    got = linear.ranked_order_touches(trades, seen, 14)
    want = []
    joined = [(r, v) for r in trades.collect() for v in [x for x in visits if r.uuid == x[0] and r.bid_date_time and r.bid_date_time - dt.timedelta(days=14) <= x[1] <= r.bid_date_time] or [(None, None, None)]]
    for i in {r.id for r, _ in joined}:
        own = sorted((v[1] or T("9999-12-31"), r.uuid or "~", r.bid_date_time or T("9999-12-31"), r.fees, v[2] or "~") for r, v in joined if r.id == i)
        want += [(i, k + 1, o[0], o[3], o[4]) for k, o in enumerate(own)]
    rows = [(r.id, r.touch_rank, r.date_c or T("9999-12-31"), r.fees, r.source_c or "~") for r in got.collect()]
    assert sorted(rows) == sorted(want)


def test_identity_map_after_increments_equals_a_full_build(spark, scratch):
    sessions = standin.load(spark, SF)["sessions"].cache()
    low, high = sessions.agg(F.min("visit_start_time"), F.max("visit_start_time")).first()
    people = IdentityMap(spark, os.path.join(scratch, "people"))
    assert people.read().count() == 0 and people.watermark() is None
    for share in (0.3, 0.6, 1.0, 1.0):
        people.update(sessions.where(F.col("visit_start_time") <= F.lit(low + (high - low) * share)))
    assert people.watermark() == high
    full = touches.identity_map(sessions)
    assert _rows(people.read()) == _rows(full)
    people.compact()
    assert _rows(people.read()) == _rows(full) and len(people._versions.newest()[1]["parts"]) == 1
    assert people.update(sessions.limit(0)) == high
    t = standin.load(spark, SF)
    assert _rows(Attribution(t, people=people.read()).install_touches) == _rows(Attribution(t).install_touches)


def test_a_client_with_many_users_spreads_over_cells(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_PER_CELL", 20)
    columns = [f.name for f in standin.schemas.INSTALLS.fields]
    rows = [dict.fromkeys(columns) | {"uuid": None if i % 2 else "u1", "customer_user_id": "shared" if i < 30 else f"c{i}", "campaign": str(i)} for i in range(40)]
    installs = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], standin.schemas.INSTALLS)
    pairs = [("shared", f"u{k}") for k in range(50)] + [("c31", "u2"), ("c33", "stranger"), (None, "u3")]
    people = spark.createDataFrame(pairs, "client_id string, user_uuid string")
    buyers = joins.key_set(spark.createDataFrame([(f"u{k}",) for k in range(45)], "uuid string"), "uuid")
    got = {(r.campaign, r.r_uuid): r.m for r in touches.resolved_installs(installs, people, buyers).collect()}
    want = {}
    for r in rows:  # the left join, then the buyers
        users = [u for c, u in pairs if c == r["customer_user_id"]] or [None]
        for u in users:
            key = (r["campaign"], r["uuid"] or u)
            if key[1] in {f"u{k}" for k in range(45)}:
                want[key] = want.get(key, 0) + 1
    assert got == want


# ---- commits ------------------------------------------------------------------------------

SEED = [("g1", "a", T("2024-07-01 10:00:00"), 1.0, 30.0, "USD", None), ("g2", "b", T("2024-07-02 10:00:00"), 0.5, 15.0, "USD", False),
        ("g3", "a", T("2024-07-03 10:00:00"), 0.25, 7.5, "USD", True)]
NEW = [("g4", "a", T("2024-07-05 09:00:00"), 1 / 3, 1e-7, "USD", None)]


def _ledger_rows(ledger):
    return _rows(ledger.read().select(*LEDGER_COLUMNS))


def test_versions_are_set_once(spark, scratch):
    v = Versions(spark, os.path.join(scratch, "v"), keep=3)
    assert v.newest() == (0, None)
    assert v.publish(1, {"a": 1}) and not v.publish(1, {"a": 2})
    assert v.newest() == (1, {"a": 1})
    for _ in range(6):
        v.change(lambda c: {"a": c["a"] + 1})
    assert v.newest() == (7, {"a": 7}) and v.numbers() == [5, 6, 7]
    assert v.change(lambda c: None) == (7, {"a": 7})
    assert not [n for n in v.folder.names() if n.startswith("_")]


def test_two_writers_lose_nothing(spark, scratch):
    root = os.path.join(scratch, "ledger")
    one, two = Ledger(spark, root).create(spark.createDataFrame(SEED, LEDGER)), Ledger(spark, root)
    original, calls = one._states.newest, []

    def late():
        found = original()
        if not calls:  # the other writer comes in between this one's read and its publication
            calls.append(two.append(spark.createDataFrame([("g5", *NEW[0][1:])], LEDGER)))
            two.mark_in_flight()
        return found

    batch = one._new_batch(L.to_ledger_rows(spark.createDataFrame(NEW, LEDGER)), None)[1]
    one._states.newest = late
    one._states.change(lambda m: {"batches": m["batches"] + batch})
    states = {r.gcl_id: r.sftp for r in Ledger(spark, root).read().collect()}
    assert states == {"g1": False, "g2": False, "g3": True, "g4": None, "g5": False}


def test_create_after_a_crash_and_twice(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "ledger")
    seed = spark.createDataFrame(SEED, LEDGER)
    with monkeypatch.context() as m:
        m.setattr(Versions, "publish", lambda self, n, c, real=Versions.publish: (_ for _ in ()).throw(IOError("crash")) if "states" in self.folder.path else real(self, n, c))
        with pytest.raises(IOError):
            Ledger(spark, root).create(seed)          # rows written, nothing published
    assert Ledger(spark, root).read().count() == 0
    led = Ledger(spark, root).create(seed)
    assert _ledger_rows(led) == _rows(seed)
    led.append(spark.createDataFrame(NEW, LEDGER))
    with pytest.raises(FileExistsError):
        Ledger(spark, root).create(seed)
    assert led.read().count() == 4


@pytest.mark.parametrize("step", ["append", "mark_in_flight", "mark_delivered"])
def test_a_crash_in_any_step_can_be_rerun(spark, scratch, monkeypatch, step):
    led = Ledger(spark, os.path.join(scratch, "ledger")).create(spark.createDataFrame(SEED, LEDGER))
    before, new = _ledger_rows(led), spark.createDataFrame(NEW, LEDGER)
    run = {"append": lambda: led.append(new), "mark_in_flight": led.mark_in_flight, "mark_delivered": led.mark_delivered}[step]
    with monkeypatch.context() as m:
        m.setattr(led._states, "publish", lambda n, c: (_ for _ in ()).throw(IOError("crash")))
        with pytest.raises(IOError):
            run()
    assert _ledger_rows(Ledger(spark, led.root)) == before
    run()
    seed = spark.createDataFrame(SEED, LEDGER)
    want = {"append": L.append_rows(seed, new), "mark_in_flight": L.mark_in_flight(seed), "mark_delivered": L.mark_delivered(seed)}[step]
    assert _ledger_rows(led) == _rows(want.select(*LEDGER_COLUMNS))


UND = "gcl_id string, conversion_name string, conversion_time string, attributed_credit double, conversion_value double, conversion_currency string"


def _lines(spark, path):
    return sorted(r.line for r in export.read_lines(spark, path).collect())


@pytest.mark.parametrize("at", ["write", "check", "first_rename", "second_rename"])
def test_a_killed_delivery_leaves_the_old_one_readable(spark, scratch, monkeypatch, at):
    path = os.path.join(scratch, "delivery")
    old = spark.createDataFrame([("g1", "n", "2024-07-01 10:00:00", 1 / 3, 1e-7, "USD")], UND)
    new = spark.createDataFrame([("g2", 'two\\r\\nlines "q"', "2024-07-02 10:00:00", 0.5, 2.0, None)], UND)
    assert export.write_delivery(old, path) == 1
    manifest, lines = export.read_manifest(spark, path), _lines(spark, path)
    assert manifest["rows"] == 1 and manifest["lines"] == 4 and len(manifest["parts"]) >= 1
    assert "g1,n,2024-07-01 10:00:00,0.3333333333333333,0.0000001,USD" in lines
    moves = []

    def move(self, a, b, real=Folder.move):
        moves.append(a)
        if len(moves) == {"first_rename": 1, "second_rename": 2}.get(at):
            raise IOError("killed")
        return real(self, a, b)

    with monkeypatch.context() as m:
        m.setattr(Folder, "move", move)
        if at == "write":
            m.setattr(export, "read_lines", lambda *a: (_ for _ in ()).throw(IOError("killed")))
        if at == "check":
            m.setattr(export, "read_lines", lambda s, p, real=export.read_lines: real(s, p).limit(2))
        with pytest.raises((IOError, RuntimeError)):
            export.write_delivery(new, path)
    export.recover(spark, path)
    assert _lines(spark, path) == lines and export.read_manifest(spark, path) == manifest
    assert export.write_delivery(new, path) == 1 and export.read_manifest(spark, path)["rows"] == 1
    assert not [n for n in Folder(spark, scratch).names() if n != "delivery"]


def test_daily_run_with_a_maintained_identity_map(spark, scratch):
    tables = FX.frames(spark)
    reports = []
    for name, identity in (("a", None), ("b", os.path.join(scratch, "people"))):
        Ledger(spark, os.path.join(scratch, name)).create(tables["ledger"])
        reports.append(daily.run_delivery(spark, tables, os.path.join(scratch, name), os.path.join(scratch, "out" + name), identity_root=identity))
    assert reports[0].exported_rows == reports[1].exported_rows == 5
    assert _lines(spark, os.path.join(scratch, "outa")) == _lines(spark, os.path.join(scratch, "outb"))
