"""Registered queries: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Each runs the library's own operators over the stand-in logical tables
built from the driver's parquet files at ``sf_dir`` (whole tables, no
sampling).  Doubles that are sums are rounded to 6 places (``round6``) so the
results compare exactly with the DuckDB oracle (``creditflow.plans.oracle``).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import schemas
from creditflow.functions import rules as R
from creditflow.functions.timeutil import format_ts, local_order_time
from creditflow.operators import linear, orders, touches
from creditflow.plans.attribution import Attribution
from creditflow.plans.daily import run_delivery
from creditflow.session import checkpoint_dir
from creditflow.sources import export, standin, tables
from creditflow.sources.identity import IdentityMap
from creditflow.sources.ledger import Ledger, undelivered


def round6(c):
    """Half-up rounding to 6 decimals by plain IEEE arithmetic (after snapping to 8).

    ``F.round`` decides ties on the shortest decimal form of the double,
    other engines on its exact binary value; this form gives the same
    double in any engine for the same input, so results compare exactly.
    """
    return F.floor(F.floor(c * F.lit(1e8) + F.lit(0.5)) / F.lit(100) + F.lit(0.5)) / F.lit(1e6)


def round9(c):
    """The same to 9 decimals, where small credits must not vanish."""
    return F.floor(F.floor(c * F.lit(1e11) + F.lit(0.5)) / F.lit(100) + F.lit(0.5)) / F.lit(1e9)


def _r(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, round6(F.col(c)))
    return df


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as the nearest doubles, for a comparison that knows no decimals."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema.fields])


def _t(spark: SparkSession, sf_dir: str) -> dict:
    return standin.load(spark, sf_dir)


def _run(spark, sf_dir, variant="all") -> Attribution:
    return Attribution(_t(spark, sf_dir), variant=variant, checkpoint=True)


# -- C1 / C2 / C3 ----------------------------------------------------------

def q_high_water_mark(spark, sf_dir):
    return orders.high_water_mark(_t(spark, sf_dir)["ledger"])


def q_incremental_orders(spark, sf_dir):
    a = _run(spark, sf_dir)
    b = a.bounds
    o = a.t["orders"].where(orders.after_mark(F.col("created_at"), b.mark))
    o = o.where(F.col("created_at") < orders.ts_lit(b.newest_visit))
    return o.select("id", "created_at", local_order_time("created_at").alias("order_date"))


def q_eligible_orders(spark, sf_dir):
    return _doubles(_run(spark, sf_dir).trades)


def q_buyers(spark, sf_dir):
    return _run(spark, sf_dir).buyers


def q_sale_indicator(spark, sf_dir):
    t = _t(spark, sf_dir)
    o = t["orders"].select("id", local_order_time("created_at").alias("order_date"))
    j = (o.join(t["order_items"], o.id == F.col("order_id"), "left")
         .join(t["product_market_cache"], F.col("sku_uuid_bin") == F.col("sku_uuid"), "left"))
    return (j.select("id", "sku_uuid_bin", "release_date", "order_date",
                     orders.sale_indicator(F.col("order_date"), F.col("release_date")).alias("sale_ind"))
            .groupBy("id", "sku_uuid_bin", "release_date", "order_date", "sale_ind")
            .agg(F.count(F.lit(1)).alias("n")))


def q_logic_flag(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    return o.select("id", "bid_user_id", "status",
                    R.logic_flag(F.col("bid_user_id"), F.col("status")).alias("logic_flag"))


def q_adjustment_pivot(spark, sf_dir):
    return _doubles(orders.adjustment_pivot(_t(spark, sf_dir)["order_adjustments"]))


def q_buyer_purchase_price(spark, sf_dir):
    t = _t(spark, sf_dir)
    piv = orders.adjustment_pivot(t["order_adjustments"])
    piv = piv.select(*[F.col(c).alias("g_" + c) for c in piv.columns])
    o = t["orders"]
    j = o.join(piv, (F.col("g_chain_id") == F.col("ask_chain_id")) & (F.col("g_order_id") == F.col("id")), "left")
    return _doubles(j.select("id", orders.buyer_purchase_price("g_").alias("buyer_purchase_price")))


# -- C5-C8 -------------------------------------------------------------------

def _identities(spark, sessions) -> IdentityMap:
    """The maintained map after two updates: the sessions up to the middle of their time, then all."""
    low, high = sessions.agg(F.min("visit_start_time"), F.max("visit_start_time")).first()
    people = IdentityMap(spark, _scratch(spark, "identity"))
    if low is not None:
        people.update(sessions.where(F.col("visit_start_time") <= orders.ts_lit(low + (high - low) / 2)))
    people.update(sessions)
    return people


def q_identity_map(spark, sf_dir):
    return _identities(spark, _t(spark, sf_dir)["sessions"]).read()


def q_install_channel(spark, sf_dir):
    a = _t(spark, sf_dir)["appsflyer_data_locker"]
    env = R.cols(source="media_source", medium="af_channel")
    return (a.select("media_source", "af_channel", R.install_channel(env).alias("source_clean"))
            .groupBy("media_source", "af_channel", "source_clean").agg(F.count(F.lit(1)).alias("n")))


def q_install_device(spark, sf_dir):
    a = _t(spark, sf_dir)["appsflyer_data_locker"]
    return (a.select("device_type", R.install_device().spark(R.cols("device_type")).alias("device_mapping"))
            .groupBy("device_type", "device_mapping").agg(F.count(F.lit(1)).alias("n")))


def q_session_channel(spark, sf_dir):
    s = _t(spark, sf_dir)["sessions"]
    s = s.withColumn("path", R.session_path(F.col("source"), F.col("medium")))
    env = R.cols("source", "medium", "path")
    return (s.select("source", "medium", R.session_channel().spark(env).alias("source_clean"))
            .groupBy("source", "medium", "source_clean").agg(F.count(F.lit(1)).alias("n")))


def q_session_device(spark, sf_dir):
    s = _t(spark, sf_dir)["sessions"]
    env = R.cols("browser", "datasource", "device_category", "operating_system")
    keys = ["browser", "datasource", "device_category", "operating_system"]
    return (s.select(*keys, R.session_device().spark(env).alias("device_mapping"),
                     R.session_source_label().spark(env).alias("d_source"))
            .groupBy(*keys, "device_mapping", "d_source").agg(F.count(F.lit(1)).alias("n")))


def q_country_normalise(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = t["sessions"].withColumn("country_key", R.country_name().spark(R.cols("country")))
    dim = t["iso_2_mapping"].select(F.col("name").alias("iso_name"), "alpha2")
    j = s.join(dim, F.col("iso_name") == F.col("country_key"), "left")
    return (j.select("country", "country_key", R.alpha2_fix().spark(R.cols("alpha2")).alias("country_code"))
            .groupBy("country", "country_key", "country_code").agg(F.count(F.lit(1)).alias("n")))


def q_install_touches(spark, sf_dir):
    t = _t(spark, sf_dir)
    return Attribution(t, checkpoint=True, people=_identities(spark, t["sessions"]).read()).install_touches


def q_session_touches(spark, sf_dir):
    return _run(spark, sf_dir).session_touches


def q_enhanced_touches(spark, sf_dir):
    return _run(spark, sf_dir).touches


# -- C9-C14 ------------------------------------------------------------------

def q_order_touches(spark, sf_dir):
    a = _run(spark, sf_dir)
    return linear.order_touches(a.trades, a.touches, a.window_days)


def q_touch_rank(spark, sf_dir):
    """Every joined (order row, touch) numbered within its order by touch time."""
    a = _run(spark, sf_dir)
    return _doubles(linear.ranked_order_touches(a.trades, a.touches, a.window_days, a._cut))


def q_touch_count(spark, sf_dir):
    return _run(spark, sf_dir).touch_count


def q_first_orders(spark, sf_dir):
    return orders.first_orders(_t(spark, sf_dir)["first_order_bids"])


def q_channel_map(spark, sf_dir):
    s = _t(spark, sf_dir)["sessions"]
    env = R.cols(source="source", medium="medium")
    return (s.select("source", "medium", R.channel_map().spark(env).alias("map"))
            .groupBy("source", "medium", "map").agg(F.count(F.lit(1)).alias("n")))


def q_channel_group(spark, sf_dir):
    s = _t(spark, sf_dir)["sessions"].withColumn("path", R.session_path(F.col("source"), F.col("medium")))
    env = R.cols("source", "medium", "campaign", "path")
    s = s.withColumn("source_clean", R.session_channel().spark(env))
    env["source_clean"] = F.col("source_clean")
    s = s.withColumn("map", R.channel_map().spark(env))
    env["map"] = F.col("map")
    s = (s.withColumn("group_raw", R.channel_group().spark(env))
         .withColumn("group_raw_1", F.trim(F.split_part("group_raw", F.lit("-"), F.lit(1))))
         .withColumn("group_raw_2", F.trim(F.split_part("group_raw", F.lit("-"), F.lit(2)))))
    keys = ["source", "medium", "campaign", "source_clean", "map", "group_raw", "group_raw_1", "group_raw_2"]
    return s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def q_vertical(spark, sf_dir):
    p = _t(spark, sf_dir)["product_market_cache"]
    return (p.select("product_category", R.vertical_name().spark(R.cols(vertical="product_category"))
                     .alias("vertical_name"))
            .groupBy("product_category", "vertical_name").agg(F.count(F.lit(1)).alias("n")))


def q_region(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t["order_addresses"].select(F.col("country_id").alias("country"))
    a = a.withColumn("country_key", R.order_country_key().spark(R.cols("country")))
    dim = t["iso_2_mapping"]
    j = a.join(dim, F.col("alpha2") == F.col("country_key"), "left")
    return (j.select("country", "country_key", R.financial_region().spark(R.cols("alpha2", "financial_regions"))
                     .alias("financial_region"))
            .groupBy("country", "country_key", "financial_region").agg(F.count(F.lit(1)).alias("n")))


def q_buyer_type(spark, sf_dir):
    t = _t(spark, sf_dir)
    fo = orders.first_orders(t["first_order_bids"])
    j = t["orders"].join(fo, F.col("id") == F.col("order_id"), "left")
    return j.select("id", F.when(F.col("id") == F.col("order_id"), R.NEW_BUYER)
                    .otherwise(R.RETURN_BUYER).alias("type"))


def q_linear_attribution(spark, sf_dir):
    return _doubles(_r(_run(spark, sf_dir).fact, *linear.MEASURES))


def q_channel_credit(spark, sf_dir):
    """Credit, GMV and fees per channel group (the flagship report)."""
    f = _run(spark, sf_dir).fact
    g = (f.groupBy("group_raw_1", "group_raw_2")
         .agg(F.sum("source_attr").alias("credit"), F.sum("gmv_source_attr").alias("gmv"),
              F.sum("fees_source_attr").alias("fees"), F.countDistinct("id").alias("orders")))
    return _r(g, "credit", "gmv", "fees")


def q_conversions_all_buyers(spark, sf_dir):
    return _r(_run(spark, sf_dir).conversions, "attributed_credit", "conversion_value")


def q_conversions_new_buyers(spark, sf_dir):
    return _r(_run(spark, sf_dir, "new").conversions, "attributed_credit", "conversion_value")


# -- S1 ------------------------------------------------------------------------

def q_source_contract(spark, sf_dir):
    """What each logical column of the sources holds, and what its cast loses."""
    t = _t(spark, sf_dir)
    parts = [tables.contract_report(t[name], name) for name in schemas.LOGICAL_TABLES]
    return reduce(DataFrame.unionByName, parts).select("table_name", "column_name", "is_missing", "n_rows", "n_values", "n_lost", "n_changed")


def q_pruned_sources(spark, sf_dir):
    """Session touches from tables laid out by day and read by the mark."""
    t, root = _t(spark, sf_dir), _scratch(spark, "sources")
    for name in tables.BY_DAY:
        tables.write_by_day(t[name], name, f"{root}/{name}")
    bounds = orders.resolve_bounds(t["ledger"], t["sessions"])
    read = tables.read_tables(spark, {name: f"{root}/{name}" for name in tables.BY_DAY}, bounds.mark)
    return Attribution(dict(t, **read), bounds=bounds, checkpoint=True).session_touches


# -- S2-S5, D1-D3 -------------------------------------------------------------

def _scratch(spark, name):
    """A new path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/creditflow/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _appended(spark, sf_dir) -> Ledger:
    """The persistent ledger, seeded and with the run's conversions inserted."""
    a = _run(spark, sf_dir)
    ledger = Ledger(spark, _scratch(spark, "ledger")).create(a.t["ledger"])
    ledger.append(a.conversions)
    return ledger


def _marked(spark, sf_dir) -> Ledger:
    ledger = _appended(spark, sf_dir)
    ledger.mark_in_flight()
    return ledger


def q_ledger_append(spark, sf_dir):
    return _r(_appended(spark, sf_dir).read(), "attributed_credit", "conversion_value")


def q_mark_in_flight(spark, sf_dir):
    return _r(_marked(spark, sf_dir).read(), "attributed_credit", "conversion_value")


def q_mark_delivered(spark, sf_dir):
    ledger = _marked(spark, sf_dir)
    ledger.mark_delivered()
    return _r(ledger.read(), "attributed_credit", "conversion_value")


def q_undelivered(spark, sf_dir):
    return _r(undelivered(_marked(spark, sf_dir).read()), "attributed_credit", "conversion_value")


def _parsed(lines: DataFrame) -> DataFrame:
    """The fields of a delivery's lines, read back as CSV; numbers rounded to 9 places for comparison only."""
    head = [",".join([p]) for p in export.PREAMBLE] + [",".join(export.HEADER)]
    fields = F.from_csv("line", ", ".join(f"f{k} string" for k in range(1, 7)), {"escape": '"'}).alias("f")
    part = F.when(F.col("line").isin(head), "head").otherwise("row").alias("part")
    rows, row = lines.select(part, fields).select("part", "f.*"), F.col("part") == "row"
    text = lambda c: F.when(~row, F.col(c)).alias(c)
    number = lambda c: round9(F.when(row, F.col(c)).cast("double"))
    return rows.select("part", "f1", "f2", "f3", text("f4"), text("f5"), "f6",
                       number("f4").alias("attributed_credit"), number("f5").alias("conversion_value"))


def q_delivery_file(spark, sf_dir):
    """The delivery as written, read back from its part files."""
    path = _scratch(spark, "delivery")
    export.write_delivery(undelivered(_marked(spark, sf_dir).read()), path)
    return _parsed(export.read_lines(spark, path))


def q_daily_run(spark, sf_dir):
    """D3: insert, mark, export, finish; the delivered rows and the ledger after the run."""
    t, path, root = _t(spark, sf_dir), _scratch(spark, "delivery"), _scratch(spark, "ledger")
    Ledger(spark, root).create(t["ledger"])
    run_delivery(spark, t, root, path)
    rows = _parsed(export.read_lines(spark, path)).where("part = 'row'")
    numbers = ["attributed_credit", "conversion_value"]
    file = rows.select(F.lit("file").alias("place"), F.col("f1").alias("gcl_id"), F.col("f2").alias("conversion_name"), F.col("f3").alias("conversion_time"),
                       *numbers, F.col("f6").alias("conversion_currency"), F.lit(None).cast("boolean").alias("sftp"))
    kept = Ledger(spark, root).read().select(F.lit("ledger").alias("place"), "gcl_id", "conversion_name", format_ts("conversion_time").alias("conversion_time"),
                                             *[round9(F.col(c)).alias(c) for c in numbers], "conversion_currency", "sftp")
    return file.unionByName(kept)


QUERIES = {name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
