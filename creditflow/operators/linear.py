"""Linear attribution: order <-> touch range join, touch count, credit split
and the conversion rows (C9-C14).

Semantics (equal to a left join of every eligible-order row to every touch
of its buyer in ``[bid - window, bid]``, each joined row getting ``1/n`` of
the order where ``n`` counts all joined rows of the order, a touch-less
order keeping one row of NULL touch columns):

* ``order_touches``: the exact (order, touch) pairs, by a day-bucketed
  equi-join on (buyer, day) with the window as residual condition.
* ``touch_pairs``: the same pairs as counts of the touch attributes that reach
  the fact.  Only the day of a touch does, so on the days wholly inside a
  window orders meet a day's touches already counted; single touches are
  looked at on the window's first and last day alone.
* Both are ``grid_join``: a (buyer, day) with many pairs is cut along its
  longer side, be that the touches or the orders.
* ``touch_count``: ``n`` per order from aggregates (no window over a
  possibly huge order partition): ``n = sum over order keys of
  rows(order key) * max(touches(order key), 1)``.
* ``linear_attribution``: orders and counted touches meet on the order's
  non-null surrogate key ``okey``; each group sums ``multiplicity / n``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow.functions import rules as R
from creditflow.functions.timeutil import shift
from creditflow.operators.joins import grid_join, hot_cells
from creditflow.operators.orders import WINDOW_DAYS

ORDER_KEY = ["id", "uuid", "bid_date_time"]
# Touch attributes that reach the fact (date_c only through its day).
PAIR_ATTRS = ["d_source_c", "gcl_id", "source_clean_c", "source_c", "medium_c", "campaign_c",
              "adset_c", "keyword_c", "country_code_c", "device_mapping_c", "date"]
FACT_KEYS = ["d_source_c", "uuid", "id", "subtotal", "order_date", "date", "gcl_id",
             "source_clean_c", "map", "source_c", "medium_c", "campaign_c", "adset_c",
             "keyword_c", "group_raw", "group_raw_1", "group_raw_2", "country",
             "device_mapping_c", "vertical_name", "product_uuid", "sale_ind",
             "financial_region", "type"]
MEASURES = ["source_attr", "gmv_source_attr", "fees_source_attr"]
# What a conversion reads of a touch; ``rest`` stands for the attributes that only part fact rows.
CLICK_ATTRS = ["gcl_id", "country_code_c", "rest", "date"]


def _surrogate(columns: list[str]) -> Column:
    """128-bit hash of an encoding of ``columns`` that keeps NULL and text apart."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in columns]
    return F.unhex(F.md5(F.concat(*parts)))


def order_key() -> Column:
    """Non-null surrogate of ``ORDER_KEY``."""
    return _surrogate(ORDER_KEY)


def with_order_key(trades: DataFrame) -> DataFrame:
    return trades if "okey" in trades.columns else trades.withColumn("okey", order_key())


def _windows(trades: DataFrame, columns: list[str], window_days: int) -> DataFrame:
    """Distinct order keys with buyer and window; orders without a bid time have none."""
    return (trades.where(F.col("bid_date_time").isNotNull()).select(*columns, F.col("uuid").alias("user_uuid"), "bid_date_time").distinct()
            .withColumn("lo", shift("bid_date_time", -window_days, "day"))
            .withColumns({"first_day": F.to_date("lo"), "last_day": F.to_date("bid_date_time")}))


def _in_window(touch: DataFrame, order: DataFrame) -> Column:
    return (touch["date_c"] >= order["lo"]) & (touch["date_c"] <= order["bid_date_time"])


def order_touches(trades: DataFrame, touches: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """(order key, touch) pairs with ``date_c`` in ``[bid - window, bid]``.

    Inner pairs only; touch-less orders are handled by the callers.
    """
    orders = _windows(trades, ["id"], window_days)
    orders = orders.select("id", "user_uuid", "bid_date_time", "lo", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    j = grid_join(touches.withColumn("day", F.to_date("date_c")), orders, ["user_uuid", "day"], _in_window)
    return j.select("right.id", F.col("right.user_uuid").alias("uuid"), "right.bid_date_time",
                    *["left." + c for c in touches.columns if c != "user_uuid"])


def click_touches(touches: DataFrame) -> DataFrame:
    """Every touch with what the conversions read of it (``CLICK_ATTRS``).

    The other attributes part the fact's rows without being read, so their
    surrogate ``rest`` does for them.  Touches without a click id are but
    counted in an order's shares: those of a buyer and day are left alike.
    """
    click = F.col("gcl_id").isNotNull()
    rest = [c for c in PAIR_ATTRS if c not in CLICK_ATTRS]
    return touches.select("user_uuid", "date_c", "gcl_id", F.when(click, F.col("country_code_c")).alias("country_code_c"),
                          F.when(click, _surrogate(rest)).alias("rest"))


def touch_pairs(trades: DataFrame, touches: DataFrame, window_days: int = WINDOW_DAYS, pair_attrs: list[str] | None = None) -> DataFrame:
    """C9 counted: ``okey``, the attributes that reach the fact, and ``m`` touches that share them.

    ``pair_attrs`` is ``CLICK_ATTRS`` for ``click_touches``.
    """
    pair_attrs = pair_attrs or PAIR_ATTRS
    orders = _windows(with_order_key(trades), ["okey"], window_days)
    dated = touches.withColumn("date", F.to_date("date_c"))
    attrs = [c for c in pair_attrs if c != "date"]
    # One count serves both joins: no day has more touches or orders in either.
    days = orders.select("user_uuid", F.explode(F.sequence("first_day", "last_day")).alias("date"))
    hot = hot_cells(dated.select("user_uuid", "date"), days, ["user_uuid", "date"])

    edges = orders.select("okey", "user_uuid", "lo", "bid_date_time", F.explode(F.array_distinct(F.array("first_day", "last_day"))).alias("date"))
    edge = grid_join(dated.select("user_uuid", "date", "date_c", *attrs), edges, ["user_uuid", "date"], _in_window, hot=hot)
    edge = edge.groupBy("right.okey", *["left." + c for c in pair_attrs]).agg(F.count(F.lit(1)).alias("m"))

    # Days between them: a group lies on one day, so nothing is left to add up.
    first, last = F.date_add("first_day", 1), F.date_sub("last_day", 1)
    inner = orders.where(first <= last).select("okey", "user_uuid", F.explode(F.sequence(first, last)).alias("date"))
    daily = dated.groupBy("user_uuid", *pair_attrs).agg(F.count(F.lit(1)).alias("m"))
    whole = grid_join(daily, inner, ["user_uuid", "date"], hot=hot).select("right.okey", *["left." + c for c in pair_attrs], "left.m")
    return edge.unionByName(whole)


def order_key_stats(trades: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per order key: its order id, ``r`` = eligible-order rows, ``t`` = touches in the window (NULL if none)."""
    rows = with_order_key(trades).groupBy("okey").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("r"))
    hits = pairs.groupBy("okey").agg(F.sum("m").alias("t"))
    return rows.join(hits, "okey", "left")


def touch_count(trades: DataFrame, pairs: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """``n`` = joined rows per order id (``max(row_number)`` of the left join)."""
    stats = order_key_stats(trades, pairs) if stats is None else stats
    return (stats.groupBy("id")
            .agg(F.sum(F.col("r") * F.greatest(F.coalesce(F.col("t"), F.lit(0)), F.lit(1)))
                 .alias("max_touch_rank")))


def _touch_side(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Per order key: its touch groups, or one NULL group (m = 1) when it has none."""
    nulls = stats.where(F.col("t").isNull()).select(
        "okey", *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in pairs.columns if c not in ("okey", "m")],
        F.lit(1).cast("long").alias("m"))
    return pairs.unionByName(nulls)


def _with_channels(side: DataFrame) -> DataFrame:
    """The channel rules depend on touch attributes only: once per touch group, before the fan-out to order rows."""
    env = R.cols("source_clean_c", source="source_c", medium="medium_c", campaign="campaign_c",
                 source_clean="source_clean_c")
    side, env = R.lowered(side, env, "source", "medium", "campaign")
    side = side.withColumn("map", R.channel_map().spark(env))
    env["map"] = F.col("map")
    side = side.withColumn("group_raw", R.channel_group().spark(env)).drop("_lower_source", "_lower_medium", "_lower_campaign")
    return side.withColumns({"group_raw_1": F.trim(F.split_part("group_raw", F.lit("-"), F.lit(1))),
                             "group_raw_2": F.trim(F.split_part("group_raw", F.lit("-"), F.lit(2)))})


def one_key_each(trades: DataFrame) -> bool:
    """Whether every order id has one order key (one small job); rows that share an id then share their key's partition."""
    keys = trades.groupBy("id").agg(F.min("okey").alias("least"), F.max("okey").alias("most"))
    return keys.where("least <> most").isEmpty()


def linear_attribution(trades: DataFrame, touches: DataFrame, first_orders: DataFrame,
                       countries: DataFrame, window_days: int = WINDOW_DAYS,
                       new_buyers_only: bool = False, extra_keys: list[str] | None = None,
                       pairs: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """The linear multi-touch fact, one row per ``FACT_KEYS`` (+ ``extra_keys``).

    ``new_buyers_only`` switches the first-order join from left to inner
    (the new-buyer variant); ``extra_keys`` carries trade columns such as
    ``buyer_purchase_price`` into the grouping.  ``countries`` may already
    carry a broadcast hint (it is used as given).  Order-level columns (first
    order, ``n``) are joined to the small, pre-aggregated order side on
    ``id``; the touch groups then join on ``okey``, straight from their shuffle,
    so that AQE can split a hot order; the grouping stays where that join left the
    rows, with ``okey`` as a further key.  Only where some order id has several
    order keys does it shuffle on all fact keys, map-side combined.

    With the pairs of ``click_touches`` the rows are the same, without the touch
    attributes that those lack and the channel columns that follow from them.
    """
    extra = list(extra_keys or [])
    trades = with_order_key(trades)
    if pairs is None:
        pairs = touch_pairs(trades, touches, window_days)
    stats = order_key_stats(trades, pairs) if stats is None else stats
    n = touch_count(trades, pairs, stats)
    fo = first_orders.select(F.col("order_id").alias("fo_id")).distinct()
    dim = countries.select(F.col("alpha2").alias("iso_alpha2"), "financial_regions")

    side = _touch_side(pairs, stats)
    if "rest" not in pairs.columns:
        side = _with_channels(side)

    # Order side: rows of one order that differ only in columns the fact does
    # not keep (fees, logic flag) are pre-aggregated, exactly:
    # sum over rows of x / n == (sum of x) * m / n for each touch group.
    order_keys = ["okey", "id", "uuid", "subtotal", "order_date", "vertical", "product_uuid", "sale_ind",
                              "country_id", "fo_id"] + extra
    orders_n = (trades.join(fo, F.col("id") == F.col("fo_id"), "inner" if new_buyers_only else "left")
                .groupBy(*order_keys)
                .agg(F.count(F.lit(1)).alias("r_rows"), F.sum("fees").cast("double").alias("fees_sum"))
                .join(n, "id"))
    country = F.coalesce("country_code_c", "country_id")
    rows = orders_n.join(side, "okey").withColumns({
        "w": F.col("m").cast("double") / F.col("max_touch_rank").cast("double"),
        "country": country,
        "vertical_name": R.vertical_name().spark(R.cols("vertical")),
        "type": F.when(F.col("id") == F.col("fo_id"), R.NEW_BUYER).otherwise(R.RETURN_BUYER),
        "country_key": R.order_country_key().spark({"country": country})})
    rows = rows.join(dim, F.col("iso_alpha2") == F.col("country_key"), "left")
    rows = rows.withColumn("financial_region", R.financial_region().spark(
        {"alpha2": F.col("iso_alpha2"), "financial_regions": F.col("financial_regions")}))
    # The fact rows are wide and many times the touches: with one order key an
    # id, no group spans two of them and nothing is shuffled again.
    dealt = ["okey"] if one_key_each(stats) else []
    keys = [c for c in [*FACT_KEYS, "rest"] if c in rows.columns]
    return (rows.groupBy(*dealt, *keys, *extra)
            .agg(F.sum(F.col("r_rows") * F.col("w")).alias("source_attr"),
                 F.sum(F.col("subtotal").cast("double") * F.col("r_rows") * F.col("w")).alias("gmv_source_attr"),
                 F.sum(F.col("fees_sum") * F.col("w")).alias("fees_source_attr"))
            .drop("okey", "rest"))


RANK_TOUCH_COLUMNS = ["d_source_c", "gcl_id", "medium_c", "source_c", "campaign_c", "adset_c", "keyword_c",
                      "source_clean_c", "country_code_c", "date_c", "visit_id_c", "device_mapping_c"]


def _rank_side(trades: DataFrame, touches: DataFrame, window_days: int) -> DataFrame:
    """Per order key: its touches in the window, or one row of NULLs."""
    pairs = order_touches(trades, touches, window_days).withColumn("okey", order_key())
    bare = trades.select("okey").distinct().join(pairs.select("okey").distinct(), "okey", "left_anti")
    nulls = bare.select("okey", *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in RANK_TOUCH_COLUMNS])
    return pairs.select("okey", *RANK_TOUCH_COLUMNS).unionByName(nulls)


def joined_order_touches(trades: DataFrame, touches: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """The left join of every eligible-order row to its buyer's touches in the window.

    A trade row without touches keeps one row of NULL touch columns.  Built
    from the bucketed pairs, so no buyer's history is compared as a whole.
    """
    trades = with_order_key(trades)
    side = _rank_side(trades, touches, window_days)
    return grid_join(trades, side, ["okey"]).select(*["left." + c for c in trades.columns if c != "okey"], *["right." + c for c in RANK_TOUCH_COLUMNS])


def _hour(at: str) -> Column:
    return F.coalesce(F.date_trunc("hour", at).cast("timestamp_ntz"), F.lit("9999-12-31 23:00:00").cast("timestamp_ntz"))


def _inside(columns: list[str], keys: list[str]) -> Column:
    """Number of a joined row inside its hour: by touch time, ties by every other column."""
    rest = [c for c in columns if c not in ("id", "date_c")]
    return F.row_number().over(Window.partitionBy(*keys, "_hour").orderBy(*[F.col(c).asc_nulls_last() for c in ("date_c", *rest)]))


def _earlier(keys: list[str]) -> Column:
    before = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_c").over(before), F.lit(0))


def touch_rank(joined: DataFrame) -> DataFrame:
    """Number each order's joined rows 1..n by touch time (NULL times last).

    Ties are broken by every other column, so only identical rows tie.  Rows
    are numbered inside (order, hour), and an hour starts behind the sum of the
    order's earlier hours (a window of a few hundred counts an order), so a hot
    order is spread over its hours.  The join to the starts goes by the window's
    own keys, a NULL id inside a struct, so the rows are shuffled once.
    """
    r = joined.withColumns({"_id": F.struct("id"), "_hour": _hour("date_c")})
    starts = r.groupBy("_id", "_hour").agg(F.count(F.lit(1)).alias("_c"))
    starts = starts.select("_id", "_hour", _earlier(["_id"]).alias("_start"))
    numbered = r.withColumn("_inside", _inside(joined.columns, ["_id"]))
    return numbered.join(starts, ["_id", "_hour"]).select(*joined.columns, (F.col("_start") + F.col("_inside")).cast("int").alias("touch_rank"))


def ranked_order_touches(trades: DataFrame, touches: DataFrame, window_days: int = WINDOW_DAYS, cut=None) -> DataFrame:
    """``touch_rank`` of ``joined_order_touches``, numbered where the join left the rows.

    With one order key an id, an hour's start follows from the touches of the
    order key and the number of its rows.  The starts (at most one an hour of
    the window) go to the join with the order rows, and the joined rows, many
    times the touches, are neither shuffled nor written before they are numbered.
    """
    cut = cut or (lambda df: df)
    trades = with_order_key(trades)
    if not one_key_each(trades):
        return touch_rank(cut(joined_order_touches(trades, touches, window_days)))
    side = cut(_rank_side(trades, touches, window_days).withColumn("_hour", _hour("date_c")))
    counts = side.groupBy("okey", "_hour").agg(F.count(F.lit(1)).alias("_c"))
    starts = counts.select("okey", "_hour", _earlier(["okey"]).alias("_start"))
    starts = starts.groupBy("okey").agg(F.collect_list(F.struct("_hour", "_start")).alias("_starts"))
    sizes = trades.groupBy("okey").agg(F.count(F.lit(1)).alias("_rows"))
    orders = trades.join(sizes.join(starts, "okey"), "okey")
    columns = [c for c in trades.columns if c != "okey"] + RANK_TOUCH_COLUMNS
    rows = grid_join(orders, side, ["okey"]).select(
        "left.okey", *["left." + c for c in trades.columns if c != "okey"], *["right." + c for c in RANK_TOUCH_COLUMNS], "right._hour",
        (F.col("left._rows") * F.element_at(F.map_from_entries("left._starts"), F.col("right._hour"))).alias("_start"))
    return rows.withColumn("_inside", _inside(columns, ["okey"])).select(*columns, (F.col("_start") + F.col("_inside")).cast("int").alias("touch_rank"))


def conversions_all_buyers(fact: DataFrame) -> DataFrame:
    """Conversion rows for every buyer (value = credit x 30), click id required."""
    return (fact.where(F.col("gcl_id").isNotNull())
            .select("gcl_id",
                    R.conversion_name(F.col("type")).alias("conversion_name"),
                    F.col("order_date").alias("conversion_time"),
                    F.col("source_attr").alias("attributed_credit"),
                    (F.col("source_attr") * R.CONVERSION_VALUE_PER_CREDIT).alias("conversion_value"),
                    F.lit(R.CONVERSION_CURRENCY).alias("conversion_currency"),
                    F.lit(None).cast("boolean").alias("sftp")))


def conversions_new_buyers(fact: DataFrame) -> DataFrame:
    """C14: new-buyer conversion rows, value = greatest(10, 0.09 x buyer purchase price).

    ``fact`` is the new-buyer variant of ``linear_attribution`` (inner join
    to first orders, ``buyer_purchase_price`` as extra key).
    """
    rate = F.lit(Decimal(str(R.NEW_BUYER_VALUE_RATE)))
    value = F.greatest(F.lit(R.NEW_BUYER_VALUE_FLOOR), rate * F.col("buyer_purchase_price")).cast("double")
    return (fact.where((F.col("type") == R.NEW_BUYER) & F.col("gcl_id").isNotNull())
            .select("gcl_id",
                    F.lit(R.NEW_BUYER_CONVERSION).alias("conversion_name"),
                    F.col("order_date").alias("conversion_time"),
                    F.col("source_attr").alias("attributed_credit"),
                    value.alias("conversion_value"),
                    F.lit(R.CONVERSION_CURRENCY).alias("conversion_currency"),
                    F.lit(None).cast("boolean").alias("sftp")))
