"""Order-side stages: high-water mark, eligible orders, buyers, first orders,
adjustment pivot and buyer purchase price (C1-C4, C11, C15, C16).

Time bounds
-----------
The mark (latest conversion already in the ledger) and the newest session
time are scalars.  ``resolve_bounds`` evaluates them once (two one-row
aggregates) so that every filter that depends on them becomes a literal and
reaches the parquet scans: besides the exact rule ``date(local(t)) > mark``
the readers get the implied, pushable bound ``t > mark`` (a local date after
the mark's timestamp can only come from a UTC instant after it, since the
local zone is behind UTC).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.functions import rules as R
from creditflow.functions.timeutil import local_order_time, shift, touch_time
from creditflow.operators.joins import key_sets, semi_reduce

# Attribution window; touch lookback is two windows before the mark.
WINDOW_DAYS = 14
BID_STATE_ACCEPTED = 300
SHIPPING_ADDRESS = "shipping"
TRANSACTIONAL_FEE = "transactional"
PIVOT_TYPES = {"shipping_amount": ("type", "shipping"),
               "shipping_original_amount": ("type", "shipping_original"),
               "buyfee_orig_amount": ("code", "BUYFEE_ORIG"),
               "buyfee_rev_amount": ("code", "BUYFEE_REV")}

TRADE_KEYS = ["id", "uuid", "subtotal", "fees", "country_id", "vertical", "product_uuid",
              "order_date", "sale_ind", "logic_flag"]


def ts_lit(value: dt.datetime | None) -> Column:
    """Exact TIMESTAMP_NTZ literal (NULL for ``None``)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def high_water_mark(ledger: DataFrame) -> DataFrame:
    """One row, ``date`` = latest conversion time in the ledger (NULL if empty)."""
    return ledger.agg(F.max("conversion_time").alias("date"))


@dataclass(frozen=True)
class Bounds:
    """Scalars that bound one run."""

    mark: dt.datetime | None          # latest conversion time in the ledger
    newest_visit: dt.datetime | None  # newest session start (orders must be older)
    window_days: int = WINDOW_DAYS

    @property
    def lookback_days(self) -> int:
        return 2 * self.window_days

    @property
    def lookback_start(self) -> dt.datetime | None:
        return None if self.mark is None else self.mark - dt.timedelta(days=self.lookback_days)


def resolve_bounds(ledger: DataFrame, sessions: DataFrame, window_days: int = WINDOW_DAYS,
                   mark: dt.datetime | None = None) -> Bounds:
    """Evaluate the mark (unless given) and the newest visit as literals.

    Only sessions newer than the mark can bound an eligible order, so the
    newest-visit scan is restricted to them (exactly the same result, and a
    pushed-down, pruned scan).
    """
    if mark is None:
        mark = high_water_mark(ledger).first()["date"]
    if mark is None:
        return Bounds(None, None, window_days)
    newest = (sessions.where(F.col("visit_start_time") > ts_lit(mark))
              .agg(F.max("visit_start_time").alias("m")).first()["m"])
    return Bounds(mark, newest, window_days)


def after_mark(ts: Column, mark: dt.datetime | None, days_back: int = 0) -> Column:
    """``date(local(ts)) > mark - days_back`` plus the implied pushable ``ts > mark - days_back``.

    With no mark (empty ledger) nothing qualifies.
    """
    if mark is None:
        return F.lit(False)
    bound = mark - dt.timedelta(days=days_back)
    return (ts > ts_lit(bound)) & (F.to_date(local_order_time(ts)) > ts_lit(bound))


def sale_indicator(order_date: Column, release_date: Column) -> Column:
    """Release (<= +5 d), cycle (<= +8 w), else closet (also for NULL release)."""
    return (F.when(order_date <= shift(release_date, R.RELEASE_DAYS, "day"), "release")
            .when(order_date <= shift(release_date, R.CYCLE_WEEKS, "week"), "cycle")
            .otherwise("closet"))


def adjustment_pivot(adjustments: DataFrame) -> DataFrame:
    """Per (chain_id, order_id) the max amount of each adjustment kind."""
    kinds = [F.col(c) == v for c, v in PIVOT_TYPES.values()]
    relevant = kinds[0] | kinds[1] | kinds[2] | kinds[3]
    return (adjustments.where(relevant)
            .groupBy("chain_id", "order_id")
            .agg(*[F.max(F.when(F.col(c) == v, F.col("amount"))).alias(name)
                   for name, (c, v) in PIVOT_TYPES.items()]))


def buyer_purchase_price(pivot_prefix: str = "", bid_amount: str = "bid_amount") -> Column:
    """(original shipping else shipping else 0) + (revised else original buyer fee else 0) + bid, in decimals."""
    p = pivot_prefix
    return (F.coalesce(F.col(p + "shipping_original_amount"), F.col(p + "shipping_amount"), F.lit(0))
            + F.coalesce(F.col(p + "buyfee_rev_amount"), F.col(p + "buyfee_orig_amount"), F.lit(0))
            + F.coalesce(F.col(bid_amount), F.lit(0)))


def eligible_orders(t: dict, bounds: Bounds, with_purchase_price: bool = False, cut=None) -> DataFrame:
    """Orders after the mark and before the newest visit, enriched and deduplicated.

    ``t`` maps logical table names to DataFrames.  One row per distinct
    ``TRADE_KEYS`` (+ ``buyer_purchase_price``) with ``bid_date_time`` = the
    latest accepted bid of the order's bid chain in EST.  ``cut`` (e.g.
    ``creditflow.session.cut_lineage``) materialises the run's orders once;
    their key sets are then counted from that small table.
    """
    o = t["orders"].where(after_mark(F.col("created_at"), bounds.mark))
    if bounds.newest_visit is None:
        o = o.where(F.lit(False))
    else:
        o = o.where(F.col("created_at") < ts_lit(bounds.newest_visit))
    cols = ["id", "subtotal", "created_at", "bid_user_id", "bid_chain_id", "ask_chain_id", "status"]
    o = o.select(*cols, *(["bid_amount"] if with_purchase_price else []))
    if cut is not None:
        o = cut(o)

    # Every history-sized table is first reduced to the run's keys (broadcast
    # semi joins behind a size check), so none of them is shuffled whole.
    keys = key_sets(o, ["id", "bid_user_id", "bid_chain_id"])
    ids = keys["id"]
    bids = (semi_reduce(t["portfolio_items_master"].where(F.col("state") == BID_STATE_ACCEPTED),
                        "chain_id", keys["bid_chain_id"])
            .groupBy("chain_id").agg(F.max(touch_time("created_at")).alias("bid_date_time")))
    addr = (semi_reduce(t["order_addresses"].where(F.col("address_type") == SHIPPING_ADDRESS), "order_id", ids)
            .select(F.col("order_id").alias("a_order_id"), "country_id"))
    users = semi_reduce(t["users"], "id", keys["bid_user_id"]).select(F.col("id").alias("u_id"), "uuid")
    items = (semi_reduce(t["order_items"], "order_id", ids)
             .select(F.col("order_id").alias("i_order_id"), "sku_uuid_bin"))
    # The product catalogue is a dimension (one row per SKU), joined as is.
    products = t["product_market_cache"].select(
        F.col("sku_uuid"), F.col("product_category").alias("vertical"), "product_uuid", "release_date")
    adjustments = semi_reduce(t["order_adjustments"], "order_id", ids)
    fees = (adjustments.where(F.col("type") == TRANSACTIONAL_FEE)
            .select(F.col("order_id").alias("f_order_id"),
                    F.col("chain_id").cast("string").alias("f_chain_id"),
                    F.col("amount").alias("fees")))

    j = (o.join(bids, o.bid_chain_id == bids.chain_id)
         .join(addr, F.col("id") == F.col("a_order_id"))
         .join(users, F.col("u_id") == F.col("bid_user_id"))
         .join(items, F.col("id") == F.col("i_order_id"), "left")
         .join(products, F.col("sku_uuid_bin") == F.col("sku_uuid"), "left")
         .join(fees, (F.col("f_chain_id") == F.col("ask_chain_id").cast("string"))
               & (F.col("f_order_id") == F.col("id")), "left"))
    extra = []
    if with_purchase_price:
        piv = adjustment_pivot(adjustments)
        piv = piv.select(*[F.col(c).alias("g_" + c) for c in piv.columns])
        j = j.join(piv, (F.col("g_chain_id").cast("string") == F.col("ask_chain_id").cast("string"))
                   & (F.col("g_order_id") == F.col("id")), "left")
        j = j.withColumn("buyer_purchase_price", buyer_purchase_price("g_"))
        extra = ["buyer_purchase_price"]
    order_date = local_order_time("created_at")
    j = j.withColumns({"order_date": order_date,
                       "sale_ind": sale_indicator(order_date, F.col("release_date")),
                       "logic_flag": R.logic_flag(F.col("bid_user_id"), F.col("status"))})
    return j.groupBy(*TRADE_KEYS, *extra).agg(F.max("bid_date_time").alias("bid_date_time"))


def buyers(trades: DataFrame) -> DataFrame:
    """C4: distinct buyer uuids of the eligible orders."""
    return trades.select("uuid").distinct()


def first_orders(first_order_bids: DataFrame) -> DataFrame:
    """C11: first-purchase order ids (deduplicated) with their multiplicity."""
    return first_order_bids.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_bids"))
