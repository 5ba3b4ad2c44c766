"""Composition of the stages into the attribution fact and conversion rows.

``Attribution`` holds the lazily built stages of one run so that tests,
the oracle queries and the daily job share one definition.  The
intermediates that are read more than once (eligible orders, session and
install touches, enhanced touches, order-touch pairs) are cut from their
lineage with a reliable checkpoint when ``checkpoint=True`` (the daily
job), so later stages and a lost executor re-read them instead of
recomputing the scans and joins above them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.operators import linear, orders, touches
from creditflow.operators.joins import bounded_broadcast, semi_reduce
from creditflow.operators.orders import Bounds, resolve_bounds
from creditflow.session import cut_lineage


class Attribution:
    """Stages of one attribution run over logical tables ``t``.

    ``variant`` is ``"all"`` (every buyer, value = credit x 30) or ``"new"``
    (new buyers only, value from the buyer purchase price).
    """

    def __init__(self, t: dict, bounds: Bounds | None = None, variant: str = "all",
                 window_days: int = orders.WINDOW_DAYS, checkpoint: bool = False, people: DataFrame | None = None):
        """``people`` is a maintained identity map; without it the map comes from all sessions."""
        assert variant in ("all", "new")
        self.people = people
        self.t, self.variant, self.window_days, self.checkpoint = t, variant, window_days, checkpoint
        self._bounds = bounds

    def _cut(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.checkpoint else df

    @cached_property
    def bounds(self) -> Bounds:
        if self._bounds is not None:
            return self._bounds
        return resolve_bounds(self.t["ledger"], self.t["sessions"], self.window_days)

    @cached_property
    def eligible(self) -> DataFrame:
        """Eligible orders with the surrogate order key that later stages meet on."""
        found = orders.eligible_orders(self.t, self.bounds, with_purchase_price=self.variant == "new",
                                       cut=self._cut if self.checkpoint else None)
        return self._cut(linear.with_order_key(found))

    @cached_property
    def first_orders(self) -> DataFrame:
        """C11 restricted to the run's orders (the full table spans all history)."""
        bids = semi_reduce(self.t["first_order_bids"], "order_id", self.eligible, "id")
        return orders.first_orders(bids)

    @cached_property
    def keyed(self) -> DataFrame:
        """Eligible orders; the new-buyer variant keeps first orders only.

        Restricting before the touch join is exact: an order's touches and
        its count ``n`` do not depend on other orders.
        """
        if self.variant == "new":
            return self._cut(self.eligible.join(self.first_orders.select(F.col("order_id").alias("id")),
                                                "id", "left_semi"))
        return self.eligible

    @property
    def trades(self) -> DataFrame:
        return self.keyed.drop("okey")

    @cached_property
    def buyers(self) -> DataFrame:
        return orders.buyers(self.keyed)

    @cached_property
    def buyer_keys(self) -> DataFrame:
        """Buyer uuids as one size-checked key set shared by the touch scans."""
        return touches.buyer_keys(self.buyers)

    @cached_property
    def countries(self) -> DataFrame:
        """Country dimension, broadcast after a row-count check (one small job)."""
        return bounded_broadcast(self.t["iso_2_mapping"])

    @cached_property
    def install_touches(self) -> DataFrame:
        return self._cut(touches.install_touches(self.t["appsflyer_data_locker"], self.t["sessions"],
                                                 self.buyer_keys, self.bounds, self.people, self._cut if self.checkpoint else None))

    @cached_property
    def session_touches(self) -> DataFrame:
        return self._cut(touches.session_touches(self.t["sessions"], self.countries, self.buyer_keys,
                                                 self.bounds))

    @cached_property
    def touches(self) -> DataFrame:
        return self._cut(touches.enhance_direct_touches(self.session_touches, self.install_touches))

    @cached_property
    def pairs(self) -> DataFrame:
        return self._cut(linear.touch_pairs(self.keyed, self.touches, self.window_days))

    @cached_property
    def order_stats(self) -> DataFrame:
        """One row per order key; cut, as the share count and the touch-less orders both come from it."""
        return self._cut(linear.order_key_stats(self.keyed, self.pairs))

    @cached_property
    def touch_count(self) -> DataFrame:
        return linear.touch_count(self.keyed, self.pairs, self.order_stats)

    def _attributed(self, touches: DataFrame, pairs: DataFrame, stats: DataFrame) -> DataFrame:
        new = self.variant == "new"
        return linear.linear_attribution(
            self.keyed, touches, self.first_orders, self.countries,
            self.window_days, new_buyers_only=new,
            extra_keys=["buyer_purchase_price"] if new else None, pairs=pairs, stats=stats)

    @cached_property
    def fact(self) -> DataFrame:
        return self._attributed(self.touches, self.pairs, self.order_stats)

    @cached_property
    def conversions(self) -> DataFrame:
        """From the fact's rows with the columns that conversions read; all touches count in the shares."""
        clicks = linear.click_touches(self.touches)
        pairs = self._cut(linear.touch_pairs(self.keyed, clicks, self.window_days, linear.CLICK_ATTRS))
        fact = self._attributed(clicks, pairs, self._cut(linear.order_key_stats(self.keyed, pairs)))
        if self.variant == "new":
            return linear.conversions_new_buyers(fact)
        return linear.conversions_all_buyers(fact)
