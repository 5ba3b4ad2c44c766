"""Logical input tables of the attribution job (types inferred from usage).

Timestamps are zone-less UTC (``TimestampNTZType``); conversion to local
zones is explicit (``creditflow.functions.timeutil``).
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Money from the sources: exact to a millionth, under 10**12.  Shares of money (credits) are doubles.
M = T.DecimalType(18, 6)
S, L, I, D, B, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampNTZType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS = _struct(("id", L), ("subtotal", M), ("created_at", TS), ("bid_user_id", L),
                 ("bid_chain_id", S), ("ask_chain_id", S), ("status", S), ("bid_amount", M))
ORDER_ADDRESSES = _struct(("order_id", L), ("address_type", S), ("country_id", S))
USERS = _struct(("id", L), ("uuid", S))
BIDS = _struct(("chain_id", S), ("state", I), ("created_at", TS))
ORDER_ITEMS = _struct(("order_id", L), ("sku_uuid_bin", S))
PRODUCTS = _struct(("sku_uuid", S), ("product_category", I), ("product_uuid", S),
                   ("release_date", TS))
ADJUSTMENTS = _struct(("order_id", L), ("chain_id", S), ("type", S), ("code", S), ("amount", M))
SESSIONS = _struct(("client_id", S), ("stitching_user_uuid", S), ("datasource", S), ("medium", S),
                   ("source", S), ("campaign", S), ("ad_content", S), ("keyword", S),
                   ("browser", S), ("operating_system", S), ("device_category", S),
                   ("country", S), ("visit_start_time", TS), ("visit_id", L), ("gcl_id", S))
INSTALLS = _struct(("uuid", S), ("customer_user_id", S), ("af_channel", S), ("media_source", S),
                   ("campaign", S), ("af_adset", S), ("af_ad", S), ("device_type", S),
                   ("country_code", S), ("attributed_touch_time", TS))
COUNTRIES = _struct(("name", S), ("alpha2", S), ("financial_regions", S))
FIRST_ORDER_BIDS = _struct(("order_id", L),)
LEDGER = _struct(("gcl_id", S), ("conversion_name", S), ("conversion_time", TS),
                 ("attributed_credit", D), ("conversion_value", D), ("conversion_currency", S),
                 ("sftp", B))

LOGICAL_TABLES = {
    "orders": ORDERS,
    "order_addresses": ORDER_ADDRESSES,
    "users": USERS,
    "portfolio_items_master": BIDS,
    "order_items": ORDER_ITEMS,
    "product_market_cache": PRODUCTS,
    "order_adjustments": ADJUSTMENTS,
    "sessions": SESSIONS,
    "appsflyer_data_locker": INSTALLS,
    "iso_2_mapping": COUNTRIES,
    "first_order_bids": FIRST_ORDER_BIDS,
    "ledger": LEDGER,
}

LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
