"""Hand-made micro-fixture in the job's logical schemas (FIXTURES.md section 3).

Times are UTC.  The ledger mark is 2024-07-10 15:00 (mid-day); the newest
session starts 2024-07-20 12:00.  Bid times are chosen so that the window
edges ``bid - 14 d`` and ``bid`` fall on exact seconds (EST = UTC - 5 h).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T_

from creditflow import schemas
from creditflow.sources import tables


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


MARK = T("2024-07-10 15:00:00")

ORDERS = [
    # id, subtotal, created_at, bid_user_id, bid_chain, ask_chain, status, bid_amount
    (1, 100.0, T("2024-07-10 20:00:00"), 1, "b1", "a1", "complete", 90.0),   # mark's own local date
    (2, 100.0, T("2024-07-11 03:00:00"), 1, "b2", "a2", "complete", 90.0),   # 07-10 23:00 local
    (3, 200.0, T("2024-07-11 12:00:00"), 1, "b3", "a3", "complete", 150.0),  # eligible
    (4, 100.0, T("2024-07-21 00:00:00"), 1, "b4", "a4", "complete", 90.0),   # after newest session
    (5, 400.0, T("2024-07-12 12:00:00"), 2, "b5", "a5", "complete", None),   # two items, two fees
    (6, 50.0, T("2024-07-13 12:00:00"), 3, "b6", "a6", "fraud", 40.0),       # no touches
    (7, 80.0, T("2024-07-15 12:00:00"), 4, "b7", "a7", "complete", 70.0),    # direct visits
    (8, 60.0, T("2024-07-14 12:00:00"), 29, "b8", "a8", "complete", 5.0),    # flagged user
]
ADDRESSES = [(i, "shipping", c) for i, c in [(1, "US"), (2, "US"), (3, "US"), (4, "US"), (5, "UK"),
                                              (6, "GB"), (7, "US"), (8, "US")]] + [(3, "billing", "DE")]
USERS = [(1, "u1"), (2, "u2"), (3, "u3"), (4, "u4"), (29, "u29")]
BIDS = [("b1", 300, T("2024-07-10 19:00:00")), ("b2", 300, T("2024-07-11 02:00:00")),
        ("b3", 300, T("2024-07-11 10:00:00")), ("b3", 300, T("2024-07-11 11:00:00")),
        ("b3", 100, T("2024-07-11 11:30:00")), ("b4", 300, T("2024-07-20 23:00:00")),
        ("b5", 300, T("2024-07-12 11:00:00")), ("b6", 300, T("2024-07-13 11:00:00")),
        ("b7", 300, T("2024-07-15 11:00:00")), ("b8", 300, T("2024-07-14 11:00:00"))]
ITEMS = [(3, "s1"), (5, "s1"), (5, "s2"), (6, "s3"), (7, "s4"), (8, "s5")]
PRODUCTS = [("s1", 1, "p1", T("2024-07-08 00:00:00")),   # release + 5 d covers 07-11/12
            ("s2", 2, "p2", None),                        # NULL release -> closet
            ("s3", 9, "p3", T("2024-05-20 12:00:00")),    # cycle window
            ("s4", 0, "p4", T("2024-01-01 00:00:00")),    # closet
            ("s5", 3, "p5", T("2024-07-09 08:00:00"))]
ADJUSTMENTS = [(5, "a5", "transactional", None, 10.0), (5, "a5", "transactional", None, 12.0),
               (5, "b5", "transactional", None, 99.0),  # other chain: not a fee of the order
               (3, "a3", "transactional", None, 5.0), (3, "a3", "shipping", None, 7.0),
               (3, "a3", "shipping_original", None, 8.0), (3, "a3", "fee", "BUYFEE_ORIG", 3.0),
               (3, "a3", "fee", "BUYFEE_REV", 4.0), (8, "a8", "shipping", None, 1.0)]

S = "2024-07-11 11:00:00"  # bid of order 3 in UTC (06:00 EST)


def sess(uuid, src, med, ts, visit_id, gcl=None, country="United States", client="c-" ,
         datasource="web", device="desktop", browser="Chrome", os_="Windows", campaign="camp"):
    return (client + (uuid or "anon"), uuid, datasource, med, src, campaign, "ad", "kw", browser, os_,
            device, country, T(ts), visit_id, gcl)


SESSIONS = [
    # order 3 (user u1, bid 2024-07-11 11:00 UTC): window edges
    sess("u1", "google", "cpc", "2024-06-27 11:00:00", 101, "G-edge-lo"),    # bid - 14 d exactly
    sess("u1", "google", "cpc", "2024-06-27 10:59:59", 102, "G-out-lo"),     # one second before
    sess("u1", "facebook", "paid", "2024-07-11 11:00:00", 103),              # bid exactly
    sess("u1", "google", "cpc", "2024-07-11 11:00:01", 104, "G-out-hi"),     # one second after
    # order 5 (user u2): one click
    sess("u2", "google", "cpc", "2024-07-12 09:00:00", 201, "G5", country="UK"),
    # order 7 (user u4): direct visits near installs
    sess("u4", "(direct)", "(none)", "2024-07-14 12:00:00", 401),   # install 10 s later -> moved
    sess("u4", "(direct)", "(none)", "2024-07-13 12:00:00", 402),   # install 11 s later -> kept
    sess("u4", "(direct)", "(none)", "2024-07-12 12:00:00", 403),   # snapchat install 23 h later -> moved
    sess("u4", "(direct)", "(none)", "2024-07-10 12:00:00", 404),   # install with NULL source/medium
    sess("u4", "google", "cpc", "2024-07-14 13:00:00", 405, "G7", country="Czechia"),
    # flagged user: click
    sess("u29", "x_int", "display", "2024-07-14 10:00:00", 801, "G8", country=None),
    # identity map: client of u5 known via another session
    ("c-known", "u4", "web", "organic", "bing", None, None, None, "Chrome", "Windows", "desktop",
     "GB", T("2024-07-01 00:00:00"), 901, None),
    # newest session
    sess("u9", "google", "cpc", "2024-07-20 12:00:00", 999, "G9"),
]


def inst(uuid, client, src, ch, ts, device="iPhone12,1", country="PL"):
    return (uuid, client, ch, src, "icamp", "iset", "iad", device, country, T(ts))


INSTALLS = [
    inst("u4", "x1", "googleadwords_int", "search", "2024-07-14 12:00:10"),
    inst("u4", "x2", "criteo", "retargeting", "2024-07-13 12:00:11"),
    inst("u4", "x3", "snapchat_int", None, "2024-07-13 11:00:00", device="SM-G1"),
    inst(None, "c-known", None, None, "2024-07-10 12:00:05"),   # uuid resolved through the identity map
]
COUNTRIES = [("United States", "US", "North America"), ("United Kingdom", "GB", "Europe"),
             ("Czech Republic", "CZ", "Europe"), ("Poland", "Po", "Europe"), ("Japan", "JP", "Core Asia")]
FIRST_ORDER_BIDS = [(3,), (3,), (7,)]
LEDGER = [("G-old", "GCLID New Buyer MTA Trades", MARK, 1.0, 30.0, "USD", True)]

ROWS = {
    "orders": ORDERS, "order_addresses": ADDRESSES, "users": USERS, "portfolio_items_master": BIDS,
    "order_items": ITEMS, "product_market_cache": PRODUCTS, "order_adjustments": ADJUSTMENTS,
    "sessions": SESSIONS, "appsflyer_data_locker": INSTALLS, "iso_2_mapping": COUNTRIES,
    "first_order_bids": FIRST_ORDER_BIDS, "ledger": LEDGER,
}


def frames(spark) -> dict:
    return {n: tables.conform(spark.createDataFrame(rows, _written(n)), n) for n, rows in ROWS.items()}


def _written(name: str) -> T_.StructType:
    """The logical schema with doubles for decimals, as the rows above are written."""
    return T_.StructType([T_.StructField(f.name, T_.DoubleType() if isinstance(f.dataType, T_.DecimalType) else f.dataType)
                          for f in schemas.LOGICAL_TABLES[name].fields])


def duckdb_prefix(con) -> str:
    """Register the fixture as DuckDB tables ``x_<name>``; returns a WITH prefix."""
    import pandas as pd
    for n, rows in ROWS.items():
        cols = [f.name for f in schemas.LOGICAL_TABLES[n].fields]
        df = pd.DataFrame(rows, columns=cols)
        con.register(f"p_{n}", df)
        types = {f.name: f.dataType.simpleString() for f in schemas.LOGICAL_TABLES[n].fields}
        dmap = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
        sel = ", ".join(f"CAST({c} AS {dmap.get(types[c], types[c])}) AS {c}" for c in cols)
        con.execute(f"CREATE OR REPLACE TABLE x_{n} AS SELECT {sel} FROM p_{n}")
    return "WITH fixture_marker AS (SELECT 1 AS one)"
