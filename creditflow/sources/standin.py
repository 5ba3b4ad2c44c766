"""Stand-in inputs: the driver's test tables reshaped into the job's logical tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not the
order / session / install tables the job reads.  Each logical table below is
a plain projection (or union of projections) of one or two driver tables;
attribute values are picked from fixed lists by the event's ``props.k`` and
user id, so every classification branch and NULL case occurs.  None of this
does any of the job's work: the job only ever sees rows in the logical
schemas (``creditflow.schemas``) and must be right for any such rows.

Every table is defined once as SQL expressions rendered for both Spark
(``selectExpr``) and DuckDB, so the correctness oracle reads exactly the
same input.

Mapping:
  orders, order_addresses, portfolio_items_master  <- events (purchase)
  users                                            <- customer
  order_items, order_adjustments                   <- lineitem
  product_market_cache                             <- part
  sessions                                         <- events (view/click/error)
  appsflyer_data_locker                            <- events (signup; some views)
  iso_2_mapping                                    <- nation x region
  first_order_bids                                 <- flagged purchases (some listed twice)
  ledger (state before the run)                    <- purchases before a fixed time
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from creditflow import schemas

# ---------------------------------------------------------------------------
# Fixed values of the stand-in data (test constants, not job rules).
# ---------------------------------------------------------------------------
SESSION_TRAFFIC = [  # (source, medium)
    ("google", "cpc"), ("google", "organic"), ("(direct)", "(none)"), ("facebook", "paid_social"),
    ("snapchat_int", "paid"), ("criteo", "display"), ("(direct)", "(none)"), ("rakuten", "affiliate"),
    ("af/imp", "link"), ("newsletter", "email"), ("leanplum", "push"), ("mainsite", "referrer"),
    ("blog.example", "referral"), ("apple search ads", "search"), ("doubleclick", "display"),
    ("bing", "organic"), (None, "cpc"), ("google", None), (None, None), ("Google", "CPC"),
    ("googleads", "video"), ("editorial_site", "editorial"), ("instagram", "social"),
    ("sendgrid", "email"), ("lyst", "cpc"), ("x_int", "display"), ("xyint", "display"),
    ("curalate", "ugc"), ("manage", "cpm"), ("(direct)", "(none)"),
    ("af/rak", "link"), ("haitao", "blog"), ("mifanli", "link"), ("ebates", "link"), ("slickdeals", "forum"),
    ("suplexed", "blog"), ("srvtrck", "link"), ("modesens", "link"), ("fkdeals", "link"), ("thedropdate", "blog"),
    ("duomai", "link"), ("rstyle", "link"), ("shopstyle", "link"), ("solsense", "link"), ("hypeanalyzer", "link"),
    ("twitter", "social"), ("Facebook Ads", "social"), ("partner", "googleads"), ("snapchat_int", "organic"),
]
SESSION_CAMPAIGNS = ["stockx_launch", "brand", None, "Spring Sale", "stockx_retarget", "generic"]
SESSION_AD_CONTENT = ["ad_a", None, "ad_b", "carousel"]
SESSION_KEYWORDS = ["sneakers", None, "jordan", "(not provided)", "watch"]
SESSION_BROWSERS = ["Chrome", "Safari", "GoogleAnalytics", None, "Firefox"]
SESSION_OS = ["iOS", "Android", "Windows", "Macintosh", "BlackBerry", "Windows Phone", None]
SESSION_DEVICES = ["desktop", "mobile", "tablet", None]
SESSION_DATASOURCES = ["web", "app", "web"]
SESSION_COUNTRIES = ["United States", "US", "UK", "GB", "Czechia", "DE", "Germany",
                     "Myanmar (Burma)", "Russia", "Poland", "Atlantis", None, "France"]
INSTALL_TRAFFIC = [  # (media_source, af_channel)
    ("googleadwords_int", "search"), ("Facebook Ads", "facebook"), ("snapchat_int", None),
    ("Apple Search Ads", "asa"), ("criteo", "retargeting"), (None, None), ("organic", None),
    ("referral_program", "referral"), ("email", "newsletter"), ("mainsite", "referrer"),
    ("tiktok_int", "ads"), ("blisspoint", "tv"), ("microsoft", "cpc"), ("youtube", "video"),
    ("manage", "dsp"), ("direct_deeplink", "direct"), ("partner", "leanplum"), (None, "facebook"),
    ("other", "network"),
]
INSTALL_CAMPAIGNS = ["stockx_app", None, "retarget", "ios_launch"]
INSTALL_ADSETS = ["set1", None, "set2"]
INSTALL_ADS = ["ad1", "ad2", None]
INSTALL_DEVICES = ["iPhone14,2", "iPad8,1", "iPod9,1", "SM-G991B", "Pixel 7", None]
INSTALL_COUNTRIES = ["US", "GB", "PL", "DE", None, "FR"]
ORDER_STATUSES = ["complete", "complete", "canceled", "complete", "fraud", "shipped", "complete"]
ORDER_COUNTRIES = ["US", "GB", "UK", "PL", "DE", None, "FR", "CZ"]
NATION_NAMES = ["United States", "United Kingdom", "Germany", "Poland", "Czech Republic", "Myanmar",
                "Russian Federation", "France", "Japan", "China", "Canada", "Brazil", "Australia",
                "India", "Italy", "Spain", "Mexico", "Netherlands", "Sweden", "Korea", "Singapore",
                "Egypt", "Kenya", "Saudi Arabia", "Israel"]
NATION_ALPHA2 = ["US", "GB", "DE", "Po", "CZ", "MM", "RU", "FR", "JP", "CN", "CA", "BR", "AU",
                 "IN", "IT", "ES", "MX", "NL", "SE", "KR", "SG", "EG", "KE", "SA", "IL"]
REGION_FINANCE = ["Rest of World", "North America", "Core Asia", "Europe", "Rest of World"]
RELEASE_BASE = "2023-10-15 00:00:00"
LEDGER_SEED_BEFORE = "2024-01-12 15:30:00"

DRIVER_TABLES = ["events", "customer", "lineitem", "part", "nation", "region"]


# ---------------------------------------------------------------------------
# One definition, two dialects.  Each logical table is a list of parts
# ``(source, filter, [(column, expression), ...])`` whose expressions are SQL
# text rendered for Spark (``selectExpr``) or DuckDB; parts are unioned.
# ---------------------------------------------------------------------------

def _lit(v, d) -> str:
    if v is None:
        return "CAST(NULL AS STRING)" if d == "spark" else "NULL::VARCHAR"
    return "'" + str(v).replace("'", "''") + "'"


def _pick(values, idx: str, d: str) -> str:
    n = len(values)
    if d == "spark":
        return f"element_at(array({', '.join(_lit(v, d) for v in values)}), CAST(pmod({idx}, {n}) + 1 AS INT))"
    return f"([{', '.join(_lit(v, d) for v in values)}])[CAST((({idx}) % {n}) AS INTEGER) + 1]"


def _str(x: str, d: str) -> str:
    return f"CAST({x} AS {'STRING' if d == 'spark' else 'VARCHAR'})"


def _cat(d: str, *parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def _shift(unit: str, n: str, ts: str, d: str) -> str:
    if d == "spark":
        return f"timestampadd({unit}, {n}, {ts})"
    return f"({ts} + ({n}) * INTERVAL 1 {unit})"


def _ts(v: str, d: str) -> str:
    return f"TIMESTAMP_NTZ '{v}'" if d == "spark" else f"TIMESTAMP '{v}'"


K_SPARK = "CAST(get_json_object(props, '$.k') AS INT)"
K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_TYPES = {"spark": {"bigint": "BIGINT", "int": "INT", "string": "STRING", "double": "DOUBLE",
                    "timestamp_ntz": "TIMESTAMP_NTZ", "boolean": "BOOLEAN"},
          "duck": {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                   "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}}


def _spec(d: str) -> dict:
    """Logical table -> list of (source, filter, [(column, expr)])."""
    P = lambda vals, idx: _pick(vals, idx, d)
    S = lambda x: _str(x, d)                    # noqa: E731
    eid = S("event_id")
    src = [x for x, _ in SESSION_TRAFFIC]
    med = [m for _, m in SESSION_TRAFFIC]
    isrc = [x for x, _ in INSTALL_TRAFFIC]
    ich = [c for _, c in INSTALL_TRAFFIC]
    purchase = "event_type = 'purchase'"
    chain = _cat(d, "'bid-'", eid)

    def install_cols(t):
        return [("uuid", f"CASE WHEN (k + u) % 3 = 0 THEN NULL ELSE {_cat(d, "'user-'", S('u'))} END"),
                ("customer_user_id", _cat(d, "'cid-'", S("u"), "'-'", S("(k + 1) % 3"))),
                ("af_channel", P(ich, "k + u * 2")), ("media_source", P(isrc, "k + u * 2")),
                ("campaign", P(INSTALL_CAMPAIGNS, "k + u")), ("af_adset", P(INSTALL_ADSETS, "k")),
                ("af_ad", P(INSTALL_ADS, "k + u")), ("device_type", P(INSTALL_DEVICES, "k + u")),
                ("country_code", P(INSTALL_COUNTRIES, "k + u * 2")), ("attributed_touch_time", t)]

    share = "CAST(1 AS DOUBLE) / CAST(k % 4 + 1 AS DOUBLE)"
    return {
        "orders": [("ev", purchase, [
            ("id", "event_id"), ("subtotal", "value"), ("created_at", "ts"), ("bid_user_id", "u"),
            ("bid_chain_id", chain), ("ask_chain_id", _cat(d, "'ask-'", eid)),
            ("status", P(ORDER_STATUSES, "k")),
            ("bid_amount", "CASE WHEN k % 9 = 0 THEN NULL ELSE value * 0.75 END")])],
        "order_addresses": [
            ("ev", purchase, [("order_id", "event_id"), ("address_type", "'shipping'"),
                              ("country_id", P(ORDER_COUNTRIES, "k + u"))]),
            ("ev", purchase + " AND k % 3 = 0", [("order_id", "event_id"), ("address_type", "'billing'"),
                                                 ("country_id", "'US'")]),
            ("ev", purchase + " AND k % 25 = 1", [("order_id", "event_id"), ("address_type", "'shipping'"),
                                                  ("country_id", "'DE'")])],
        "users": [("customer", None, [("id", "c_custkey"), ("uuid", _cat(d, "'user-'", S("c_custkey")))])],
        "portfolio_items_master": [
            ("ev", purchase + " AND k % 20 <> 19", [
                ("chain_id", chain), ("state", "300"),
                ("created_at", _shift("HOUR", "-((k * 5 + u) % 48)", "ts", d))]),
            ("ev", purchase + " AND k % 20 <> 19", [
                ("chain_id", chain), ("state", "CASE WHEN k % 5 = 0 THEN 100 ELSE 300 END"),
                ("created_at", _shift("MINUTE", "-(k % 7)", "ts", d))]),
            ("ev", purchase, [("chain_id", chain), ("state", "400"), ("created_at", _shift("HOUR", "1", "ts", d))])],
        "order_items": [("lineitem", None, [("order_id", "l_orderkey"),
                                            ("sku_uuid_bin", _cat(d, "'sku-'", S("l_partkey")))])],
        "product_market_cache": [("part", None, [
            ("sku_uuid", _cat(d, "'sku-'", S("p_partkey"))), ("product_category", "p_size % 7"),
            ("product_uuid", _cat(d, "'prod-'", "p_brand")),
            ("release_date", f"CASE WHEN p_size % 10 = 0 THEN NULL ELSE "
                             f"{_shift('DAY', 'p_partkey % 110', _ts(RELEASE_BASE, d), d)} END")])],
        "order_adjustments": [("lineitem", None, [
            ("order_id", "l_orderkey"),
            ("chain_id", _cat(d, "CASE WHEN l_linenumber % 4 = 3 THEN 'bid-' ELSE 'ask-' END", S("l_orderkey"))),
            ("type", "CASE WHEN l_returnflag = 'A' THEN 'transactional' WHEN l_returnflag = 'N' THEN 'shipping' "
                     "ELSE 'shipping_original' END"),
            ("code", "CASE WHEN l_linenumber % 3 = 0 THEN 'BUYFEE_ORIG' WHEN l_linenumber % 3 = 1 "
                     "THEN 'BUYFEE_REV' ELSE 'PROMO' END"),
            ("amount", "l_extendedprice / CAST(1000 AS DOUBLE)")])],
        "sessions": [("ev", "event_type IN ('view', 'click', 'error')", [
            ("client_id", _cat(d, "'cid-'", S("u"), "'-'", S("k % 3"))),
            ("stitching_user_uuid", f"CASE WHEN (k + u) % 5 = 4 THEN NULL ELSE {_cat(d, "'user-'", S('u'))} END"),
            ("datasource", P(SESSION_DATASOURCES, "k + u")),
            ("medium", P(med, "k")), ("source", P(src, "k")),
            ("campaign", P(SESSION_CAMPAIGNS, "k * 3 + u")), ("ad_content", P(SESSION_AD_CONTENT, "k + u * 2")),
            ("keyword", P(SESSION_KEYWORDS, "k * 7 + u")), ("browser", P(SESSION_BROWSERS, "k + u")),
            ("operating_system", P(SESSION_OS, "k * 2 + u")),
            ("device_category", P(SESSION_DEVICES, "k * 11 + u")),
            ("country", P(SESSION_COUNTRIES, "k + u * 3")),
            ("visit_start_time", "ts"), ("visit_id", "event_id"),
            ("gcl_id", f"CASE WHEN event_type = 'click' THEN {_cat(d, "'gclid-'", eid)} END")])],
        "appsflyer_data_locker": [
            ("ev", "event_type = 'signup'", install_cols("ts")),
            ("ev", "event_type = 'view' AND k % 4 = 0", install_cols(_shift("SECOND", "(k * 7 + u) % 23 - 11", "ts", d)))],
        "iso_2_mapping": [("natreg", None, [("name", P(NATION_NAMES, "n_nationkey")),
                                            ("alpha2", P(NATION_ALPHA2, "n_nationkey")),
                                            ("financial_regions", P(REGION_FINANCE, "r_regionkey"))])],
        "first_order_bids": [("ev", purchase + " AND k % 4 = 0", [("order_id", "event_id")]),
                             ("ev", purchase + " AND k % 8 = 0", [("order_id", "event_id")])],
        "ledger": [("ev", f"{purchase} AND ts < {_ts(LEDGER_SEED_BEFORE, d)}", [
            ("gcl_id", _cat(d, "'gclid-'", eid)),
            ("conversion_name", "CASE WHEN k % 2 = 0 THEN 'GCLID New Buyer MTA Trades' "
                                "ELSE 'GCLID Repeat Buyer MTA Trades' END"),
            ("conversion_time", "ts"), ("attributed_credit", share),
            ("conversion_value", f"({share}) * 30"), ("conversion_currency", "'USD'"),
            ("sftp", "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN FALSE ELSE TRUE END")])],
    }


def _typed(name: str, cols, d: str) -> list[str]:
    types = {f.name: f.dataType.simpleString() for f in schemas.LOGICAL_TABLES[name].fields}
    return [f"CAST({e} AS {_TYPES[d].get(types[c], types[c])}) AS {c}" for c, e in cols]


# ---------------------------------------------------------------------------
# Spark side.
# ---------------------------------------------------------------------------

def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in DRIVER_TABLES}


def logical_tables(d: dict) -> dict:
    """Spark stand-ins of the logical tables from the driver tables ``d``."""
    bases = {"ev": d["events"].selectExpr("*", f"{K_SPARK} AS k", "user_id AS u"),
             "customer": d["customer"], "lineitem": d["lineitem"], "part": d["part"],
             "natreg": d["nation"].join(d["region"], d["nation"].n_regionkey == d["region"].r_regionkey)}
    out = {}
    for name, parts in _spec("spark").items():
        frames = []
        for source, cond, cols in parts:
            base = bases[source] if cond is None else bases[source].where(cond)
            frames.append(base.selectExpr(*_typed(name, cols, "spark")))
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f)
        out[name] = df
    return out


def load(spark: SparkSession, sf_dir: str) -> dict:
    return logical_tables(read_driver_tables(spark, sf_dir))


# ---------------------------------------------------------------------------
# DuckDB side (views ``events`` etc. are the driver's tables).
# ---------------------------------------------------------------------------

def sql_views() -> dict:
    """Logical table name -> DuckDB SELECT over the driver views."""
    bases = {"ev": f"(SELECT *, {K_SQL} AS k, user_id AS u FROM events) AS ev",
             "customer": "customer", "lineitem": "lineitem", "part": "part",
             "natreg": "(SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) AS natreg"}
    out = {}
    for name, parts in _spec("duck").items():
        selects = []
        for source, cond, cols in parts:
            where = "" if cond is None else f" WHERE {cond}"
            selects.append(f"SELECT {', '.join(_typed(name, cols, 'duck'))} FROM {bases[source]}{where}")
        out[name] = "\nUNION ALL ".join(selects)
    return out


def sql_with() -> str:
    """A ``WITH`` prefix defining every logical table as a CTE (prefixed ``x_``)."""
    return "WITH " + ",\n".join(f"x_{n} AS ({q})" for n, q in sql_views().items())
