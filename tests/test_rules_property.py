"""Property: the Spark and the SQL rendering of every rule set agree on any input.

The oracle relies on the SQL rendering; this checks both renderings on
random strings built from the rule needles (mixed case, NULLs, underscores).
"""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from creditflow.functions import rules as R

FRAGMENTS = ["google", "GOOGLE", "cpc", "organic", "(direct)", "(none)", "direct", "facebook", "Facebook Ads",
             "snapchat", "_int", "int", "x_", "criteo", "manage", "apple", "search", "apple search ads",
             "doubleclick", "rakuten", "af/imp", "lyst", "referral", "referrer", "main", "email", "leanplum",
             "sendgrid", "editorial", "googleads", "stockx", "instagram", "curalate", "iphone", "iPad", "ipod",
             "web", "app", "mobile", "tablet", "iOS", "Android", "GoogleAnalytics", "UK", "GB", "Po", "/", " ", "-"]

text = st.one_of(st.none(), st.lists(st.sampled_from(FRAGMENTS), min_size=0, max_size=3).map("".join))
CLEAN = st.one_of(st.none(), st.sampled_from(["Paid", "Direct", "Organic", "Affiliate", "Referral",
                                               "Email / Leanplum", "Other"]))
MAP = st.sampled_from(["Facebook", "Criteo", "Google", "Manage", "Snapchat", "Apple", "Other"])
COLS = ["source", "medium", "campaign", "source_clean", "map", "browser", "datasource",
        "device_category", "operating_system", "device_type", "country", "alpha2", "financial_regions"]
ROW = st.tuples(text, text, text, CLEAN, MAP, text, text, text, text, text, text, text, text)


def _renderings():
    sess = {c: c for c in COLS}
    sess["path"] = "lower(source || '/' || medium)"
    return [
        ("install_channel", lambda e: R.install_channel(e), lambda e: R.install_channel_sql(e)),
        ("session_channel", lambda e: R.session_channel().spark(e), lambda e: R.session_channel().sql(e)),
        ("install_device", lambda e: R.install_device().spark(e), lambda e: R.install_device().sql(e)),
        ("session_device", lambda e: R.session_device().spark(e), lambda e: R.session_device().sql(e)),
        ("source_label", lambda e: R.session_source_label().spark(e), lambda e: R.session_source_label().sql(e)),
        ("country_name", lambda e: R.country_name().spark(e), lambda e: R.country_name().sql(e)),
        ("alpha2_fix", lambda e: R.alpha2_fix().spark(e), lambda e: R.alpha2_fix().sql(e)),
        ("channel_map", lambda e: R.channel_map().spark(e), lambda e: R.channel_map().sql(e)),
        ("channel_group", lambda e: R.channel_group().spark(e), lambda e: R.channel_group().sql(e)),
        ("financial_region", lambda e: R.financial_region().spark(e), lambda e: R.financial_region().sql(e)),
    ], sess


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture,
                                                                 HealthCheck.too_slow])
@given(rows=st.lists(ROW, min_size=40, max_size=40))
def test_spark_and_sql_renderings_agree(spark, rows):
    renders, sql_env = _renderings()
    rows = [r + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS) + ", i int")
    env = {c: df[c] for c in COLS}
    env["path"] = R.session_path(df.source, df.medium)
    spark_out = df.select("i", *[fn(env).alias(n) for n, fn, _ in renders]).orderBy("i").collect()
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({', '.join(c + ' VARCHAR' for c in COLS)}, i INTEGER)")
    con.executemany(f"INSERT INTO t VALUES ({', '.join('?' for _ in range(len(COLS) + 1))})", rows)
    sql = f"SELECT i, {', '.join(f'{fn(sql_env)} AS {n}' for n, _, fn in renders)} FROM t ORDER BY i"
    duck_out = con.execute(sql).fetchall()
    assert [tuple(r) for r in spark_out] == [tuple(r) for r in duck_out]
