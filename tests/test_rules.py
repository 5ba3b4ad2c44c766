"""Every branch of the classification rules, with NULLs and branch-order conflicts."""

import pytest
from pyspark.sql import functions as F

from creditflow.functions import rules as R


def _apply(spark, rows, schema, expr_fn):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_fn(df)).collect()]


def _check(spark, cases, schema, expr_fn):
    """All cases of one rule set in one DataFrame (one Spark job)."""
    rows = [c[:-1] for c in cases]
    got = _apply(spark, [r + (i,) for i, r in enumerate(rows)], schema + ", i int",
                 lambda df: F.struct(df.i, expr_fn(df)))
    got = [g[1] for g in sorted(got, key=lambda g: g[0])]
    assert list(zip(rows, got)) == [(c[:-1], c[-1]) for c in cases]


INSTALL_CHANNEL_CASES = [
    ("googleadwords_int", "x", "Paid"), ("Facebook Ads", None, "Paid"), (None, "criteo", "Paid"),
    ("snapchat_int", None, "Paid"), ("Apple Search Ads", "asa", "Paid"), ("blisspoint", "tv", "Paid"),
    ("bing_microsoft", "cpc", "Paid"), ("YouTube", "v", "Paid"), ("manage", "dsp", "Paid"),
    ("direct_deeplink", "x", "Paid"), ("tiktok_int", "ads", "Paid"), ("xyint", "ads", "Other"),
    ("referral_program", None, "Referral"), (None, "email", "Email / Leanplum"),
    ("partner", "leanplum", "Email / Leanplum"), ("mainsite", "referrer", "Email / Leanplum"),
    ("mainsite", None, "Other"), (None, None, "Other"), ("organic", None, "Other"),
]


def test_install_channel(spark):
    _check(spark, INSTALL_CHANNEL_CASES, "s string, m string",
           lambda df: R.install_channel({"source": df.s, "medium": df.m}))


SESSION_CHANNEL_CASES = [
    ("google", "cpc", "Paid"), ("Google", "CPC", "Paid"), ("criteo", "display", "Paid"),
    ("x_int", "display", "Paid"), ("xyint", "display", "Other"), ("apple search ads", "s", "Paid"),
    ("doubleclick", "d", "Paid"), ("(direct)", "(none)", "Direct"), ("google", "organic", "Organic"),
    ("rakuten", "affiliate", "Affiliate"), ("af", "imp", "Affiliate"), ("lyst", "cpc", "Paid"),
    ("shopstyle", "x", "Affiliate"), ("blog", "referral", "Referral"), ("newsletter", "email", "Email / Leanplum"),
    ("mainsite", "referrer", "Email / Leanplum"), (None, "cpc", "Other"), ("google", None, "Other"),
    (None, "referral", "Referral"), (None, None, "Other"), ("bing", "social", "Other"),
]


def test_session_channel(spark):
    _check(spark, SESSION_CHANNEL_CASES, "s string, m string",
           lambda df: R.session_channel().spark({"source": df.s, "medium": df.m,
                                                 "path": R.session_path(df.s, df.m)}))


def test_install_device(spark):
    cases = [("iPhone14,2", "iOS"), ("iPad8,1", "iOS"), ("ipod9,1", "iOS"), ("SM-G991B", "Android"),
             (None, "Android"), ("my iphone", "Android")]
    _check(spark, cases, "d string", lambda df: R.install_device().spark({"device_type": df.d}))


SESSION_DEVICE_CASES = [
    ("GoogleAnalytics", "web", "mobile", "iOS", "iOS"), ("GoogleAnalytics", "app", None, None, None),
    ("Chrome", "web", "mobile", "Windows", "Mobile Web"), ("Chrome", "web", "desktop", "Android", "Mobile Web"),
    ("Chrome", "web", None, "BlackBerry", "Mobile Web"), ("Chrome", "web", "desktop", "Windows", "desktop"),
    ("Chrome", "app", "mobile", "iOS", "mobile"), (None, "web", None, None, None),
]


def test_session_device(spark):
    _check(spark, SESSION_DEVICE_CASES, "b string, d string, c string, o string",
           lambda df: R.session_device().spark({"browser": df.b, "datasource": df.d, "device_category": df.c,
                                                "operating_system": df.o}))


def test_source_label_country_alpha2(spark):
    df = spark.createDataFrame([("app", "UK", "Po"), ("web", "GB", "PL"), (None, "Czechia", None),
                                ("web", "Atlantis", "US"), ("web", None, None)], "d string, c string, a string")
    out = df.select(R.session_source_label().spark({"datasource": df.d}),
                    R.country_name().spark({"country": df.c}),
                    R.alpha2_fix().spark({"alpha2": df.a})).collect()
    assert [tuple(r) for r in out] == [
        ("app-107725170", "United Kingdom", "PL"), ("web-107718485", "United Kingdom", "PL"),
        ("web-107718485", "Czech Republic", None), ("web-107718485", "Atlantis", "US"),
        ("web-107718485", None, None)]


CHANNEL_MAP_CASES = [
    ("facebook", "cpc", "Facebook"), ("criteo", "x", "Criteo"), ("google", "organic", "Other"),
    ("Google", "Organic", "Other"), ("google", "organic_x", "Google"), ("google", "cpc", "Google"),
    ("manage", "x", "Manage"), ("snapchat_int", "x", "Snapchat"), ("apple", "x", "Apple"),
    (None, None, "Other"), ("bing", "cpc", "Other"),
]


def test_channel_map(spark):
    _check(spark, CHANNEL_MAP_CASES, "s string, m string",
           lambda df: R.channel_map().spark({"source": df.s, "medium": df.m}))


CHANNEL_GROUP_CASES = [
    ("criteo", "x", None, "Paid", "Criteo", "Paid - Criteo"),
    ("google", "cpc", None, "Paid", "Google", "Paid - Google"),
    ("x", "googleads", None, "Other", "Other", "Paid - Google"),
    ("site", "editorial", None, "Other", "Other", "Paid - Media Buy"),
    ("Facebook Ads", "x", None, "Other", "Facebook", "Paid - Paid Social"),
    ("apple store search", "x", None, "Other", "Apple", "Paid - Other"),
    ("sendgrid", "x", None, "Email / Leanplum", "Other", "Owned - Email / Leanplum"),
    ("instagram", "x", "stockx_drop", "Other", "Other", "Owned - Social"),
    ("x", "curalate", None, "Other", "Other", "Owned - Social"),
    ("(direct)", "(none)", None, "Direct", "Other", "Direct - Direct"),
    ("google", "organic", None, "Organic", "Other", "Organic - Organic"),
    ("bing", "organic", None, "Organic", "Other", "Organic - Organic"),
    ("x_int", "display", None, "Paid", "Other", "Paid - Other"),
    ("rakuten", "affiliate", None, "Affiliate", "Other", "Paid - Affiliate"),
    ("newsletter", "email", None, "Email / Leanplum", "Other", "Owned - Email / Leanplum"),
    (None, None, None, None, "Other", "Other - Other"),
    ("snapchat", "x", None, "Paid", "Snapchat", "Paid - Paid Social"),
    ("apple", "x", None, "Paid", "Apple", "Paid - Other"),
    ("google", "x", None, None, "Google", None),
    ("google", "x", None, "Referral", "Google", "Referral - Google"),
]


def test_channel_group(spark):
    _check(spark, CHANNEL_GROUP_CASES, "s string, m string, c string, k string, p string",
           lambda df: R.channel_group().spark({"source": df.s, "medium": df.m, "campaign": df.c,
                                               "source_clean": df.k, "map": df.p}))


def test_vertical_region_flag_names(spark):
    df = spark.createDataFrame([(0, "GB", "Europe", 29, "complete", "New"),
                                (5, "JP", "Core Asia", 1, "fraud", "Return"),
                                (6, None, None, None, None, None)],
                               "v int, a string, f string, u long, st string, t string")
    out = df.select(R.vertical_name().spark({"vertical": df.v}),
                    R.financial_region().spark({"alpha2": df.a, "financial_regions": df.f}),
                    R.logic_flag(df.u, df.st), R.conversion_name(df.t)).collect()
    assert [tuple(r) for r in out] == [
        ("N/A", "UK", 1, "GCLID New Buyer MTA Trades"),
        ("Collectibles", "Rest of World", 1, "GCLID Repeat Buyer MTA Trades"),
        (None, None, 0, "GCLID Repeat Buyer MTA Trades")]


def test_rules_render_sql_matches_spark(spark):
    """The SQL rendering used by the oracle agrees with the Spark rendering."""
    import duckdb
    rows = [("google", "cpc", "c"), ("(direct)", "(none)", None), (None, "email", "stockx"),
            ("x_int", None, None), ("apple search ads", "q", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "s string, m string, c string")
    env = {"source": df.s, "medium": df.m, "path": R.session_path(df.s, df.m), "campaign": df.c}
    spark_out = [r[0] for r in df.select(R.session_channel().spark(env)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s VARCHAR, m VARCHAR, c VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    senv = {"source": "s", "medium": "m", "path": "lower(s || '/' || m)", "campaign": "c"}
    sql_out = [r[0] for r in con.execute(f"SELECT {R.session_channel().sql(senv)} FROM t").fetchall()]
    assert spark_out == sql_out


AFFILIATES = ["af/imp", "af/rak", "haitao", "mifanli", "rakuten", "ebates", "slickdeals", "suplexed", "lyst", "srvtrck", "modesens",
              "fkdeals", "thedropdate", "duomai", "rstyle", "shopstyle", "solsense", "hypeanalyzer"]
COUNTRIES = [("Czechia", "Czech Republic"), ("DE", "Germany"), ("Myanmar (Burma)", "Myanmar"), ("Russia", "Russian Federation"),
             ("UK", "United Kingdom"), ("GB", "United Kingdom"), ("US", "United States"), ("Atlantis", "Atlantis"), (None, None)]


def test_every_affiliate_needle_and_country_name(spark):
    """One hand case each, in source and in medium, in capitals too."""
    rows = [(f"Www.{a.upper()}.com", "link") for a in AFFILIATES] + [("partner", f"x-{a}") for a in AFFILIATES]
    df = spark.createDataFrame(rows, "source string, medium string").withColumn("path", R.session_path(F.col("source"), F.col("medium")))
    got = df.select(R.session_channel().spark(R.cols("source", "medium", "path")).alias("c")).collect()
    assert [r.c for r in got] == ["Affiliate"] * len(rows)
    df = spark.createDataFrame(COUNTRIES, "country string, want string").select("want", R.country_name().spark(R.cols("country")).alias("got"))
    assert all(r.got == r.want for r in df.collect())


def test_a_wrong_needle_or_order_turns_the_oracle_red(spark, monkeypatch):
    """The oracle has rules of its own: a misspelt needle and two swapped rules both show."""
    from creditflow.plans import oracle, queries
    from tests.compare import compare, duck
    sf = "/root/testdata/sf0.001"
    con = duck(sf)

    def green():
        return compare(spark, con, "q_session_channel", queries.q_session_channel, oracle.queries()["q_session_channel"], sf)[0]

    assert green()
    with monkeypatch.context() as m:
        m.setattr(R, "AFFILIATE_NEEDLES", [n.replace("duomai", "duomia") for n in R.AFFILIATE_NEEDLES])
        assert not green()
    with monkeypatch.context() as m:
        swapped = R.session_channel().rules
        swapped[0], swapped[2] = swapped[2], swapped[0]
        real = R.RuleSet
        m.setattr(R, "session_channel", lambda: real([(c, o) for c, o in swapped], "Other"))
        assert not green()
