"""Ordered classification rules (first match wins) as Spark columns.

Each rule set is data (an ordered list of ``(condition, result)``) rendered
into one ``F.when`` chain, so it stays a JVM-side expression inside
whole-stage codegen.  The same data renders to SQL text for the DuckDB
oracle used by the correctness checks.

NULL semantics follow SQL: a condition that evaluates to NULL does not
match and evaluation falls through to the next branch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the job's definitions; order matters).
# ---------------------------------------------------------------------------

# Install channel (media source / channel), checked in this order.
INSTALL_PAID_CHANNELS = [
    ("google", "Google Paid"),
    ("facebook", "Facebook Paid"),
    ("criteo", "Criteo Paid"),
    ("snapchat", "Snapchat Paid"),
    ("apple", "Apple Paid"),
    ("blisspoint", "Blisspoint Paid"),
    ("microsoft", "Microsoft Paid"),
    ("youtube", "Youtube Paid"),
    ("manage", "Manage Paid"),
    ("direct", "Direct Paid"),
    ("_int", "Other Paid"),
]
# Session channel needles tested on lower(source || '/' || medium).
SESSION_PAID_NEEDLES = ["cpc", "criteo", "_int", "apple search ads", "doubleclick"]
SESSION_DIRECT_NEEDLE = "direct"
SESSION_ORGANIC_NEEDLE = "organic"
AFFILIATE_NEEDLES = ["af/imp", "af/rak", "haitao", "mifanli", "rakuten", "ebates", "slickdeals",
                     "suplexed", "lyst", "srvtrck", "modesens", "fkdeals", "thedropdate", "duomai",
                     "rstyle", "shopstyle", "solsense", "hypeanalyzer"]
REFERRAL_NEEDLE = "referral"
EMAIL_NEEDLES = ["email", "leanplum"]
EMAIL_MAIN_SOURCE, EMAIL_REFERRER_MEDIUM = "main", "referrer"
# Install device prefixes (lower-cased device type).
IOS_DEVICE_PREFIXES = ["iphone", "ipad", "ipod"]
# Session device.
ANALYTICS_BROWSER = "GoogleAnalytics"
MOBILE_DEVICE_CATEGORIES = ["mobile", "tablet"]
MOBILE_OPERATING_SYSTEMS = ["iOS", "Android", "BlackBerry", "Windows Phone"]
# Data source labels.
APP_DATASOURCE, WEB_DATASOURCE = "app", "web"
APP_SOURCE_LABEL, WEB_SOURCE_LABEL = "app-107725170", "web-107718485"
INSTALL_SOURCE_LABEL = "AppsFlyer"
# Country name normalisation before the dimension lookup, then alpha2 fixes.
COUNTRY_NAME_FIXES = [
    ("Czechia", "Czech Republic"),
    ("DE", "Germany"),
    ("Myanmar (Burma)", "Myanmar"),
    ("Russia", "Russian Federation"),
    ("UK", "United Kingdom"),
    ("GB", "United Kingdom"),
    ("US", "United States"),
]
ALPHA2_FIXES = [("Po", "PL")]
ORDER_COUNTRY_FIXES = [("UK", "GB")]
# Sale indicator thresholds after the release date.
RELEASE_DAYS, CYCLE_WEEKS = 5, 8
# Orders flagged for review (flag only; never filtered).
FLAGGED_USER_ID, FLAGGED_STATUSES = 29, ["canceled", "fraud"]
# Direct visit markers.
DIRECT_MEDIUM, DIRECT_SOURCE = "(none)", "(direct)"
# Wide install-match band for these networks (else 10 seconds).
WIDE_BAND_NETWORKS = ["snapchat", "facebook"]
NARROW_BAND_SECONDS, WIDE_BAND_DAYS = 10, 1
# Channel map on (source_c, medium_c).
CHANNEL_MAP = [
    ("facebook", "Facebook"),
    ("criteo", "Criteo"),
    (("google", "organic"), "Other"),     # exact source google + exact medium organic
    ("google", "Google"),
    ("manage", "Manage"),
    ("snapchat", "Snapchat"),
    ("apple", "Apple"),
]
CHANNEL_MAP_DEFAULT = "Other"
# Channel group rules on touch attributes.
PAID_SOCIAL_SOURCES = ["facebook", "facebook ads", "snapchat_int"]
OWNED_SOCIAL_CAMPAIGN = "stockx"
OWNED_SOCIAL_SOURCES = ["facebook", "instagram", "snapchat", "twitter"]
CURALATE = "curalate"
# Group from (source_clean_c, map) pairs, checked after the attribute rules.
CLEAN_MAP_GROUPS = [
    ("Direct", ["Other"], "Direct - Direct"),
    ("Organic", ["Other", "Google"], "Organic - Organic"),
    ("Paid", ["Google"], "Paid - Google"),
    ("Paid", ["Facebook", "Snapchat"], "Paid - Paid Social"),
    ("Affiliate", ["Other"], "Paid - Affiliate"),
    ("Paid", ["Criteo", "Manage"], "Paid - Criteo"),
    ("Paid", ["Apple"], "Paid - Other"),
    ("Email / Leanplum", ["Other"], "Owned - Email / Leanplum"),
]
# Vertical names by product category code.
VERTICAL_NAMES = [(0, "N/A"), (1, "Sneakers"), (2, "Handbags"), (3, "Watches"),
                  (4, "Streetwear"), (5, "Collectibles")]
# Financial region fixes.
UK_ALPHA2, UK_REGION = "GB", "UK"
CORE_ASIA, REST_OF_WORLD = "Core Asia", "Rest of World"
# Conversion names.
NEW_BUYER, RETURN_BUYER = "New", "Return"
NEW_BUYER_CONVERSION = "GCLID New Buyer MTA Trades"
REPEAT_BUYER_CONVERSION = "GCLID Repeat Buyer MTA Trades"
CONVERSION_CURRENCY = "USD"
CONVERSION_VALUE_PER_CREDIT = 30
NEW_BUYER_VALUE_FLOOR, NEW_BUYER_VALUE_RATE = 10, 0.09


# ---------------------------------------------------------------------------
# A tiny condition algebra with two renderers (Spark Column, SQL text).
# ``env`` maps logical names to a Column (Spark) or SQL expression (oracle).
# ---------------------------------------------------------------------------

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lower(env, name: str) -> Column:
    """The lower-cased value: its own column where ``lowered`` has made one."""
    return env[name + ".lower"] if name + ".lower" in env else F.lower(env[name])


def lowered(df: DataFrame, env: dict, *names: str) -> tuple[DataFrame, dict]:
    """``df`` with the lower-cased values of ``names`` as columns, made once a row, and ``env`` with them.

    A chain tests a value against dozens of needles, and Spark shares nothing
    between the branches of a chain.
    """
    made = {f"_lower_{n}": F.lower(env[n]) for n in names}
    return df.withColumns(made), env | {n + ".lower": F.col(f"_lower_{n}") for n in names}


class Cond:
    def __and__(self, other: "Cond") -> "Cond":
        return _Bool("AND", [self, other])

    def __or__(self, other: "Cond") -> "Cond":
        return _Bool("OR", [self, other])


class _Bool(Cond):
    def __init__(self, op, parts):
        self.op, self.parts = op, parts

    def spark(self, env):
        cols = [p.spark(env) for p in self.parts]
        return reduce((lambda a, b: a & b) if self.op == "AND" else (lambda a, b: a | b), cols)

    def sql(self, env):
        return "(" + f" {self.op} ".join(p.sql(env) for p in self.parts) + ")"


def any_of(*conds: Cond) -> Cond:
    return _Bool("OR", list(conds))


def all_of(*conds: Cond) -> Cond:
    return _Bool("AND", list(conds))


class Has(Cond):
    """Case-insensitive substring test (``lower(c) LIKE '%needle%'``)."""

    def __init__(self, name, needle, lowered=False):
        self.name, self.needle, self.lowered = name, needle, lowered

    def spark(self, env):
        c = env[self.name] if self.lowered else _lower(env, self.name)
        return c.contains(self.needle)

    def sql(self, env):
        c = env[self.name] if self.lowered else f"lower({env[self.name]})"
        return f"contains({c}, {_q(self.needle)})"


class Starts(Cond):
    def __init__(self, name, prefix):
        self.name, self.prefix = name, prefix

    def spark(self, env):
        return _lower(env, self.name).startswith(self.prefix)

    def sql(self, env):
        return f"starts_with(lower({env[self.name]}), {_q(self.prefix)})"


class Like(Cond):
    """Case-insensitive LIKE with a pattern free of escapes."""

    def __init__(self, name, pattern):
        self.name, self.pattern = name, pattern

    def spark(self, env):
        return _lower(env, self.name).like(self.pattern)

    def sql(self, env):
        return f"(lower({env[self.name]}) LIKE {_q(self.pattern)})"


class Eq(Cond):
    def __init__(self, name, value, lower=False):
        self.name, self.value, self.lower = name, value, lower

    def spark(self, env):
        c = _lower(env, self.name) if self.lower else env[self.name]
        return c == F.lit(self.value)

    def sql(self, env):
        c = f"lower({env[self.name]})" if self.lower else env[self.name]
        v = _q(self.value) if isinstance(self.value, str) else str(self.value)
        return f"({c} = {v})"


class In(Cond):
    def __init__(self, name, values, lower=False):
        self.name, self.values, self.lower = name, list(values), lower

    def spark(self, env):
        c = _lower(env, self.name) if self.lower else env[self.name]
        return c.isin(self.values)

    def sql(self, env):
        c = f"lower({env[self.name]})" if self.lower else env[self.name]
        return f"({c} IN ({', '.join(_q(v) for v in self.values)}))"


class IsNull(Cond):
    def __init__(self, name):
        self.name = name

    def spark(self, env):
        return env[self.name].isNull()

    def sql(self, env):
        return f"({env[self.name]} IS NULL)"


def either(needle: str, a: str = "source", b: str = "medium") -> Cond:
    """``needle`` in lower(a) or in lower(b)."""
    return Has(a, needle) | Has(b, needle)


class Out:
    """A branch result: a literal, a reference, or a NULL-propagating concat."""

    def __init__(self, lit=None, ref=None, concat=None):
        self.lit, self.ref, self.concat = lit, ref, concat

    def spark(self, env):
        if self.ref is not None:
            return env[self.ref]
        if self.concat is not None:
            return F.concat(*[p.spark(env) for p in self.concat])
        return F.lit(self.lit)

    def sql(self, env):
        if self.ref is not None:
            return env[self.ref]
        if self.concat is not None:
            return "(" + " || ".join(p.sql(env) for p in self.concat) + ")"
        return "NULL" if self.lit is None else _q(self.lit)


def _out(v) -> Out:
    return v if isinstance(v, Out) else Out(lit=v)


class RuleSet:
    """Ordered ``(Cond, result)`` list with a default (``None`` = NULL)."""

    def __init__(self, rules, default=None):
        self.rules = [(c, _out(v)) for c, v in rules]
        self.default = None if default is None else _out(default)

    def spark(self, env) -> Column:
        expr = None
        for cond, out in self.rules:
            expr = (F.when(cond.spark(env), out.spark(env)) if expr is None
                    else expr.when(cond.spark(env), out.spark(env)))
        return expr if self.default is None else expr.otherwise(self.default.spark(env))

    def sql(self, env) -> str:
        parts = " ".join(f"WHEN {c.sql(env)} THEN {o.sql(env)}" for c, o in self.rules)
        tail = "" if self.default is None else f" ELSE {self.default.sql(env)}"
        return f"CASE {parts}{tail} END"


# ---------------------------------------------------------------------------
# Rule sets.  Logical input names are listed in each docstring.
# ---------------------------------------------------------------------------

def _email_rule() -> Cond:
    return any_of(*[either(n) for n in EMAIL_NEEDLES],
                  Has("source", EMAIL_MAIN_SOURCE) & Has("medium", EMAIL_REFERRER_MEDIUM))


def install_channel_detail() -> RuleSet:
    """R1 inner chain on (source, medium) -> 'X Paid' / Referral / Email / Leanplum / Other."""
    rules = [(either(n), label) for n, label in INSTALL_PAID_CHANNELS]
    rules += [(either(REFERRAL_NEEDLE), "Referral"), (_email_rule(), "Email / Leanplum")]
    return RuleSet(rules, "Other")


def install_channel(env) -> Column:
    """The detailed install channel, any '... Paid' collapsed to 'Paid'."""
    detail = install_channel_detail().spark(env)
    return F.when(detail.endswith("Paid"), F.lit("Paid")).otherwise(detail)


def install_channel_sql(env) -> str:
    d = install_channel_detail().sql(env)
    return f"CASE WHEN ends_with({d}, 'Paid') THEN 'Paid' ELSE {d} END"


def session_channel() -> RuleSet:
    """R2 on (path = lower(source || '/' || medium), source, medium)."""
    path = lambda n: Has("path", n, lowered=True)
    return RuleSet([
        (any_of(*[path(n) for n in SESSION_PAID_NEEDLES]), "Paid"),
        (path(SESSION_DIRECT_NEEDLE), "Direct"),
        (path(SESSION_ORGANIC_NEEDLE), "Organic"),
        (any_of(*[path(n) for n in AFFILIATE_NEEDLES]), "Affiliate"),
        (either(REFERRAL_NEEDLE), "Referral"),
        (_email_rule(), "Email / Leanplum"),
    ], "Other")


def session_path(source: Column, medium: Column) -> Column:
    """lower(source || '/' || medium): NULL when either part is NULL."""
    return F.lower(F.concat(source, F.lit("/"), medium))


def install_device() -> RuleSet:
    """R3 on device_type."""
    return RuleSet([(any_of(*[Starts("device_type", p) for p in IOS_DEVICE_PREFIXES]), "iOS")],
                   "Android")


def session_device() -> RuleSet:
    """R4 on (browser, datasource, device_category, operating_system)."""
    mobile = Eq("datasource", WEB_DATASOURCE) & (
        In("device_category", MOBILE_DEVICE_CATEGORIES) | In("operating_system", MOBILE_OPERATING_SYSTEMS))
    return RuleSet([(Eq("browser", ANALYTICS_BROWSER), Out(ref="operating_system")),
                    (mobile, "Mobile Web")], Out(ref="device_category"))


def session_source_label() -> RuleSet:
    """R5 on datasource."""
    return RuleSet([(Eq("datasource", APP_DATASOURCE), APP_SOURCE_LABEL)], WEB_SOURCE_LABEL)


def country_name() -> RuleSet:
    """R6 on country."""
    return RuleSet([(Eq("country", a), b) for a, b in COUNTRY_NAME_FIXES], Out(ref="country"))


def alpha2_fix() -> RuleSet:
    """R7 on alpha2."""
    return RuleSet([(Eq("alpha2", a), b) for a, b in ALPHA2_FIXES], Out(ref="alpha2"))


def order_country_key() -> RuleSet:
    """R18 lookup key on country (touch country else order country)."""
    return RuleSet([(Eq("country", a), b) for a, b in ORDER_COUNTRY_FIXES], Out(ref="country"))


def logic_flag(bid_user_id: Column, status: Column) -> Column:
    """1 for the flagged user or a canceled/fraud status, else 0."""
    return F.when((bid_user_id == FLAGGED_USER_ID) | status.isin(FLAGGED_STATUSES), 1).otherwise(0)


def channel_map() -> RuleSet:
    """R11 on (source_c, medium_c)."""
    rules = []
    for key, label in CHANNEL_MAP:
        if isinstance(key, tuple):
            rules.append((Eq("source", key[0], lower=True) & Eq("medium", key[1], lower=True), label))
        else:
            rules.append((either(key), label))
    return RuleSet(rules, CHANNEL_MAP_DEFAULT)


def channel_group() -> RuleSet:
    """R12 on (source, medium, campaign, source_clean, map) -> 'Part1 - Part2'."""
    rules = [
        (either("criteo") | either("manage"), "Paid - Criteo"),
        ((Has("source", "google") & Has("medium", "cpc")) | either("googleads"), "Paid - Google"),
        (Has("medium", "editorial"), "Paid - Media Buy"),
        (In("source", PAID_SOCIAL_SOURCES, lower=True), "Paid - Paid Social"),
        (Like("source", "%apple%search%"), "Paid - Other"),
        (either("leanplum") | either("sendgrid"), "Owned - Email / Leanplum"),
        ((Has("campaign", OWNED_SOCIAL_CAMPAIGN) & any_of(*[Has("source", s) for s in OWNED_SOCIAL_SOURCES]))
         | either(CURALATE, "medium", "source"), "Owned - Social"),
    ]
    rules += [(Eq("source_clean", clean) & In("map", maps), group) for clean, maps, group in CLEAN_MAP_GROUPS]
    rules.append((IsNull("source_clean") & Eq("map", "Other"), "Other - Other"))
    fallback = Out(concat=[Out(ref="source_clean"), Out(lit=" - "), Out(ref="map")])
    return RuleSet(rules, fallback)


def vertical_name() -> RuleSet:
    """R14 on vertical (no default: unknown codes give NULL)."""
    return RuleSet([(Eq("vertical", code), name) for code, name in VERTICAL_NAMES])


def financial_region() -> RuleSet:
    """R15 on (alpha2, financial_regions)."""
    return RuleSet([(Eq("alpha2", UK_ALPHA2), UK_REGION),
                    (Eq("financial_regions", CORE_ASIA), REST_OF_WORLD)],
                   Out(ref="financial_regions"))


def conversion_name(buyer_type: Column) -> Column:
    """R17."""
    return F.when(buyer_type == NEW_BUYER, NEW_BUYER_CONVERSION).otherwise(REPEAT_BUYER_CONVERSION)


def cols(*names: str, **renamed: str) -> dict:
    """Spark env: logical name -> column (``renamed`` maps logical -> physical)."""
    env = {n: F.col(n) for n in names}
    env.update({k: F.col(v) for k, v in renamed.items()})
    return env
