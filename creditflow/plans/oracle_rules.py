"""The classification rules as ranked needle rows for the DuckDB oracle.

Written from the job's rule definitions on their own, without a look at
``creditflow.functions.rules``: a needle or an order that is wrong there turns
a query red.  A row is (rank, (field, test, text), and maybe a second such
condition, label); of the rows that hold, the lowest rank gives the label.

Tests: ``has`` and ``starts`` on the lower-cased field, ``is`` equality of the
lower-cased field, ``same`` exact equality, ``null``.
"""

from __future__ import annotations

# Fixed values.
_EITHER = ("source", "medium")
_MAIL = [("email",), ("leanplum",)]


def _both(rank: int, needle: str, label: str, fields=_EITHER) -> list[tuple]:
    return [(rank, (f, "has", needle), None, label) for f in fields]


INSTALL_CHANNEL = [row for needle in ("google", "facebook", "criteo", "snapchat", "apple", "blisspoint", "microsoft", "youtube", "manage", "direct", "_int")
                   for row in _both(1, needle, "Paid")]
INSTALL_CHANNEL += _both(2, "referral", "Referral")
INSTALL_CHANNEL += _both(3, "email", "Email / Leanplum") + _both(3, "leanplum", "Email / Leanplum")
INSTALL_CHANNEL += [(3, ("source", "has", "main"), ("medium", "has", "referrer"), "Email / Leanplum"), (9, None, None, "Other")]

SESSION_CHANNEL = [(1, ("path", "has", x), None, "Paid") for x in ("cpc", "criteo", "_int", "apple search ads", "doubleclick")]
SESSION_CHANNEL += [(2, ("path", "has", "direct"), None, "Direct"), (3, ("path", "has", "organic"), None, "Organic")]
SESSION_CHANNEL += [(4, ("path", "has", x), None, "Affiliate") for x in (
    "af/imp", "af/rak", "haitao", "mifanli", "rakuten", "ebates", "slickdeals", "suplexed", "lyst", "srvtrck", "modesens", "fkdeals",
    "thedropdate", "duomai", "rstyle", "shopstyle", "solsense", "hypeanalyzer")]
SESSION_CHANNEL += _both(5, "referral", "Referral")
SESSION_CHANNEL += _both(6, "email", "Email / Leanplum") + _both(6, "leanplum", "Email / Leanplum")
SESSION_CHANNEL += [(6, ("source", "has", "main"), ("medium", "has", "referrer"), "Email / Leanplum"), (9, None, None, "Other")]

INSTALL_DEVICE = [(1, ("device_type", "starts", x), None, "iOS") for x in ("iphone", "ipad", "ipod")] + [(9, None, None, "Android")]

CHANNEL_MAP = (_both(1, "facebook", "Facebook") + _both(2, "criteo", "Criteo") + [(3, ("source", "is", "google"), ("medium", "is", "organic"), "Other")]
               + _both(4, "google", "Google") + _both(5, "manage", "Manage") + _both(6, "snapchat", "Snapchat") + _both(7, "apple", "Apple")
               + [(9, None, None, "Other")])

CHANNEL_GROUP = (
    _both(1, "criteo", "Paid - Criteo") + _both(1, "manage", "Paid - Criteo")
    + [(2, ("source", "has", "google"), ("medium", "has", "cpc"), "Paid - Google")] + _both(2, "googleads", "Paid - Google")
    + [(3, ("medium", "has", "editorial"), None, "Paid - Media Buy")]
    + [(4, ("source", "is", x), None, "Paid - Paid Social") for x in ("facebook", "facebook ads", "snapchat_int")]
    + [(5, ("source", "like", "%apple%search%"), None, "Paid - Other")]
    + _both(6, "leanplum", "Owned - Email / Leanplum") + _both(6, "sendgrid", "Owned - Email / Leanplum")
    + [(7, ("campaign", "has", "stockx"), ("source", "has", x), "Owned - Social") for x in ("facebook", "instagram", "snapchat", "twitter")]
    + _both(7, "curalate", "Owned - Social")
    + [(8, ("clean", "same", clean), ("map", "same", m), group) for clean, m, group in (
        ("Direct", "Other", "Direct - Direct"), ("Organic", "Other", "Organic - Organic"), ("Organic", "Google", "Organic - Organic"),
        ("Paid", "Google", "Paid - Google"), ("Paid", "Facebook", "Paid - Paid Social"), ("Paid", "Snapchat", "Paid - Paid Social"),
        ("Affiliate", "Other", "Paid - Affiliate"), ("Paid", "Criteo", "Paid - Criteo"), ("Paid", "Manage", "Paid - Criteo"),
        ("Paid", "Apple", "Paid - Other"), ("Email / Leanplum", "Other", "Owned - Email / Leanplum"))]
    + [(9, ("clean", "null", ""), ("map", "same", "Other"), "Other - Other")])

COUNTRY_NAME = {"Czechia": "Czech Republic", "DE": "Germany", "Myanmar (Burma)": "Myanmar", "Russia": "Russian Federation",
                "UK": "United Kingdom", "GB": "United Kingdom", "US": "United States"}
VERTICAL = {0: "N/A", 1: "Sneakers", 2: "Handbags", 3: "Watches", 4: "Streetwear", 5: "Collectibles"}

SETS = {"install_channel": INSTALL_CHANNEL, "session_channel": SESSION_CHANNEL, "install_device": INSTALL_DEVICE,
        "channel_map": CHANNEL_MAP, "channel_group": CHANNEL_GROUP}


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def needles_cte(name: str) -> str:
    """``needles_<name>``: the rows of one rule set."""
    rows = []
    for rank, a, b, label in SETS[name]:
        a, b = a or (None, "any", None), b or (None, "any", None)
        rows.append(f"({rank}, {', '.join(_q(x) for x in (*a, *b, label))})")
    return f"needles_{name}(rank, field1, test1, text1, field2, test2, text2, label) AS (VALUES {', '.join(rows)})"


def labels_cte(name: str, source: str, fields: dict[str, str], out: str) -> str:
    """``out``: the label of every distinct combination of ``fields`` (rule field -> column of ``source``)."""
    columns = list(dict.fromkeys(fields.values()))
    values = "CASE {f} " + " ".join(f"WHEN '{f}' THEN CAST(c.{c} AS varchar)" for f, c in fields.items()) + " END"

    def holds(k: int) -> str:
        v = values.format(f=f"n.field{k}")
        return (f"CASE n.test{k} WHEN 'any' THEN TRUE WHEN 'has' THEN contains(lower({v}), n.text{k}) WHEN 'starts' THEN starts_with(lower({v}), n.text{k}) "
                f"WHEN 'is' THEN lower({v}) = n.text{k} WHEN 'same' THEN {v} = n.text{k} WHEN 'like' THEN lower({v}) LIKE n.text{k} WHEN 'null' THEN {v} IS NULL END")

    keys = ", ".join(f"c.{c}" for c in columns)
    return f"""{out} AS (
  SELECT {keys}, arg_min(n.label, n.rank) AS label
  FROM (SELECT DISTINCT {', '.join(columns)} FROM {source}) c JOIN needles_{name} n ON ({holds(1)}) AND ({holds(2)})
  GROUP BY {keys})"""


def lookup(out: str, alias: str, fields: dict[str, str]) -> str:
    """Join condition of ``alias`` to the labels in ``out``; the columns may be NULL."""
    return " AND ".join(f"{alias}.{c} IS NOT DISTINCT FROM {out}.{c}" for c in dict.fromkeys(fields.values()))


def cases(expr: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {_q(k) if isinstance(k, str) else k} THEN {_q(v)}" for k, v in table.items())
    return f"CASE {expr} {arms} ELSE {default} END"
