"""Format-preserving pseudonyms for personal numbers and dates (DataFrame functions only).

Found by pattern, then validated; only valid values change:

* card: 13 to 19 digits, single spaces or hyphens between, right Luhn digit
* phone: international or North American notation with 10 national digits
* ssn: ddd-dd-dddd with an area, group and serial that can be given out
* ip: four decimal octets of an IPv4 address
* date: yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy, a real day of 1800 to 2199

A value's variable part is a number of a domain of A * B values.  ``ROUNDS``
rounds of a Feistel network on the two parts, with sums modulo A and B and
round functions from SHA-256 over key, format, round and the other part, permute
that domain.  So equal values get equal pseudonyms in all documents, different
ones different pseudonyms, and a pseudonym is valid in the same format: a card
keeps its length, first digit and layout and gets its Luhn digit, a phone keeps
its country code, a date stays a day in the same notation.

Defined results: a null text stays null, with counts of 0; an empty text stays
empty.  Repeated rows are treated alike.  Other columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KEY = "change-me"
KINDS = ("card", "phone", "ssn", "ip", "date")
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "date": "(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[.][0-9]{2}[.][0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9/]|[.-][0-9])",
    "ip": f"(?<![0-9.])(?:{_OCTET}[.]){{3}}{_OCTET}(?![0-9]|[.][0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": "(?<![0-9])(?:[+][0-9]{1,3}[ .-]?(?:[(][0-9]{3}[)]|[0-9]{3})[ .-]?|[(][0-9]{3}[)] ?|[0-9]{3}[.-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    "card": "(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(value: str, a: str, b: str, fmt: str, key: str) -> str:
    """SQL of the permuted value of [0, a * b)."""
    draw = lambda part, r: f"cast(conv(left(sha2(concat_ws('|', {_quote(key)}, {fmt}, {r}, {part}), 256), 15), 16, 10) as bigint)"
    step = (f"(s, r) -> struct((s.x + {draw('s.y', 'r')} % ({a})) % ({a}) as x, s.y as y)",
            f"(s, r) -> struct(s.x as x, (s.y + {draw('s.x', '-r')} % ({b})) % ({b}) as y)")
    start = f"struct(({value}) div ({b}) as x, ({value}) % ({b}) as y)"
    # each round moves one part by the other
    both = f"(s, r) -> transform(array(transform(array(s), s -> {step[0][10:]})[0]), s -> {step[1][10:]})[0]"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, {both}, s -> s.x * ({b}) + s.y)"


def _luhn(digits: str) -> str:
    """SQL of the Luhn sum of a digit string, the last digit counted once."""
    digit = f"cast(substr({digits}, -i, 1) as int)"
    return f"aggregate(transform(sequence(1, length({digits})), i -> if(i % 2 = 1, {digit}, {digit} * 2 - if({digit} > 4, 9, 0))), 0, (t, x) -> t + x)"


def _fill(match: str, digits: str) -> str:
    """SQL of the match with its digits replaced in order."""
    return (f"array_join(transform(sequence(1, length({match})), i -> if(substr({match}, i, 1) rlike '[0-9]', "
            f"substr({digits}, length(regexp_replace(left({match}, i), '[^0-9]', '')), 1), substr({match}, i, 1))), '')")


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, so that it is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _card(key: str) -> str:
    size = "(length(d) - 2)"
    low, high = f"cast(power(10, {size} div 2) as bigint)", f"cast(power(10, {size} - {size} div 2) as bigint)"
    middle = f"lpad(cast({_feistel(f'cast(substr(d, 2, {size}) as bigint)', low, high, 'concat(\"card\", length(d), left(d, 1))', key)} as string), {size}, '0')"
    checked = _let("p", f"concat(left(d, 1), {middle})", f"concat(p, cast((10 - {_luhn('concat(p, \"0\")')} % 10) % 10 as string))")
    return f"if(length(d) between 13 and 19 and {_luhn('d')} % 10 = 0, {_let('nd', checked, _fill('m', 'nd'))}, cast(null as string))"


def _phone(key: str) -> str:
    new = f"concat(left(d, length(d) - 10), lpad(cast({_feistel('cast(right(d, 10) as bigint)', '100000L', '100000L', '\"phone\"', key)} as string), 10, '0'))"
    return _let("nd", new, _fill("m", "nd"))


def _ssn(key: str) -> str:
    area, group, serial = (f"cast(substr(d, {at}, {n}) as bigint)" for at, n in ((1, 3), (4, 2), (6, 4)))
    value = f"({area} - 1 - if({area} > 666, 1, 0)) * 989901 + ({group} - 1) * 9999 + {serial} - 1"
    parts = ("lpad(cast(v div 989901 + 1 + if(v div 989901 >= 665, 1, 0) as string), 3, '0'), '-', "
             "lpad(cast(v % 989901 div 9999 + 1 as string), 2, '0'), '-', lpad(cast(v % 9999 + 1 as string), 4, '0')")
    new = _let("v", _feistel(value, "898L", "989901L", '"ssn"', key), f"concat({parts})")
    return f"if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, {new}, cast(null as string))"


def _ip(key: str) -> str:
    value = "aggregate(split(m, '[.]'), 0L, (t, x) -> t * 256 + cast(x as bigint))"
    return _let("v", _feistel(value, "65536L", "65536L", '"ip"', key), "concat_ws('.', v div 16777216, v div 65536 % 256, v div 256 % 256, v % 256)")


def _date(key: str) -> str:
    parts = ("case when m like '____-%' then struct(left(d, 4) as y, substr(d, 5, 2) as mo, right(d, 2) as da) "
             "when m like '__.%' then struct(right(d, 4) as y, substr(d, 3, 2) as mo, left(d, 2) as da) "
             "else struct(right(d, 4) as y, left(d, 2) as mo, substr(d, 3, 2) as da) end")
    layout = "case when m like '____-%' then 'yyyy-MM-dd' when m like '__.%' then 'dd.MM.yyyy' else 'MM/dd/yyyy' end"
    real = ("case when cast(p.y as int) not between 1800 and 2199 or cast(p.mo as int) not between 1 and 12 then false "
            "else cast(p.da as int) between 1 and day(last_day(make_date(cast(p.y as int), cast(p.mo as int), 1))) end")
    number = "cast(datediff(make_date(cast(p.y as int), cast(p.mo as int), cast(p.da as int)), date'1800-01-01') as bigint)"
    new = _let("v", _feistel(number, "27L", "5411L", '"date"', key), f"date_format(date_add(date'1800-01-01', cast(v as int)), {layout})")
    return _let("p", parts, f"case when {real} then {new} end")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_card, n_phone, n_ssn, n_ip, n_date and the pseudonymised text of every row."""
    makers = {"card": _card, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date}
    digits = "regexp_replace(m, '[^0-9]', '')"
    cases = " ".join(f"when m rlike {_quote('^(?:' + p + ')$')} then struct('{k}' as kind, {makers[k](key)} as made)" for k, p in PATTERNS.items())
    change = f"transform(found, m -> {_let('d', digits, f'case {cases} else struct(cast(null as string) as kind, cast(null as string) as made) end')})"
    docs = docs.select("doc_id", "text")
    docs = docs.withColumn("found", F.expr(f"coalesce(regexp_extract_all(text, {_quote(_ANY)}, 0), array())"))
    docs = docs.withColumn("changed", F.expr(f"case when size(found) > 0 then {change} else array() end"))
    whole = f"""case when size(found) > 0 then array_join(zip_with(split(text, {_quote(_ANY)}, -1), zip_with(found, changed, (m, c) -> coalesce(c.made, m)),
               (a, b) -> concat(a, coalesce(b, ''))), '') else text end"""
    counts = [F.expr(f"cast(size(filter(changed, c -> c.made is not null and c.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return docs.select("doc_id", *counts, F.expr(whole).alias("text"))
