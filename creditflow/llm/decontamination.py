"""Benchmark decontamination by canonical templates (DataFrame functions only).

1. Numbers, units after a number and names (capitalised words, wherever they
   stand) are replaced by typed placeholders; the rest is lowered.  Words keep
   their places, so a template's words line up with the text's.
2. Templates are cut into windows of ``WINDOW`` words (a shorter template is
   one window) and hash-joined: documents' windows with the benchmark's.  A
   window without a literal word (one with a letter and no placeholder) would
   equal every other of its kind, so it stands for its own values, lowered:
   numbers or names alone match where they are the same ones.
3. Hits are gathered for each document, item and offset between them, and
   offsets in regions, so that inserted and deleted words split nothing: two
   offsets at most a third of the item's windows (``WINDOW`` at least) apart
   share a region, and no region is over twice as wide.  A region, or an offset
   alone, is a candidate where at least ``percent`` of the item's windows hit,
   each counted once and read at the region's offset with most hits that has it.
4. The slots of the windows that hit are compared: each value of the item must
   stand for one value in the document and the other way round, type by type.
   A consistent candidate with other values is a re-parameterised question.
   Where values clash, the windows with the item's own values count alone: with
   ``percent`` of them the text is a copy in which a value was edited.

Defined results: null and empty texts have no words, match nothing and have no
windows.  Repeated items and repeated rows match each on their own.  Of several
candidates of one pair the one with most hits counts, the smallest ``at_word``
of equals; a region's is its offset with most hits.
Extra columns are ignored; an empty table on either side gives no rows.

Units are those of ``UNITS`` and names are words that start with a capital:
other units are literal words, and names in scripts without capitals too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts, let, text_key

WINDOW = 5
PERCENT = 80
SPACE = "[\\x20\\x09-\\x0D]+"
#: Unit words, a fixed list; matched in any case behind a number.
UNITS = ("km", "kg", "cm", "mm", "mg", "ml", "km/h", "mph", "m", "g", "l", "s", "h", "lb", "lbs", "oz", "ft", "in", "mi", "usd", "eur", "gbp",
         "dollars", "euros", "pounds", "cents", "percent", "years", "months", "weeks", "days", "hours", "minutes", "seconds", "meters", "metres",
         "kilometers", "miles", "liters", "litres", "grams", "kilograms", "degrees")
NUMBER, UNIT, NAME = "\u0001n", "\u0001u", "\u0001p"


def template(text: Column) -> Column:
    """The text with typed placeholders, lowered; as many words as before."""
    numbers = F.regexp_replace(text, "[0-9]+(?:[.,:/][0-9]+)*", NUMBER)
    units = F.regexp_replace(numbers, f"({NUMBER}[ \\t]?)(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\\p{{L}}/])", f"$1{UNIT}")
    names = F.regexp_replace(units, "(?<![\\p{L}\\p{N}'’-])\\p{Lu}[\\p{L}'’-]*", NAME)
    return F.lower(names)


def _words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return let(bare, lambda b: F.when(b == "", F.array().cast("array<string>")).otherwise(F.split(b, SPACE)))


def _literal(word: Column) -> Column:
    return ~word.contains("\u0001") & word.rlike("\\p{L}")


def shingles(words: Column) -> Column:
    """Hash of every WINDOW words; none of fewer."""
    tail = lambda a, k: F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))
    head = lambda a, k: F.slice(a, 1, F.greatest(F.size(a) - k, F.lit(0)))
    pair = lambda a, b, k: F.zip_with(head(a, k), tail(b, k), lambda x, y: F.xxhash64(x, y))

    def fives(ones: Column) -> Column:
        return let(pair(ones, ones, 1), lambda twos: let(pair(twos, twos, 2), lambda fours: F.zip_with(
            head(fours, 1), tail(ones, WINDOW - 1), lambda x, y: F.xxhash64(x, y))))

    return let(F.transform(words, lambda x: F.xxhash64(x)), fives)


def _windows(marks: Column, words: Column) -> Column:
    """Hash of every WINDOW marks, of the words where no mark is literal; of the whole when there are fewer, none of nothing."""
    def by_value(hashes: Column, literal: Column) -> Column:
        own = lambda i: F.xxhash64(F.lit("values"), F.lower(F.array_join(F.slice(words, i + 1, WINDOW), " ")))
        return F.transform(hashes, lambda h, i: F.when(F.exists(F.slice(literal, i + 1, WINDOW), lambda x: x), h).otherwise(own(i)))

    whole = lambda w: F.array(F.xxhash64(F.lit("short"), F.when(F.exists(w, _literal), F.array_join(w, " ")).otherwise(F.lower(F.array_join(words, " ")))))
    return let(marks, lambda w: F.when(F.size(w) >= WINDOW, let(F.transform(w, _literal), lambda ok: by_value(shingles(w), ok)))
               .when(F.size(w) > 0, whole(w)).otherwise(F.array().cast("array<bigint>")))


def _spots(parts: Column) -> Column:
    """(item_at, at) of each item window that hits, once, at the first of the parts that has it."""
    every = F.flatten(F.transform(parts, lambda p, i: F.transform(p["hit"], lambda w: F.struct(w.alias("item_at"), i.alias("rank"), p["at"].alias("at")))))
    return let(F.sort_array(every), lambda e: F.filter(e, lambda x, i: (i == 0) | (F.get(e, i - 1)["item_at"] != x["item_at"])))


def _slots(spot: Column, words: Column, marks: Column, doc: Column) -> Column:
    """Placeholder, value in the item and value in the document of each slot of a window that hits."""
    places = F.sequence(spot["item_at"], F.least(spot["item_at"] + WINDOW, F.size(words)) - 1)
    every = F.transform(places, lambda i: F.struct(F.get(marks, i).alias("mark"), F.lower(F.get(words, i)).alias("item"), F.lower(F.get(doc, i + spot["at"])).alias("doc")))
    return F.filter(every, lambda s: s["mark"].contains("\u0001"))


def _one_to_one(slots: Column) -> Column:
    """Each value of the item stands for one value in the document and the other way round, type by type."""
    def check(pairs: Column) -> Column:
        sides = lambda side: F.size(F.array_distinct(F.transform(pairs, lambda s: F.struct(s["mark"], s[side]))))
        return (sides("item") == F.size(pairs)) & (sides("doc") == F.size(pairs))

    return let(F.array_distinct(slots), check)


def decontaminate(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, item_id, n_windows, n_hits, at_word, same_values of each item found in a document.

    ``same_values`` is false for a re-parameterised item.
    """
    cuts = Cuts()
    items = benchmark.select("item_id", "text").withColumn("item_key", F.xxhash64("item_id", "text"))
    items = items.withColumn("marks", _words(template(F.col("text")))).withColumn("words", _words(F.col("text")))
    items = items.withColumn("windows", _windows(F.col("marks"), F.col("words")))
    items = cuts.write(items.select("item_id", "item_key", "words", "marks", "windows", F.size("windows").alias("n_windows")).distinct())
    cells = cuts.write(items.select("item_key", "n_windows", F.posexplode("windows").alias("item_at", "h")).distinct())

    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    marked = docs.select("doc_id", "text_key", _words(template(F.col("text"))).alias("marks"), _words(F.col("text")).alias("words"))
    spots = marked.select("doc_id", "text_key", F.posexplode(_windows(F.col("marks"), F.col("words"))).alias("doc_at", "h"))
    pair = ("doc_id", "text_key", "item_key", "n_windows")
    hits = spots.join(cells, "h").groupBy(*pair, (F.col("doc_at") - F.col("item_at")).alias("at")).agg(F.collect_set("item_at").alias("hit"))
    enough = lambda n: F.lit(100) * n >= F.lit(percent) * F.col("n_windows")
    reach = F.greatest(F.lit(WINDOW), F.floor(F.col("n_windows") / 3))
    step = F.floor(F.col("at") / reach)
    none = F.lit(None).cast("int")
    own = F.when(enough(F.size("hit")), F.array(F.struct(F.lit(None).cast("bigint").alias("step"), F.col("at").alias("alone")))).otherwise(F.array())
    regions = F.concat(F.array(*[F.struct(s.alias("step"), none.alias("alone")) for s in (step, step - 1)]), own)
    parts = hits.select(*pair, F.explode(regions).alias("region"), F.struct((-F.size("hit")).alias("order"), "at", "hit").alias("part"))
    parts = parts.groupBy(*pair, "region").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    # a region of one offset is that offset alone
    parts = parts.where((F.size("parts") > 1) | F.col("region.alone").isNotNull())
    found = cuts.write(parts.where(enough(F.size(F.array_distinct(F.flatten("parts.hit"))))).select(*pair, "parts"))

    # slots of the candidates, read again from the texts
    near = found.withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"}).join(
        items.select("item_key", "item_id", F.col("words").alias("item_words"), F.col("marks").alias("item_marks")), "item_key")
    both = near.join(docs, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")))
    slots = let(_words(F.col("text")), lambda doc: F.transform(_spots(F.col("parts")), lambda s: _slots(s, F.col("item_words"), F.col("item_marks"), doc)))
    both = both.withColumn("slots", slots)
    same = F.filter("slots", lambda w: F.forall(w, lambda s: s["item"] == s["doc"]))
    both = both.withColumn("n_same", F.size(same)).withColumn("n_hits", F.when(_one_to_one(F.flatten("slots")), F.size("slots")).otherwise(F.col("n_same")))
    both = both.where(enough(F.col("n_hits"))).withColumn("same_values", F.col("n_same") == F.col("n_hits")).withColumn("at_word", F.col("parts")[0]["at"])
    rank = F.struct(F.col("n_hits"), -F.col("at_word"), F.col("same_values"))
    best = both.groupBy("doc_id", "text_key", "item_id", "item_key", "n_windows").agg(
        F.max("n_hits").alias("n_hits"), F.max_by("at_word", rank).alias("at_word"), F.max_by("same_values", rank).alias("same_values"))
    return best.drop("item_key")
