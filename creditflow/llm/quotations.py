"""Chat formatting: quoted passages linked to their messages, replies in order, quotes left out.

1. A line's quote level is the number of ``>`` at its start (single spaces
   between); consecutive lines of one level over 0 form a quoted passage.
2. A passage is normalised (marks off, lines joined, lowered, white space runs
   to one space) and cut into windows of ``WINDOW`` words; a shorter one is one
   window.  So are the own (level 0) words of each message, in windows of up to
   ``WINDOW`` words, for those that some passage of the conversation asks for.
   Re-wrapped lines and quoted parts of a line therefore match.
3. A passage belongs to the earlier message of its conversation that has most
   of its windows, the latest of equals, if that is ``PERCENT`` of them.  Hashes
   of the windows are joined: a window goes to the last earlier message that has
   it.  Two messages are tried first, the one that most windows go to and the
   one that the rarest window goes to: one that has all windows is the answer,
   as no later message has the window that led to it.  For every other passage
   all messages with one of its rarest windows are counted, as many windows as
   leave too few for ``PERCENT`` without them, once for equal passages.
4. A message replies to the message of its first linked passage of the
   lowest level, else to the one before it.  Messages are put in the order of the messages
   they reply to, then of their turns, so a reply never stands before its
   message.  Linked passages leave the text, others stay: nothing is lost.

Owners are looked up, and positions counted, in blocks of ``BLOCK`` turns and
over the blocks, so that neither a long conversation nor a sentence that
all messages hold is sorted in one task.

Defined results: a null text has no lines and stays null; a message of linked
quotes only becomes empty.  A passage without words isn't linked.  Messages without conv_id or turn have no links, reply_to
or position.  Messages that share conv_id and turn are one message where they
are quoted, and numbered in the order of their texts' hashes; a link names
their turn.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditflow.llm.cuts import Cuts, let, text_key

BLOCK = 1000
WINDOW = 4
PERCENT = 80
_MARK = "^[ ]*(?:>[ ]?)+"
_MESSAGE = ("conv_id", "turn", "text_key")


def _hashes(words: Column, width: Column | int) -> Column:
    """Hash of every ``width`` words."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(words) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, width), " ")))


def _words(lines: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.array_join(lines, " ")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def _before(rows: DataFrame, keys: list[str], value: str) -> Column:
    """The largest ``value`` among a key's rows of earlier turns in the same block."""
    return F.max(value).over(Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))


def _owners(asks: DataFrame, own: DataFrame, keys: tuple[str, ...] = ("conv_id", "h"), value: str = "turn") -> DataFrame:
    """The keys, turn, owner: the greatest ``value`` (the last turn) of earlier rows of ``own``; no pairs are made."""
    seen = own.select(*keys, "turn", F.col(value).alias("own"))
    rows = seen.unionByName(asks.select(*keys, "turn", F.lit(None).cast(seen.schema["own"].dataType).alias("own")))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = rows.withColumn("near", _before(rows, list(keys), "own")).where("own is null").drop("own")
    ends = rows.groupBy(*keys, "block").agg(F.max("own").alias("last"))
    ends = ends.select(*keys, "block", F.max("last").over(Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("far"))
    owner = F.greatest("near", "far") if value != "turn" else F.coalesce("near", "far")
    return inside.join(ends, [*keys, "block"]).select(*keys, "turn", owner.alias("owner")).where("owner is not null")


def _searched(asked: DataFrame, own: DataFrame, held: DataFrame, cuts: Cuts, percent: int) -> DataFrame:
    """The owners of passages by all messages that have ``percent`` of their windows."""
    kind = ["conv_id", "words_key"]
    asks = asked.select(*_MESSAGE, "passage", "words_key").distinct()
    windows = asked.select(*kind, "place", "h").distinct().join(held, ["conv_id", "h"], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    sizes = windows.groupBy(*kind).agg(F.count("*").alias("n")).withColumn("least", F.ceil(F.col("n") * percent / 100))
    ranked = windows.withColumn("rank", F.row_number().over(Window.partitionBy(*kind).orderBy("held", "place"))).join(sizes, kind)
    rare = ranked.where((F.col("rank") <= F.col("n") - F.greatest("least", F.lit(1)) + 1) & (F.col("held") > 0)).select(*kind, "h")
    last = asks.groupBy(*kind).agg(F.max("turn").alias("last"))
    near = rare.join(own, ["conv_id", "h"]).join(last, kind).where("turn < last").select(*kind, "turn").distinct()
    has = near.join(windows.select(*kind, "h"), kind).join(own, ["conv_id", "h", "turn"]).groupBy(*kind, "turn").agg(F.count("*").alias("n_has"))
    good = cuts.write(has.join(sizes, kind).where("n_has >= least").select(*kind, "turn", F.struct("n_has", "turn").alias("best")))
    found = _owners(asks.select(*kind, "turn").distinct(), good, tuple(kind), "best")
    return asks.join(found, [*kind, "turn"]).select(*_MESSAGE, "passage", F.col("owner.turn").alias("owner"))


def _link(passages: DataFrame, messages: DataFrame, cuts: Cuts, percent: int) -> DataFrame:
    """The passages that belong to an earlier message, with its turn as ``owner``."""
    windows = F.when(F.size("words") >= WINDOW, _hashes(F.col("words"), WINDOW)).otherwise(F.array(F.xxhash64(F.array_join("words", " "))))
    asked = passages.where(F.size("words") > 0).select(*_MESSAGE, "passage", F.xxhash64("words").alias("words_key"), F.posexplode(windows).alias("place", "h"))
    asked = cuts.write(asked)
    talks = asked.select("conv_id").distinct()
    words = messages.join(talks, "conv_id", "left_semi").select("conv_id", "turn", "words")
    every = words.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(*[_hashes(F.col("words"), k) for k in range(1, WINDOW + 1)]))).alias("h"))
    own = cuts.write(every.join(asked.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi").distinct())

    found = _owners(asked.select("conv_id", "h", "turn").distinct(), own)
    held = own.groupBy("conv_id", "h").agg(F.count("*").alias("held"))
    hits = cuts.write(asked.join(found, ["conv_id", "h", "turn"]).join(held, ["conv_id", "h"]))
    votes = hits.groupBy(*_MESSAGE, "passage", "owner").agg(F.count("*").alias("n"))
    most = votes.groupBy(*_MESSAGE, "passage").agg(F.max(F.struct("n", "owner"))["owner"].alias("owner"))
    rare = hits.groupBy(*_MESSAGE, "passage").agg(F.min(F.struct("held", "place", "owner"))["owner"].alias("owner"))
    candidates = most.unionByName(rare).distinct()

    # how much of the passage each candidate has
    wanted = candidates.join(asked.select(*_MESSAGE, "passage", "h"), [*_MESSAGE, "passage"])
    there = own.withColumnRenamed("turn", "owner").withColumn("has", F.lit(1))
    shares = wanted.join(there, ["conv_id", "h", "owner"], "left").groupBy(*_MESSAGE, "passage", "owner").agg(F.count("*").alias("n"), F.count("has").alias("n_has"))
    whole = shares.where("n_has = n").groupBy(*_MESSAGE, "passage").agg(F.max("owner").alias("owner"))
    whole = cuts.write(whole)
    rest = cuts.write(asked.join(whole, [*_MESSAGE, "passage"], "left_anti"))
    return whole.unionByName(_searched(rest, own, held, cuts, percent))


def _runs(text: Column) -> Column:
    """level and lines of each run of lines of one quote level."""
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, _MARK, 0), "[^>]", ""))

    def cut(lines: Column, levels: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(levels, i) != F.get(levels, i - 1)))
        run = lambda at, i, k: F.struct(F.get(levels, i).alias("level"), F.slice(lines, i + 1, F.coalesce(F.get(at, k + 1), F.size(lines)) - i).alias("lines"))
        return let(starts, lambda at: F.transform(at, lambda i, k: run(at, i, k)))

    return let(F.split(text, "\n"), lambda lines: let(F.transform(lines, level), lambda levels: cut(lines, levels)))


def link_quotations(conversations: DataFrame, percent: int = PERCENT) -> DataFrame:
    """conv_id, turn, role, reply_to, position, n_passages, n_linked, max_level, text of every message."""
    cuts = Cuts()
    messages = conversations.select("conv_id", "turn", "role", text_key().alias("text_key"), F.when(F.col("text").isNotNull(), _runs(F.col("text"))).alias("runs"))
    messages = cuts.write(messages)
    placed = messages.where("conv_id is not null and turn is not null and runs is not null").select(*_MESSAGE, "runs").distinct()

    quoted = placed.select(*_MESSAGE, F.posexplode("runs").alias("passage", "run")).where("run.level > 0")
    passages = cuts.write(quoted.select(*_MESSAGE, "passage", F.col("run.level").alias("level"), _words(F.transform("run.lines", lambda x: F.regexp_replace(x, _MARK, ""))).alias("words")))
    level0 = F.flatten(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["lines"]))
    links = _link(passages, placed.select("conv_id", "turn", _words(level0).alias("words")), cuts, percent)
    links = links.join(passages.select(*_MESSAGE, "passage", "level"), [*_MESSAGE, "passage"])
    linked = links.groupBy(*_MESSAGE).agg(F.collect_list("passage").alias("gone"), F.min_by("owner", F.struct("level", "passage")).alias("quoted_turn"))

    base = messages.join(linked.withColumnsRenamed({c: f"x_{c}" for c in _MESSAGE}),
                         (F.col("conv_id") == F.col("x_conv_id")) & (F.col("turn") == F.col("x_turn")) & (F.col("text_key") == F.col("x_text_key")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("runs") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    text = F.array_join(F.flatten(F.transform(stay, lambda i: F.get("runs", i)["lines"])), "\n")
    levels = F.transform(F.coalesce("runs", F.array().cast(messages.schema["runs"].dataType)), lambda r: r["level"])
    return _ordered(cuts.write(base.select(*_MESSAGE, "role", F.when(F.col("runs").isNotNull(), text).alias("text"), "quoted_turn",
                                           F.size(F.filter(levels, lambda x: x > 0)).alias("n_passages"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_linked"),
                                           F.coalesce(F.array_max(levels), F.lit(0)).alias("max_level"))))


def _ordered(base: DataFrame) -> DataFrame:
    """Parents and positions of the messages; those without conv_id or turn have neither."""
    known = base.where("conv_id is not null and turn is not null").withColumn("block", F.floor(F.col("turn") / BLOCK))
    turns = known.select("conv_id", "turn", "block").distinct()
    prior = turns.withColumn("previous", F.lag("turn").over(Window.partitionBy("conv_id", "block").orderBy("turn")))
    ends = turns.groupBy("conv_id", "block").agg(F.max("turn").alias("last"))
    ends = ends.select("conv_id", "block", F.lag("last").over(Window.partitionBy("conv_id").orderBy("block")).alias("last"))
    prior = prior.join(ends, ["conv_id", "block"]).select("conv_id", "turn", F.coalesce("previous", "last").alias("previous"))
    known = known.join(prior, ["conv_id", "turn"]).withColumn("reply_to", F.coalesce("quoted_turn", "previous"))

    # rank among a parent's replies in a block of turns, after the cells and the blocks of parents before
    known = known.withColumn("parent", F.coalesce(F.col("reply_to").cast("long"), F.lit(-(1 << 63)))).withColumn("part", F.floor(F.col("parent") / BLOCK))
    cell = ["conv_id", "part", "parent", "block"]
    ahead = lambda keys, order: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cells = known.groupBy(*cell).agg(F.count("*").alias("c"))
    parts = cells.groupBy("conv_id", "part").agg(F.sum("c").alias("c"))
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("c").over(ahead(["conv_id"], ["part"])), F.lit(0)).alias("parts_before"))
    cells = cells.select(*cell, F.coalesce(F.sum("c").over(ahead(["conv_id", "part"], ["parent", "block"])), F.lit(0)).alias("cells_before"))
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("turn", "text_key", "role"))
    known = known.withColumn("rank", rank).join(cells, cell).join(parts, ["conv_id", "part"])
    known = known.withColumn("position", F.col("rank") - 1 + F.col("cells_before") + F.col("parts_before"))
    out = ["conv_id", "turn", "role", "reply_to", "position", "n_passages", "n_linked", "max_level", "text"]
    loose = base.where("conv_id is null or turn is null")
    return known.select(*out).unionByName(loose.select(*out[:3], *(F.lit(None).cast(known.schema[c].dataType).alias(c) for c in out[3:5]), *out[5:]))
