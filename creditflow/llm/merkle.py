"""Merkle manifest of a dataset: a tree per source, a tree over the sources, proofs of every row.

1. Each row's leaf is hashed in the scan.  Leaves take their place in their
   source by counting: ids are counted by ever shorter prefixes, so that every
   ordering window holds at most a few ten thousand counts, whatever share of
   the rows a source has.  Rows alike in everything are one unit with a count.
2. ``BLOCK`` consecutive places are an aligned block.  A block keeps each level
   as one hex string: the parents are hashed from fixed-width substrings of the
   level below.  The blocks' roots are the next round's leaves, until a source
   has one; the sources' roots, in order of source, are a tree of the same kind.
3. On the way down each node's flanking substrings become the (left, right)
   segments of its run's other nodes; a block's rows share the segments above it
   and are unfolded where they lie.

Defined results: leaves stand by doc_id, null first, rows with the same doc_id by
leaf; rows alike in every column take neighbouring places.  A null source is a
source of its own, before the empty one.  A null field enters a leaf as ``-``.
A source's lone leaf is its subroot, a lone subroot the root, and a proof without
siblings the hash of the empty text.  Other columns are ignored.  An empty table
gives an empty result.

Only a number of rounds and up to about ``PIVOTS`` source names come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts, let, pieces

FAN = 16
STEPS = 3
BLOCK = FAN ** STEPS
HEX = 64
PIVOTS = 4096
#: Bits dropped from an id, coarse to fine: each window orders the counts of one prefix's children.
SHIFTS = (48, 32, 20, 8, 0)


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_digest(*fields: Column) -> Column:
    """Hash of the fields, each as ``-`` or its UTF-8 length, a colon and its text."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(F.concat(*(part(c) for c in fields)))


# ---- places -------------------------------------------------------------------

def _before(*partition: str, order: list[str], count: str = "m") -> Column:
    span = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(span), F.lit(0))


def places(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (src, doc_id, leaf, observed) as units with their first place and count m; and n by src."""
    units = leaves.groupBy("src", "doc_id", "leaf", "observed").agg(F.count("*").alias("m"))
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    units = units.withColumns({f"k{s}": F.shiftright(known, s) for s in SHIFTS} | {"twig": F.substring("leaf", 1, 4)})
    chain = [f"k{s}" for s in SHIFTS] + ["twig"]
    counts = units.groupBy("src", *chain).agg(F.sum("m").alias("m"))
    tables = [counts]
    for depth in range(len(chain) - 1, 0, -1):
        tables.append(tables[-1].groupBy("src", *chain[:depth]).agg(F.sum("m").alias("m")))
    tables.reverse()
    start = None
    for depth, table in enumerate(tables, 1):
        parent, name = chain[:depth - 1], chain[depth - 1]
        here = table.withColumn("start", _before("src", *parent, order=[name])).drop("m")
        start = here if start is None else here.join(start.withColumnRenamed("start", "above"), ["src", *parent]).withColumn(
            "start", F.col("start") + F.col("above")).drop("above")
    own = units.withColumn("own", _before("src", *chain, order=["leaf", "observed"]))
    placed = own.join(start, ["src", *chain]).select("src", "doc_id", "leaf", "observed", "m", (F.col("start") + F.col("own")).alias("place"))
    return placed, tables[0].groupBy("src").agg(F.sum("m").alias("n"))


def source_places(tops: DataFrame) -> DataFrame:
    """(src, place): sources in order, dealt by pivots drawn from themselves, ranked between two pivots."""
    share = pieces(tops.count(), PIVOTS)
    pivots = sorted((r.src for r in tops.where(F.pmod(F.xxhash64("src"), F.lit(share)) == 0).select("src").collect()), key=lambda s: s.encode())
    below = F.size(F.filter(F.array(*map(F.lit, pivots)), lambda p: p <= F.col("src"))) if pivots else F.lit(0)
    dealt = tops.select("src", below.alias("lot"))
    lots = dealt.groupBy("lot").agg(F.count("*").alias("m"))
    starts = lots.select("lot", _before(order=["lot"]).alias("start"))
    rank = F.row_number().over(Window.partitionBy("lot").orderBy("src")) - 1
    return dealt.withColumn("rank", rank).join(starts, "lot").select("src", (F.col("start") + F.col("rank")).alias("place"))


# ---- levels -------------------------------------------------------------------

def height(n: Column) -> Column:
    """Levels above n leaves."""
    out = F.lit(0)
    for h in range(16):
        out = out + (n > FAN ** h).cast("int") if FAN ** h < 1 << 62 else out
    return out


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (FAN * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda j: digest(level.substr(j * (FAN * HEX) + 1, F.lit(FAN * HEX)))), "").cast("binary")


def _levels(blocks: DataFrame) -> DataFrame:
    """``blocks`` (level0 as hex bytes, steps) with the levels above and the block's root."""
    for k in range(STEPS):
        level = F.col(f"level{k}")
        blocks = blocks.withColumn(f"level{k + 1}", F.when(F.col("steps") > k, _parents(level)).otherwise(level))
    return blocks.withColumn("top", F.col(f"level{STEPS}").cast("string")).drop(f"level{STEPS}")


def _steps(done: int) -> Column:
    return F.least(F.lit(STEPS), F.greatest(F.lit(0), F.col("height") - STEPS * done))


def _flanks(place: Column, steps: Column, levels: list[Column]) -> Column:
    """The (left, right) segments of one place's ancestors inside its block, from below."""
    parts = []
    for k in range(STEPS):
        at = F.floor(F.pmod(place, F.lit(BLOCK)) / FAN ** k).cast("int")
        slot = at % FAN
        left = levels[k].substr((at - slot) * HEX + 1, slot * HEX).cast("string")
        right = levels[k].substr((at + 1) * HEX + 1, (FAN - 1 - slot) * HEX).cast("string")
        parts.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*parts), F.lit(1), steps)


def _block(place: str = "place") -> Column:
    return F.floor(F.col(place) / BLOCK).cast("long")


def _rounds(cuts: Cuts, first: DataFrame, key: list[str]) -> list[DataFrame]:
    """Block tables from ``first`` up to one block a key; a round's roots are the next one's leaves."""
    tables = [first]
    highest = first.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
    for done in range(1, -(-highest // STEPS)):
        nodes = tables[-1].select(*key, "height", F.col("block").alias("place"), "top")
        grouped = nodes.groupBy(*key, "height", _block().alias("block")).agg(F.array_sort(F.collect_list(F.struct("place", "top"))).alias("held"))
        level = F.array_join(F.col("held.top"), "").cast("binary")
        tables.append(cuts.write(_levels(grouped.select(*key, "height", "block", _steps(done).alias("steps"), level.alias("level0")))))
    return tables


def _paths(tables: list[DataFrame], key: list[str], path: DataFrame) -> DataFrame:
    """(key, block, path) of the lowest table's blocks, from the ``path`` of each key's last block."""
    out = path.withColumn("block", F.lit(0).cast("long"))
    for above, below in zip(tables[:0:-1], tables[-2::-1], strict=True):
        held = above.select(*key, F.col("block").alias("parent"), "steps", *(f"level{k}" for k in range(STEPS)))
        held = held.join(out.withColumnRenamed("block", "parent"), [*key, "parent"])
        nodes = below.select(*key, "block", _block("block").alias("parent")).join(held, [*key, "parent"])
        own = _flanks(F.col("block"), F.col("steps"), [F.col(f"level{k}") for k in range(STEPS)])
        out = nodes.select(*key, "block", F.concat(own, "path").alias("path"))
    return out


def merkle_manifest(leaves: DataFrame) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``leaves`` holds doc_id (an integer), source, leaf and ``observed``: the leaf
    that a reader finds now, folded with the row's siblings and held against the root.
    """
    cuts = Cuts()
    key = ["src"]
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = cuts.write(leaves.select(named.alias("src"), "doc_id", "leaf", "observed"))
    placed, totals = places(rows)
    each = placed.select("src", "doc_id", "leaf", "observed", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("m") - 1)).alias("place"))
    held = F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "observed")))
    blocks = each.groupBy("src", _block().alias("block")).agg(held.alias("held")).join(totals, "src")
    blocks = blocks.withColumn("height", height(F.col("n"))).withColumn("steps", _steps(0))
    items = F.transform("held", lambda x: F.struct(x["place"].alias("place"), x["doc_id"].alias("doc_id"), x["observed"].alias("observed")))
    level = F.array_join(F.col("held.leaf"), "").cast("binary")
    first = cuts.write(_levels(blocks.select("src", "height", "block", "steps", items.alias("items"), level.alias("level0"))))
    tables = _rounds(cuts, first, key)

    subroots = cuts.write(tables[-1].select("src", F.col("top").alias("subroot")))
    ranked = source_places(subroots).join(subroots, "src")
    whole = subroots.count()
    grouped = ranked.groupBy(_block().alias("block")).agg(F.array_sort(F.collect_list(F.struct("place", "src", "subroot"))).alias("held"))
    grouped = grouped.select(F.lit(0).alias("all"), height(F.lit(whole)).alias("height"), "block", F.col("held"), F.array_join(F.col("held.subroot"), "").cast("binary").alias("level0"))
    upper = _rounds(cuts, cuts.write(_levels(grouped.withColumn("steps", _steps(0)))), ["all"])
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    root = upper[-1].select("all", F.col("top").alias("root"), nothing.alias("path"))
    above = _paths(upper, ["all"], root.drop("root"))
    flanks = lambda x, path: F.concat(_flanks(x["place"], F.col("steps"), [F.col(f"level{k}") for k in range(STEPS)]), path)
    sources = upper[0].join(above, ["all", "block"]).join(root.select("all", "root"), "all")
    sources = sources.select("root", F.explode(F.transform("held", lambda x: F.struct(x["src"].alias("src"), x["subroot"].alias("subroot"), flanks(x, F.col("path")).alias("path")))).alias("it"))
    sources = cuts.write(sources.select("root", "it.*"))

    lower = _paths(tables, key, sources.select("src", "path"))
    joined = first.join(lower, ["src", "block"]).join(sources.select("src", "subroot", "root"), "src")

    def unfolded(x: Column) -> Column:
        fold = lambda path: F.aggregate(path, x["observed"], lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))
        proof = lambda path: digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
        leaf = F.col("level0").substr(F.pmod(x["place"], F.lit(BLOCK)).cast("int") * HEX + 1, F.lit(HEX)).cast("string")
        return let(flanks(x, F.col("path")), lambda path: F.struct(
            x["doc_id"].alias("doc_id"), leaf.alias("leaf"), proof(path).alias("proof_sha256"), fold(path).alias("folded_root")))

    out = joined.select("src", "subroot", "root", F.explode(F.transform("items", unfolded)).alias("row"))
    source = F.when(F.col("src") != "", F.expr("substring(src, 2)"))
    return out.select("row.doc_id", source.alias("source"), "row.leaf", "subroot", "root", "row.proof_sha256", "row.folded_root",
                      (F.col("row.folded_root") == F.col("root")).alias("verified"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_manifest(docs: DataFrame, every: int = 5) -> DataFrame:
    """Manifest of ``docs``, read back with the texts of one in ``every`` rows (by crc32 of the id) in lower case."""
    leaf = leaf_digest(*(F.col(c) for c in FIELDS))
    lowered = leaf_digest(*(F.col(c) for c in FIELDS[:-1]), F.translate("text", UPPER, LOWER))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return merkle_manifest(docs.select("doc_id", "source", leaf.alias("leaf"), F.when(hit, lowered).otherwise(leaf).alias("observed")))
