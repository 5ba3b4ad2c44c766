"""Substring dedup over words by a compacted de Bruijn graph.

The graph's edges are the k-mers of words (the contract's 50-word windows).

1. Each document's k-mers are cut into fragments: runs of consecutive k-mers
   with the same minimizer (the least hash of their ``SEED``-word grams), so
   equal k-mers have equal minimizers anywhere.  A fragment is identified by
   the hash of its words.
2. Fragments whose minimizer occurs in one document only go.
3. A fragment that is always followed by one other, which it always precedes,
   lies on a nonbranching path.  Repeated paths are compacted by joins that
   double the distance to the path's head each round.  Every occurrence of a
   head stands for an occurrence of the whole path.
4. Where several fragments share a minimizer the graph branches: there the
   k-mers themselves are compared, taken from each fragment's source
   coordinates (smallest doc_id, first place).
5. The repeated spans go back to their documents.  A path's span is verified
   by a second hash, taken at its source coordinates and at the occurrence.

A word goes if a k-mer that covers it also starts in a document with a smaller
doc_id.  K-mers are judged on the input.

Defined results: null and empty texts have no words.  A null doc_id is neither
smaller nor larger than another: such rows keep all words and take none from
others.  Rows that repeat a doc_id are parts of one document: they remove
nothing from each other.  Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts, text_key

SEED = 16
_CHECK = np.uint64(0xA24BAED4963EE407)


def _word_hashes(data: np.ndarray, offs: np.ndarray):
    starts, ends, first = B.words(data, offs)
    return starts, ends, first, B.spans(B.prefix(data), starts, ends, values=data)


def _fragments(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, offs in B.blocks(batch.column("text")):
                _, _, first, wh = _word_hashes(data, offs)
                if len(wh) < k:
                    continue
                pre = B.prefix(wh)
                least = B.sliding_min(B.rolling(pre, SEED), k - SEED + 1)
                row = B.row_of(first)[: len(least)]
                inside = np.arange(len(least)) + k <= first[row + 1]
                begin = inside.copy()
                begin[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
                at = np.flatnonzero(begin)
                end = np.concatenate([at[1:], [len(least)]])
                end = np.minimum(end, first[row[at] + 1] - k + 1)
                frag = B.spans(pre, at, end + k - 1, values=wh)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(row[at] + lo)) for c in ("doc_id", "text_key")]
                    + [pa.array(B.signed(least[at])), pa.array(B.signed(frag)), pa.array((at - first[row[at]]).astype(np.int32)),
                       pa.array((end - at).astype(np.int32))], ["doc_id", "text_key", "seed", "frag", "start", "n"])
    return run


def _read_sources(k: int):
    """K-mer hashes of fragments, and check hashes of paths, at their source coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frag, frag_first = B.lists(batch.column("frags"))
            start, n, path = (B.lists(batch.column(c))[0] for c in ("starts", "ns", "is_path"))
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                _, _, first, wh = _word_hashes(data, offs)
                pre, wh2 = B.prefix(wh), B.mix(wh ^ _CHECK)
                pre2 = B.prefix(wh2)
                a, b = frag_first[lo], frag_first[hi]
                row = np.repeat(np.arange(hi - lo), np.diff(frag_first[lo:hi + 1]))
                left, count = first[row] + start[a:b], n[a:b].astype(np.int64)
                whole = path[a:b] == 1
                each = np.where(whole, 1, count)
                which = np.repeat(np.arange(b - a), each)
                shift = B.arange_each(each)
                begin = left[which] + shift
                end = np.where(whole[which], begin + count[which] + k - 1, begin + k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(frag[a:b][which]), pa.array(shift.astype(np.int32)), pa.array(whole[which].astype(np.int32)),
                     pa.array(B.signed(B.spans(pre, begin, end, values=wh))), pa.array(B.signed(B.spans(pre2, begin, end, values=wh2)))],
                    ["frag", "i", "is_path", "h", "h2"])
    return run


def remove_words(data, offs, starts, ends, first, gone):
    """Text of each row from its words that are not ``gone``, joined by one space: bytes and bounds."""
    keep = np.flatnonzero(~gone)
    row = np.searchsorted(first, keep, side="right") - 1
    lead = np.ones(len(keep), bool)
    lead[1:] = row[1:] != row[:-1]
    mask = B.cover(len(data), starts[keep] - ~lead, ends[keep])
    out = np.where(B.SEPARATOR[data], np.uint8(32), data)[mask]
    return out, np.concatenate([[0], np.cumsum(mask)])[offs]


def _remove(k: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, span_first = B.lists(batch.column("starts"))
            n, check = B.lists(batch.column("ns"))[0], B.lists(batch.column("checks"))[0]
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                starts, ends, first, wh = _word_hashes(data, offs)
                gone = np.zeros(len(starts), bool)
                a, b = span_first[lo], span_first[hi]
                if b > a:
                    row = np.repeat(np.arange(hi - lo), np.diff(span_first[lo:hi + 1]))
                    begin = first[row] + start[a:b]
                    end = begin + n[a:b] + k - 1
                    wh2 = B.mix(wh ^ _CHECK)
                    pre2 = B.prefix(wh2)
                    inside = end <= first[row + 1]
                    same = np.zeros(b - a, bool)
                    same[inside] = B.signed(B.spans(pre2, begin[inside], end[inside], values=wh2)) == check[a:b][inside]
                    gone = B.cover(len(starts), begin[same], end[same])
                out, at = remove_words(data, offs, starts, ends, first, gone)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
                cols = [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)), pa.array(removed.astype(np.int64)),
                        pa.array(B.digests(out, at))]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    cols.append(pa.StringArray.from_buffers(hi - lo, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out.tobytes())))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def compact_paths(nodes: DataFrame) -> DataFrame:
    """(frag, head, skip) of fragments (frag, n, nxt, prv): the head of its path and how many k-mers lie before it.

    nxt and prv are the only successor and predecessor of all occurrences, or
    null.  Fragments on a cycle without a head are their own paths.
    """
    cuts = Cuts()
    back = nodes.select(F.col("frag").alias("nxt"), F.col("prv").alias("back"))
    steps = nodes.where("nxt is not null").select(F.col("frag").alias("from"), "nxt", F.col("n").cast("long").alias("step"))
    steps = steps.join(back, "nxt").where(F.col("back") == F.col("from")).select(F.col("nxt").alias("frag"), F.col("from").alias("up"), "step")
    paths = nodes.select("frag").join(steps, "frag", "left").select(
        "frag", F.coalesce("up", "frag").alias("head"), F.coalesce("step", F.lit(0)).alias("skip"), F.col("up").isNull().alias("done"))
    paths = cuts.write(paths)
    left = paths.where("not done").count()
    while left:
        ahead = paths.select(F.col("frag").alias("head"), F.col("head").alias("head2"), F.col("skip").alias("skip2"), F.col("done").alias("done2"))
        moved = paths.where("not done").join(ahead, "head").select(
            "frag", F.when(F.col("done2"), F.col("head")).otherwise(F.col("head2")).alias("head"),
            F.when(F.col("done2"), F.col("skip")).otherwise(F.col("skip") + F.col("skip2")).alias("skip"), F.col("done2").alias("done"))
        new = cuts.write(paths.where("done").unionByName(moved))
        cuts.drop(paths)
        paths, before = new, left
        left = paths.where("not done").count()
        if left == before:  # what is left lies on cycles
            break
    return paths.select("frag", F.when(F.col("done"), F.col("head")).otherwise(F.col("frag")).alias("head"),
                        F.when(F.col("done"), F.col("skip")).otherwise(F.lit(0)).alias("skip"))


def substring_dedup(docs: DataFrame, k: int = 50, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every row of ``docs``; k is at least ``SEED`` + 1."""
    if k <= SEED:
        raise ValueError(f"k must be over {SEED}")
    cuts = Cuts()
    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    dtype = docs.schema["doc_id"].dataType.simpleString()
    found = docs.where("doc_id is not null and text is not null").mapInArrow(
        _fragments(k), f"doc_id {dtype}, text_key long, seed long, frag long, start int, n int")
    shared = found.groupBy("seed").agg(F.min("doc_id").alias("d1"), F.max("doc_id").alias("d2")).where("d1 < d2").select("seed")
    places = cuts.write(found.join(shared, "seed"))

    # successors and predecessors within a document, then over all occurrences of a fragment
    w = Window.partitionBy("doc_id", "text_key").orderBy("start", "frag")
    chained = places.withColumns({"nxt": F.lead(F.struct("start", "frag")).over(w), "prv": F.lag(F.struct("start", "n", "frag")).over(w)})
    chained = chained.withColumns({"nxt": F.when(F.col("nxt.start") == F.col("start") + F.col("n"), F.col("nxt.frag")),
                                   "prv": F.when(F.col("prv.start") + F.col("prv.n") == F.col("start"), F.col("prv.frag"))})
    only = lambda c: F.when((F.count(c) == F.count("*")) & (F.min(c) == F.max(c)), F.min(c))
    nodes = cuts.write(chained.groupBy("seed", "frag").agg(
        F.min(F.struct("doc_id", "text_key", "start")).alias("src"), F.max("doc_id").alias("last"), F.first("n").alias("n"),
        only("nxt").alias("nxt"), only("prv").alias("prv")).withColumn("owner", F.col("src.doc_id")))
    twice = nodes.where(F.col("last") > F.col("owner"))
    paths = compact_paths(twice)
    whole = paths.join(twice.select("frag", "n"), "frag").groupBy("head").agg(F.max(F.col("skip") + F.col("n")).cast("int").alias("n"))
    whole = cuts.write(whole.join(twice.select(F.col("frag").alias("head"), "src", "owner"), "head"))

    # what is read again at the source coordinates
    branches = nodes.groupBy("seed").agg(F.count("*").alias("c")).where("c > 1").select("seed")
    forks = nodes.join(branches, "seed").select("frag", "src.*", "n", F.lit(0).alias("is_path"))
    wanted = forks.unionByName(whole.select(F.col("head").alias("frag"), "src.*", "n", F.lit(1).alias("is_path")))
    wanted = wanted.groupBy(F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key")).agg(
        F.collect_list(F.struct("frag", "start", "n", "is_path")).alias("x"))
    lists = wanted.select("want_id", "want_key", F.col("x.frag").alias("frags"), F.col("x.start").alias("starts"), F.col("x.n").alias("ns"), F.col("x.is_path").alias("is_path"))
    read = docs.join(lists, (F.col("doc_id") == F.col("want_id")) & (F.col("text_key") == F.col("want_key")))
    read = cuts.write(read.select("text", "frags", "starts", "ns", "is_path").mapInArrow(_read_sources(k), "frag long, i int, is_path int, h long, h2 long"))

    # branches: a k-mer goes where another fragment has it in a smaller document
    edges = read.where("is_path = 0").join(nodes.select("frag", "owner"), "frag")
    firsts = edges.groupBy("h", "h2").agg(F.min("owner").alias("least"), F.max("owner").alias("most")).where("least < most").select("h", "h2", "least")
    lost = edges.join(firsts, ["h", "h2"]).where("least < owner").select("frag", "owner", "i", "h2").distinct()
    own = places.join(lost, "frag").where(F.col("doc_id") == F.col("owner"))
    bits = own.select("doc_id", "text_key", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n"), F.col("h2").alias("check"))
    # paths: all occurrences but those in the first document
    checks = read.where("is_path = 1").select("frag", F.col("h2").alias("check")).distinct()
    spans = places.select("doc_id", "text_key", "start", "frag").join(
        whole.select(F.col("head").alias("frag"), "n", "owner").join(checks, "frag"), "frag").where(F.col("doc_id") > F.col("owner"))
    gone = spans.select("doc_id", "text_key", "start", "n", "check").unionByName(bits).distinct()
    gone = gone.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).agg(F.collect_list(F.struct("start", "n", "check")).alias("x"))
    gone = gone.select("gone_id", "gone_key", F.col("x.start").alias("starts"), F.col("x.n").alias("ns"), F.col("x.check").alias("checks"))
    joined = docs.join(gone, (F.col("doc_id") == F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    schema = f"doc_id {dtype}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.select("doc_id", "text", "starts", "ns", "checks").mapInArrow(_remove(k, with_text), schema)
