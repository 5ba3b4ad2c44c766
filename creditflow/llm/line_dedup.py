"""Line dedup through a sharded minimal perfect hash.

1. Every document's distinct line keys are hashed and counted in Spark.
2. The distinct keys are dealt to shards of about ``SHARD_KEYS``; each shard
   becomes one minimal perfect hash (levels of bit arrays: a key owns the first
   level bit that no other key of its shard wants) whose slot numbers index a
   fingerprint and a count array.
3. Each document's keys go to their shard and probe those arrays; a shard is
   loaded once and its probes stream past it.  Keys in over 1/1024 of all
   document-line pairs (so at most 1024 keys) have their shard copied to as many
   places as they hold such shares, and their probes dealt over them.
4. Keys found in enough documents go back to their documents, which drop them.

Defined results: a null or empty text is one empty line.  Empty keys are never
dropped.  Every row of the input counts as one document, also rows that repeat
a doc_id; a row's dropped keys come back to it by doc_id and text, so rows that
share an id (or have none) cost no more than others.  A null doc_id is an id like any other.  Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts, pieces, shuffle_partitions, text_key

SHARD_KEYS = 32_768
HOT_SHARE = 1024
_COUNT_MAX = 65_535


# ---- minimal perfect hash ---------------------------------------------------

def _slot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (B.mix(h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def build_mph(h: np.ndarray) -> list[np.ndarray]:
    """Level bit arrays of the minimal perfect hash of distinct 64-bit keys."""
    levels, left = [], h
    while len(left):
        size = 2 * len(left) + 1
        at = _slot(left, len(levels), size)
        wanted = np.bincount(at, minlength=size)
        levels.append(wanted == 1)
        left = left[wanted[at] != 1]
    return levels


def mph_slots(levels: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """Slot number of each key; keys outside the set get any slot, or -1."""
    out = np.full(len(h), -1, np.int64)
    left, base = np.arange(len(h)), 0
    for level, bits in enumerate(levels):
        at = _slot(h[left], level, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits)
        out[left[hit]] = base + rank[at[hit]] - 1
        left, base = left[~hit], base + int(rank[-1])
    return out


def _pack(levels: list[np.ndarray]) -> tuple[list[int], bytes]:
    return [len(x) for x in levels], b"".join(np.packbits(x).tobytes() for x in levels)


def _unpack(sizes, raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        out.append(np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at), count=n).astype(bool))
        at += (n + 7) // 8
    return out


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["h", "f"])
    twin = pdf["h"].duplicated()  # keys that share all of h: kept exactly, beside the arrays
    h = pdf["h"].to_numpy()[~twin].view(np.uint64)
    levels = build_mph(h)
    slots = mph_slots(levels, h)
    prints, counts = np.empty(len(h), np.int32), np.empty(len(h), np.uint16)
    prints[slots] = pdf["f"].to_numpy()[~twin]
    counts[slots] = np.minimum(pdf["n"].to_numpy()[~twin], _COUNT_MAX)
    sizes, raw = _pack(levels)
    rest = pdf[twin]
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "sizes": [sizes], "bits": [raw], "prints": [prints.tobytes()],
                         "counts": [counts.tobytes()], "rest_h": [rest["h"].tolist()], "rest_f": [rest["f"].tolist()],
                         "rest_n": [rest["n"].tolist()]})


_INDEX = ("shard long, sizes array<int>, bits binary, prints binary, counts binary, "
          "rest_h array<long>, rest_f array<int>, rest_n array<long>")


# ---- lines ------------------------------------------------------------------

def _lines(data: np.ndarray, offs: np.ndarray):
    """Each line's start, end, row, hash, fingerprint and whether its key is empty."""
    cuts = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offs[:-1], cuts + 1]), kind="stable")
    rows = np.searchsorted(cuts, offs)
    n_lines = np.diff(rows) + 1
    row = np.repeat(np.arange(len(offs) - 1), n_lines)
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    final = np.cumsum(n_lines) - 1
    ends[final] = offs[1:]
    begin, stop, _ = B.words(data, offs)
    lo, hi = np.searchsorted(begin, starts), np.searchsorted(begin, ends)
    blank = lo == hi
    a = np.where(blank, starts, begin[np.minimum(lo, len(begin) - 1)] if len(begin) else starts)
    b = np.where(blank, starts, stop[np.maximum(hi, 1) - 1] if len(stop) else starts)
    key = B.strings(B.LOWER[data], a, b)
    return starts, ends, row, n_lines, np.ascontiguousarray(key["h"]).view(np.int64), np.ascontiguousarray(key["f"]), blank


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, data, offs in B.blocks(batch.column("text")):
            _, _, row, _, h, f, blank = _lines(data, offs)
            keep = np.flatnonzero(~blank)
            order = keep[np.lexsort((f[keep], h[keep], row[keep]))]
            r, hh, ff = row[order], h[order], f[order]
            new = np.ones(len(order), bool)
            new[1:] = (r[1:] != r[:-1]) | (hh[1:] != hh[:-1]) | (ff[1:] != ff[:-1])
            of = pa.array(r[new] + lo)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), batch.column("text_key").take(of), pa.array(hh[new]), pa.array(ff[new])],
                                             ["doc_id", "text_key", "h", "f"])


def _probe(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index = None, None
        for batch in batches:
            shards, kind = np.asarray(batch.column("shard")), np.asarray(batch.column("is_probe"))
            bounds = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if kind[lo] == 0:
                    row = batch.slice(lo, 1).to_pylist()[0]
                    shard = row["shard"]
                    rest = dict(zip(zip(row["rest_h"], row["rest_f"], strict=True), row["rest_n"], strict=True))
                    index = (_unpack(row["sizes"], row["bits"]), np.frombuffer(row["prints"], np.int32),
                             np.frombuffer(row["counts"], np.uint16), rest)
                    continue
                assert shards[lo] == shard, "a probe came to a place without its shard"
                levels, prints, counts, rest = index
                part = batch.slice(lo, hi - lo)
                h, f = np.asarray(part.column("h")), np.asarray(part.column("f"))
                slots = mph_slots(levels, h.view(np.uint64))
                found = (slots >= 0) & (prints[slots] == f)
                hit = found & (counts[slots] >= threshold)
                if rest:
                    hit |= np.fromiter((rest.get(k, 0) >= threshold for k in zip(h.tolist(), f.tolist(), strict=True)), bool, len(h))
                at = pa.array(np.flatnonzero(hit))
                yield pa.RecordBatch.from_arrays([part.column(c).take(at) for c in ("doc_id", "text_key", "h", "f")], ["doc_id", "text_key", "h", "f"])
    return run


def _drop_lines(with_text: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            bad_h, bad_first = B.lists(batch.column("bad_h"))
            bad_f, _ = B.lists(batch.column("bad_f"))
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                starts, ends, row, n_lines, h, f, blank = _lines(data, offs)
                a, b = bad_first[lo], bad_first[hi]
                if b > a:
                    bad_row = np.repeat(np.arange(hi - lo), np.diff(bad_first[lo:hi + 1]))
                    want = pd.MultiIndex.from_arrays([row, h, f])
                    drop = want.isin(pd.MultiIndex.from_arrays([bad_row, bad_h[a:b], bad_f[a:b]])) & ~blank
                else:
                    drop = np.zeros(len(row), bool)
                keep = np.flatnonzero(~drop)
                first = np.ones(len(keep), bool)  # of the kept lines of a row: no newline before it
                first[1:] = row[keep][1:] != row[keep][:-1]
                left = starts[keep] - ~first  # takes the newline before the line along
                # a kept line that follows dropped ones has the last dropped line's newline before it
                mask = B.cover(len(data), left, ends[keep]) if drop.any() else np.ones(len(data), bool)
                at = np.concatenate([[0], np.cumsum(mask)])[offs]
                out = data[mask]
                n_dropped = np.bincount(row, weights=drop, minlength=hi - lo).astype(np.int64)
                cols = [ids.slice(lo, hi - lo), pa.array(n_lines.astype(np.int64)), pa.array(n_dropped), pa.array(B.digests(out, at))]
                if with_text:
                    cols.append(pa.StringArray.from_buffers(hi - lo, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out.tobytes())))
                    cols.append(batch.column("rest").slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, with_text: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of ``docs``; with text also kept_text and the whole row as struct ``rest`` without its text.

    A line's key is the line without separators at both ends and A-Z lowered;
    a key in at least ``min_docs`` documents (1 to 65,535) loses all its lines.
    """
    if not 1 <= min_docs <= _COUNT_MAX:
        raise ValueError("min_docs must be between 1 and 65535")
    spark, cuts = docs.sparkSession, Cuts()
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    docs = docs.select("doc_id", "text", text_key().alias("text_key"), *([F.struct(*others).alias("rest")] if with_text else []))
    dtype = docs.schema["doc_id"].dataType.simpleString()
    pairs = cuts.write(docs.select("doc_id", "text_key", "text").mapInArrow(_emit_keys, f"doc_id {dtype}, text_key long, h long, f int"))
    counts = cuts.write(pairs.groupBy("h", "f").agg(F.count("*").alias("n")))
    n_keys, n_pairs = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards, each = pieces(n_keys, SHARD_KEYS), max(n_pairs // HOT_SHARE, SHARD_KEYS)
    hot = counts.where(F.col("n") > each).groupBy("h").agg(F.ceil(F.sum("n") / each).cast("int").alias("salts")).collect()  # HOT_SHARE at most

    shard = F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard")
    index = cuts.write(counts.select(shard, "h", "f", "n").groupBy("shard").applyInPandas(_build_shard, _INDEX))
    hot = spark.createDataFrame([(r.h, r.salts) for r in hot], "h long, salts int")
    copies = hot.groupBy(shard).agg(F.max("salts").alias("salts")).select("shard", F.explode(F.sequence(F.lit(1), F.col("salts") - 1)).alias("salt")) \
        .where("salt > 0")
    placed = index.withColumn("salt", F.lit(0)).unionByName(index.join(F.broadcast(copies), "shard").select("*"))
    salt = F.pmod(F.xxhash64("doc_id", "text_key"), F.coalesce("salts", F.lit(1))).cast("int")
    probes = pairs.join(F.broadcast(hot), "h", "left").select(shard, salt.alias("salt"), F.lit(1).alias("is_probe"), "doc_id", "text_key", "h", "f")
    both = placed.withColumn("is_probe", F.lit(0)).unionByName(probes, allowMissingColumns=True)
    both = both.repartition(max(shards, shuffle_partitions(docs)), "shard", "salt").sortWithinPartitions("shard", "salt", "is_probe")
    bad = both.mapInArrow(_probe(min_docs), f"doc_id {dtype}, text_key long, h long, f int")
    bad = bad.groupBy(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).agg(F.collect_set(F.struct("h", "f")).alias("bad"))
    bad = bad.select("bad_id", "bad_key", F.col("bad.h").alias("bad_h"), F.col("bad.f").alias("bad_f"))
    joined = docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("text_key") == F.col("bad_key")), "left").drop("bad_id", "bad_key")
    out = f"doc_id {dtype}, n_lines long, n_dropped long, kept_sha256 string"
    if with_text:
        out += f", kept_text string, rest {docs.schema['rest'].dataType.simpleString()}"
    return joined.mapInArrow(_drop_lines(with_text, ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text", "rest"][: 6 if with_text else 4]), out)


__all__ = ["build_mph", "line_dedup", "mph_slots"]
