"""Repeated byte strings through suffix arrays built by linear Lyndon grouping.

1. Each text's 200-byte windows are cut into fragments: runs of windows that
   share the place of their minimizer (the least hash of their ``SEED``-byte
   grams, the first of equal ones).  Equal windows have equal minimizers, so
   they can only meet among the fragments of one minimizer.
2. Fragments whose minimizer occurs once go; equal fragments are counted
   before they are shuffled.  All windows of a fragment found twice repeat.
3. For a minimizer with several different fragments, one of them found once,
   the suffix array of those fragments is built (``suffix_array``): windows
   that equal their neighbour in the array repeat.  Minimizers with over
   ``GROUP`` fragments are taken apart further: there each window is counted
   by a 128-bit hash, so that no group meets in one task.
4. The bytes under repeated windows are removed.

``suffix_array`` groups suffixes by their Lyndon prefix: groups are processed in
descending order, each member's previous smaller suffix is found by following
such pointers, and gets moved up behind the others of its group by how many
members point at it; then one sweep over the array emits every group's order
along the same pointers.  Nothing is renamed or sorted recursively.

Defined results: null and empty texts have no bytes.  Every row is a text of
its own, also rows that repeat a doc_id or have none: a row that repeats as a
whole is removed if it has 200 bytes.  Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts, shuffle_partitions, text_key

SEED = 64
GROUP = 1024
_PLACE = np.uint64((1 << 28) - 1)
_CHECK = 0x5851F42D4C957F2D


# ---- suffix array -----------------------------------------------------------

def suffix_array(s: list[int]) -> list[int]:
    """Order of all suffixes of ``s`` by linear Lyndon grouping."""
    n = len(s) + 1  # a smallest symbol ends the text
    tally: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        tally.setdefault(c, []).append(i)
    order, start = [n - 1], [0] * n  # suffixes by group; first place of each suffix's group
    for c in sorted(tally):
        at = len(order)
        for i in tally[c]:
            start[i] = at
        order += tally[c]
    place = [0] * n
    for at, i in enumerate(order):
        place[i] = at
    end = {}  # one past the last place of the groups, by first place
    at = 0
    while at < n:
        first = at
        while at < n and start[order[at]] == first:
            at += 1
        end[first] = at
    prev = [-1] * n  # the last suffix before with a smaller group

    hi = n
    while hi > 0:
        lo = start[order[hi - 1]]
        members = order[lo:hi] if hi - lo == 1 else sorted(order[lo:hi])
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and start[j] >= lo:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        most = max(pointed.values(), default=0)
        for times in range(most, 0, -1):  # those pointed at most often go highest
            tail: dict[int, int] = {}
            for p, k in pointed.items():
                if k == times:
                    g = start[p]
                    last = end[g] - 1 - tail.get(g, 0)
                    tail[g] = end[g] - last
                    here, other = place[p], order[last]
                    order[here], order[last] = other, p
                    place[other], place[p] = here, last
            for g, count in tail.items():
                stop = end[g]
                first = stop - count
                if first > g:
                    end[g], end[first] = first, stop
                    for x in range(first, stop):
                        start[order[x]] = first
        hi = lo

    out, filled = [-1] * n, [False] * n
    front = {g: g for g in end}
    out[0], filled[n - 1] = n - 1, True
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not filled[j]:
            g = start[j]
            out[front[g]] = j
            front[g] += 1
            filled[j] = True
            j = prev[j]
    return out[1:]


def repeated_windows(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text, which of its windows of ``width`` bytes occur again in any of the texts."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = (data.astype(np.int32) + 1)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    symbols[ends] = 0
    sa = np.array(suffix_array(symbols.tolist()), np.int64)
    counts = np.maximum(np.diff(np.concatenate([[0], ends + 1])) - width, 0)
    begins = np.concatenate([[0], ends[:-1] + 1])
    valid = np.zeros(len(data), bool)
    valid[np.repeat(begins, counts) + B.arange_each(counts)] = True
    sa = sa[valid[sa]]
    again = np.zeros(len(data), bool)
    if len(sa) > 1:
        view = np.lib.stride_tricks.sliding_window_view(data, width)
        for at in range(0, len(sa) - 1, 20_000):
            a, b = sa[at:at + 20_001][:-1], sa[at:at + 20_001][1:]
            same = (view[a] == view[b]).all(axis=1)
            again[a[same]] = True
            again[b[same]] = True
    return [again[b:b + c] for b, c in zip(begins.tolist(), counts.tolist(), strict=True)]


# ---- tasks ------------------------------------------------------------------

def _fragments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                if len(data) < width:
                    continue
                pre = B.prefix(data)
                seeds = B.rolling(pre, SEED)
                least = B.sliding_min((seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64), width - SEED + 1)
                row = np.repeat(np.arange(hi - lo), np.diff(offs))[: len(least)]
                inside = np.arange(len(least)) + width <= offs[row + 1]
                begin = inside.copy()
                begin[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
                at = np.flatnonzero(begin)
                end = np.minimum(np.concatenate([at[1:], [len(least)]]), offs[row[at] + 1] - width + 1)
                seed = seeds[(least[at] & _PLACE).astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(row[at] + lo)) for c in ("doc_id", "text_key")]
                    + [pa.array(B.signed(seed)), pa.array(B.signed(B.spans(pre, at, end + width - 1))), pa.array((at - offs[row[at]]).astype(np.int32)),
                       pa.array((end - at).astype(np.int32))], ["doc_id", "text_key", "seed", "frag", "start", "n"])
    return run


def _read_sources(width: int):
    """Bytes of fragments at their source coordinates; of those in large groups, the hash of each window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frag, first = B.lists(batch.column("frags"))
            seed, start, n, large, found = (B.lists(batch.column(c))[0] for c in ("seeds", "starts", "ns", "large", "found"))
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                a, b = first[lo], first[hi]
                left = offs[np.repeat(np.arange(hi - lo), np.diff(first[lo:hi + 1]))] + start[a:b]
                count, one = n[a:b].astype(np.int64), large[a:b] == 1
                small = np.flatnonzero(~one)
                raw = [data[x:x + c + width - 1].tobytes() for x, c in zip(left[small].tolist(), count[small].tolist(), strict=True)]
                big = np.repeat(np.flatnonzero(one), count[one])
                shift = B.arange_each(count[one])
                begin = left[big] + shift
                h = B.spans(B.prefix(data), begin, begin + width) if len(big) else np.empty(0, np.uint64)
                h2 = B.spans(B.prefix(data.astype(np.uint32) * np.uint32(0x85EBCA6B) >> np.uint32(5)), begin, begin + width, seed=_CHECK) if len(big) else h
                pick = np.concatenate([small, big])
                none = [None] * len(small)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[a:b][pick]), pa.array(frag[a:b][pick]), pa.array(found[a:b][pick]), pa.array(raw + [None] * len(big), pa.binary()),
                     pa.array(none + shift.tolist(), pa.int32()), pa.array(none + B.signed(h).tolist(), pa.int64()), pa.array(none + B.signed(h2).tolist(), pa.int64())],
                    ["seed", "frag", "found", "raw", "i", "h", "h2"])
    return run


def _runs(frag: int, again: np.ndarray) -> list[tuple[int, int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
    return [(frag, int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _sort_groups(width: int):
    """Repeated windows of fragments found once; rows come sorted by seed."""
    def settle(frags, found, raw):
        hits = repeated_windows(raw, width)
        return [r for f, c, again in zip(frags, found, hits, strict=True) if c == 1 for r in _runs(f, again)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []

        def ship():
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], ["frag", "i", "n"])

        for batch in batches:
            for seed, *rest in zip(*(batch.column(c).to_pylist() for c in ("seed", "frag", "found", "raw")), strict=True):
                if seed != now:
                    if held:
                        out += settle(*zip(*held, strict=True))
                    now, held = seed, []
                held.append(rest)
            if out:
                yield ship()
                out.clear()
        if held:
            out += settle(*zip(*held, strict=True))
        if out:
            yield ship()
    return run


def _remove(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, first = B.lists(batch.column("starts"))
            n = B.lists(batch.column("ns"))[0]
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                a, b = first[lo], first[hi]
                left = offs[np.repeat(np.arange(hi - lo), np.diff(first[lo:hi + 1]))] + start[a:b]
                gone = B.cover(len(data), left, left + n[a:b] + width - 1) if b > a else np.zeros(len(data), bool)
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                inner = offs[:-1][offs[:-1] < len(data)]
                opens[inner] = gone[inner]
                at = np.concatenate([[0], np.cumsum(~gone)])[offs]
                spans = np.diff(np.concatenate([[0], np.cumsum(opens)])[offs])
                out, sizes = data[~gone], np.diff(offs)
                cols = [batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes), pa.array(sizes - np.diff(at)), pa.array(spans.astype(np.int64)), pa.array(B.digests(out, at))]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    cols.append(pa.array([out[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary()))
                    names.append("kept_bytes")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def suffix_dedup(docs: DataFrame, width: int = 200, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes) of every row of ``docs``; width is over ``SEED``."""
    if width <= SEED:
        raise ValueError(f"width must be over {SEED}")
    cuts = Cuts()
    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    dtype = docs.schema["doc_id"].dataType.simpleString()
    found = docs.where("text is not null").mapInArrow(_fragments(width), f"doc_id {dtype}, text_key long, seed long, frag long, start int, n int")
    shared = found.groupBy("seed").agg(F.count("*").alias("c")).where("c > 1").select("seed")
    places = cuts.write(found.join(shared, "seed"))
    nodes = cuts.write(places.groupBy("seed", "frag").agg(F.min(F.struct("doc_id", "text_key", "start")).alias("src"), F.first("n").alias("n"), F.count("*").alias("found")))

    groups = nodes.groupBy("seed").agg(F.count("*").alias("size"), F.min("found").alias("least")).where("size > 1 and least = 1")
    groups = groups.select("seed", (F.col("size") > GROUP).cast("int").alias("large"))
    wanted = nodes.join(groups, "seed").groupBy(F.col("src.doc_id").alias("want_id"), F.col("src.text_key").alias("want_key")).agg(
        F.collect_list(F.struct("seed", "frag", "src.start", "n", "large", F.least("found", F.lit(2)).alias("found"))).alias("x"))
    wanted = wanted.select("want_id", "want_key", *(F.col(f"x.{c}").alias(t) for c, t in (("seed", "seeds"), ("frag", "frags"), ("start", "starts"), ("n", "ns"), ("large", "large"), ("found", "found"))))
    read = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_key") == F.col("want_key")))
    read = read.select("text", "seeds", "frags", "starts", "ns", "large", "found").mapInArrow(
        _read_sources(width), "seed long, frag long, found long, raw binary, i int, h long, h2 long")
    read = cuts.write(read)
    small = read.where("raw is not null").select("seed", "frag", "found", "raw").dropDuplicates(["frag"])
    small = small.repartition(4 * shuffle_partitions(docs), "seed").sortWithinPartitions("seed", "frag")
    sorted_runs = small.mapInArrow(_sort_groups(width), "frag long, i int, n int")
    # the windows of large groups; a fragment found more than once counts for itself already
    windows = read.where("raw is null").select("h", "h2", "frag", "i", "found").dropDuplicates(["frag", "i"])
    twice = windows.groupBy("h", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h", "h2")
    counted_runs = windows.where("found = 1").join(twice, ["h", "h2"]).select("frag", "i", F.lit(1).alias("n"))
    runs = sorted_runs.unionByName(counted_runs).withColumnRenamed("n", "m")
    single = nodes.where("found = 1").join(runs, "frag").select("src.doc_id", "src.text_key", (F.col("src.start") + F.col("i")).alias("start"), F.col("m").alias("n"))
    whole = places.join(nodes.where("found > 1").select("frag"), "frag").select("doc_id", "text_key", "start", "n")
    gone = whole.unionByName(single).groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).agg(F.collect_set(F.struct("start", "n")).alias("x"))
    gone = gone.select("gone_id", "gone_key", F.col("x.start").alias("starts"), F.col("x.n").alias("ns"))
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    schema = f"doc_id {dtype}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    return joined.select("doc_id", "text", "starts", "ns").mapInArrow(_remove(width, with_text), schema)
