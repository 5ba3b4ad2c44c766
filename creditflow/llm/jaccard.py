"""N-gram Jaccard join by a token-group matrix, and the components of its links.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets
of shingles.  Documents with equal sets are one class from the start.

1. All sets use one global token order: tokens held by over 1/``HOT_SHARE`` of
   the documents last, then longer shingles first (they are rarer).  A set of n
   tokens that must share ``ceil(percent * n / 100)`` of them with a partner
   has to share ``SHARED`` of its first ``n - that + SHARED``: its prefix.
   (Where it must share fewer than ``SHARED`` in all, the set is its prefix.)
2. Classes are partitioned into groups by the prefix token that most prefixes
   hold, so that copies of a text stay together; a group of over ``GROUP``
   classes is split by class hash.
3. The token-group matrix has a row for each prefix token and group with the
   sizes of the members; queries are counted against it, and a group is a
   candidate of a query when at least ``SHARED`` cells match.
4. A candidate group is opened in one task together with a block of its
   queries: the group's full token union bounds the overlap, groups that can't
   reach the bound stay closed, the others' members are compared exactly.  Only
   links that join two parts not joined before in that task are returned.
5. Connected components of those links.

Which tokens count as hot (from counts that each task prunes) moves tokens in
the order only; the result doesn't depend on it.  Nothing is capped.

Defined results: null and empty texts have an empty set, n_shingles 0 and
themselves as component.  With fewer words than a shingle, the whole sequence
is the only shingle.  Rows that share a doc_id are compared each on its own; a null
doc_id counts last in the choice of the smallest.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.components import components
from creditflow.llm.cuts import Cuts, text_key

HOT_SHARE = 4096
SHARED = 8
GROUP = 1024
QUERIES = 4096
_COUNT_AT = 4_000_000


def _sets(data: np.ndarray, offs: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row's distinct shingle hashes, sorted, and their lengths in bytes."""
    low = B.LOWER[data]
    starts, ends, first = B.words(data, offs)
    wh = B.spans(B.prefix(low), starts, ends, values=low)
    pre = B.prefix(wh)
    long, sizes = B.rolling(pre, k), ends - starts
    total = np.concatenate([[0], np.cumsum(sizes)])
    lens = total[k:] - total[:-k] if len(sizes) >= k else np.empty(0, np.int64)
    bounds = first.tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            h, at = np.unique(long[a:b - k + 1], return_index=True)
            yield h, lens[a:b - k + 1][at]
        elif b > a:
            yield B.spans(pre, np.array([a]), np.array([b]), seed=k), np.array([int(total[b] - total[a])])
        else:
            yield np.empty(0, np.uint64), np.empty(0, np.int64)


def _local_counts(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        docs = size = 0

        def settle():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(2, docs // (2 * HOT_SHARE))
            return pa.RecordBatch.from_arrays([pa.array(B.signed(h[often])), pa.array(n[often].astype(np.int64))], ["token", "n"])

        for batch in batches:
            for _, _, data, offs in B.blocks(batch.column(0)):
                for h, _ in _sets(data, offs, k):
                    held.append(h)
                    docs, size = docs + 1, size + len(h)
                if size >= _COUNT_AT:
                    yield settle()
                    held, docs, size = [], 0, 0
        if held:
            yield settle()
    return run


def _prefixes(k: int, percent: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_tokens = hot.value
        for batch in batches:
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                n, cls, prefix = [], [], []
                for h, lens in _sets(data, offs, k):
                    need = -(-percent * len(h) // 100)
                    size = len(h) - need + min(SHARED, need)
                    late = np.zeros(len(h), np.int64)
                    if len(hot_tokens) and len(h):
                        late = (hot_tokens[np.minimum(np.searchsorted(hot_tokens, h), len(hot_tokens) - 1)] == h).astype(np.int64)
                    rank = (late << 40) - lens
                    order = np.lexsort((h, rank)) if len(h) else np.empty(0, np.int64)
                    prefix.append(B.signed(h[order[:size]]))
                    n.append(len(h))
                    cls.append(int(B.mix(B.mix(h + np.uint64(len(h))).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]))
                at = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(prefix)))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
                                                 + [pa.array(n, pa.int64()), pa.array(cls, pa.int64()), lists],
                                                 ["doc_id", "text_key", "n", "cls", "prefix"])
    return run


def _token_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                sets = [h.tobytes() for h, _ in _sets(data, offs, k)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in ("cls", "seats")), pa.array(sets, pa.binary())], ["cls", "seats", "tokens"])
    return run


class _Parts:
    """Which of the seen classes are joined already."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[a] = b
        return a != b


def open_group(members: list[tuple[int, np.ndarray]], queries: list[tuple[int, np.ndarray]], percent: int) -> Iterator[tuple[int, int]]:
    """Links of the members with each other and with the queries, without those that follow from others."""
    sizes = np.array([len(t) for _, t in members])
    union, at = np.unique(np.concatenate([t for _, t in members]), return_inverse=True)
    order = np.argsort(at, kind="stable")
    holder = np.repeat(np.arange(len(members)), sizes)[order]
    begin = np.searchsorted(at[order], np.arange(len(union) + 1))
    parts = _Parts()
    for own, (cls, tokens) in enumerate([*members, *queries]):
        where = np.searchsorted(union, tokens)
        where[where == len(union)] = 0
        where = where[union[where] == tokens]
        if 100 * len(where) < percent * len(tokens):
            continue  # the union's bound: no member can reach the overlap
        counts = begin[where + 1] - begin[where]
        posts = holder[np.repeat(begin[where], counts) + B.arange_each(counts)]
        shared = np.bincount(posts, minlength=len(members))
        linked = np.flatnonzero(100 * shared >= percent * (len(tokens) + sizes - shared))
        for m in linked[linked < own].tolist():
            if members[m][0] != cls and parts.join(cls, members[m][0]):
                yield cls, members[m][0]


def _open(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["is_query", "cls"])
        sets = [(c, np.frombuffer(t, np.uint64)) for c, t in zip(pdf["cls"].tolist(), pdf["tokens"], strict=True)]
        cut = int((pdf["is_query"] == 0).sum())
        return pd.DataFrame(list(open_group(sets[:cut], sets[cut:], percent)) if cut else [], columns=["a", "b"])
    return run


def jaccard_links(docs: DataFrame, shingle: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Classes of every row (doc_id, text_key, n, cls), and links (a, b) between classes that span their components."""
    if percent < 51:
        raise ValueError("percent must be at least 51")
    spark, cuts = docs.sparkSession, Cuts()
    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    dtype = docs.schema["doc_id"].dataType.simpleString()
    total = docs.count()
    counts = docs.select("text").mapInArrow(_local_counts(shingle), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    # at most HOT_SHARE times the mean set size: each hot token takes 1/HOT_SHARE of the documents
    often = counts.where(F.col("n") >= max(4, total // HOT_SHARE)).select("token").toPandas()["token"].to_numpy(np.int64)
    hot = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)))
    rows = cuts.write(docs.mapInArrow(_prefixes(shingle, percent, hot), f"doc_id {dtype}, text_key long, n long, cls long, prefix array<long>"))

    # sets of under 9 tokens link only when equal, which is the same class
    least = 100 // (100 - percent) - 1 if percent < 100 else 1 << 62
    classes = rows.where(F.col("n") >= min(least, 9) if percent >= 90 else F.col("n") > 0)
    classes = classes.groupBy("cls").agg(F.min_by(F.struct("doc_id", "text_key", "prefix"), F.struct("doc_id", "text_key")).alias("x"), F.first("n").alias("n"))
    classes = cuts.write(classes.select("cls", "n", "x.*"))
    cells = classes.select("cls", "n", F.explode("prefix").alias("token"))
    held = cells.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    cells = cuts.write(cells.join(held, "token"))
    enough = F.least(F.lit(SHARED), F.expr(f"({percent} * n + 99) div 100"))
    heads = cells.groupBy("cls", "n").agg(F.max(F.struct("held", "token")).alias("head"), F.count("*").alias("c"))
    heads = heads.where(F.col("c") >= enough).select("cls", "head.token")  # others can't share enough with anyone
    sizes = heads.groupBy("token").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / GROUP))
    grouped = cuts.write(heads.join(sizes, "token").select("cls", F.xxhash64("token", part).alias("grp")))
    cells = cuts.write(cells.join(grouped, "cls").select("token", "cls", "n", "grp"))
    inside = cells.groupBy("token", "grp").agg(F.count("*").alias("c")).where("c > 1").select("token", "grp")
    likely = cells.join(inside, ["token", "grp"]).groupBy("cls", "n", "grp").agg(F.count("*").alias("c")).where(F.col("c") >= enough).select("cls", "grp")
    shared = cells.groupBy("token").agg(F.min("grp").alias("g1"), F.max("grp").alias("g2")).where("g1 <> g2").select("token")
    cells = cells.join(shared, "token")
    matrix = cells.groupBy("token", "grp").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    fits = (F.lit(100) * F.col("n") >= F.lit(percent) * F.col("least")) & (F.lit(100) * F.col("most") >= F.lit(percent) * F.col("n"))
    queries = (cells.withColumnRenamed("grp", "own").join(matrix, "token").where((F.col("own") > F.col("grp")) & fits)
               .groupBy("cls", "n", "grp").agg(F.count("*").alias("hits")).where(F.col("hits") >= enough).select("cls", "grp"))
    queries = cuts.write(queries)
    # a group is opened for its queries, or for those members that may link within it
    asked = cuts.write(queries.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("asks")))
    own = likely.join(asked, "grp", "left_anti").select("cls", "grp", F.lit(0).alias("block"), F.lit(0).alias("is_query"))
    members = grouped.join(asked, "grp").select("cls", "grp", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("block"), F.lit(0).alias("is_query"))
    asking = queries.join(asked, "grp").select("cls", "grp", F.pmod(F.xxhash64("cls"), F.col("asks")).cast("int").alias("block"), F.lit(1).alias("is_query"))
    seats = own.unionByName(members).unionByName(asking).groupBy("cls").agg(F.collect_list(F.struct("grp", "block", "is_query")).alias("seats"))
    needed = seats.join(classes.select("cls", F.col("doc_id").alias("want_id"), F.col("text_key").alias("want_key")), "cls")
    whole = docs.join(needed, F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("text_key") == F.col("want_key")))
    sets = whole.select("cls", "text", "seats").mapInArrow(_token_sets(shingle), "cls long, seats array<struct<grp:long,block:int,is_query:int>>, tokens binary")
    seated = sets.select("cls", "tokens", F.explode("seats").alias("s")).select("cls", "tokens", "s.*")
    links = seated.groupBy("grp", "block").applyInPandas(_open(percent), "a long, b long")
    links = cuts.write(links)
    return rows.select("doc_id", "text_key", "n", "cls"), links


def jaccard_roots(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, text_key, n, root of every row of ``docs``: rows with n over 0 are of one component where they share the root."""
    rows, links = jaccard_links(docs, shingle, percent)
    roots = components(links)
    return rows.join(roots, rows["cls"] == roots["node"], "left").select("doc_id", "text_key", "n", F.coalesce("root", "cls").alias("root"))


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id of every row of ``docs``."""
    marked = jaccard_roots(docs, shingle, percent)
    first = marked.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "r")
    out = marked.join(first, (F.col("root") == F.col("r")) & (F.col("n") > 0), "left")
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
