"""Word-pair language model counted over the whole corpus.

An interpolated modified Kneser-Ney model of order 2 over unfolded words.  A
word's code is 32 bits of the hash of its bytes and its document's ``lang``, so
languages share no words; a pair of codes is a 64-bit key.  A pair's count is
the number of documents that have it, less one: what only one document has
supports nobody, and each text is scored on what others say.  The shares and
discounts are those of a Kneser-Ney model over these counts, the lower order
being the number of different words before a word, with one place for all
words that follow none.  Two words share a code with a chance of V / 2**32 for
V different words.

Nothing of the model is broadcast or sent to the driver but a few sums (counts
of counts).  Texts are coded in blocks of about ``BLOCK_WORDS`` words; a
block's different pairs go, as sorted packed arrays, to buckets by key, where
all blocks' counts meet, and each block gets its own pairs' counts back, one
number a pair.  Words' sums and answers go the same way.  A bucket sees a pair
at most once a block, so frequent words and pairs, or many copies of a text,
make no bucket larger; there are as many buckets as the words ask for.

All buckets are counted, and all blocks scored, in ``PASSES`` equal parts one
after the other, and a part's shuffle files are removed behind it: the disk
holds the coded texts and the counts, but never all pairs or all answers at
once.  Inside a block, pairs are made for about ``RUN_WORDS`` words at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts

BLOCK_WORDS = 1 << 21
BUCKET_WORDS = 1 << 20
RUN_WORDS = 1 << 18
PASSES = 4
LEAST_BITS = 6
_U = np.uint64
_ROWS = "kind int, block long, bucket int, keys binary, vals binary, docs binary, n long"
_TEXT, _PAIRS, _WORDS, _SUMS = range(4)
_FIELDS = ("total", "n1", "n2", "n3", "n4", "more", "before")
_TOTALS = [f"{c}{k}" for c in "nm" for k in range(1, 5)] + ["pairs", "words"]


def row_key() -> Column:
    """One number for a row's doc_id, text_key and language; rows that share it are copies."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"), F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")))


def _pack(values: np.ndarray) -> bytes:
    """An array's bytes, those of equal weight together, compressed behind its length."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpack(raw: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(raw[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _pack(np.diff(keys, prepend=keys.dtype.type(0)))


def _unpack_sorted(raw: bytes, dtype: type) -> np.ndarray:
    return np.cumsum(_unpack(raw, dtype), dtype=dtype)


def _unmix(h: np.ndarray) -> np.ndarray:
    """The number that ``blocks.mix`` made ``h`` of."""
    h = h ^ (h >> _U(31)) ^ (h >> _U(62))
    h *= _U(pow(0x94D049BB133111EB, -1, 1 << 64))
    h ^= (h >> _U(27)) ^ (h >> _U(54))
    h *= _U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    h ^= (h >> _U(30)) ^ (h >> _U(60))
    return h


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    names = [c.split()[0] for c in _ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_rows(rows)])


def _slices(keys: np.ndarray, width: int, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys by their top bits."""
    top = (keys >> keys.dtype.type(width - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]])) if len(top) else np.empty(0, np.int64)
    yield from zip(top[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=False)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different values, and the place of each value among them."""
    own, at = np.unique(values, return_inverse=True)
    return own, at.astype(np.uint32)


def _by_count(counts: np.ndarray) -> np.ndarray:
    """The order that puts frequent words first: their ranks are short numbers."""
    return np.argsort(-counts, kind="stable")


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, seed, text) as blocks: sorted word codes, each word's rank among them by its count, and the texts' keys, sizes and heads with the counts."""
    part, made, held, n = TaskContext.get().partitionId(), 0, [], 0

    def block() -> pa.RecordBatch:
        coded, *rest = zip(*held, strict=True)
        heads, keys, sizes = map(np.concatenate, rest)
        words = np.unique(np.concatenate([*(own for own, _ in coded), heads]))
        places = np.concatenate([np.searchsorted(words, own).astype(np.uint32)[at] for own, at in coded])
        counts = np.bincount(places, minlength=len(words))
        rank = np.empty(len(words), np.uint32)
        rank[_by_count(counts)] = np.arange(len(words), dtype=np.uint32)
        docs = np.concatenate([keys, sizes, rank[np.searchsorted(words, heads)], counts])
        return _rows([(_TEXT, (part << 32) + made, None, _pack_sorted(words), _pack(rank[places]), _pack(docs), len(places))])

    for batch in batches:
        keys, seeds = (np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "seed"))
        for lo, hi, data, offs in B.blocks(batch.column("text")):
            starts, ends, first = B.words(data, offs)
            seed = seeds[lo:hi].view(_U)
            codes = B.mix(B.spans(B.prefix(data), starts, ends, values=data) ^ seed[B.row_of(first)]) >> _U(32)
            held.append((_distinct(codes.astype(np.uint32)), (B.mix(seed) >> _U(32)).astype(np.uint32), keys[lo:hi], np.diff(first).astype(np.int64)))
            n += len(codes)
            if n >= BLOCK_WORDS:
                yield block()
                made, held, n = made + 1, [], 0
    if held:
        yield block()


def _pairs(words: np.ndarray, places: np.ndarray, sizes: np.ndarray, heads: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole texts: their words, the texts, and for each word the key of the pair that ends there, its first word's place and its text in the run."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        a = int(ends[lo] - sizes[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, a + RUN_WORDS, side="right")))
        own, b = sizes[lo:hi], int(ends[hi - 1])
        if b > a:
            left = np.empty(b - a, np.uint32)
            left[1:] = places[a:b - 1]
            left[(np.cumsum(own) - own)[own > 0]] = heads[lo:hi][own > 0]
            yield slice(a, b), slice(lo, hi), B.mix((words[left].astype(_U) << _U(32)) | words[places[a:b]]), left, np.repeat(np.arange(hi - lo), own)
        lo = hi


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from those before them."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _block(row: dict) -> tuple[np.ndarray, ...]:
    """A block's sorted words, their order by rank, each word's rank, and the texts' keys, sizes and heads."""
    words, docs = _unpack_sorted(row["keys"], np.uint32), _unpack(row["docs"], np.int64)
    texts = len(docs) - len(words)
    return words, _by_count(docs[texts:]), _unpack(row["vals"], np.uint32), *docs[:texts].reshape(3, -1)


def _ask_pairs(bits: int, at_pass: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                words, order, places, _, sizes, heads = _block(row)
                found = []
                for _, _, key, _, text in _pairs(words[order], places, sizes, heads):
                    mine = np.flatnonzero((key >> _U(64 - bits)) % _U(PASSES) == at_pass)
                    mine = mine[np.argsort(key[mine], kind="stable")]
                    found.append(key[mine[_starts(key[mine], text[mine])]])
                key = np.concatenate([np.empty(0, _U), *found])
                del found, places
                key.sort()
                first = np.flatnonzero(_starts(key))
                docs, key = np.diff(first, append=len(key)).astype(np.uint32), key[first]
                if len(key):
                    yield _rows([(_PAIRS, row["block"], b, _pack_sorted(key[i:j]), _pack(docs[i:j]), None, None) for b, i, j in _slices(key, 64, bits)])
    return run


def _ask_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys in zip(batch.column("block").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                words = _unpack_sorted(keys, np.uint32)
                yield _rows([(_WORDS, block, b, _pack_sorted(words[i:j]), None, None, None) for b, i, j in _slices(words, 32, bits)])
    return run


def _count_pairs(bits: int):
    """Each block's counts of its pairs, and what a bucket's pairs add to the sums of their words."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "bucket", "keys", "vals"]).to_pylist()
        keys = [_unpack_sorted(r.pop("keys"), _U) for r in rows]
        edges, key = np.cumsum([0, *map(len, keys)]), np.concatenate(keys)
        del keys
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(_starts(key))
        count = np.add.reduceat(np.concatenate([_unpack(r.pop("vals"), np.uint32) for r in rows])[order], first, dtype=np.int64) - 1
        mine = np.empty(len(key), np.uint32)
        mine[order] = np.repeat(count, np.diff(first, append=len(key)))
        out = [(_PAIRS, r["block"], r["bucket"], None, _pack(mine[i:j]), None, None) for r, i, j in zip(rows, edges[:-1], edges[1:], strict=True)]
        key = key[first]
        del order, mine, first
        pair, count = _unmix(key[count > 0]), count[count > 0]
        words, at = np.unique(np.concatenate([pair >> _U(32), pair & _U(0xFFFFFFFF)]).astype(np.uint32), return_inverse=True)
        first, last = at[:len(pair)], at[len(pair):]
        add = lambda w: np.bincount(first, w, len(words))
        sums = np.array([add(count), *(add(count == k) for k in range(1, 5)), add(count > 2), np.bincount(last, minlength=len(words))]).astype(np.int64)
        return _table(out + [(_SUMS, None, b, _pack_sorted(words[i:j]), _pack(sums[:, i:j].ravel()), None, None) for b, i, j in _slices(words, 32, bits)])
    return run


def _add_sums(table: pa.Table) -> pa.Table:
    """The sums of a bucket's words in one row, with its counts of counts."""
    rows = table.select(["bucket", "keys", "vals"]).to_pylist()
    words, at = np.unique(np.concatenate([_unpack_sorted(r["keys"], np.uint32) for r in rows]), return_inverse=True)
    parts = np.concatenate([_unpack(r["vals"], np.int64).reshape(len(_FIELDS), -1) for r in rows], axis=1)
    sums = np.array([np.bincount(at, p, len(words)) for p in parts]).astype(np.int64)
    before = sums[6]
    totals = [*sums[1:5].sum(axis=1).tolist(), *(int((before == k).sum()) for k in range(1, 5)), int(before.sum()), int((before > 0).sum())]
    columns = {"bucket": pa.array([rows[0]["bucket"]], pa.int32()), "keys": pa.array([_pack_sorted(words)], pa.binary()), "vals": pa.array([_pack(sums.ravel())], pa.binary())}
    return pa.table(columns | {c: pa.array([v], pa.int64()) for c, v in zip(_TOTALS, totals, strict=True)})


def discounts(n: list[int]) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more give away, from the numbers of counts 1 to 4."""
    if not n[0] or not n[1]:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    out = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(out))])


def _tell_words(d: np.ndarray, m: np.ndarray, unseen: float, pairs: int):
    """Each block's words' totals, what they leave to the lower order, and their probability there."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["kind", "block", "bucket", "keys", "vals"]).to_pylist()
        have, sums = np.empty(0, np.uint32), np.empty((len(_FIELDS), 0), np.int64)
        for r in rows:
            if r["kind"] == _SUMS:
                have, sums = _unpack_sorted(r["keys"], np.uint32), _unpack(r["vals"], np.int64).reshape(len(_FIELDS), -1)
        total, n1, n2, _, _, more, before = sums.astype(np.float64)
        left = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * more) / np.maximum(total, 1), 1.0)
        low = (before - m[np.minimum(sums[6], 3)]) / max(pairs, 1) + unseen
        told = np.array([np.append(total, 0), np.append(left, 1), np.append(low, unseen)], np.float32)
        out = []
        for r in rows:
            if r["kind"] == _WORDS:
                words = _unpack_sorted(r["keys"], np.uint32)
                at = np.searchsorted(have, words)
                found = at < len(have)
                found[found] = have[at[found]] == words[found]
                out.append((_WORDS, r["block"], r["bucket"], None, _pack(told[:, np.where(found, at, len(have))].ravel()), None, None))
        return _table(out)
    return run


def _score(d: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["kind", "bucket", "keys", "vals", "docs"]).to_pylist(), key=lambda r: (r["kind"], r["bucket"] or 0))
        words, order, places, keys, sizes, heads = _block(rows[0])
        total, left, low = np.concatenate([_unpack(r["vals"], np.float32).reshape(3, -1) for r in rows if r["kind"] == _WORDS], axis=1)[:, order]
        counts = np.concatenate([np.empty(0, np.uint32), *(_unpack(r["vals"], np.uint32) for r in rows if r["kind"] == _PAIRS)])
        runs = [(at, texts, _distinct(key), first, text.astype(np.uint32)) for at, texts, key, first, text in _pairs(words[order], places, sizes, heads)]
        known = np.concatenate([np.empty(0, _U), *(own for _, _, (own, _), _, _ in runs)])
        known.sort()
        known = known[_starts(known)]
        nats = np.zeros(len(sizes))
        for at, texts, (own, key), first, text in runs:
            count = counts[np.searchsorted(known, own)].astype(np.int64)[key]
            p = left[first].astype(np.float64) * low[places[at]]
            seen = np.flatnonzero(count)
            p[seen] += (count[seen] - d[np.minimum(count[seen], 3)]) / total[first[seen]]
            nats[texts] = np.bincount(text, -np.log(p), len(sizes[texts]))
        return pa.table({"key": pa.array(keys, pa.int64()), "word_nats": pa.array(np.round(nats / np.maximum(sizes, 1), 6))})
    return run


def word_nats(docs: DataFrame) -> tuple[DataFrame, float]:
    """key (``row_key``) and word_nats (mean negative log probability of a word) of doc_id, text_key, lang and text.

    Beside it what a word has that follows none, behind one that none follows.
    """
    cuts = Cuts()
    seed = F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")))
    coded = cuts.write(docs.select(row_key().alias("key"), seed.alias("seed"), "text").mapInArrow(_code, _ROWS))
    n = coded.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_BITS, (n // BUCKET_WORDS).bit_length())
    counted = [cuts.write(coded.mapInArrow(_ask_pairs(bits, i), _ROWS).groupBy("bucket").applyInArrow(_count_pairs(bits), _ROWS), free=True) for i in range(PASSES)]
    every = reduce(DataFrame.unionByName, counted)
    sums = every.where(F.col("kind") == _SUMS).groupBy("bucket").applyInArrow(
        _add_sums, "bucket int, keys binary, vals binary, " + ", ".join(f"{c} long" for c in _TOTALS))
    sums = cuts.write(sums, free=True)
    have = sums.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS)).first()
    d, m = discounts([have[f"n{k}"] for k in range(1, 5)]), discounts([have[f"m{k}"] for k in range(1, 5)])
    known = [have["m1"], have["m2"], have["words"] - have["m1"] - have["m2"]]
    unseen = (float(m[1:] @ known) / have["pairs"] if have["pairs"] else 1.0) / (have["words"] + 1)
    told_of = sums.select(F.lit(_SUMS).alias("kind"), "bucket", "keys", "vals")
    scored = []
    for i in range(PASSES):
        texts, pairs = (df.where(F.pmod(F.xxhash64("block"), F.lit(PASSES)) == i) for df in (coded, every.where(F.col("kind") == _PAIRS)))
        told = texts.mapInArrow(_ask_words(bits), _ROWS).unionByName(told_of, allowMissingColumns=True)
        told = told.groupBy("bucket").applyInArrow(_tell_words(d, m, unseen, have["pairs"]), _ROWS)
        meet = texts.unionByName(pairs).unionByName(told)
        scored.append(cuts.write(meet.groupBy("block").applyInArrow(_score(d), "key long, word_nats double"), free=True))
    cuts.drop(coded, *counted, sums)
    return reduce(DataFrame.unionByName, scored).groupBy("key").agg(F.max("word_nats").alias("word_nats")), -math.log(unseen)
