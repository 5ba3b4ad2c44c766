"""Quality rules: countable base rules, n-gram perplexity bands and a word-pair model.

The language model is an interpolated modified Kneser-Ney model of order 4 for
each value of ``lang`` over bytes folded to 64 symbols (case, digits and
multi-byte characters fold together).  Spark counts the 4-grams of every
document; lower orders are continuation counts of those.  A gram is a 24-bit
code, so a language has at most 2**24 of them whatever the input: that is the
proven bound of what is broadcast for it.  The codes lie in a sorted array; a
bit map for each 3-symbol context leads to a code's place in it.

A document that passes the base rules is kept if the mean negative log
probability of its symbols lies in its language's band, ``[q1 - LOW_IQRS * s,
q3 + HIGH_IQRS * s]`` with ``s = iqr * sqrt(1 + BAND_WORDS / n_words)`` (short
texts scatter more).  The quartiles are counted exactly over all base-passing
documents of that language, in bins of 0.001.  The lower band catches text
that is too easy to predict (symbol rows, endless repeats); the upper one lies
where documents that mix languages still pass and random letters don't, even
with a hundred such texts among those that the model was counted on.

A language's grams and their counts are what is broadcast; a task works out the
model of a language when it meets one, and keeps ``HELD_MODELS`` of them.

The fold leaves that model little of a corpus, so with ``word_share`` a model of
whole word pairs (``word_model``), which grows with the corpus and is neither
broadcast nor collected, has a say too: a document is kept only if the mean of
its words is at most ``word_share`` of what a word costs that no other document
has.  A language is judged where at least ``JUDGED_SHARE`` of its base-passing
documents are under that line; where most share no words with others, being
alone says nothing.  There is no lower end for words: a copied text is easy to
predict from its copies, and that is the deduplication's matter.

Defined results: null and empty texts have no words and fail the base rules.
A null ``lang`` is a language of its own.  Rows that repeat are scored and
counted each.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts, text_key
from creditflow.llm.word_model import row_key, word_nats

BITS = 6
SYMBOLS = 1 << BITS
ORDER = 4
BIN = 0.001
LOW_IQRS = 4.0
HIGH_IQRS = 10.0
WORD_SHARE = 0.93
JUDGED_SHARE = 0.75
HELD_MODELS = 8
SCORED_BYTES = 1 << 18
BAND_WORDS = 100
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
_T3 = 1 << 3 * BITS


def _fold() -> np.ndarray:
    """Symbol of each byte; 0 stands before a text begins."""
    table = np.full(256, 41, np.int64)
    for b in range(26):
        table[65 + b] = table[97 + b] = 1 + b
    table[48:58] = 27
    table[[32, 9]] = 28
    table[[10, 11, 12, 13]] = 29
    for at, chars in enumerate((".", ",", ";:", "!?", "\"'`", "()[]{}", "-_", "#*$%&|<>", "@/\\=+~^")):
        table[[ord(c) for c in chars]] = 30 + at
    table[0x80:0xC0] = 48 + (np.arange(64) & 15)
    table[0xC0:] = 42 + np.arange(64) % 6
    return table


_FOLD = _fold()
_SYMBOL_CHAR = np.zeros(256, bool)
_SYMBOL_CHAR[[ord(c) for c in "#*$%&|<>"]] = True


def grams(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The 4-gram code that ends at each byte; no gram reaches over a text's start."""
    code = _FOLD[data]
    starts = offs[:-1][offs[:-1] < len(data)]
    out = code.copy()
    for back in range(1, ORDER):
        earlier = np.zeros_like(code)
        earlier[back:] = code[:-back]
        for k in range(back):
            at = starts + k
            earlier[at[at < len(code)]] = 0
        out |= earlier << (BITS * back)
    return out


def _languages(column: pa.Array) -> tuple[list[str | None], np.ndarray]:
    """The values of a language column, null among them, and which one each row has."""
    coded = column.cast(pa.string()).dictionary_encode(null_encoding="encode")
    return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64)


def _merge(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

    def settle(lang):
        parts = have[lang]
        have[lang] = [_merge(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]

    for batch in batches:
        langs, which = _languages(batch.column(0))
        for lo, hi, data, offs in B.blocks(batch.column(1)):
            code = grams(data, offs)
            lang_of = np.repeat(which[lo:hi], np.diff(offs))
            both, n = np.unique((lang_of << ORDER * BITS) | code, return_counts=True)
            own = both >> ORDER * BITS
            for k in np.unique(own):
                lang = langs[k]
                have.setdefault(lang, []).append(((both & (1 << ORDER * BITS) - 1)[own == k], n[own == k]))
                if len(have[lang]) >= 16:
                    settle(lang)
    for lang in have:
        settle(lang)
        codes, n = have[lang][0]
        for at in range(0, len(codes), 50_000):
            part = codes[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part.astype(np.int32)),
                                              pa.array(n[at:at + 50_000].astype(np.int64))], ["lang", "gram", "n"])


# ---- modified Kneser-Ney ----------------------------------------------------

def _discounts(counts: np.ndarray) -> tuple[float, float, float]:
    n = [int((counts == k).sum()) for k in range(1, 5)]
    if not n[0] or not n[1]:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    out = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(out))


def _discounted(counts: np.ndarray, context: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """Each gram's discounted share of its context, and what each context leaves to the lower order."""
    d = np.array([0.0, *_discounts(counts)])
    cut = d[np.minimum(counts, 3)]
    total = np.bincount(context, counts, contexts)
    left = np.bincount(context, cut, contexts)
    safe = np.where(total > 0, total, 1)
    return (counts - cut) / safe[context], np.where(total > 0, left / safe, 1.0)


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of the model of one language, from its sorted 4-gram codes and their counts."""
    below = np.full(SYMBOLS, 1 / SYMBOLS)
    types = [codes]
    for order in (3, 2, 1):
        types.insert(0, np.unique(types[0] & (1 << BITS * order) - 1))
    for order in (1, 2, 3):  # dense; counts of distinct left neighbours
        size = 1 << BITS * order
        cont = np.bincount(types[order] & size - 1, minlength=size)
        seen = np.flatnonzero(cont)
        share, left = _discounted(cont[seen], seen >> BITS, max(1, size >> BITS))
        dense = below[np.arange(size) & (size >> BITS) - 1] if order > 1 else below.copy()
        dense *= left[np.arange(size) >> BITS]
        dense[seen] += share
        below = dense
    share, left = _discounted(counts, codes >> BITS, _T3)
    bitmap = np.zeros(_T3, np.uint64)
    np.bitwise_or.at(bitmap, codes >> BITS, np.uint64(1) << (codes & SYMBOLS - 1).astype(np.uint64))
    return {"codes": codes.astype(np.int32), "share": share.astype(np.float32), "left": left.astype(np.float32),
            "below": below.astype(np.float32), "bitmap": bitmap,
            "start": np.searchsorted(codes, np.arange(_T3) << BITS).astype(np.int32)}


def log_prob(model: dict[str, np.ndarray], code: np.ndarray) -> np.ndarray:
    context, last = code >> BITS, (code & SYMBOLS - 1).astype(np.uint64)
    bits = model["bitmap"][context]
    p = model["left"][context] * model["below"][code & _T3 - 1]
    seen = np.flatnonzero((bits >> last) & np.uint64(1))
    at = model["start"][context[seen]] + np.bitwise_count(bits[seen] & ((np.uint64(1) << last[seen]) - np.uint64(1)))
    p[seen] += model["share"][at]
    return np.log(p, dtype=np.float64)


# ---- scores -----------------------------------------------------------------

def _repeat_words(wh: np.ndarray, first: np.ndarray, k: int = 5) -> np.ndarray:
    """How many words of each row lie in a k-word window that the row has twice or more."""
    rows = len(first) - 1
    h = B.rolling(B.prefix(wh), k)
    row = B.row_of(first)
    inside = np.flatnonzero(np.arange(len(h)) + k <= first[row[: len(h)] + 1])
    own = B.mix(h[inside] ^ (row[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    ranked = np.sort(own)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return np.zeros(rows, np.int64)
    at = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
    begin = inside[twice[at] == own]
    covered = B.cover(len(wh), begin, begin + k)
    return np.bincount(row[covered], minlength=rows).astype(np.int64)


def base_counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The contract's countable features of each row of a block."""
    starts, ends, first = B.words(data, offs)
    at = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])
    in_word = ~B.SEPARATOR[data]
    pre = B.prefix(data)
    rows = len(offs) - 1
    cuts = np.flatnonzero(data == 10)
    n_lines = np.diff(np.searchsorted(cuts, offs)) + 1
    line = np.sort(np.concatenate([offs[:-1], cuts + 1]), kind="stable")
    row = np.repeat(np.arange(rows), n_lines)
    stop = np.empty_like(line)
    stop[:-1] = line[1:] - 1
    stop[np.cumsum(n_lines) - 1] = offs[1:]
    full = np.searchsorted(starts, line) < np.searchsorted(starts, stop)
    own = B.mix(B.spans(pre, line[full], stop[full], values=data) ^ (row[full].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    _, once = np.unique(own, return_index=True)
    n_full, n_once = np.bincount(row[full], minlength=rows), np.bincount(row[full][once], minlength=rows)
    return {"n_words": np.diff(first).astype(np.int64), "word_chars": at(in_word & ((data & 0xC0) != 0x80)),
            "n_symbols": at(_SYMBOL_CHAR[data]), "n_dup_lines": (n_full - n_once).astype(np.int64),
            "n_repeat_words": _repeat_words(B.spans(pre, starts, ends, values=data), first)}


_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score(counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, dict[str, np.ndarray]] = {}

        def model_of(lang: str | None) -> dict[str, np.ndarray]:
            if lang not in held:
                if len(held) >= HELD_MODELS:
                    held.pop(next(iter(held)))
                codes, n = counted.value[lang]
                held[lang] = kneser_ney(codes.astype(np.int64), n)
            return held[lang]

        for batch in batches:
            langs, which = _languages(batch.column("lang"))
            for lo, hi, data, offs in B.blocks(batch.column("text"), SCORED_BYTES):
                counts = base_counts(data, offs)
                code, sizes = grams(data, offs), np.diff(offs)
                total = np.zeros(hi - lo)
                for k in np.unique(which[lo:hi]):
                    rows = which[lo:hi] == k
                    picked = np.repeat(rows, sizes)
                    row = np.repeat(np.arange(hi - lo), np.where(rows, sizes, 0))
                    if len(row):
                        total += np.bincount(row, log_prob(model_of(langs[k]), code[picked]), hi - lo)
                nats = np.round(-total / np.maximum(sizes, 1), 6)
                keys = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key", "lang")]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(counts[c].astype(np.int64)) for c in _FEATURES), pa.array(nats)],
                                                 ["doc_id", "text_key", "lang", *_FEATURES, "nats"])
    return run


def _quartiles(bins: pd.DataFrame) -> dict[str | None, tuple[float, float]]:
    out = {}
    for lang, part in bins.groupby("lang", dropna=False):
        part = part.sort_values("bin")
        share = part["n"].cumsum().to_numpy() / part["n"].sum()
        out[lang if isinstance(lang, str) else None] = tuple(
            float(part["bin"].to_numpy()[np.searchsorted(share, q)] + edge) * BIN for q, edge in ((0.25, 0), (0.75, 1)))
    return out


def quality_rules(docs: DataFrame, low_iqrs: float = LOW_IQRS, high_iqrs: float = HIGH_IQRS, word_share: float | None = None) -> DataFrame:
    """doc_id, text_key, lang, the base counts, base_failed, nats (mean negative log probability) and kept, for every row.

    With ``word_share`` each row has word_nats too, and ``kept`` asks for both models' verdicts.
    """
    spark, cuts = docs.sparkSession, Cuts()
    docs = docs.select("doc_id", "lang", "text", text_key().alias("text_key"))
    grams_of = docs.select("lang", "text").mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = grams_of.toArrow().combine_chunks()  # at most 2**24 codes a language
    langs, which = _languages(table["lang"].combine_chunks()) if len(table) else ([], np.empty(0, np.int64))
    gram, n = table["gram"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort((gram, which))
    edges = np.searchsorted(which[order], np.arange(len(langs) + 1))
    counted = spark.sparkContext.broadcast({lang: (gram[order[a:b]], n[order[a:b]]) for lang, a, b in zip(langs, edges[:-1], edges[1:], strict=True)})
    del table, gram, n, order, which
    dtype = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.mapInArrow(_score(counted), f"doc_id {dtype}, text_key long, lang string, " + ", ".join(f"{c} long" for c in _FEATURES) + ", nats double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = cuts.write(scored.withColumn("base_failed", failed))
    counted.destroy()
    bins = scored.where(~F.col("base_failed")).groupBy("lang", F.floor(F.col("nats") / BIN).alias("bin")).agg(F.count("*").alias("n")).toPandas()
    inside, scatter = F.lit(False), F.sqrt(1 + F.lit(BAND_WORDS) / F.greatest(F.col("n_words"), F.lit(1)))
    for lang, (q1, q3) in _quartiles(bins).items():
        band = F.col("nats").between(q1 - low_iqrs * (q3 - q1) * scatter, q3 + high_iqrs * (q3 - q1) * scatter)
        inside = F.when(F.col("lang").eqNullSafe(F.lit(lang)), band).otherwise(inside)
    kept = ~F.col("base_failed") & inside
    if word_share is None:
        return scored.withColumn("kept", kept)
    by_words, most = word_nats(docs)
    both = cuts.write(scored.withColumn("key", row_key()).join(by_words, "key").drop("key"))
    cuts.drop(scored, by_words)
    under = F.col("word_nats") <= word_share * most
    judged = both.where(~F.col("base_failed")).groupBy(F.col("lang").alias("own")).agg((F.avg(under.cast("int")) >= JUDGED_SHARE).alias("judged"))
    both = both.join(F.broadcast(judged), F.col("lang").eqNullSafe(F.col("own")), "left")
    return both.withColumn("kept", kept & (under | ~F.col("judged"))).drop("own", "judged")
