"""The word-pair model against a plain version, and its verdict in the registered queries."""

import collections
import math
import re
import time
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

import corpus_pipeline as P
from creditflow.llm import quality
from creditflow.llm import queries as Q
from creditflow.llm import word_model as W
from creditflow.llm.cuts import text_key

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


def _plain(rows):
    """Mean negative log probability of each row's words, and that of an unsupported word."""
    words = [[(lang, w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] for _, text, lang in rows]
    pairs = [list(zip([(lang, None), *own[:-1]], own, strict=True)) if own else [] for own, (_, _, lang) in zip(words, rows, strict=True)]
    docs = collections.Counter(p for own in pairs for p in set(own))
    count = {p: n - 1 for p, n in docs.items() if n > 1}
    total, left, before = collections.Counter(), collections.Counter(), collections.Counter()
    d = W.discounts([list(count.values()).count(k) for k in range(1, 5)])
    for (v, w), n in count.items():
        total[v] += n
        left[v] += d[min(n, 3)]
        before[w] += 1
    m = W.discounts([list(before.values()).count(k) for k in range(1, 5)])
    every = sum(before.values())
    unseen = (sum(m[min(n, 3)] for n in before.values()) / every if every else 1) / (len(before) + 1)

    def nats(v, w):
        low = unseen + ((before[w] - m[min(before[w], 3)]) / every if before[w] else 0)
        if not total[v]:
            return -math.log(low)
        n = count.get((v, w), 0)
        return -math.log(((n - d[min(n, 3)] if n else 0) + left[v] * low) / total[v])

    return [sum(nats(*p) for p in own) / max(len(own), 1) for own in pairs], -math.log(unseen)


def _scores(docs):
    docs = docs.withColumn("text_key", text_key())
    scored, most = W.word_nats(docs)
    scored = {r.key: r.word_nats for r in scored.collect()}
    return {(r.doc_id, r.text, r.lang): scored[r.key] for r in docs.withColumn("key", W.row_key()).collect()}, most


def test_word_model_is_the_plain_one(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(None, None, None), (-2, "", None), (-3, "a b c", "en"), (-3, "a b c", "fr"), (-4, "a b c", None), (-4, "a b c", ""), (-5, "zzz a b", "en"), (-5, "zzz a b", "en"),
             (-6, "hot pair " * 3000, "en"), (-7, f"long {'x' * 5000} hot pair", "en")]
    want, line = _plain(rows)
    for parts in (1, 7):
        got, most = _scores(spark.createDataFrame(rows, DOCS).repartition(parts))
        assert abs(most - line) < 1e-9 and len(got) == len(set(rows))
        assert max(abs(got[r] - w) for r, w in zip(rows, want, strict=True)) < 1e-5
    assert _scores(spark.createDataFrame(rows, DOCS).limit(0))[0] == {}


def test_packed_arrays_and_keys_come_back():
    rng = np.random.default_rng(1)
    for values in (rng.integers(0, 1 << 63, 1000).astype(np.uint64), np.arange(7, dtype=np.uint32), np.empty(0, np.float32)):
        assert np.array_equal(W._unpack(W._pack(values), values.dtype.type), values)
    pairs = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert np.array_equal(W._unmix(W.B.mix(pairs)), pairs)


def test_invented_words_are_left_out(spark, scratch):
    """Words made of halves of real ones look right to the symbols; no other document has them."""
    rng = np.random.default_rng(5)
    syllables = ["".join(p) for p in zip(rng.choice(list("bdfgklmnprst"), 60), rng.choice(list("aeiou"), 60), strict=True)]
    real = ["".join(rng.choice(syllables, 4)) for _ in range(3000)]
    rows = []
    for i in range(600):  # texts of frequent words, mixed with rare ones
        n, rare = int(rng.integers(60, 150)), rng.uniform(0, 0.6)
        rows.append((i, " ".join(real[int(rng.integers(len(real) if rng.random() < rare else 100))] for _ in range(n)), "xx"))
    invented = [(1000 + i, " ".join("".join(rng.choice(syllables, 4)) for _ in range(80)), "xx") for i in range(20)]
    alone = [(2000, " ".join(f"sole{i}" for i in range(40)), "yy"), (2001, " ".join(f"other{i}" for i in range(40)), None)]
    docs = spark.createDataFrame(rows + invented + alone, DOCS)
    docs.write.parquet(f"{scratch}/documents.parquet")
    symbols = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    assert len([i for i in symbols if 1000 <= i < 2000]) >= 18
    out = {r.doc_id: r for r in Q.op10_quality_rules(spark, scratch).collect()}
    assert {i for i, r in out.items() if r.kept} == {i for i in symbols if not 1000 <= i < 2000}
    assert {r.doc_id for r in P.quality(spark, docs, scratch).collect()} == {i for i, r in out.items() if r.kept}
    want, _ = _plain(rows + invented + alone)
    assert all(abs(out[r[0]].word_nats - w) < 1e-5 for r, w in zip(rows + invented + alone, want, strict=True))


def test_a_block_is_scored_in_runs(monkeypatch):
    """Memory follows the block's coded words, not ten arrays of 64 bits a word."""
    rng = np.random.default_rng(3)
    rows = pa.table({"key": pa.array(range(1000), pa.int64()), "seed": pa.array([7] * 1000, pa.int64()),
                     "text": [" ".join(f"w{i}" for i in rng.zipf(1.3, 1500) % 50_000) for _ in range(1000)]})
    monkeypatch.setattr(W, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    block, = (r for b in W._code(iter(rows.to_batches())) for r in b.to_pylist())
    n = len(W._unpack_sorted(block["keys"], np.uint32))
    told = W._pack(np.full(3 * n, 0.5, np.float32))
    counts = W._pack(np.zeros(1_500_000, np.uint32))
    table = W._table([tuple(block.values()), (W._WORDS, 0, 0, None, told, None, None), (W._PAIRS, 0, 0, None, counts, None, None)])
    tracemalloc.start()
    try:
        out = W._score(np.array([0.0, 0.5, 0.5, 0.5]))(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.allclose(out["word_nats"].to_numpy(), -math.log(0.25), atol=1e-6)
    assert peak < 75 * block["n"], peak / block["n"]


def test_shuffle_files_are_removed_behind_each_pass(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c d{i}", "en") for i in range(100)], DOCS).withColumn("text_key", text_key())
    before = files()
    scored, _ = W.word_nats(docs)
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert len({f.split("_")[1] for f in left}) <= 1  # the sums of sizes and of counts are collected, not written
    assert scored.count() == 100
