"""Whitening, packing and the Merkle manifest against plain versions, and on awkward rows."""

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditflow.llm import exact_spectrum as X
from creditflow.llm import merkle
from creditflow.llm import queries as Q
from creditflow.llm.packing import LIMITS, pack
from creditflow.llm.whitening import whiten
from creditflow.llm.word_ids import WordIds
from tests.llm import brute

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- Merkle manifest ----------------------------------------------------------

def manifest(df):
    return sorted((tuple(r) for r in df.select("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def test_merkle_manifest(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = manifest(Q.op13_merkle_manifest(spark, SF))
    assert got == sorted(brute.merkle(rows), key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_merkle_manifest_awkward(spark, monkeypatch):
    """Several rounds of blocks, null and repeated ids and sources, copies, far ids, clashing columns."""
    monkeypatch.setattr(merkle, "BLOCK", 256)
    monkeypatch.setattr(merkle, "STEPS", 2)
    monkeypatch.setattr(merkle, "PIVOTS", 3)
    rows = [(None, None, None, None, None)] * 40
    rows += [(i % 700 if i % 3 else None, [None, "", "a", "B", "é", "zz"][0 if i < 1000 else i % 6], "en", i, f"T{i % 900}x") for i in range(1500)]
    rows += [(x, "far", "e", 1, "Q") for x in (-5, 0, 2 ** 62, -2 ** 63, 2 ** 63 - 1)] + [(9, "long", "e", 1, "Wörd " * 100_000)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, src int, leaf int, m int")
    assert manifest(merkle.tampered_manifest(df)) == sorted(brute.merkle(rows), key=repr)
    assert manifest(merkle.tampered_manifest(df.limit(0))) == []
    lone = merkle.tampered_manifest(df.where("source = 'long'")).first()
    assert lone.leaf == lone.subroot == lone.root and lone.proof_sha256 == hashlib.sha256(b"").hexdigest()


# ---- whitening ------------------------------------------------------------------

def usable(rows):
    """Plain integers of the rows that have them, by the commonest length."""
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, [math.floor(64 * c) + 1_000_000 for c in v]))
    sizes = collections.Counter(len(v) for _, v in out)
    size = max(sizes, key=lambda s: (sizes[s], s))
    return [(i, v) for i, v in out if len(v) == size]


def check_whitening(got, rows):
    rows = usable(rows)
    fit = sorted({tuple(v) for _, v in rows})
    n, size = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit, strict=True)]
    x = np.array([[n * a - b for a, b in zip(v, s, strict=True)] for v in fit], float) / n
    cov = x.T @ x / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = collections.defaultdict(list)
    for r in got:
        by[r.component].append(r)
    k = min(16, np.linalg.matrix_rank(cov))
    assert sorted(by) == list(range(1, k + 1))
    copies = collections.Counter((i, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True))) for i, v in rows)
    for c, held in by.items():
        assert collections.Counter((r.vec_id, r.deviation) for r in held) == copies
        assert {r.n for r in held} == {n}
        assert held[0].explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        assert held[0].identity_error < 1e-9
    if size == 64 and k == 16:  # distinct eigenvalues: one direction, either sign
        plain = {i: (np.array(v) - np.array(s) / n) @ vectors[:, :16] / np.sqrt(values[:16]) for i, v in rows}
        for c, held in by.items():
            a, b = np.array([r.whitened for r in held]), np.array([plain[r.vec_id][c - 1] for r in held])
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(Q.op11_embedding_whitening(spark, SF).collect(), rows)


def test_whitening_awkward(spark):
    """Bad rows, other lengths, copies, null ids, one and no distinct vectors; equal eigenvalues."""
    square = [[1.0, 1.0, 0.0], [1.0, -1.0, 0.0], [-1.0, 1.0, 0.0], [-1.0, -1.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(square * 3)]
    rows += [(None, [1.0, 1.0, 0.0]), (20, None), (21, [1.0, None, 0.0]), (22, [1.0, float("nan"), 0.0]), (23, [float("inf"), 0.0, 0.0]), (24, []), (25, [1.0, 2.0]), (5, [1.0, -1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, n int, code int")
    got = whiten(df).collect()
    check_whitening(got, [r for r in rows if r[0] != 25])
    by_row = collections.defaultdict(dict)
    for r in got:
        by_row[r.vec_id][r.component] = r.whitened
    assert all(abs(sum(w * w for w in held.values()) - 2) < 1e-12 for i, held in by_row.items() if i is not None and i != 5)
    assert whiten(df.where("vec_id in (0, 4)")).collect() == []
    assert whiten(df.limit(0)).collect() == []
    assert whiten(df.where("vec_id = 20")).collect() == []


def test_whitening_of_large_entries_and_few_rows(spark):
    """Fewer distinct vectors than dimensions; entries whose squares pass a long."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(4)]
    check_whitening(whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)
    rows = [(i, [float(c) for c in rng.normal(size=3) * 2.0 ** 38]) for i in range(50)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 150 and max(r.identity_error for r in got) < 1e-9 and all(r.deviation is None for r in got)


def test_exact_spectrum(spark):
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 20):
        a = rng.integers(-9, 10, (n, max(1, n - 2)))
        matrix = [[int(x) for x in row] for row in a @ a.T]
        values = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
        found = X.leading_components(spark, matrix, 5)
        assert np.allclose([r / (1 << b) for r, b, _ in found], [v for v in values[:5] if v > 1e-6], rtol=1e-12)
        for r, b, v in found:
            assert np.abs(np.array(matrix) @ v - r / (1 << b) * np.array(v)).max() < 1e-9 * max(1, values[0])


def test_roots_close_together():
    """1000000 and 1000000 + 2**-40 in one polynomial; three equal roots."""
    poly = [1]
    for num, den in ((1_000_000, 1), (1_000_000 * 2 ** 40 + 1, 2 ** 40), (3, 1), (3, 1), (3, 1)):
        poly = [x - y for x, y in zip([0, *(c * den for c in poly)], [*(c * num for c in poly), 0], strict=True)]
    roots, bits = X.largest_roots(poly, 2_000_010, 5)
    assert [(r + (1 << bits - 41) >> bits - 40, k) for r, k in roots] == [(1_000_000 * 2 ** 40 + 1, 1), (1_000_000 * 2 ** 40, 1), (3 * 2 ** 40, 3)]


# ---- packing ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def check_packing(tokenizer, df, prompt=None, limits=LIMITS):
    """Every id in one piece, pieces gapless in document and sequence, all limits kept; the padded share."""
    got = pack(df, VOCABULARY, prompt, limits, with_ids=True).collect()
    wanted = collections.defaultdict(list)
    for r in df.collect():
        ids = [*(tokenizer.encode(r[prompt] or "", add_special_tokens=False).ids if prompt else []), *tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        wanted[r["doc_id"]].append(ids)
    sequences, documents = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length > 0 and r.ids_crc32 == zlib.crc32(r.ids)
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    for held in sequences.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [sum(x.length for x in held[:k]) for k in range(len(held))]
        assert all(a <= b for a, b in zip((sum(r.length for r in held), len(held), sum(r.loss_tokens for r in held)), limits, strict=True))
    assert set(documents) == set(wanted)
    for i, held in documents.items():
        assert sum(r.length for r in held) == sum(map(len, wanted[i]))
        if len(wanted[i]) == 1:
            held.sort(key=lambda r: r.start)
            assert b"".join(r.ids for r in held) == np.array(wanted[i][0], "<u4").tobytes()
            assert [r.start for r in held] == [sum(x.length for x in held[:k]) for k in range(len(held))]
            assert {r.doc_tokens for r in held} == {len(wanted[i][0])}
    total = sum(r.length for r in got)
    return (limits[0] * len(sequences) - total) / max(1, total)


def test_packing(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert check_packing(tokenizer, docs) < 0.02
    assert check_packing(tokenizer, docs.repartition(40)) < 0.02  # the short sequences of 40 partitions are packed again
    assert "ids" not in Q.op12_packing(spark, SF).columns


def test_packing_awkward(spark, tokenizer):
    rows = [(None, None), (None, "Null id"), (1, ""), (1, "twice"), (1, "twice"), (2, "Hello <|endoftext|>World ß́ ÀÉ×÷ \x01\x1cİ ǅ"),
            (3, "It's I'LL x'Sy \t\x0b\x0c  日本語 é Å Ω １２ ½ ª µ ÿ auß"), (4, "\n".join(["word123"] * 20_000)), (5, "a" * 50_000)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, ids long, lot long")
    check_packing(tokenizer, df)
    check_packing(tokenizer, df, limits=(64, 3, 64))
    assert pack(df.limit(0), VOCABULARY).collect() == []


def test_packing_under_three_limits(spark, tokenizer):
    rows = [(i, "please do this task %d " % i * (i % 9), "the answer " * (i * 7 % 400)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, ask string, text string")
    check_packing(tokenizer, df, "ask", (2048, 8, 900))
    check_packing(tokenizer, df, "ask", (300, 2, 10))
    packed = pack(df, VOCABULARY, "ask", (2048, 8, 900))
    prompts = {i: len(tokenizer.encode(a, add_special_tokens=False).ids) for i, a, _ in rows}
    loss = {r.doc_id: (r.s, r.t) for r in packed.groupBy("doc_id").agg(F.sum("loss_tokens").alias("s"), F.max("doc_tokens").alias("t")).collect()}
    assert all(s == t - prompts[i] for i, (s, t) in loss.items())


def test_word_ids_equal_the_tokenizer(tokenizer):
    with open(VOCABULARY, encoding="utf-8") as f:
        fast = WordIds(f.read())
    assert fast.fast
    rng = np.random.default_rng(1)
    alphabet = [chr(c) for c in [*range(1, 0x180), 0x300, 0x301, 0x327, 0x3A3, 0x3C2, 0x85, 0xA0, 0x2003, 0x2028, 0x3000, 0x4E2D, 0xFB01, 0x1F600, 0x130, 0x1E9E]] + ["'s", "'LL", " ", " ", "\n", "the ", "<|startoftext|>"]
    for _ in range(3000):
        text = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(0, 25)))
        if not rng.integers(0, 3):
            text = "".join(c for c in text if c.isascii() or c in "àéßÀÉÿø")
        assert np.frombuffer(fast.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
