"""Deduplication operators against plain Python versions, and on awkward rows."""

import random

import numpy as np
import pytest

from creditflow.llm import jaccard, suffix_dedup
from creditflow.llm import queries as Q
from creditflow.llm.components import components
from creditflow.llm.line_dedup import build_mph, line_dedup, mph_slots
from creditflow.llm.substring_dedup import compact_paths, substring_dedup
from tests.llm import brute

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(300))
AWKWARD = [(None, "a b c " * 40), (None, None), (1, ""), (2, "a b c " * 40), (2, "a b c " * 40), (3, "x y " + "a b c " * 30 + " z"), (4, LONG.replace(" ", "\n")),
           (5, " ".join(f"w{i}" for i in range(100, 220))), (5, " ".join(f"w{i}" for i in range(150, 290))), (6, "q " * 500), (7, "é" * 150 + "q" * 250),
           (8, "é" * 150 + "z" * 250 + "q" * 250), (9, "word\r\n" * 20000), (10, " A \nb\n\nc\x0b"), (11, "a\nB"), (12, "\n\n")]


def frame(spark, rows):
    """With extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, h long, frag long, text_key long")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


LINES = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_line_dedup(spark):
    assert got(Q.op3_line_dedup(spark, SF), *LINES) == sorted(brute.line_dedup(documents(spark)), key=repr)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_dedup_awkward(spark, least):
    assert got(line_dedup(frame(spark, AWKWARD), least), *LINES) == sorted(brute.line_dedup(AWKWARD, least), key=repr)


def test_line_dedup_hot_key_is_salted(spark, monkeypatch):
    from creditflow.llm import line_dedup as module
    monkeypatch.setattr(module, "SHARD_KEYS", 16)
    monkeypatch.setattr(module, "HOT_SHARE", 4)
    rows = [(i, f"same line\nown {i}") for i in range(300)]
    assert got(line_dedup(frame(spark, rows)), *LINES) == sorted(brute.line_dedup(rows), key=repr)


def test_line_dedup_text_and_empty(spark):
    rows = [(i, "drop\nkeep %d" % i) for i in range(10)]
    out = line_dedup(frame(spark, rows), with_text=True)
    assert {r.kept_text for r in out.collect()} == {"keep %d" % i for i in range(10)}
    assert {r.rest.frag for r in out.collect()} == {2}
    assert line_dedup(frame(spark, AWKWARD).limit(0)).collect() == []


def test_minimal_perfect_hash():
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    levels = build_mph(h)
    assert sorted(mph_slots(levels, h).tolist()) == list(range(5000))


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.randint(0, rng.choice([1, 2, 5, 30])) for _ in range(rng.randint(0, 40))]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_dedup(spark):
    assert got(Q.op2_suffix_array_dedup(spark, SF), *BYTES) == sorted(brute.suffix_dedup(documents(spark)), key=repr)


@pytest.mark.parametrize("group", [1, 1024])
def test_suffix_dedup_awkward(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = [r for r in AWKWARD if r[0] != 9] + [(13, "u" * 199), (14, "u" * 200), (14, "0123456789" * 19 + "abcdefghij"), (15, "0123456789" * 19 + "abcdefghij")]
    assert got(suffix_dedup.suffix_dedup(frame(spark, rows)), *BYTES) == sorted(brute.suffix_dedup(rows), key=repr)
    assert suffix_dedup.suffix_dedup(frame(spark, rows).limit(0)).collect() == []


def test_substring_dedup(spark):
    assert got(Q.op5_substring_dedup(spark, SF), *WORDS) == sorted(brute.substring_dedup(documents(spark)), key=repr)


def test_substring_dedup_awkward(spark):
    assert got(substring_dedup(frame(spark, AWKWARD)), *WORDS) == sorted(brute.substring_dedup(AWKWARD), key=repr)
    assert substring_dedup(frame(spark, AWKWARD).limit(0)).collect() == []


def test_paths_are_compacted_and_cycles_end(spark):
    rows = [(1, 2, 2, None), (2, 3, 3, 1), (3, 1, None, 2), (7, 1, 8, 8), (8, 1, 7, 7)]
    out = {r.frag: (r.head, r.skip) for r in compact_paths(spark.createDataFrame(rows, "frag long, n int, nxt long, prv long")).collect()}
    assert out == {1: (1, 0), 2: (1, 2), 3: (1, 5), 7: (7, 0), 8: (8, 0)}


def test_jaccard(spark):
    assert got(Q.op6_ngram_jaccard_join(spark, SF), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(documents(spark)), key=repr)


@pytest.mark.parametrize(("k", "percent", "group"), [(3, 90, 1024), (3, 90, 5), (5, 80, 5)])
def test_jaccard_of_edited_copies(spark, monkeypatch, k, percent, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rng = random.Random(7)
    base, rows = [f"t{i}" for i in range(120)], [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "two words"), (5, "a b c " * 30), (6, " a B c " * 30)]
    for i in range(10, 70):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    rows += [(100, "s1 s2 s3 s4 s5 s6 s7 s8"), (101, "s1 s2 s3 s4 s5 s6 s7 s8 s9"), (102, "s2 s3 s4 s5 s6 s7 s8 s9"), (103, "z s2 s3 s4 s5 s6 s7 s8")]
    for i in range(70, 90):  # a shared passage doesn't make them alike
        rows.append((i, " ".join([f"d{i}x{j}" for j in range(200)] + base[:40])))
    assert got(jaccard.jaccard_components(frame(spark, rows), k, percent), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(rows, k, percent), key=repr)


def test_jaccard_repeated_and_null_ids(spark):
    rows = [(None, "p q r s"), (3, "p q r s"), (3, "p q r s"), (2, None), (None, None)]
    out = got(jaccard.jaccard_components(frame(spark, rows)), "doc_id", "n_shingles", "component_id")
    assert out == sorted([(None, 2, 3), (3, 2, 3), (3, 2, 3), (2, 0, 2), (None, 0, None)], key=repr)
    assert jaccard.jaccard_components(frame(spark, rows).limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {x: find(x) for x in list(root)}


def thue_morse(a: str, b: str, bits: int) -> tuple[list, list]:
    one = [a if i.bit_count() % 2 == 0 else b for i in range(1 << bits)]
    return one, [a if x == b else b for x in one]


def test_constructed_strings_do_not_collide(spark):
    """The Thue-Morse word and its complement agree under any polynomial modulo 2**64 with an odd base."""
    one, other = ("".join(x) for x in thue_morse("a", "b", 11))
    rows = [(i, one) for i in range(10)] + [(10, other), (11, one + " " + other), (12, other + "\nx")]
    assert got(line_dedup(frame(spark, rows)), *LINES) == sorted(brute.line_dedup(rows), key=repr)
    words = [" ".join(x) for x in thue_morse("up", "down", 11)]
    rows = [(1, words[0]), (2, words[1]), (3, f"{one} x " * 30), (4, f"{other} x " * 30)]
    assert got(substring_dedup(frame(spark, rows)), *WORDS) == sorted(brute.substring_dedup(rows), key=repr)
    assert got(jaccard.jaccard_components(frame(spark, rows), shingle=3, percent=90), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard(rows), key=repr)


def test_line_dedup_many_rows_without_an_id(spark):
    rows = [(None, f"common\nown line {i}\ncommon {i // 20}") for i in range(20_000)]
    out = line_dedup(frame(spark, rows).repartition(4))
    assert out.groupBy("n_lines", "n_dropped").count().collect() == [(3, 2, 20_000)]
