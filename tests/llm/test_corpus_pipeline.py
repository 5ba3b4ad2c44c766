"""The pipeline's stages, one by one, and its plain SQL neighbours."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from creditflow.llm import queries as Q
from tests.compare import canon
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_oracle_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    found = con.execute(Q.SQL[name])
    names = [d[0] for d in found.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(names, found.fetchall())


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"shard": F.lit(1), "rest": F.lit("x"), "text_key": F.lit(5)})
    columns = docs.columns
    for at, (_, stage) in enumerate(P.STAGES):
        out = P.Cuts().write(stage(spark, docs, SF))
        assert out.columns == (columns if at + 1 < len(P.STAGES) else [*columns, "rate"])
        assert 0.7 * docs.count() <= out.count() <= docs.count()
        docs = out


def test_near_duplicates_leave_one(spark):
    text = " ".join(f"t{i}" for i in range(100))
    rows = [(3, text), (1, text + " more"), (1, text + " more"), (2, "other " * 3), (None, None), (None, None), (4, "")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    kept = P.near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 4]


def test_near_duplicates_go_by_class_and_not_by_id(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(100)) for x in "abcde")
    rows = [(None, a), (None, b), (None, b), (None, c + " more"), (7, c), (5, d), (5, e), (6, e + " more"), (9, d + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id or 0), r.text[0]) for r in P.near_duplicates(spark, docs, SF).collect())
    assert kept == [(0, "a"), (0, "b"), (5, "d"), (5, "e"), (7, "c")]


def test_line_stage_changes_the_text(spark):
    docs = spark.createDataFrame([(i, f"junk\nown {i}", 10) for i in range(10)], "doc_id long, text string, n_chars long")
    assert {(r.text, r.n_chars) for r in P.lines(spark, docs, SF).collect()} == {(f"own {i}", 5) for i in range(10)}


def test_run_on_an_empty_and_an_awkward_table(spark, scratch):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    source.limit(0).write.parquet(f"{scratch}/documents.parquet")
    assert P.run(spark, scratch).collect() == []
    clean = source.where("lang = 'en' and n_chars between 500 and 5000").limit(30)
    long = " ".join(r.text for r in clean.collect())
    odd = [(None, None, None, None, None), (None, "", "", "", 0), (-1, "few words", "en", "s", 9), (-2, long, "en", "s", len(long)), (-2, long, "en", "s", len(long)),
           (None, long + " and more", None, None, None), (-3, "x " * 5000, "xx", "s", 10_000)]
    awkward = clean.unionByName(spark.createDataFrame(odd, clean.schema)).unionByName(clean.limit(3)).withColumns({"rate": F.lit("own"), "root": F.lit(1), "h": F.lit(2)})
    awkward.write.mode("overwrite").parquet(f"{scratch}/documents.parquet")
    out = P.run(spark, scratch)
    assert [c for c in awkward.columns if c != "rate"] == [c for c in out.columns if c != "rate"] and "rate" in out.columns
    kept = [r.doc_id for r in out.select("doc_id").collect()]
    assert -3 not in kept and -1 not in kept and kept.count(-2) <= 1 and len(kept) >= 15


def test_brute_force_agrees_on_the_line_stage(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, d) for i, n, d, _ in brute.line_dedup(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in Q.op3_line_dedup(spark, SF).collect()} == want
