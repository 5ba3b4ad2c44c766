"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that it keeps, with all columns of its input.  The last
stage adds ``rate``, the weight a document is sampled with, and leaves out
documents whose rate is under ``MIN_RATE``, but for those that are good with a
posterior over one half: unreachable targets cost no clean document.

Documents without text, with a null doc_id or given twice pass as the operators'
docstrings say; near-duplicate classes leave the row with the smallest doc_id,
null after all others, and of equal ids that with the smallest text hash.  A
column of the documents named ``rate`` gives way to the last stage's.  An empty
table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts, text_key
from creditflow.llm.decontamination import decontaminate
from creditflow.llm.jaccard import jaccard_roots
from creditflow.llm.line_dedup import line_dedup
from creditflow.llm.mixing import mix
from creditflow.llm.quality import WORD_SHARE, quality_rules

MIN_RATE = 0.25
_ID, _KEY, _RATE = "__own_doc_id", "__own_text_key", "__own_rate"


def _matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text are (left_semi) or are not (left_anti) in ``keys``."""
    keys = keys.select(F.col("doc_id").alias(_ID), F.col("text_key").alias(_KEY), *[c for c in keys.columns if c not in ("doc_id", "text_key")]).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys[_ID]) & (text_key() == keys[_KEY]), how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _matching(docs, quality_rules(docs, word_share=WORD_SHARE).where("kept").select("doc_id", "text_key"), "left_semi")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(docs, with_text=True)
    text = F.col("kept_text")
    fields = {c: F.col(f"rest.`{c}`") for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in fields:
        fields["n_chars"] = F.when(F.col("n_dropped") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(fields["n_chars"])
    return cleaned.select(*(fields[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets of five-word shingles, similarity 0.8."""
    rows = Cuts().write(jaccard_roots(docs, shingle=5, percent=80))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("least")
    first = rows.where("n > 0").groupBy("root").agg(least).select("least.doc_id", "least.text_key")
    stay = first.unionByName(rows.where("n = 0").select("doc_id", "text_key"))
    kept = _matching(docs, stay, "left_semi")
    again = rows.where("n > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("copies")).where("copies > 1")
    if again.isEmpty():
        return kept
    twice = again.select("doc_id", "text_key")
    return _matching(kept, twice, "left_anti").unionByName(_matching(kept, twice, "left_semi").dropDuplicates(["doc_id", "text"]))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _matching(docs, decontaminate(docs, items).select("doc_id", "text_key"), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rates = mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where((F.col("rate") >= MIN_RATE) | (F.col("p_good") > 0.5))
    rates = rates.select("doc_id", "text_key", F.col("rate").alias(_RATE))
    return _matching(docs, rates, "inner").select(*(docs[c] for c in docs.columns if c != "rate"), F.col(_RATE).alias("rate"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("mixing", mixing),
]

#: The language model and the classifier can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = Cuts().write(docs)
    return docs
