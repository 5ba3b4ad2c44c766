"""Registered queries of the training-data operators, and their oracle SQL.

Each query applies its operator with production parameters to the whole table
and returns the whole result.  ``SQL`` has an entry where DuckDB can express it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from creditflow.llm.decontamination import decontaminate
from creditflow.llm.jaccard import jaccard_components
from creditflow.llm.licenses import notices, scan_licenses
from creditflow.llm.line_dedup import line_dedup
from creditflow.llm.merkle import tampered_manifest
from creditflow.llm.mixing import mix
from creditflow.llm.packing import pack
from creditflow.llm.pseudonyms import pseudonymise
from creditflow.llm.quality import WORD_SHARE, quality_rules
from creditflow.llm.quotations import link_quotations
from creditflow.llm.substring_dedup import substring_dedup
from creditflow.llm.suffix_dedup import suffix_dedup
from creditflow.llm.whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_documents(spark, sf_dir), width=200)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_documents(spark, sf_dir), k=50)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir), shingle=3, percent=90).drop("text_key")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text_key")


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir), notices(spark)).drop("text_key")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir), word_share=WORD_SHARE).drop("text_key")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_suffix_array_dedup, op3_line_dedup, op4_benchmark_decontamination, op5_substring_dedup, op6_ngram_jaccard_join,
    op7_source_mixing, op8_pii_pseudonyms, op9_license_scan, op10_quality_rules,
    op11_embedding_whitening, op12_packing, op13_merkle_manifest, pipeline)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def _merkle_sql(levels: int = 7, source_levels: int = 6) -> str:
    """The manifest level by level, for up to 16 ** levels rows a source and 16 ** source_levels sources."""
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS varchar)) || ':' || {c}, '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    ctes = [f"""table_crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
)""", f"""docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce('=' || source, '') AS src, {head} AS head, text,
         list_reduce(list_transform(string_split(CAST(doc_id AS varchar), ''), lambda d: CAST(ascii(d) AS bigint)),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295) AS crc
  FROM documents, table_crc
)""", f"""hashed AS (
  SELECT *, sha256(head || {field('text')}) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || {field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) ELSE leaf END AS observed
  FROM docs
)""", """s0 AS (
  SELECT rid, src, leaf AS d, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf, observed) - 1 AS p,
         count(*) OVER (PARTITION BY src) AS c
  FROM hashed
)""", "w0 AS (SELECT rid, src, p, observed AS f, '' AS q FROM s0 JOIN hashed USING (rid, src))"]

    def level(nodes: str, walk: str, k: int, by: str) -> list[str]:
        """Runs and parents of level k, and each row's way up through it."""
        return [f"""{nodes}run{k} AS (
  SELECT {by}, p // 16 AS p, string_agg(d, '' ORDER BY p) AS s, min(c) AS c FROM {nodes}{k} GROUP BY {by}, p // 16
)""", f"""{nodes}{k + 1} AS (
  SELECT {by}, p, CASE WHEN c > 1 THEN sha256(s) ELSE s END AS d, (c + 15) // 16 AS c FROM {nodes}run{k}
)""", f"""{walk}{k + 1} AS (
  SELECT rid, w.{by}, w.p // 16 AS p, CASE WHEN c > 1 THEN sha256(s[1:(w.p % 16) * 64] || f || s[(w.p % 16 + 1) * 64 + 1:]) ELSE f END AS f,
         CASE WHEN c > 1 THEN q || s[1:(w.p % 16) * 64] || s[(w.p % 16 + 1) * 64 + 1:] ELSE q END AS q
  FROM {walk}{k} w JOIN {nodes}run{k} r ON w.{by} = r.{by} AND w.p // 16 = r.p
)"""]

    for k in range(levels):
        ctes += level("s", "w", k, "src")
    ctes += [f"g0 AS (SELECT src, 0 AS top, d, row_number() OVER (ORDER BY src) - 1 AS p, count(*) OVER () AS c FROM s{levels})",
             f"v0 AS (SELECT rid, g.top, g.p, f, q FROM w{levels} w JOIN g0 g USING (src))"]
    for k in range(source_levels):
        ctes += level("g", "v", k, "top")
    body = ",\n".join(ctes)
    return f"""
WITH {body}
SELECT doc_id, source, leaf, s.d AS subroot, g.d AS root, sha256(q) AS proof_sha256, f AS folded_root, f = g.d AS verified
FROM v{source_levels} v JOIN hashed USING (rid) JOIN s{levels} s USING (src) JOIN g{source_levels} g ON v.top = g.top
"""


SQL = {
    "op13_merkle_manifest": _merkle_sql(),
    "op3_line_dedup": f"""
WITH numbered AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM numbered
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines
), common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY rid, doc_id
""",
    "op5_substring_dedup": r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS pos FROM split
), windows AS (
  SELECT rid, doc_id, pos, md5(array_to_string(list_slice(ws, pos, pos + 49), ' ')) AS win FROM starts
), firsts AS (
  SELECT win, min(doc_id) AS least FROM windows GROUP BY win
), gone AS (
  SELECT DISTINCT rid, unnest(range(pos, pos + 50)) AS pos FROM windows JOIN firsts USING (win) WHERE least < doc_id
), words AS (
  SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM split
), kept AS (
  SELECT w.rid, count(g.pos) AS n_removed, string_agg(word, ' ' ORDER BY w.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM words w LEFT JOIN gone g ON w.rid = g.rid AND w.pos = g.pos GROUP BY w.rid
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (rid)
""",
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
