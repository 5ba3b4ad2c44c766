"""Mixing documents to target weights by soft domain membership.

1. ``labels`` names each labelled document's domain: toxic, else good or low by
   quality.  A document's features are its distinct words and their first
   ``STEM`` bytes, hashed to ``BUCKETS``.  The classifier is fitted on the
   ``FIT_ROWS`` labels that come first by a hash of doc_id (all when there are no
   more), so that they can be broadcast and no text is shuffled.  Spark counts in
   how many of their documents of each domain a feature occurs; those whose
   log-odds for some domain are ``MIN_Z`` standard errors from 0 enter a
   multinomial logistic regression, which gives every document a posterior over
   the domains.
2. Expected tokens of document d in domain k are ``n_d * p_dk``.  Rates r >= 0
   are fitted to ``min |sum_d n_d p_d r_d - target|^2`` by projected gradients
   from r = 1.  The gradient is scaled by 1 / n_d for each document and by the
   inverse of the K x K curvature over the documents with a rate above 0.  A
   step is one Spark aggregation; a document's rate is a fold over the steps so
   far, so nothing of its size leaves the executors.

Defined results: null and empty texts have no tokens and the posterior of a
document without features.
Label rows with a null are left out; of a doc_id's repeated labels the worst
counts; a labelled doc_id with several texts enters the regression with one.  Repeated documents get equal rates.  Without labels all posteriors are
uniform.  Extra columns are ignored; an empty table gives no rows.  Unreachable
targets are approached as far as nonnegative rates allow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import blocks as B
from creditflow.llm.cuts import Cuts, text_key

DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.94, "low": 0.05, "toxic": 0.01}
BUCKETS = 1 << 18
STEM = 4
MIN_Z = 3.5
FIT_ROWS = 10_000
FIT_STEPS = 150
FIT_BLOCK = 1000
FIT_RATE = 0.1
RIDGE = 1e-4
STEPS = 30
TOLERANCE = 1e-6


def _present(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature bucket) pairs, and each row's number of words."""
    low = B.LOWER[data]
    starts, ends, first = B.words(low, offs)
    pre, row = B.prefix(low), B.row_of(first)
    stems = B.spans(pre, starts, np.minimum(ends, starts + STEM), seed=1)
    pairs = np.unique(np.concatenate([row * BUCKETS + (h >> np.uint64(40)).astype(np.int64) % BUCKETS for h in (B.spans(pre, starts, ends), stems)]))
    return pairs // BUCKETS, pairs % BUCKETS, np.diff(first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((len(DOMAINS), BUCKETS + 1), np.int64)  # the last column counts documents
    for batch in batches:
        domain = np.asarray(batch.column("domain"))
        for lo, hi, data, offs in B.blocks(batch.column("text")):
            row, bucket, _ = _present(data, offs)
            np.add.at(totals, (domain[lo:hi][row], bucket), 1)
            np.add.at(totals, (domain[lo:hi], np.full(hi - lo, BUCKETS)), 1)
    k, at = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(totals[k, at])], ["domain", "bucket", "n"])


def telling_buckets(counts: np.ndarray, min_z: float = MIN_Z) -> np.ndarray:
    """Feature buckets whose log-odds for any domain are ``min_z`` standard errors from 0."""
    docs = counts[:, -1].astype(float)
    sure = np.zeros(counts.shape[1] - 1, bool)
    held_by_all = counts[:, :-1].sum(0)
    for k in range(len(DOMAINS)):
        held = counts[k, :-1]
        rest, rest_docs = held_by_all - held, docs.sum() - docs[k]
        odds = np.log((held + 0.5) / (docs[k] - held + 0.5)) - np.log((rest + 0.5) / (rest_docs - rest + 0.5))
        sure |= np.abs(odds) >= min_z * np.sqrt(1 / (held + 0.5) + 1 / (rest + 0.5))
    return np.flatnonzero(sure)


def _features(chosen):
    """The positions in ``chosen`` of each document's telling buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int32)
        place[chosen.value] = np.arange(len(chosen.value))
        for batch in batches:
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                row, bucket, _ = _present(data, offs)
                told = place[bucket] >= 0
                ends = np.searchsorted(row[told], np.arange(hi - lo + 1)).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[bucket[told]]))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("label_id", "text_key", "domain")] + [held],
                                                 ["label_id", "text_key", "domain", "features"])
    return run


def fit_regression(domain: np.ndarray, first: np.ndarray, feature: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Bias of each domain and weights (domain, feature) of a multinomial logistic regression, by scaled gradient steps.

    Document i has ``feature[first[i]:first[i + 1]]``.  A step goes through ``FIT_BLOCK`` documents at a time.
    """
    n, k = len(domain), len(DOMAINS)
    docs = np.bincount(domain, minlength=k)
    bias, weights = np.log((docs + 1) / (docs + 1).sum()), np.zeros((k, n_features))
    seen, seen_bias = np.full((k, n_features), 1e-8), np.full(k, 1e-8)
    for _ in range(FIT_STEPS if n else 0):
        slope, slope_bias = RIDGE * weights, np.zeros(k)
        for lo in range(0, n, FIT_BLOCK):
            at = first[lo : lo + FIT_BLOCK + 1]
            row, held = B.row_of(at), feature[at[0] : at[-1]].astype(np.int64)
            size = len(at) - 1
            score = np.stack([bias[j] + np.bincount(row, weights[j][held], size) for j in range(k)])
            gap = np.exp(score - score.max(0))
            gap /= gap.sum(0)
            gap[domain[lo : lo + size], np.arange(size)] -= 1
            slope_bias += gap.sum(1) / n
            for j in range(k):
                slope[j] += np.bincount(held, gap[j][row], n_features) / n
        seen += slope**2
        seen_bias += slope_bias**2
        weights -= FIT_RATE * slope / np.sqrt(seen)
        bias = bias - FIT_RATE * slope_bias / np.sqrt(seen_bias)
    return bias, weights


def _posteriors(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights = model.value
        for batch in batches:
            for lo, hi, data, offs in B.blocks(batch.column("text")):
                row, bucket, n = _present(data, offs)
                score = np.stack([bias[k] + np.bincount(row, weights[k][bucket], hi - lo) for k in range(len(DOMAINS))])
                p = np.exp(score - score.max(0))
                p = np.round(p / p.sum(0), 9)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")] + [pa.array(n.astype(np.int64))]
                                                 + [pa.array(x) for x in p], ["doc_id", "text_key", "n_tokens", *(f"p_{d}" for d in DOMAINS)])
    return run


def _fit(taught: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bias and weights (domain, bucket) of the classifier."""
    chosen = telling_buckets(counts)
    weights = np.zeros((len(DOMAINS), BUCKETS), np.float32)
    dtype = taught.schema["label_id"].dataType.simpleString()
    told = taught.sparkSession.sparkContext.broadcast(chosen)
    held = taught.mapInArrow(_features(told), f"label_id {dtype}, text_key long, domain int, features array<int>")
    one = held.groupBy("label_id").agg(F.min_by(F.struct("domain", "features"), "text_key").alias("held"))  # FIT_ROWS at most
    table = one.select("label_id", "held.domain", "held.features").toArrow().sort_by("label_id").combine_chunks()
    told.destroy()
    feature, first = (np.zeros(0, np.int64), np.zeros(1, np.int64)) if not len(table) else B.lists(table["features"].combine_chunks())
    bias, fitted = fit_regression(table["domain"].to_numpy().astype(int), first, feature, len(chosen))
    weights[:, chosen] = fitted
    return bias, weights


def domain_posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_key, n_tokens and the posterior of each domain, for every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1).alias("domain")
    drawn = known.orderBy(F.xxhash64("label_id"), "label_id").limit(FIT_ROWS)  # bounds what is broadcast
    taught = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")).select("label_id", "text_key", domain, "text")
    rows = taught.select("domain", "text").mapInArrow(_count, "domain int, bucket int, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(DOMAINS), BUCKETS + 1), np.int64)  # the bound of what comes to the driver
    counts[rows["domain"].to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    del rows
    model = spark.sparkContext.broadcast(_fit(taught, counts))
    dtype = docs.schema["doc_id"].dataType.simpleString()
    out = Cuts().write(docs.mapInArrow(_posteriors(model), f"doc_id {dtype}, text_key long, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS)))
    model.destroy()
    return out


def fit_rates(members: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``members`` (n_tokens, p_*) with the rate of each document; targets are shares of all tokens."""
    p = [F.col(f"p_{d}") for d in DOMAINS]
    total = members.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    goal = np.array([targets[d] for d in DOMAINS]) * total
    rate = F.lit(1.0)
    best = (np.inf, rate)
    for _ in range(STEPS if total else 0):
        active = F.when(rate > 0, F.col("n_tokens")).otherwise(F.lit(0))
        sums = [F.sum(F.col("n_tokens") * x * rate) for x in p]
        curve = [F.sum(active * a * b) for i, a in enumerate(p) for b in p[i:]]
        found = members.agg(*(x.alias(f"c{i}") for i, x in enumerate(sums + curve))).first()
        gap = np.array(found[:len(p)]) - goal
        if np.abs(gap).sum() < best[0]:
            best = (np.abs(gap).sum(), rate)
        if np.abs(gap).sum() <= TOLERANCE * total:
            break
        matrix = np.zeros((len(p), len(p)))
        matrix[np.triu_indices(len(p))] = found[len(p):]
        step = np.linalg.pinv(matrix + np.triu(matrix, 1).T, rcond=1e-9) @ gap
        rate = F.greatest(F.lit(0.0), rate - sum(x * float(v) for x, v in zip(p, step, strict=True)))
    return members.withColumn("rate", F.round(best[1], 9))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, text_key, n_tokens, p_good, p_low, p_toxic and the rate of every row of ``docs``."""
    return fit_rates(domain_posteriors(docs, labels), targets or TARGETS)
