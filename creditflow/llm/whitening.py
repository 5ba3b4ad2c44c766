"""Embedding whitening through the exact spectrum of the integer scatter matrix.

Entries become integers, so the scatter of the fit list (each distinct vector
once) is an exact integer matrix, summed over partitions in 32-bit limbs; its
leading eigenpairs come from ``exact_spectrum``.  Rows are whitened in the tasks
that read them.

Vectors travel as their integers without the offset, in as few bytes an entry as
each vector needs.

Defined results: a vector that is null, or holds a null, non-finite or too large
entry (one without a long), leaves no row; nor does one that hasn't the commonest
length (the longer of equally common ones).  Every other input row counts, also with a
null or repeated vec_id.  Components without variance are left out, so a table
with one distinct vector, or none, gives an empty result.  ``deviation`` is null
where it doesn't fit a long.  Other columns are ignored.

The driver holds matrices of the vectors' length only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts
from creditflow.llm.exact_spectrum import leading_components

SCALE = 64
OFFSET = 1_000_000
LIMB, LIMBS = 32, 5
Batches = Iterator[pa.RecordBatch]


def _codes(batches: Batches) -> Batches:
    """vec_id, size and code (entry width, then the entries) of the rows that have integers."""
    for batch in batches:
        column = batch.column("embedding")
        lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
        c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries turn to NaN
        with np.errstate(invalid="ignore", over="ignore"):
            y = np.floor(SCALE * c)
            bad = ~(np.abs(y) < 2.0 ** 62)
        y = np.where(bad, 0, y).astype(np.int64)
        ends = np.cumsum(lengths)
        wrong = np.concatenate([[0], np.cumsum(bad)])
        keep = np.asarray(column.is_valid()) & (wrong[ends] == wrong[ends - lengths])
        rows, codes = np.flatnonzero(keep), []
        for r in rows:
            v = y[ends[r] - lengths[r]:ends[r]]
            big = int(np.abs(v).max(initial=0))
            width = 1 if big < 1 << 7 else 2 if big < 1 << 15 else 4 if big < 1 << 31 else 8
            codes.append(bytes([width]) + v.astype(f"<i{width}").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(lengths[rows]), pa.array(codes, pa.binary())], ["vec_id", "size", "code"])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of entries without the offset."""
    codes = column.to_pylist()
    out = np.empty((len(codes), size), np.int64)
    for r, code in enumerate(codes):
        out[r] = np.frombuffer(code, f"<i{code[0]}", offset=1)
    return out


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact y.T @ y as Python integers: in doubles where every partial sum is an exact one."""
    big = int(np.abs(y).max(initial=0))
    if big >= 1 << 26:
        return y.T.astype(object) @ y.astype(object)
    total, rows = np.zeros((y.shape[1],) * 2, object), max(1, (1 << 52) // max(1, big * big))
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(size: int) -> Callable[[Batches], Batches]:
    """Rows (i, j, limbs) of a partition: the Gram matrix's upper half, sums at j = -1, the count at i = -1."""
    def run(batches: Batches) -> Batches:
        n, s, g = 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            y = _matrix(batch.column("code"), size)
            n += len(y)
            s = s + y.astype(object).sum(0) if len(y) else s
            g = g + _gram(y)
        entries = [(-1, -1, n)] + [(i, -1, s[i]) for i in range(size)] + [(i, j, g[i, j]) for i in range(size) for j in range(i, size)]
        mask = (1 << LIMB) - 1
        limbs = [[int(v) >> LIMB * k & mask if k < LIMBS - 1 else int(v) >> LIMB * k for *_, v in entries] for k in range(LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in entries]), pa.array([e[1] for e in entries]), *map(pa.array, limbs)],
                                         ["i", "j", *(f"l{k}" for k in range(LIMBS))])
    return run


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums (offset included) and n * sum(x x') - S S' of the vectors in ``fit`` (code), exactly."""
    limbs = [f"l{k}" for k in range(LIMBS)]
    parts = fit.select("code").mapInArrow(_sums(size), "i long, j long, " + ", ".join(f"{x} long" for x in limbs))
    held = {(r.i, r.j): sum(r[x] << LIMB * k for k, x in enumerate(limbs)) for r in parts.groupBy("i", "j").agg(*(F.sum(x).alias(x) for x in limbs)).collect()}
    n, s = held.get((-1, -1), 0), [held.get((i, -1), 0) for i in range(size)]
    matrix = [[n * held.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(size)] for i in range(size)]
    return n, [x + n * OFFSET for x in s], matrix


def _deviations(y: np.ndarray, n: int, s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S without the offset, as doubles; and its square sums, -1 where they exceed a long."""
    big = max(int(np.abs(y).max(initial=0)) * n, max(map(abs, s), default=0)) * 2
    if big * big * max(1, y.shape[1]) < 1 << 63:
        t = n * y - np.array(s, np.int64)
        return t.astype(np.float64), (t * t).sum(1)
    t = n * y.astype(object) - np.array(s, object)
    squares = (t * t).sum(1)
    return t.astype(np.float64), np.array([q if q < 1 << 63 else -1 for q in squares], np.int64)


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    spark, cuts = embeddings.sparkSession, Cuts()
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    coded = cuts.write(embeddings.select("vec_id", "embedding").mapInArrow(_codes, f"vec_id {id_type}, size long, code binary"))
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = coded.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], schema)
    size = common["size"]
    coded = coded.where(F.col("size") == size)
    fit = cuts.write(coded.select("code").distinct())
    n, total, matrix = scatter(fit, size)
    found = leading_components(spark, matrix, components)
    if not found:
        return spark.createDataFrame([], schema)
    s = [x - n * OFFSET for x in total]
    trace = sum(matrix[i][i] for i in range(size))
    explained = [root / (trace << bits) for root, bits, _ in found]
    project = np.array([v for *_, v in found]).T / np.array([math.sqrt(root / (1 << bits)) for root, bits, _ in found])
    k = len(found)

    def check(batches: Batches) -> Batches:
        """Sums of whitened values (j = -1) and of their products over a partition of the fit list."""
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _deviations(_matrix(batch.column("code"), size), n, s)[0] @ project
            sums += w.sum(0)
            products += w.T @ w
        i, j = np.meshgrid(range(k), range(-1, k), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(np.column_stack([sums, products]).ravel())], ["i", "j", "v"])

    table = np.zeros((k, k + 1))
    for r in fit.mapInArrow(check, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        table[r.i, r.j + 1] = r.v / n
    error = float(np.abs(table[:, 1:] - np.outer(table[:, 0], table[:, 0]) - np.eye(k)).max())

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            t, squares = _deviations(_matrix(batch.column("code"), size), n, s)
            m = len(t)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array(np.repeat(squares, k), mask=np.repeat(squares < 0, k)), pa.array((t @ project).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], [x.split()[0] for x in schema.split(", ")])

    return coded.select("vec_id", "code").mapInArrow(rows, schema)
