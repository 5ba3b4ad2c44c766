"""Leading eigenpairs of an integer positive semidefinite matrix through its exact characteristic polynomial.

The polynomial is found modulo 31-bit primes by Hessenberg reduction (one Spark
row a prime) and put together by Chinese remaindering.  All its roots are real,
so Descartes' rule counts the roots above a point exactly; bisection isolates
the largest ones and refines them to ``BITS`` bits behind their separation.
Each root's null space comes from inverse iteration in fixed-point integers (one
Spark row a root); a root of multiplicity m gives m orthogonal components.

Everything here is of the size of the matrix, not of the data behind it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BITS = 192


# ---- modular characteristic polynomial ------------------------------------------

def primes_below(top: int) -> Iterator[int]:
    """Primes under ``top`` (at most 2**32), falling."""
    def passes(n: int, a: int) -> bool:
        d, s = n - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        x = pow(a, d, n)
        return x in (1, n - 1) or any((x := x * x % n) == n - 1 for _ in range(s - 1))

    for n in range(top - 1, 61, -1):
        if n % 2 and all(passes(n, a) for a in (2, 3, 5, 7)):  # exact under 3,215,031,751
            yield n


def modular_polynomial(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients modulo p, constant first, of det(x - matrix); entries of ``matrix`` are reduced."""
    a, n = matrix.astype(np.int64).copy(), len(matrix)
    for m in range(1, n - 1):
        found = np.flatnonzero(a[m:, m - 1])
        if not len(found):
            continue
        i = m + int(found[0])
        if i != m:
            a[[i, m]] = a[[m, i]]
            a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * u % p).sum(1)) % p
    polys = np.zeros((n + 1, n + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, n + 1):
        polys[m, 1:] = polys[m - 1, :-1]
        weights, t = np.zeros(m, np.int64), 1
        for i in range(m - 1, -1, -1):
            weights[i] = t * int(a[i, m - 1]) % p
            if i:
                t = t * int(a[i, i - 1]) % p
        polys[m] = (polys[m] - (weights[:, None] * polys[:m] % p).sum(0)) % p
    return polys[n]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, constant first, of a positive semidefinite integer matrix."""
    n = len(matrix)
    trace = sum(matrix[i][i] for i in range(n))
    need = 2 * (1 + -(-trace // n)) ** n  # the coefficients' absolute sum is prod(1 + root), largest at equal roots
    primes, have = [], 1
    for p in primes_below(1 << 31):
        if have > need:
            break
        primes.append(p)
        have *= p

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                residues = np.array([[x % p for x in row] for row in matrix], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([modular_polynomial(residues, p).tolist()])], ["p", "c"])

    out = [0] * (n + 1)
    for row in spark.createDataFrame([(p,) for p in primes], "p long").mapInArrow(reduce, "p long, c array<long>").collect():
        rest = have // row.p
        lift = rest * pow(rest, -1, row.p)
        for k, c in enumerate(row.c):
            out[k] += c * lift
    out = [x % have for x in out]
    return [x - have if 2 * x > have else x for x in out]


# ---- real roots -------------------------------------------------------------------

def _primitive(a: list[int]) -> list[int]:
    while a and not a[-1]:
        a = a[:-1]
    g = math.gcd(*a) if a else 1
    return [x // g for x in a]


def _rest(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Quotient and remainder of a by b, both up to an integer factor (pseudo-division)."""
    a, lead, quotient = list(a), b[-1], [0] * max(1, len(a) - len(b) + 1)
    for k in range(len(a) - len(b), -1, -1):
        top = a[k + len(b) - 1]
        quotient = [x * lead for x in quotient]
        quotient[k] += top
        a = [x * lead for x in a]
        for i, y in enumerate(b):
            a[k + i] -= top * y
    return _primitive(quotient), _primitive(a[:len(b) - 1])


def _gcd(a: list[int], b: list[int]) -> list[int]:
    while b:
        a, b = b, _rest(a, b)[1] if len(a) >= len(b) else a
    return a if a[-1] > 0 else [-x for x in a]


def _derivative(a: list[int]) -> list[int]:
    return _primitive([k * x for k, x in enumerate(a)][1:])


def _square_free_modulo(a: list[int], p: int) -> bool:
    """True proves that a has no repeated root."""
    def trim(x: list[int]) -> list[int]:
        x = [y % p for y in x]
        while x and not x[-1]:
            x.pop()
        return x

    x, y = trim(a), trim([k * c for k, c in enumerate(a)][1:])
    if len(x) != len(a):
        return False
    while y:
        inverse = pow(y[-1], -1, p)
        while len(x) >= len(y):
            f, k = x[-1] * inverse % p, len(x) - len(y)
            for i, c in enumerate(y):
                x[k + i] = (x[k + i] - f * c) % p
            x = trim(x)
        x, y = y, x
    return len(x) == 1


def square_free_parts(a: list[int]) -> list[tuple[list[int], int]]:
    """Square-free factors of a nonconstant polynomial with their multiplicities."""
    if any(_square_free_modulo(a, p) for p in (2147483647, 2147483629)):
        return [(a, 1)]
    parts, k = [], 1
    common = _gcd(a, _derivative(a))
    single = _rest(a, common)[0]
    while len(single) > 1:
        again = _gcd(single, common) if len(common) > 1 else [1]
        part = _rest(single, again)[0]
        if len(part) > 1:
            parts.append((part, k))
        common, single, k = _rest(common, again)[0], again, k + 1
    return parts


def _scaled(a: list[int], bits: int) -> list[int]:
    """Polynomial in y = x * 2**bits."""
    n = len(a) - 1
    return [c << bits * (n - k) for k, c in enumerate(a)]


def roots_above(a: list[int], m: int, bits: int) -> int:
    """Roots over m / 2**bits of a polynomial whose roots are all real (Descartes' rule is exact then)."""
    c = _scaled(a, bits)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += m * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _sign(a: list[int], m: int, bits: int) -> int:
    value = 0
    for k, c in enumerate(reversed(a)):
        value = value * m + (c << bits * k)
    return (value > 0) - (value < 0)


def isolate(a: list[int], top: int, most: int) -> list[tuple[int, int]]:
    """(m, bits) of the ``most`` largest roots in (0, top] of a square-free polynomial: each alone in (m - 1, m] / 2**bits."""
    width = max(top, 1).bit_length()
    found, queue = [], [(1, -width, roots_above(a, 0, 0), 0)]  # an interval's end m / 2**bits, roots over its start, over its end
    while queue and len(found) < most:
        m, bits, over_start, over_end = queue.pop()
        if over_start - over_end == 1 and bits >= 0:
            found.append((m, bits))
        elif over_start > over_end:
            middle = roots_above(a, 2 * m - 1, bits + 1) if bits >= -1 else roots_above(a, (2 * m - 1) << -(bits + 1), 0)
            queue += [(2 * m - 1, bits + 1, over_start, middle), (2 * m, bits + 1, middle, over_end)]
    return found


def refine(a: list[int], m: int, bits: int, to: int) -> int:
    """The root alone in (m - 1, m] / 2**bits as a multiple of 2**-to, rounded up."""
    end = _sign(a, m, bits)
    if not end:
        return m << to - bits
    while bits < to:
        m, bits = 2 * m, bits + 1
        s = _sign(a, m - 1, bits)
        if not s:
            return (m - 1) << to - bits
        if s == end:
            m -= 1
    return m


def largest_roots(a: list[int], top: int, most: int) -> tuple[list[tuple[int, int]], int]:
    """Positive roots, falling, as (multiple of 2**-bits, multiplicity), and bits; at least ``most`` roots by multiplicity if there are."""
    while len(a) > 1 and not a[0]:
        a = a[1:]
    if len(a) == 1:
        return [], BITS
    found = [(part, k, m, bits) for part, k in square_free_parts(a) for m, bits in isolate(part, top, most)]
    to = BITS + max(bits for *_, bits in found)
    rows = sorted(((refine(part, m, bits, to), k) for part, k, m, bits in found), reverse=True)
    while True:  # roots of different parts may lie close together
        gaps = [x - y for (x, _), (y, _) in zip(rows, rows[1:], strict=False)]
        if all(g >> to - BITS // 2 or g.bit_length() > BITS // 2 for g in gaps):
            return rows, to
        to *= 2
        rows = sorted(((refine(part, m, bits, to), k) for part, k, m, bits in found), reverse=True)


# ---- null spaces --------------------------------------------------------------------

def null_vectors(matrix: list[list[int]], root: int, bits: int, count: int) -> list[list[float]]:
    """``count`` orthonormal null vectors of matrix - root / 2**bits, by inverse iteration with ``bits`` fraction bits."""
    n = len(matrix)
    a = np.array([[x << bits for x in row] for row in matrix], object)
    a[np.arange(n), np.arange(n)] -= root
    order = np.arange(n)
    for k in range(n):
        i = k + max(range(n - k), key=lambda r: abs(a[k + r, k]))
        if i != k:
            a[[i, k]] = a[[k, i]]
            order[[i, k]] = order[[k, i]]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < n:
            f = np.array([(int(x) << bits) // int(a[k, k]) for x in a[k + 1:, k]], object)
            a[k + 1:, k + 1:] -= (f[:, None] * a[k, k + 1:]) >> bits
            a[k + 1:, k] = f

    def unit(v: np.ndarray) -> np.ndarray:
        length = math.isqrt(sum(int(x) * int(x) for x in v))
        return np.array([(int(x) << bits) // length for x in v], object)

    def across(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for u in others:
                v = v - ((u * (int((u * v).sum()) >> bits)) >> bits)
        return v

    found: list[np.ndarray] = []
    for k in range(count):
        v = unit(across(np.array([((i + 1) * (2 * i + 3 + k * k) * 40503 >> 3) % 1009 - 504 << bits for i in range(n)], object) + (1 << bits), found))
        for _ in range(3):
            x = v[order]
            for i in range(1, n):
                x[i] -= int((a[i, :i] * x[:i]).sum()) >> bits
            for i in range(n - 1, -1, -1):
                x[i] = ((int(x[i]) << bits) - int((a[i, i + 1:] * x[i + 1:]).sum())) // int(a[i, i])
            v = unit(across(x, found))
        found.append(v)
    out = []
    for v in found:
        lead = max(v, key=abs)
        out.append([int(x) / (1 << bits) * (1 if lead > 0 else -1) for x in v])
    return out


def leading_components(spark: SparkSession, matrix: list[list[int]], most: int) -> list[tuple[int, int, list[float]]]:
    """(root, bits, unit vector) of up to ``most`` positive eigenvalues root / 2**bits, falling."""
    n = len(matrix)
    trace = sum(matrix[i][i] for i in range(n))
    if not trace:
        return []
    roots, bits = largest_roots(characteristic_polynomial(spark, matrix), trace, most)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = null_vectors(matrix, int(row["root"]), bits, row["times"])
                yield pa.RecordBatch.from_arrays([pa.array([row["at"]] * len(vectors)), pa.array(range(len(vectors))), pa.array(vectors)], ["at", "k", "v"])

    wanted, total = [], 0
    for at, (root, times) in enumerate(roots):
        if total < most:
            wanted.append((at, str(root), min(times, most - total)))
            total += times
    if not wanted:
        return []
    solved = spark.createDataFrame(wanted, "at long, root string, times int").mapInArrow(solve, "at long, k long, v array<double>").collect()
    return [(roots[r.at][0], bits, r.v) for r in sorted(solved, key=lambda r: (r.at, r.k))]
