"""Vectorised text helpers for Arrow batches (numpy inside Spark tasks).

A *block* is a run of rows of one Arrow batch whose texts lie behind each
other in one byte array: ``data`` (uint8) and ``offs`` (row i's text is
``data[offs[i]:offs[i+1]]``).  Blocks hold about ``BLOCK_BYTES`` of text so
that the arrays made from them stay small; a longer text is a block by itself
and is never cut.  Null texts are empty.

Hashes of short spans are 64-bit polynomials modulo 2**64 with a final mix.
Such a polynomial can be made to collide by long constructed spans (the
Thue-Morse word of 2**k symbols and its complement agree in about k * (k + 3) / 2
low bits before the mix, so surely from 1,024 symbols on); ``spans`` with the
``values`` themselves takes a keyed BLAKE2b of spans of ``LONG`` elements and
more, and ``strings`` one of every span.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
LONG = 64
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: The word separators of every contract: space and 0x09-0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        full = np.full(size, base, _U)
        full[0] = 1
        have = np.cumprod(full, dtype=_U)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, one longer than ``values``."""
    out = np.empty(len(values) + 1, _U)
    out[0] = 0
    np.cumsum(values * _power(_BASE, len(values)), dtype=_U, out=out[1:])
    return out


def spans(pre: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int = 0, values: np.ndarray | None = None) -> np.ndarray:
    """Hash of each span [lo, hi) of the sequence behind ``pre``; equal spans hash alike anywhere.

    With ``values``, that sequence, spans from ``LONG`` on get a sound hash.
    """
    h = (pre[hi] - pre[lo]) * _power(_INV, len(pre))[lo]
    h = mix(h ^ ((hi - lo).astype(_U) * _U(0xD6E8FEB86659FD93)) ^ _U(seed))
    if values is not None:
        long = np.flatnonzero(hi - lo >= LONG)
        if len(long):
            h[long] = strings(values, lo[long], hi[long], seed)["h"]
    return h


#: What ``strings`` gives: 64 bits and 32 more.
STRING = np.dtype([("h", "<u8"), ("f", "<i4")])


def strings(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int = 0) -> np.ndarray:
    """96 bits of the BLAKE2b of each span [lo, hi) of ``values``."""
    size, view = values.itemsize, memoryview(np.ascontiguousarray(values).tobytes())
    key = seed.to_bytes(8, "little")
    out = b"".join([hashlib.blake2b(view[a:b], digest_size=12, key=key).digest() for a, b in zip((lo * size).tolist(), (hi * size).tolist(), strict=True)])
    return np.frombuffer(out, STRING)


def rolling(pre: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive elements; empty when there are fewer."""
    n = len(pre) - 1
    if n < k:
        return np.empty(0, _U)
    return mix((pre[k:] - pre[:-k]) * _power(_INV, n - k + 1))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive elements, by doubling."""
    if len(h) < w:
        return h[:0]
    m, have = h, 1
    while 2 * have <= w:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(h) - w + 1], m[w - have : w - have + len(h) - w + 1])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, offs) of each block of a text column."""
    data, offs = texts(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each row's first word (one more at the end)."""
    is_word = ~SEPARATOR[data]
    n = len(data)
    begin = is_word.copy()
    begin[1:] &= ~is_word[:-1]
    inner = offs[:-1][offs[:-1] < n]
    begin[inner] = is_word[inner]
    end = is_word.copy()
    end[:-1] &= ~is_word[1:]
    last = offs[1:][offs[1:] > 0] - 1
    end[last] = is_word[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def row_of(first: np.ndarray) -> np.ndarray:
    """Row of each item, from each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def arange_each(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def cover(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of n positions lie in any interval [lo, hi)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, lo, 1)
    np.add.at(delta, hi, -1)
    return np.cumsum(delta[:-1]) > 0


def digests(out: np.ndarray, bounds: np.ndarray) -> list[str]:
    """SHA-256 of each row's bytes."""
    view = memoryview(np.ascontiguousarray(out))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and each row's first value of a list column of integers; null is empty."""
    n = len(column)
    if column.null_count:
        lengths = np.asarray(column.value_lengths().fill_null(0))
        return np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    offs = np.asarray(column.offsets)[: n + 1].astype(np.int64)
    return np.asarray(column.flatten()), offs - offs[0]
