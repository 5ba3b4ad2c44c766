"""Join helpers that stay safe when one key holds a large share of rows.

* ``bounded_broadcast``: broadcast a side only after measuring its rows and bytes.
* ``semi_reduce``: filter a big table by the run's key set: broadcast when the
  set is under a checked size, else a blocked bloom filter of the keys thins
  the scan before the shuffled semi join.
* ``grid_join``: inner join on equal ``keys`` plus a residual condition, where a
  key's work is its number of row pairs; keys with too many are cut into a grid
  of cells, along whichever side is the longer one.
* ``salted_bucket_join``: the one-sided form, which also does left joins.

The tables of hot keys are bounded: the threshold grows with the total, so that
at most ``MAX_HOT_KEYS`` keys can pass it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds under which a dimension may be broadcast.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 << 20
# Bound under which a set of join keys (ids, uuids) may be broadcast.
KEYS_BROADCAST_MAX_BYTES = 256 << 20
# What a row of a broadcast table takes besides its values.
ROW_BYTES = 48
# Bloom filter: blocks of 4 x 64 bits, 8 bits set by a key; beyond the bound there is no filter.
BLOCK_WORDS, BITS_PER_WORD = 4, 2
KEYS_PER_BLOCK = 16
FILTER_MAX_BYTES = 512 << 20
# Rows per (key, salt) task slice that we are happy to process in one task.
HOT_KEY_ROWS = 2_000_000
# Upper bound on the number of hot keys (sizes the broadcast hot-key table).
MAX_HOT_KEYS = 100_000
# Row pairs of one join key that one task may look at.
PAIRS_PER_CELL = 50_000_000


def value_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the texts' own, 8 for any other."""
    total = F.lit(0)
    for f in df.schema.fields:
        wide = f.dataType.simpleString() in ("string", "binary")
        total = total + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if wide else F.lit(8))
    return total


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and the bytes that they take when broadcast (one job)."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(value_bytes(df)), F.lit(0))).first()
    return n, size + ROW_BYTES * n


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is within both bounds, else ``df``.

    The check runs one small job; use it for dimensions, not facts.
    """
    n, size = measured(df)
    small = n <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows) and size <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)
    return F.broadcast(df) if small else df


# ---- key sets --------------------------------------------------------------

@dataclass(frozen=True)
class KeySet:
    """Distinct non-NULL keys of a run (column ``_semi_key``) and how many they are."""

    keys: DataFrame
    count: int
    small: bool


def _distinct(keys: DataFrame, key_col: str) -> DataFrame:
    return keys.select(F.col(key_col).alias("_semi_key")).where(F.col("_semi_key").isNotNull()).distinct()


def key_set(keys: DataFrame, key_col: str, max_bytes: int | None = None) -> KeySet:
    """The measured key set of one column (one job; reuse the result)."""
    k = _distinct(keys, key_col)
    n, size = measured(k)
    return KeySet(k, n, size <= (KEYS_BROADCAST_MAX_BYTES if max_bytes is None else max_bytes))


def key_sets(keys: DataFrame, key_cols: list[str], max_bytes: int | None = None) -> dict[str, KeySet]:
    """``key_set`` for several columns of one (small) frame with a single job.

    A column's distinct keys are taken to be as wide as its rows on average.
    """
    bound = KEYS_BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    found = keys.agg(*[x for c in key_cols for x in (
        F.count_distinct(c).alias(c), F.coalesce(F.avg(value_bytes(keys.select(c))), F.lit(0.0)).alias("_w_" + c))]).first()
    return {c: KeySet(_distinct(keys, c), found[c], found[c] * (found["_w_" + c] + ROW_BYTES) <= bound) for c in key_cols}


def _bits(key: Column) -> list[Column]:
    """The bits that ``key`` sets in each word of its block."""
    h = F.xxhash64(key, F.lit(1))
    words = []
    for w in range(BLOCK_WORDS):
        masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * (BITS_PER_WORD * w + i)).bitwiseAND(F.lit(63)).cast("int"))
                 for i in range(BITS_PER_WORD)]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), masks))
    return words


def bloom_blocks(keys: KeySet) -> tuple[DataFrame, int]:
    """The blocked bloom filter of a key set as rows (_block, _w0.._w3), and its number of blocks."""
    blocks = max(1, math.ceil(keys.count / KEYS_PER_BLOCK))
    k = F.col("_semi_key")
    rows = keys.keys.select(F.pmod(F.xxhash64(k), F.lit(blocks)).alias("_block"), *[b.alias(f"_w{w}") for w, b in enumerate(_bits(k))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(BLOCK_WORDS)]), blocks


def bloom_reduce(big: DataFrame, col: Column, keys: KeySet) -> DataFrame:
    """Rows of ``big`` whose key may be in ``keys``: all that are, and about one in a hundred of the others.

    A broadcast semi join on the key's block, bits compared as its condition,
    while ``big`` is scanned.  Its size is known from the key count; without
    room for it ``big`` comes back as it is.
    """
    blocks = max(1, math.ceil(keys.count / KEYS_PER_BLOCK))
    if blocks * (ROW_BYTES + 8 * (BLOCK_WORDS + 1)) > FILTER_MAX_BYTES:
        return big
    table, blocks = bloom_blocks(keys)
    cond = F.pmod(F.xxhash64(col), F.lit(blocks)) == table["_block"]
    for w, bits in enumerate(_bits(col)):
        cond = cond & (table[f"_w{w}"].bitwiseAND(bits) == bits)
    return big.join(F.broadcast(table), cond, "left_semi")


def semi_reduce(big: DataFrame, big_key, keys: KeySet | DataFrame, key_col: str | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """Rows of ``big`` whose ``big_key`` (name or Column) occurs in the key set.

    ``keys`` is a ``KeySet`` or a frame whose ``key_col`` holds the keys.  The
    distinct keys of a run (a few days of orders, their buyers, their chains)
    are measured; a small set is broadcast, so the big, history-sized table is
    filtered map-side while it is scanned and never shuffled whole.  Above the
    bound the bloom filter of the keys does that, and an ordinary shuffled semi
    join removes what it let through.
    """
    k = keys if key_col is None else key_set(keys, key_col, max_bytes)
    col = F.col(big_key) if isinstance(big_key, str) else big_key
    if k.small:
        return big.join(F.broadcast(k.keys), col == k.keys["_semi_key"], "left_semi")
    return bloom_reduce(big, col, k).join(k.keys, col == k.keys["_semi_key"], "left_semi")


# ---- skewed joins ------------------------------------------------------------

def hot_keys(big: DataFrame, keys: list[str], threshold: int | None = None,
             max_hot_keys: int | None = None) -> tuple[DataFrame | None, int]:
    """Keys of ``big`` holding more than the effective threshold, with a salt count.

    Returns ``(hot, threshold)`` where ``hot`` has ``keys + ['_salts']``, or
    ``None`` when no key is hot.  The effective threshold grows with the
    total (``max(threshold, total / max_hot_keys)``), so at most
    ``max_hot_keys`` keys can qualify.  When the whole side is under the
    threshold no key can be hot and the per-key count is skipped; otherwise
    one job computes the key counts (a partial, map-side combined aggregate)
    and checks whether any key exceeds the threshold.
    """
    threshold = HOT_KEY_ROWS if threshold is None else threshold
    max_hot_keys = MAX_HOT_KEYS if max_hot_keys is None else max_hot_keys
    total = big.count()
    eff = max(threshold, math.ceil(total / max_hot_keys))
    if total <= eff:
        return None, eff
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = (counts.where(F.col("_n") > eff)
           .select(*keys, F.ceil(F.col("_n") / F.lit(eff)).cast("int").alias("_salts")))
    if hot.limit(1).count() == 0:
        return None, eff
    return hot, eff


def salted_bucket_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                       condition=None, salt_by: list[str] | None = None,
                       threshold: int | None = None, max_hot_keys: int | None = None) -> DataFrame:
    """Join ``big`` and ``small`` on equal ``keys`` plus an optional residual ``condition``.

    ``how`` is ``inner`` or ``left`` (``left`` keeps every row of ``big``).
    ``condition`` is a function ``(big_df, small_df) -> Column`` evaluated on
    the two sides after salting.  Each big row gets one salt, so the join
    result is identical to the unsalted join.
    """
    assert how in ("inner", "left")
    hot, _ = hot_keys(big, keys, threshold, max_hot_keys)
    if hot is None:  # no hot key: plain equi-join
        b, s, join_keys = big.alias("big"), small.alias("small"), list(keys)
    else:
        hot = F.broadcast(hot)  # at most max_hot_keys rows by construction
        salt_cols = [F.col(c) for c in (salt_by or big.columns)]
        b = (big.join(hot, keys, "left")
             .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                         .otherwise(F.pmod(F.xxhash64(*salt_cols), F.col("_salts")).cast("int")))
             .drop("_salts"))
        s = (small.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
             .drop("_salts"))
        b, s, join_keys = b.alias("big"), s.alias("small"), keys + ["_salt"]
    cond: Column = None
    for k in join_keys:
        c = F.col(f"big.{k}") == F.col(f"small.{k}")
        cond = c if cond is None else cond & c
    if condition is not None:
        cond = cond & condition(b, s)
    return b.join(s, cond, how)


def hot_cells(left: DataFrame, right: DataFrame, keys: list[str], pairs: int | None = None,
              max_hot_keys: int | None = None) -> DataFrame | None:
    """Keys whose number of row pairs passes the bound, with the salts of each side; None without any.

    One job counts both sides by key (map-side combined) and takes the sum and
    the maximum of the products.  A hot key gets about pairs / bound cells: the
    side with more rows is cut first, the other one only where its rows alone
    would not give enough cells.
    """
    bound = PAIRS_PER_CELL if pairs is None else pairs
    most = MAX_HOT_KEYS if max_hot_keys is None else max_hot_keys
    counts = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
              .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys)
              .withColumn("_pairs", F.col("_l").cast("double") * F.col("_r")))
    highest, total = counts.agg(F.max("_pairs"), F.sum("_pairs")).first()
    bound = max(bound, math.ceil((total or 0) / most))
    if not highest or highest <= bound:
        return None
    cells = F.ceil(F.col("_pairs") / bound)
    long_cut = F.least(cells, F.greatest("_l", "_r"))
    short_cut = F.least(F.ceil(cells / long_cut), F.least("_l", "_r"))
    left_longer = F.col("_l") >= F.col("_r")
    return counts.where(F.col("_pairs") > bound).select(
        *keys, F.when(left_longer, long_cut).otherwise(short_cut).cast("int").alias("_ls"),
        F.when(left_longer, short_cut).otherwise(long_cut).cast("int").alias("_rs"))


def _in_cells(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    """One salt of its own for each row, copied for every salt of the other side."""
    own_n, other_n = F.coalesce(F.col(own + "s"), F.lit(1)), F.coalesce(F.col(other + "s"), F.lit(1))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), own_n).cast("int")
    copies = F.explode(F.sequence(F.lit(0), other_n - 1))
    out = df.join(F.broadcast(hot), keys, "left")
    return out.select(*df.columns, salt.alias(own), copies.alias(other))


_COUNT = object()


def grid_join(left: DataFrame, right: DataFrame, keys: list[str], condition=None, pairs: int | None = None,
              max_hot_keys: int | None = None, hot: DataFrame | None = _COUNT) -> DataFrame:
    """Inner join (aliases ``left`` and ``right``) on equal ``keys`` plus an optional residual ``condition``.

    Without hot keys a plain equi-join.  Every pair of rows meets in exactly one
    cell, so the result is the unsalted join's.  ``condition`` is a function of
    the two aliased frames.  ``hot`` takes the cells from an earlier
    ``hot_cells`` of the same keys, None for none.
    """
    if hot is _COUNT:
        hot = hot_cells(left, right, keys, pairs, max_hot_keys)
    join_keys = list(keys)
    if hot is not None:
        left = _in_cells(left, hot, keys, "_l", "_r")
        right = _in_cells(right, hot, keys, "_r", "_l")
        join_keys += ["_l", "_r"]
    left, right = left.alias("left"), right.alias("right")
    cond = reduce(lambda a, b: a & b, [F.col(f"left.{k}") == F.col(f"right.{k}") for k in join_keys])
    if condition is not None:
        cond = cond & condition(left, right)
    return left.join(right, cond)
