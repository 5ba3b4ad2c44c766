"""Written cuts of one operator's run, and document keys shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.session import cut_lineage


class Cuts:
    """Tables written to the shared checkpoint folder while one result is built.

    ``drop`` deletes those that no later step reads, through Spark's own file
    system, so that only what the returned frame still reads stays behind.
    """

    def write(self, df: DataFrame, free: bool = False) -> DataFrame:
        """With ``free``, the shuffle files of this write are removed at its end, not when the driver collects garbage."""
        return cut_lineage(df, free)

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            spark = df.sparkSession
            for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
                path = spark._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pieces(total: int, each: int) -> int:
    """How many pieces of about ``each`` hold ``total``; at least one."""
    return max(1, math.ceil(total / each))


def text_key(text: str = "text") -> Column:
    """With doc_id, tells rows apart: rows that share both are copies and get the same result."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same_key(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality on the named columns."""
    cond = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        cond &= a[n].eqNullSafe(b[n])
    return cond


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, worked out once a row: expressions inside array functions are not shared otherwise."""
    return F.transform(F.array(value), body)[0]
