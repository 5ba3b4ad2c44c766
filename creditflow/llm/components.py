"""Connected components of a link table, by distributed label propagation with pointer jumping.

Nothing is collected but one count a round.  Each round writes its table to the
shared checkpoint folder and deletes the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b): root is the smallest node that links reach.

    Self links and repeated links are harmless; null ends are not nodes.  Large
    star: each node's larger neighbours are tied to its smallest one; small
    star: each node's smaller neighbours likewise.  Rounds until nothing moves.
    """
    cuts = Cuts()

    def count_of(frame):
        return frame.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        lows = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        joined = both.join(lows, "a")
        if large:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lows.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    edges = cuts.write(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = count_of(edges)
    for _ in range(max_rounds):
        new = cuts.write(star(star(edges, True), False))
        cuts.drop(edges)
        edges, before, mark = new, mark, count_of(new)
        if tuple(before) == tuple(mark):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
