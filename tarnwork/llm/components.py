"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``(a, b)``: ``root`` is the smallest node that can be reached.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest neighbour, until nothing
    changes: about the logarithm of the longest path in rounds. A node's neighbours are met through their minimum
    (combined before the shuffle) and a join, never gathered, and every round is written to the shared folder.
    """
    def star(e: DataFrame, larger: bool) -> DataFrame:
        if larger:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = e.join(low, "a")
        if larger:
            out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    now = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        # Equal sums of both columns and equal counts over two rounds: nothing has moved.
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == before:
            break
        before = sums
        now = settle(star(star(now, True), False), "edges")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
