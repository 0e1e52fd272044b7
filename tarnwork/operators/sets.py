"""Unions and list differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unified_view(clean: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Clean and quarantined rows together; the quarantine columns are null on clean rows."""
    return union_all_by_name(clean, quarantined)


def two_branch(first: DataFrame, second: DataFrame, mapping: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One dimension from two sources: ``mapping`` gives each output column's expression on both sides. Each branch
    is made distinct."""
    a = first.select(*[x.alias(o) for o, (x, _) in mapping.items()]).distinct()
    b = second.select(*[y.alias(o) for o, (_, y) in mapping.items()]).distinct()
    return a.unionByName(b)


def list_diff(current: DataFrame, desired: DataFrame, key: str, col: str) -> DataFrame:
    """Names per key that were added, removed or kept, and what that means for the key.

    Works on (key, name) rows: a full outer join decides each name, one aggregation decides each key; lists hold names
    of one key only.
    """
    a = current.select(key, col).distinct().withColumn("_cur", F.lit(1))
    b = desired.select(key, col).distinct().withColumn("_des", F.lit(1))
    both = a.join(b, [key, col], "full")
    lists = both.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("_cur").isNull(), F.col(col)))), ",").alias("added"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("_des").isNull(), F.col(col)))), ",").alias("removed"),
        F.count("_cur").alias("_nc"),
        F.count("_des").alias("_nd"),
    )
    change = (
        F.when(F.col("_nc") == 0, "new").when(F.col("_nd") == 0, "removed")
        .when((F.col("added") == "") & (F.col("removed") == ""), "unchanged").otherwise("changed")
    )
    return lists.select(key, "added", "removed", change.alias("change"))
