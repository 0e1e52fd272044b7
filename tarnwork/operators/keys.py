"""Key checks and null-safe equi-joins shared by the other operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null; the right side's key columns are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def assert_unique(df: DataFrame, keys: list[str], what: str = "right side") -> None:
    """Raise when a key occurs twice. Counts combine in the map tasks; one offending key is fetched for the message."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys).first()
    if twice is not None:
        raise ValueError(f"{what}: key {twice.asDict()} occurs more than once")
