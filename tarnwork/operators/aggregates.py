"""Grouped totals, funnels, in-force book, customer view, time frames, lists and gates."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import total_of
from tarnwork.operators.keys import join_null_safe
from tarnwork.operators.windows import latest_per_key


def totals(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Several aggregates per key in one pass."""
    return df.groupBy(*keys).agg(*[c.alias(o) for o, c in measures.items()])


def min_max(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def funnel(df: DataFrame, dims: list[str], stage_col: str, stages: dict[str, str]) -> DataFrame:
    """Rows per stage side by side: ``stages`` maps an output name to the stage's value."""
    return df.groupBy(*dims).agg(*[F.count(F.when(F.col(stage_col) == v, 1)).alias(f"{n}_count") for n, v in stages.items()])


def ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` as double; null when ``b`` is zero."""
    x = F.col(a) if isinstance(a, str) else a
    y = F.col(b) if isinstance(b, str) else b
    return x.cast("double") / F.nullif(y.cast("double"), F.lit(0.0))


def funnel_ratios(counts: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Add ``<from>_to_<to>_ratio`` for each pair of stages."""
    return counts.withColumns({f"{a}_to_{b}_ratio": ratio(f"{b}_count", f"{a}_count") for a, b in pairs})


def inforce(df: DataFrame, dims: list[str], end_col: str, premium: Column, as_of: date) -> DataFrame:
    """Rows not ended on ``as_of`` (end on or after it, or open): count and premium per dimension."""
    alive = df.filter(F.col(end_col).isNull() | (F.col(end_col) >= F.lit(as_of)))
    return alive.groupBy(*dims).agg(F.count(F.lit(1)).alias("inforce_count"), premium.alias("total_premium"))


def customer_360(df: DataFrame, keys: list[str], id_col: str, measures: dict[str, Column], category: str) -> DataFrame:
    """Per customer: distinct contracts, totals, the sorted category list and its length, in one pass over the input.

    The category set of a customer holds no more entries than there are categories, and sets combine in the map tasks.
    """
    grouped = df.groupBy(*keys).agg(
        F.countDistinct(id_col).alias("total_policies"), *[c.alias(o) for o, c in measures.items()], F.array_sort(F.collect_set(category)).alias("_set"),
    )
    return grouped.select("*", F.array_join("_set", ", ").alias("categories"), F.size("_set").cast("long").alias("category_count")).drop("_set")


def cross_sell(c360: DataFrame, segment_col: str, segment: str) -> DataFrame:
    """High priority: exactly one category and the given segment."""
    high = (F.col("category_count") == 1) & (F.col(segment_col) == segment)
    return c360.withColumn("cross_sell_priority", F.when(high, "High").otherwise("Low"))


def bucket_counts(df: DataFrame, keys: list[str], ts: str, status: str, as_of: date, tie: str | None = None) -> DataFrame:
    """Keys per status at the end of ``as_of``: the latest status of each key up to that day, counted."""
    seen = until(df, ts, as_of)
    order = [F.col(ts).desc(), *([F.col(tie).desc()] if tie else [])]
    last = latest_per_key(seen.select(*dict.fromkeys([*keys, ts, status, *([tie] if tie else [])])), keys, order)
    return last.groupBy(status).agg(F.count(F.lit(1)).alias("policy_count"))


def monthly(df: DataFrame, ts: str, measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(*[c.alias(o) for o, c in measures.items()])


def yoy(df: DataFrame, ts: str, measures: dict[str, Column], year: int) -> DataFrame:
    """``year`` and the year before side by side, with the difference. ``measures`` maps a name to a row value whose
    sum is compared; the time filter is a plain range, so partitions and row groups are pruned."""
    both = df.filter((F.col(ts) >= F.lit(date(year - 1, 1, 1))) & (F.col(ts) < F.lit(date(year + 1, 1, 1))))
    current = F.year(ts) == year
    sums = both.agg(*[
        F.sum(F.when(side, c)).alias(f"{o}_{name}")
        for o, c in measures.items() for name, side in (("current", current), ("prior", ~current))
    ])
    shown = []
    for o in measures:
        cur, prior = F.col(f"{o}_current"), F.col(f"{o}_prior")
        shown += [cur.cast("double").alias(f"{o}_current"), prior.cast("double").alias(f"{o}_prior"), (cur - prior).cast("double").alias(f"{o}_delta")]
    return sums.select(F.lit(year).alias("year"), *shown)


def until(df: DataFrame, ts: str, as_of: date) -> DataFrame:
    """Rows up to the end of the day ``as_of``."""
    return df.filter(F.col(ts) < F.lit(as_of + timedelta(days=1)))


def ytd(df: DataFrame, ts: str, as_of: date) -> DataFrame:
    """From 1 January of the year of ``as_of`` through that day."""
    return until(df, ts, as_of).filter(F.col(ts) >= F.lit(date(as_of.year, 1, 1)))


def rolling_12m(df: DataFrame, ts: str, as_of: date) -> DataFrame:
    """The twelve months that end with ``as_of``: after the same day one year before."""
    start = F.date_add(F.add_months(F.lit(as_of), -12), 1)
    return until(df, ts, as_of).filter(F.col(ts) >= start)


def prior_year(df: DataFrame, ts: str, as_of: date, period: str) -> DataFrame:
    """The same period one year earlier: ``period`` is ``ytd`` or ``rolling_12m``."""
    if period == "ytd":
        start, end = F.lit(date(as_of.year - 1, 1, 1)), F.add_months(F.lit(as_of), -12)
    elif period == "rolling_12m":
        start, end = F.date_add(F.add_months(F.lit(as_of), -24), 1), F.add_months(F.lit(as_of), -12)
    else:
        raise ValueError(f"unknown period {period!r}")
    return df.filter((F.col(ts) >= start) & (F.col(ts) < F.date_add(end, 1)))


def collect_sorted(df: DataFrame, keys: list[str], col: str, out: str | None = None) -> DataFrame:
    """The distinct values of ``col`` per key as a sorted array. Meant for names (columns of a table, datasets of a
    feed): the array holds the distinct values only, reduced before the final grouping."""
    return df.select(*keys, col).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list(col)).alias(out or col))


def quoted_list(df: DataFrame, keys: list[str], col: str, out: str = "quoted") -> DataFrame:
    """``'a','b','c'`` per key from the sorted distinct values."""
    lists = collect_sorted(df, keys, col, "_v")
    return lists.select(*keys, F.concat(F.lit("'"), F.array_join("_v", "','"), F.lit("'")).alias(out))


def completeness_gate(df: DataFrame, key: str, expected: list[str], day_col: str, day: date, state: str, good) -> DataFrame:
    """One row, ``complete``: 1 when every expected key has a row on ``day`` and none of its rows is in another
    state than ``good``."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(k,) for k in dict.fromkeys(expected)], f"_key {df.schema[key].dataType.simpleString()}")
    rows = df.filter((F.col(day_col) >= F.lit(day)) & (F.col(day_col) < F.lit(day + timedelta(days=1))) & F.col(key).isin(expected))
    states = rows.groupBy(key).agg(F.min((F.col(state) == good).cast("int")).alias("_good"))
    joined = wanted.join(states, wanted["_key"] == states[key], "left")
    return joined.agg(F.min(F.coalesce("_good", F.lit(0))).alias("complete"))


def reconcile(fact: DataFrame, source: DataFrame, keys: list[str], measures: dict[str, tuple[str, str]], scale: int = 2) -> DataFrame:
    """Per key of ``fact`` and measure 1 when the fact total equals the source total, else 0 (a missing or null total
    fails). ``measures`` maps a flag to ``(fact column, source column)``; both sides are aggregated once."""
    f = fact.groupBy(*keys).agg(*[total_of(fact, a, scale).alias(f"_f_{o}") for o, (a, _) in measures.items()])
    s = source.groupBy(*keys).agg(*[total_of(source, b, scale).alias(f"_s_{o}") for o, (_, b) in measures.items()])
    both = f.join(s, keys, "left")
    return both.select(*keys, *[F.when(F.col(f"_f_{o}") == F.col(f"_s_{o}"), 1).otherwise(0).alias(o) for o in measures])


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
