"""Ordered operators per key: latest row, duplicates, previous row, sequence, numbering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnwork.operators.keys import join_null_safe
from tarnwork.operators.skew import chunk_bounds, hot_keys, position, range_bounds, shuffle_partitions, with_chunks

QUARANTINE_ALL = "quarantine_all_duplicates"
RETAIN_ONE = "retain_one_duplicate"
RETAIN_ALL = "retain_all_duplicate"


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Spark limits each key within the map tasks first (WindowGroupLimit), so a
    hot key reaches the shuffle as at most ``n`` rows per task."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``. End ``order`` with a unique column for a stable survivor."""
    return top_n_per_key(df, keys, order, 1)


def running(df: DataFrame, keys: list[str], order: list[str], outputs: dict[str, tuple], profile: DataFrame | None = None) -> DataFrame:
    """Add running values per key along ascending ``order`` (nulls first).

    ``outputs`` maps a new column to ``("row_number",)``, ``("lag", col)``, ``("last", col)`` (latest non-null up to
    and including the row) or ``("sum", col)``. ``order`` must be a total order within a key for ``lag``.

    A hot key is cut along ``order``: each chunk is its own window group, and what the earlier chunks carry over is
    computed from one summary row per chunk. Where ``df`` is expensive, ``profile`` may be a cheaper frame with the same
    key and order columns and about the same rows: it only decides where to cut, never the result.
    """
    bounds = chunk_bounds(df if profile is None else profile, keys, order)
    if bounds is None:
        w = W.partitionBy(*keys).orderBy(*order)
        return df.withColumns({out: _inside(spec, w) for out, spec in outputs.items()})

    tagged = with_chunks(df, keys, order, bounds)
    w = W.partitionBy(*keys, "_chunk").orderBy(*order)
    inside = tagged.withColumns({"_rn": F.row_number().over(w), **{f"_i_{o}": _inside(s, w) for o, s in outputs.items()}})

    here = F.struct(*order)
    summary = tagged.filter("_hot").groupBy(*keys, "_chunk").agg(*[_summary(s, here).alias(f"_c_{o}") for o, s in outputs.items()])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    previous = W.partitionBy(*keys).orderBy("_chunk")
    carried = summary.select(
        *keys, "_chunk", *[_carry(s, F.col(f"_c_{o}"), before, previous).alias(f"_c_{o}") for o, s in outputs.items()]
    )
    joined = join_null_safe(inside, F.broadcast(carried), [*keys, "_chunk"], "left")
    result = {o: _combine(s, F.col(f"_i_{o}"), F.col(f"_c_{o}")) for o, s in outputs.items()}
    return joined.withColumns(result).select(*df.columns, *outputs)


def _inside(spec: tuple, w) -> Column:
    rows = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    if spec[0] == "row_number":
        return F.row_number().over(w).cast("long")
    if spec[0] == "lag":
        return F.lag(spec[1]).over(w)
    if spec[0] == "last":
        return F.last(spec[1], ignorenulls=True).over(rows)
    if spec[0] == "sum":
        return F.sum(spec[1]).over(rows)
    raise ValueError(f"unknown running value {spec[0]!r}")


def _summary(spec: tuple, here: Column) -> Column:
    if spec[0] == "row_number":
        return F.count(F.lit(1))
    value = F.col(spec[1])
    if spec[0] == "lag":
        return F.max_by(F.struct(value.alias("v")), here)
    if spec[0] == "last":
        return F.max_by(value, F.when(value.isNotNull(), here))
    return F.sum(value)


def _carry(spec: tuple, value: Column, before, previous) -> Column:
    if spec[0] == "lag":
        return F.lag(value).over(previous)
    if spec[0] == "last":
        return F.last(value, ignorenulls=True).over(before)
    return F.sum(value).over(before)


def _combine(spec: tuple, inside: Column, carried: Column) -> Column:
    if spec[0] == "lag":
        return F.when(F.col("_rn") == 1, carried["v"]).otherwise(inside)
    if spec[0] == "last":
        return F.coalesce(inside, carried)
    return F.coalesce(inside + carried, inside, carried)


def duplicate_counts(df: DataFrame, keys: list[str], out: str = "_copies") -> DataFrame:
    """Every row with the row count of its key. Counts combine in the map tasks; the join back splits skewed keys
    (adaptive execution), which a ``count(*) over`` window would not."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return join_null_safe(df, counts, keys, "inner")


def mark_duplicates(df: DataFrame, keys: list[str], policy: str = QUARANTINE_ALL, order: list[Column] | None = None, out: str = "is_copy") -> DataFrame:
    """Every row with the mark whether its key's duplicates put it out.

    * ``quarantine_all_duplicates``: all rows of a key that occurs more than once are marked.
    * ``retain_one_duplicate``: all but the first row in ``order`` are marked.
    * ``retain_all_duplicate``: marked like the first policy, for reporting; the rows stay.
    """
    if policy in (QUARANTINE_ALL, RETAIN_ALL):
        return duplicate_counts(df, keys).withColumn(out, F.col("_copies") > 1).select(*df.columns, out)
    if policy != RETAIN_ONE:
        raise ValueError(f"unknown duplicate policy {policy!r}")
    if not order:
        raise ValueError("retain_one_duplicate needs an order, or the survivor is arbitrary")
    hot = hot_keys(df, keys)
    if hot is None:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_rn", rank).select(*df.columns, (F.col("_rn") > 1).alias(out))
    # Two rounds for hot keys: the first among the rows of one salt, then among the winners of the salts (at most one
    # per salt). The salt is the scan partition, as identical copies cannot be told apart by their content.
    salts = shuffle_partitions(df.sparkSession)
    marks = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    salted = join_null_safe(df.withColumn("_part", F.spark_partition_id()), marks, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.hash("_part", *df.columns), F.lit(salts))).otherwise(0)
    )
    first = salted.withColumn("_rn", F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order)))
    winners = first.filter("_rn = 1").withColumn(
        "_final", F.row_number().over(W.partitionBy(*keys).orderBy(*order, F.col("_salt")))
    )
    losers = first.filter("_rn > 1").select(*df.columns, F.lit(True).alias(out))
    return losers.unionByName(winners.select(*df.columns, (F.col("_final") > 1).alias(out)))


def split_duplicates(
    df: DataFrame, keys: list[str], policy: str = QUARANTINE_ALL, order: list[Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, duplicates) by the marks of ``mark_duplicates``: together exactly the input, but for
    ``retain_all_duplicate``, where everything stays clean and duplicates are reported only."""
    marked = mark_duplicates(df, keys, policy, order, "_out")
    clean = df if policy == RETAIN_ALL else marked.filter("NOT _out").drop("_out")
    return clean, marked.filter("_out").drop("_out")


def drop_dups(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return latest_per_key(df, keys, order)


def first_value(df: DataFrame, keys: list[str], order: list[Column], col: str, out: str) -> DataFrame:
    """Every row with ``col`` of its key's first row in ``order`` (FIRST_VALUE, frame from the start)."""
    firsts = top_n_per_key(df, keys, order, 1).select(*keys, F.col(col).alias(out))
    return join_null_safe(df, firsts, keys, "inner")


def window_sum(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Every row with totals of its key: aggregate first, then join back."""
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in measures.items()])
    return join_null_safe(df, totals, keys, "inner")


def sequence(df: DataFrame, keys: list[str], order: list[str], out: str = "seq") -> DataFrame:
    """1, 2, 3 … within each key along ``order``."""
    return running(df, keys, order, {out: ("row_number",)})


def with_previous(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str]) -> DataFrame:
    """Values of the previous row of the key: ``cols`` maps a new column to a source column."""
    return running(df, keys, order, {out: ("lag", c) for out, c in cols.items()})


def days_in_status(df: DataFrame, keys: list[str], ts: str, order: list[str] | None = None, out: str = "days_in_status") -> DataFrame:
    """Whole days since the previous row of the key; null for its first row."""
    prev = with_previous(df, keys, order or [ts], {"_prev_ts": ts})
    return prev.withColumn(out, F.datediff(F.col(ts), F.col("_prev_ts"))).drop("_prev_ts")


def dense_number(df: DataFrame, order: list[str], out: str = "id", start: int = 1) -> DataFrame:
    """Gap-free numbers over the whole frame along ascending, unique ``order``.

    The frame is cut into ranges, each range is numbered on its own, and the row counts of the earlier ranges are
    added. The number depends on the data only, so a retried task repeats it.
    """
    cuts = range_bounds(df, order)
    here = F.struct(*order)
    if cuts:
        kinds = {c: df.schema[c].dataType for c in order}
        bounds = [F.struct(*[F.lit(cut[c]).cast(kinds[c]).alias(c) for c in order]) for cut in cuts]
        step = math.isqrt(len(bounds) - 1) + 1
        coarse = F.slice(F.array(*bounds), 1, 0) if step > len(bounds) else F.array(*bounds[step - 1::step])
        tagged = df.withColumn("_range", position(F.array(*bounds), coarse, F.lit(step), here))
    else:
        tagged = df.withColumn("_range", F.lit(0))
    sizes = tagged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range, no more than there are shuffle partitions.
    before = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = tagged.withColumn("_rn", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    joined = numbered.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, (F.col("_rn") + F.col("_offset") + F.lit(start - 1)).cast("long").alias(out))
