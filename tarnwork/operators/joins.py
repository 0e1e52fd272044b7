"""Joins beyond a plain ``df.join``: lookups, stars, versions in time, chains.

No size hint is given to dimensions: Spark broadcasts a side below its own size threshold and otherwise sorts and merges,
where adaptive execution splits skewed partitions. A hint appears only behind a measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.functions.columns import norm
from tarnwork.operators.keys import assert_unique, join_null_safe  # noqa: F401 (join_null_safe is offered here too)
from tarnwork.operators.skew import broadcast_limit, fits_broadcast, hinted, key_profile
from tarnwork.operators.windows import latest_per_key, running

FEW_VERSIONS = 64  # most versions of one key for which a range test per candidate stays cheap


def left_lookup(left: DataFrame, right: DataFrame, keys: list[str], unique: bool = True) -> DataFrame:
    """Left outer lookup. With ``unique`` the right keys are checked, so no left row can be doubled."""
    if unique:
        assert_unique(right, keys)
    return left.join(right, keys, "left")


def star_lookup(fact: DataFrame, dims: list[tuple], default: int = -1) -> DataFrame:
    """Look up surrogate keys in many dimensions.

    Each entry is ``(dimension, {fact column: dimension column}, {output key: dimension key})`` and may have a fourth
    part ``{output: dimension attribute}``. An unmatched key gets ``default``, an unmatched attribute null. Only the
    columns named here enter the plan. All dimensions are measured by one job, and those that are small enough together
    are broadcast, so that the fact moves for the large ones only.
    """
    out, found, sides = fact, [], []
    for i, (dim, on, keys, *rest) in enumerate(dims):
        attrs = rest[0] if rest else {}
        sides.append(dim.select(*[F.col(d).alias(f"_d{i}_{d}") for d in on.values()], *[F.col(c).alias(o) for o, c in {**keys, **attrs}.items()]))
        found += [F.coalesce(F.col(o), F.lit(default)).alias(o) for o in keys] + [F.col(o) for o in attrs]
    for i, (side, (_, on, *_)) in enumerate(zip(hinted(sides), dims, strict=True)):
        out = out.join(side, reduce(lambda a, b: a & b, [out[f] == side[f"_d{i}_{d}"] for f, d in on.items()]), "left")
    # One projection at the end: every further step over a wide plan is analysed anew.
    return out.select(*fact.columns, *found)


def join_norm(left: DataFrame, right: DataFrame, cols: dict[str, str], how: str = "inner") -> DataFrame:
    """Join on ``upper(trim(key))``; each side normalises its key once, before the join."""
    a, b = left, right
    for i, (x, y) in enumerate(cols.items()):
        a = a.withColumn(f"_n{i}", norm(x))
        b = b.withColumn(f"_n{i}", norm(y))
    names = [f"_n{i}" for i in range(len(cols))]
    return a.join(b, names, how).drop(*names)


def join_on_exprs(left: DataFrame, right: DataFrame, on: dict[str, Column], how: str = "left") -> DataFrame:
    """Join ``right`` on key values computed per left row (CASE keys): ``on`` maps a right column to an expression."""
    names = {y: f"_e_{y}" for y in on}
    a = left.withColumns({names[y]: e for y, e in on.items()})
    cond = reduce(lambda p, q: p & q, [a[names[y]] == right[y] for y in on])
    return a.join(right, cond, how).drop(*names.values())


def date_roles(fact: DataFrame, dim_date: DataFrame, roles: dict[str, str], date: str = "date", key: str = "date_key", default: int = -1) -> DataFrame:
    """One date dimension in many roles: ``roles`` maps the new key column to the fact's date or timestamp column.

    The dimension is measured once, and if it is small, as dates are, every role looks it up in one and the same broadcast
    (Spark reuses the exchange of equal plans), so the fact does not move."""
    out, small = fact, fits_broadcast(dim_date.select(date, key))
    for role, source in roles.items():
        day = dim_date.select(F.col(date).alias(f"_d_{role}"), F.col(key).alias(role))
        out = out.join(F.broadcast(day) if small else day, F.to_date(out[source]) == day[f"_d_{role}"], "left")
    return out.select(*fact.columns, *[F.coalesce(F.col(r), F.lit(default)).alias(r) for r in roles])


def lookup_codes(df: DataFrame, codes: DataFrame, wanted: list[tuple[str, str, str, str]]) -> DataFrame:
    """Descriptions from one code table ``(programid, keyfield, vals, descrip)``, one join per ``(program, field,
    column, output)``; all text compares without regard to case."""
    out = df
    for i, (program, field, column, name) in enumerate(wanted):
        part = codes.filter((F.upper("programid") == program.upper()) & (F.upper("keyfield") == field.upper()))
        part = part.select(F.upper("vals").alias(f"_v{i}"), F.col("descrip").alias(name))
        out = out.join(part, F.upper(out[column]) == part[f"_v{i}"], "left").drop(f"_v{i}")
    return out


def exists_flag(df: DataFrame, other: DataFrame, keys: dict[str, str], out: str) -> DataFrame:
    """1 when the key occurs in ``other``, else 0: join to the distinct keys."""
    found = other.select(*[F.col(y).alias(f"_x_{y}") for y in keys.values()]).distinct().withColumn("_found", F.lit(1))
    cond = reduce(lambda a, b: a & b, [df[x] == found[f"_x_{y}"] for x, y in keys.items()])
    joined = df.join(found, cond, "left")
    return joined.withColumn(out, F.coalesce("_found", F.lit(0))).drop("_found", *[f"_x_{y}" for y in keys.values()])


def with_child_sums(parent: DataFrame, child: DataFrame, keys: dict[str, str], measures: dict[str, Column]) -> DataFrame:
    """Sums of child rows per parent: one aggregate with all measures, joined once."""
    sums = child.groupBy(*[F.col(y).alias(f"_p_{y}") for y in keys.values()]).agg(*[F.sum(c).alias(o) for o, c in measures.items()])
    cond = reduce(lambda a, b: a & b, [parent[x] == sums[f"_p_{y}"] for x, y in keys.items()])
    return parent.join(sums, cond, "left").drop(*[f"_p_{y}" for y in keys.values()])


def changed_rows(source: DataFrame, target: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
    """Source rows whose key is in the target with another hash."""
    other = target.select(*keys, F.col(hash_col).alias("_th"))
    return source.join(other, keys).filter(F.col(hash_col) != F.col("_th")).select(*source.columns)


def choice_key(df: DataFrame, cond: Column, when_true: str, when_false: str, out: str) -> DataFrame:
    """One foreign key out of two, chosen per row, so that one join serves both."""
    return df.withColumn(out, F.when(cond, F.col(when_true)).otherwise(F.col(when_false)))


def next_in_chain(df: DataFrame, id_col: str, pointer: str, back_ref: str, order: list[Column], status: list[str], back_filter: Column | None = None) -> DataFrame:
    """Add ``next_id`` and the next record's ``status`` columns (as ``next_<column>``).

    The explicit pointer wins; otherwise the latest row that refers back. A pointer to an absent record gives null.
    """
    refs = df.filter(F.col(back_ref).isNotNull())
    if back_filter is not None:
        refs = refs.filter(back_filter)
    latest = latest_per_key(refs, [back_ref], order).select(F.col(back_ref).alias("_ref"), F.col(id_col).alias("_by_ref"))
    linked = df.join(latest, df[id_col] == latest["_ref"], "left").withColumn("_want", F.coalesce(F.col(pointer), F.col("_by_ref")))
    records = df.select(F.col(id_col).alias("next_id"), *[F.col(c).alias(f"next_{c}") for c in status])
    return linked.join(records, linked["_want"] == records["next_id"], "left").drop("_ref", "_by_ref", "_want")


def asof_latest(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, values: list[str], tie: str | None = None
) -> DataFrame:
    """Each left row with ``values`` of the latest right row of its key at or before ``left_ts`` (null if none).

    Right rows without a key or a time match nothing, and left rows without one find nothing.

    Both sides are stacked and one running ``last`` does the match, so no pair of rows is ever formed. ``tie`` is a
    right column that decides between right rows of equal time.
    """
    ts_type = left.schema[left_ts].dataType
    tie_type = right.schema[tie].dataType if tie else "int"
    payload = F.struct(*left.columns)
    value = F.struct(*values)
    a = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"), payload.alias("_row"))
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in [*keys, right_ts]])
    b = right.filter(known).select(
        *keys, F.col(right_ts).cast(ts_type).alias("_ts"), F.lit(0).alias("_side"),
        (F.col(tie) if tie else F.lit(None).cast("int")).alias("_tie"), value.alias("_val"),
    )
    both = a.unionByName(b, allowMissingColumns=True)
    found = running(both, keys, ["_ts", "_side", "_tie"], {"_found": ("last", "_val")}).filter("_side = 1")
    return found.select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])


def scd2_join(
    facts: DataFrame, dim: DataFrame, keys: list[str], ts: str, start: str, end: str, values: list[str], fallback: str | None = None
) -> DataFrame:
    """Each fact with the version of its key valid at ``ts`` (``start <= ts <= end``); null columns when there is none.

    ``fallback="latest"`` gives facts without a valid version the key's latest one. Where versions overlap, the one that
    starts last counts, and of those that start together the one with the largest end, then values. Null keys and times
    match nothing.
    A dimension measured small, with few versions per key, is broadcast and range-tested, so the facts do not move;
    any other goes through the single-sort as-of form. Both give the same rows.
    """
    slim = dim.groupBy(*keys, start).agg(F.max(F.struct(end, *values)).alias("_v")).select(*keys, start, f"_v.{end}", *[f"_v.{v}" for v in values])
    most, size = key_profile(slim, keys)
    if most <= FEW_VERSIONS and size <= broadcast_limit(facts.sparkSession):
        following = F.lead(start).over(Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first()))
        d = F.broadcast(slim.select(*[F.col(k).alias(f"_d_{k}") for k in keys], F.col(start).alias("_from"), F.col(end).alias("_to"), following.alias("_next"), *values))
        on = [facts[k] == d[f"_d_{k}"] for k in keys] + [facts[ts].between(d["_from"], d["_to"]), d["_next"].isNull() | (facts[ts] < d["_next"])]
        hit = facts.join(d, reduce(lambda a, b: a & b, on), "left")
        joined = hit.withColumn("_hit", F.col("_from").isNotNull()).drop("_from", "_to", "_next", *[f"_d_{k}" for k in keys])
    else:
        hit = asof_latest(facts, slim.withColumn("_start", F.col(start)), keys, ts, start, ["_start", end, *values])
        valid = F.col("_start").isNotNull() & (F.col(ts) <= F.col(end))
        joined = hit.withColumns({"_hit": F.coalesce(valid, F.lit(False)), **{v: F.when(valid, F.col(v)) for v in values}}).drop("_start", end)
    if fallback is None:
        return joined.drop("_hit")
    if fallback != "latest":
        raise ValueError(f"unknown fallback {fallback!r}")
    last = slim.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(start)).alias("_last"))
    out = joined.join(last, keys, "left")
    return out.select(*facts.columns, *[F.when(F.col("_hit"), F.col(v)).otherwise(F.col(f"_last.{v}")).alias(v) for v in values])
