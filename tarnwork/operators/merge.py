"""Load strategies as pure functions: ``(target, source, …) -> new target``.

Source keys must be unique, as in MERGE; that is checked with one aggregation. A null key matches nothing, except where
the operator says null-safe.

Two plans serve the upserts. A source measured small is broadcast: the target streams through without a shuffle and only
the matched keys are looked up for the inserts. A larger source is joined full outer on the keys.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarnwork.functions.columns import lit_like
from tarnwork.operators.keys import assert_unique, join_null_safe
from tarnwork.operators.skew import broadcast_limit, fits_broadcast, key_profile
from tarnwork.operators.windows import dense_number, latest_per_key
from tarnwork.session import cut


def sync_columns(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns, target order first; missing values are null."""
    def widen(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})

    t = widen(target, source)
    return t, widen(source, target).select(*t.columns)


def any_differs(cols: list[str], left: str = "t", right: str = "s") -> Column:
    """Null-safe: some column differs between the two sides."""
    return reduce(lambda a, b: a | b, [~F.col(f"{left}_{c}").eqNullSafe(F.col(f"{right}_{c}")) for c in cols])


# What a merge did to a row, as its ``action`` column tells (null where the row stayed as it was).
INSERTED, UPDATED = "inserted", "updated"
# Source columns that follow from the others or are the same for all rows, by the prefix of the names that they read: they
# are worked out where the rows meet instead of being moved there.
Derived = Callable[[str], dict[str, Column]]


def merge_rows(
    target: DataFrame, source: DataFrame, keys: list[str], update: dict[str, Column], insert: dict[str, Column] | None,
    matched: Column | None = None, null_safe: bool = False, small: bool | None = None, insert_when: Column | None = None, action: str | None = None,
    derived: Derived | None = None,
) -> DataFrame:
    """The common core. Inside ``update``, ``insert``, ``matched`` and ``insert_when`` target columns are called
    ``t_<name>`` and source columns ``s_<name>``. ``update`` values replace target columns of matched rows that satisfy
    ``matched``; ``insert`` gives the columns of unmatched source rows, all of them or those that satisfy
    ``insert_when``, or is ``None`` for no insert. ``small`` says whether the source was measured to fit a broadcast; it
    is measured here when not given. ``action`` names a further column that tells what was done to each row. ``derived``
    gives source columns that need not move with the rows.
    """
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    late = {f"s_{c}": e for c, e in (derived("s_") if derived else {}).items() if c not in keys}
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns if f"s_{c}" not in late], F.lit(True).alias("_s"))
    same = [(t[f"t_{k}"].eqNullSafe(s[f"s_{k}"]) if null_safe else t[f"t_{k}"] == s[f"s_{k}"]) for k in keys]
    on = reduce(lambda a, b: a & b, same)
    hit = F.col("_t") & F.col("_s")
    if matched is not None:
        hit = hit & F.coalesce(matched, F.lit(False))
    changed = {c: F.when(hit, update[c]).otherwise(F.col(f"t_{c}")) if c in update else F.col(f"t_{c}") for c in cols}
    done = [action] if action else []
    changed |= {c: F.when(hit, F.lit(UPDATED)) for c in done}

    if small is None:
        small = fits_broadcast(source)
    if insert is None or small:
        kept = t.join(F.broadcast(s) if small else s, on, "left").withColumns(late).select(*[changed[c].alias(c) for c in [*cols, *done]])
        if insert is None:
            return kept
        present = t.join(F.broadcast(s.select(*[f"s_{k}" for k in keys])), on, "left_semi").select(*[F.col(f"t_{k}") for k in keys]).distinct()
        same = [(s[f"s_{k}"].eqNullSafe(present[f"t_{k}"]) if null_safe else s[f"s_{k}"] == present[f"t_{k}"]) for k in keys]
        # At most the keys of the small source come out of the target, so they are broadcast as well.
        new = s.join(F.broadcast(present), reduce(lambda a, b: a & b, same), "left_anti").withColumns(late)
        new = new if insert_when is None else new.filter(insert_when)
        return kept.unionByName(new.select(*[insert[c].alias(c) for c in cols], *[F.lit(INSERTED).alias(c) for c in done]))

    both = t.join(s, on, "full").withColumns(late)
    if insert_when is not None:
        both = both.filter(F.col("_t") | F.coalesce(insert_when, F.lit(False)))
    here = F.coalesce(F.col("_t"), F.lit(False))
    insert = insert | {c: F.lit(INSERTED) for c in done}
    return both.select(*[F.when(here, changed[c]).otherwise(insert[c]).alias(c) for c in [*cols, *done]])


def check_source(source: DataFrame, keys: list[str]) -> bool:
    """Refuse repeated keys; tell whether the source is small enough to broadcast. One pass answers both."""
    most, size = key_profile(source, keys)
    if most > 1:
        assert_unique(source.dropna(subset=keys), keys, "source")
    return size <= broadcast_limit(source.sparkSession)


def absent(source: DataFrame, target: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Source rows whose key is not in the target. With a small source the target's keys are first reduced to the
    source's by a broadcast semi join, so the target is not shuffled."""
    known = target.select(*keys)
    if small:
        known = known.join(F.broadcast(source.select(*keys)), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def merge_insert_only(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """Append the source rows whose key is not in the target; existing rows stay as they are."""
    small = check_source(source, keys)
    if target is None:
        return source
    t, s = sync_columns(target, source)
    return t.unionByName(absent(s, target, keys, small).select(*t.columns))


def merge_upsert(
    target: DataFrame | None, source: DataFrame, keys: list[str], condition: list[str] | None = None, keep: list[str] | None = None,
    action: str | None = None, derived: Derived | None = None,
) -> DataFrame:
    """Replace matched rows, insert the others. With ``condition`` a matched row is replaced only if one of those
    columns differs; ``keep`` names columns that retain the target's value. ``target=None`` is the first load. With
    ``action`` every row also tells what was done to it. Columns that ``derived`` gives do not move with the rows."""
    small = check_source(source.drop(*(c for c in (derived("") if derived else {}) if c not in keys)), keys)
    if target is None:
        return source.withColumn(action, F.lit(INSERTED)) if action else source
    t, s = sync_columns(target, source)
    fixed = {*keys, *(keep or [])}
    update = {c: F.col(f"s_{c}") for c in t.columns if c not in fixed}
    insert = {c: F.col(f"s_{c}") for c in t.columns}
    return merge_rows(t, s, keys, update, insert, any_differs(condition) if condition else None, small=small, action=action, derived=derived)


def merge_on_hash(
    target: DataFrame | None, source: DataFrame, keys: list[str], hash_col: str = "dl_rowhash", keep: list[str] | None = None,
    action: str | None = None, derived: Derived | None = None,
) -> DataFrame:
    """Upsert that rewrites a matched row only when its row hash differs; the creation time stays the target's."""
    kept = keep if keep is not None else ["dl_createddateutc"]
    kept = [c for c in kept if target is None or c in target.columns]
    return merge_upsert(target, source, keys, [hash_col], kept, action, derived)


def merge_update_columns(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Null-safe key match, update of the named columns only, no insert."""
    rows = source.select(*keys, *cols)
    most, size = key_profile(rows, keys)
    if most > 1:
        assert_unique(rows, keys, "source")
    small = size <= broadcast_limit(source.sparkSession)
    return merge_rows(target, rows, keys, {c: F.col(f"s_{c}") for c in cols}, None, null_safe=True, small=small)


def update_where(target: DataFrame, cond: Column, values: dict[str, object]) -> DataFrame:
    """Set literals (or expressions) on the rows that satisfy ``cond``."""
    hit = F.coalesce(cond, F.lit(False))
    return target.withColumns({
        c: F.when(hit, v if isinstance(v, Column) else F.lit(v).cast(target.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()
    })


def overwrite_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Delete every target row whose key occurs in the source, then add the source (which may repeat a key). The source's
    keys are measured: few are broadcast and the target is not moved. Null keys match nothing."""
    t, s = sync_columns(target, source)
    gone = source.select(*keys).distinct()
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone
    return t.join(gone, keys, "left_anti").select(*t.columns).unionByName(s)


def capture_deletes(target: DataFrame, snapshot: DataFrame, keys: list[str], flag: str = "is_deleted") -> DataFrame:
    """Flag target rows whose key is missing from a full snapshot: the snapshot's distinct keys decide. Null keys match
    null keys; a flag from an earlier run is replaced."""
    seen = snapshot.select(*keys).distinct().withColumn("_seen", F.lit(True))
    kept = [c for c in target.columns if c != flag]
    return join_null_safe(target, seen, keys, "left").select(*kept, F.col("_seen").isNull().cast("int").alias(flag))


def ensure_unknown_member(dim: DataFrame, key: str, defaults: dict[str, object] | None = None, value: int = -1) -> DataFrame:
    """Guarantee one row with the key ``value``. The extra row is dropped again when the dimension already has one."""
    given = {key: value, **(defaults or {})}
    spark = dim.sparkSession
    row = spark.range(1).select(*[F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    present = dim.filter(F.col(key) == value).select(F.col(key).alias("_have")).limit(1)
    missing = row.join(present, row[key] == present["_have"], "left_anti")
    return dim.unionByName(missing)


def assign_identity(target: DataFrame | None, source: DataFrame, bus_keys: list[str], id_col: str) -> DataFrame:
    """Source rows with their identity: known business keys keep theirs, new ones continue after the largest in
    business-key order."""
    if target is None:
        return dense_number(source, bus_keys, id_col, 1).select(id_col, *source.columns)
    known = target.select(*bus_keys, F.col(id_col).cast("long").alias(id_col)).distinct()
    top = target.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    old = join_null_safe(source, known, bus_keys, "inner")
    fresh = dense_number(join_null_safe(source, known.select(*bus_keys), bus_keys, "left_anti"), bus_keys, id_col, max(top, 0) + 1)
    return old.select(id_col, *source.columns).unionByName(fresh.select(id_col, *source.columns))


class LoadCounts:
    """Rows inserted and updated, counted while a merge with an ``action`` column is written: no second pass, no join.

    ``watch`` wraps the frame to write and takes the column away; ``counts`` is known once that write has ended.
    """

    def __init__(self, action: str):
        self.action, self.seen = action, Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        done = F.col(self.action)
        counts = [F.count(F.lit(1)).alias("rows_total"), *[F.count(F.when(done == kind, 1)).alias(f"rows_{kind}") for kind in (INSERTED, UPDATED)]]
        return df.observe(self.seen, *counts).drop(self.action)

    def counts(self) -> dict[str, int]:
        return {k: int(v or 0) for k, v in self.seen.get.items()}


def merge_metrics(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows inserted, updated and deleted between two states of a table with unique keys; null keys match null
    keys. For states that are at hand without the load that made them, which counts them itself (``LoadCounts``)."""
    cols = [c for c in after.columns if c in before.columns and c not in keys]
    b = before.select(*[F.col(k).alias(f"t_{k}") for k in keys], *[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_b"))
    a = after.select(*[F.col(k).alias(f"s_{k}") for k in keys], *[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_a"))
    both = b.join(a, reduce(lambda x, y: x & y, [b[f"t_{k}"].eqNullSafe(a[f"s_{k}"]) for k in keys]), "full")
    differs = any_differs(cols) if cols else F.lit(False)
    return both.agg(
        F.count(F.when(F.col("_b").isNull(), 1)).alias("rows_inserted"),
        F.count(F.when(F.col("_a") & F.col("_b") & differs, 1)).alias("rows_updated"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("rows_deleted"),
    )


def seed_merge(target: DataFrame | None, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of constant rows; running it again changes nothing."""
    return merge_upsert(target, rows, keys)


def scd2_first(
    source: DataFrame, batch_time: datetime, start: str = "effective_from", end: str = "effective_to", current: str = "is_current"
) -> DataFrame:
    """First versions: open end, current."""
    kind = "timestamp_ntz" if batch_time.tzinfo is None else "timestamp"
    return source.withColumns({start: F.lit(batch_time).cast(kind), end: F.lit(None).cast(kind), current: F.lit(1)})


def scd2_apply(
    target: DataFrame | None, source: DataFrame, keys: list[str], tracked: list[str], batch_time: datetime,
    start: str = "effective_from", end: str = "effective_to", current: str = "is_current",
) -> DataFrame:
    """Type-two history. Same key and same tracked values: nothing. Tracked values differ: the current version ends at
    ``batch_time`` and a new one starts. New key: a first version."""
    small = check_source(source, keys)
    incoming = scd2_first(source, batch_time, start, end, current)
    if target is None:
        return incoming
    t, s = sync_columns(target, incoming)
    changed = (F.col(f"t_{current}") == 1) & any_differs(tracked)
    close = {end: F.lit(batch_time).cast(t.schema[end].dataType), current: F.lit(0).cast(t.schema[current].dataType)}
    closed = merge_rows(t, source.select(*keys, *tracked), keys, close, None, changed, small=small)
    same = t.filter(F.col(current) == 1).select(*keys, *tracked)
    if small:  # only the current versions of the incoming keys matter
        same = same.join(F.broadcast(source.select(*keys)), keys, "left_semi")
    return closed.unionByName(_not_identical(s, same, keys, tracked))


def _not_identical(source: DataFrame, current: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    other = current.select(*[F.col(c).alias(f"_o_{c}") for c in current.columns])
    on = [source[k] == other[f"_o_{k}"] for k in keys] + [source[c].eqNullSafe(other[f"_o_{c}"]) for c in tracked]
    return source.join(other, reduce(lambda a, b: a & b, on), "left_anti")


# Change-feed operation codes (fixed values): 1 delete, 2 insert, 3 before-image, 4 update.
OP_DELETE, OP_INSERT, OP_BEFORE, OP_UPDATE = 1, 2, 3, 4


def cdc_latest(changes: DataFrame, keys: list[str], lsn: str, seq: str) -> DataFrame:
    """The last change of each key by (lsn, seq)."""
    return latest_per_key(changes, keys, [F.col(lsn).desc(), F.col(seq).desc()])


def cdc_net_changes(changes: DataFrame, keys: list[str], op: str, lsn: str, seq: str, last_lsn=None) -> DataFrame:
    """Net changes after ``last_lsn``: before-images dropped, the last change per key, ``is_deleted`` = delete."""
    rows = changes.filter(F.col(op).isin(OP_DELETE, OP_INSERT, OP_UPDATE))
    if last_lsn is not None:
        rows = rows.filter(F.col(lsn) > lit_like(rows, lsn, last_lsn))
    return cdc_latest(rows, keys, lsn, seq).withColumn("is_deleted", (F.col(op) == OP_DELETE).cast("int"))


def cdc_apply(
    target: DataFrame, changes: DataFrame, keys: list[str], batch_time: datetime, op: str, lsn: str, seq: str, last_lsn=None,
) -> DataFrame:
    """Apply a change feed. Inserts and updates upsert (a matched row is rewritten when a business column differs or
    the row was deleted); a delete only flags the existing row and keeps its values; a delete of an unknown key does
    nothing. The feed's own columns are not stored. Several changes of a key in one batch count as their last one.
    """
    missing = {"dl_is_deleted", "dl_iscurrent", "dl_lastmodifiedutc"} - set(target.columns)
    if missing:
        raise ValueError(f"the target lacks {', '.join(sorted(missing))}")
    # The merge reads the net feed several times; it is worked out and written once.
    net = cut(cdc_net_changes(changes, keys, op, lsn, seq, last_lsn).drop(lsn, seq, "is_deleted"), "net")
    business = [c for c in net.columns if c not in (op, *keys)]
    t, _ = sync_columns(target, net.drop(op))
    gone = F.col(f"s_{op}") == OP_DELETE
    stamp = F.lit(batch_time).cast(t.schema["dl_lastmodifiedutc"].dataType)
    differs = any_differs(business) | (F.col("t_dl_is_deleted") == 1)
    update = {c: F.when(gone, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")) for c in business}
    update |= {"dl_is_deleted": gone.cast("int"), "dl_iscurrent": (~gone).cast("int"), "dl_lastmodifiedutc": stamp}
    born = {"dl_is_deleted": F.lit(0), "dl_iscurrent": F.lit(1), "dl_lastmodifiedutc": stamp, "dl_createddateutc": stamp, "dl_recordstartdateutc": stamp}
    insert = {
        c: F.col(f"s_{c}") if c in (*keys, *business) else born.get(c, F.lit(None)).cast(t.schema[c].dataType)
        for c in t.columns
    }
    matched = F.when(gone, F.col("t_dl_is_deleted") == 0).otherwise(differs)
    # A delete without a target row is not inserted.
    return merge_rows(t, net, keys, update, insert, matched, insert_when=~gone)
