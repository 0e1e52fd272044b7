"""Hierarchies from parent pointers, of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.session import cut

# What became of a row's way to the root.
COMPLETE, TOO_DEEP, CYCLE, NO_ROOT = "complete", "too deep", "cycle", "no root"


def climbed(rows: DataFrame, code: str, parent: str, levels: int) -> DataFrame:
    """``_at, _tail, _n, _end`` for every code that is somebody's parent: the last ``levels`` codes on its way to the root
    (the root last, itself included), the number of all codes on it, and how the way ends.

    Pointer doubling: each round replaces every pointer by the pointer of what it points to, so a way of ``d`` steps takes
    about the binary logarithm of ``d`` rounds, not ``d``. Rounds are written, as each reads the one before twice. Ways that
    have not ended after as many rounds as the number of parents has binary digits go round in a circle. A row holds
    ``levels`` codes at most, however deep the hierarchy.
    """
    parents = rows.select(F.col(parent).alias("_at")).filter("_at IS NOT NULL").distinct()
    links = rows.select(F.col(code).alias("_code"), F.col(parent).alias("_up")).distinct()
    known = parents.join(links, parents["_at"] == links["_code"], "left")
    end = F.when(F.col("_code").isNull(), NO_ROOT).when(F.col("_up").isNull(), COMPLETE)
    now = cut(known.select("_at", F.col("_up"), F.array("_at").alias("_tail"), F.lit(1).cast("long").alias("_n"), end.alias("_end")), "climb")
    size = now.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_end").isNull(), 1)).alias("open")).first()
    still, rounds = size["open"], int(size["n"]).bit_length()
    while still and rounds:
        ahead = now.select(F.col("_at").alias("_key"), *[F.col(c).alias(f"o{c}") for c in ("_up", "_tail", "_n", "_end")])
        open_ = now.filter("_end IS NULL").join(ahead, F.col("_up") == F.col("_key"))
        joined = F.concat("_tail", "o_tail")
        kept = F.slice(joined, F.greatest(F.size(joined) - levels, F.lit(0)) + 1, F.lit(levels))
        further = open_.select("_at", F.col("o_up").alias("_up"), kept.alias("_tail"), (F.col("_n") + F.col("o_n")).alias("_n"), F.col("o_end").alias("_end"))
        now = cut(now.filter("_end IS NOT NULL").unionByName(further), "climb")
        still, rounds = now.filter("_end IS NULL").count(), rounds - 1
    return now.select("_at", "_tail", "_n", F.coalesce("_end", F.lit(CYCLE)).alias("_end"))


def hierarchy_paths(rows: DataFrame, code: str, parent: str, levels: int) -> DataFrame:
    """The rows with their path ``l0_level`` … (the top ancestor first, null below the row's own level), ``level_count``
    (how many levels the way to the root has, the row's own included; null where there is no root) and
    ``hierarchy_state``: ``complete``, ``too deep`` (more than ``levels``), ``cycle`` (on a circle or below one) or
    ``no root`` (an ancestor is no code). Only complete rows have a path.

    Only codes that are somebody's parent climb; the rows themselves, mostly leaves, are joined to their parent's way
    once. A code with two parents has a way, and a row, for each. Null codes are leaves.
    """
    ways = climbed(rows, code, parent, levels)
    out = rows.join(ways, rows[parent] == ways["_at"], "left")
    own = F.array(F.col(code))
    whole = F.reverse(F.concat(own, F.coalesce("_tail", F.slice(own, 1, 0))))
    depth = F.when(F.col(parent).isNull(), F.lit(1).cast("long")).when(F.col("_end") == COMPLETE, F.col("_n") + 1)
    state = F.when(depth > levels, TOO_DEEP).when(depth.isNotNull(), COMPLETE).otherwise(F.col("_end"))
    paths = {f"l{i}_level": F.when((state == COMPLETE) & (depth > i), F.get(whole, F.lit(i))) for i in range(levels)}
    told = out.withColumns({**paths, "level_count": depth, "hierarchy_state": state})
    return told.select(*rows.columns, *paths, "level_count", "hierarchy_state")
