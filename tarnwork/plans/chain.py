"""Transform documents: named sources, a chain of SQL queries, a target with a load strategy."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tarnwork.functions.columns import mask_to_null
from tarnwork.operators.keys import join_null_safe
from tarnwork.operators.merge import assign_identity, ensure_unknown_member, merge_upsert, overwrite_by_key, scd2_apply, sync_columns
from tarnwork.operators.quality import quarantine
from tarnwork.operators.windows import QUARANTINE_ALL, dense_number, mark_duplicates
from tarnwork.session import cut, scratch
from tarnwork.sources.extracts import incremental_source
from tarnwork.sources.runs import Runs

STRATEGIES = {"type_two", "merge", "overwrite", "append", "overwrite_by_key"}
TARGET_OPTIONS = {
    "lakehouse", "schema", "table", "load_strategy", "key_columns", "unknown_record", "identity", "identity_column_name", "partition_by", "pii_columns",
    "quarantine_strategy",
}
QUARANTINES = {"merge", "append"}
MODIFIED = "dl_lastmodifiedutc"
# Outputs of a run.
TARGET, QUARANTINE = "target", "quarantine"


def load_spec(text: str) -> dict:
    """A transform document from YAML text."""
    try:
        import yaml
    except ImportError as err:
        raise RuntimeError("PyYAML is needed to read transform documents") from err
    return check_spec(yaml.safe_load(text))


def check_spec(spec: dict) -> dict:
    """The document, or an error that names what is missing."""
    target = spec.get("target") or {}
    for name in ("lakehouse", "schema", "table", "load_strategy"):
        if not target.get(name):
            raise ValueError(f"target.{name} is required")
    if unknown := sorted(set(target) - TARGET_OPTIONS):
        raise ValueError(f"unknown target options {unknown}")
    strategy = target["load_strategy"]
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown load strategy {strategy!r}")
    keys = target.get("key_columns") or []
    if strategy not in ("overwrite", "append") and not keys:
        raise ValueError(f"{strategy} needs key_columns")
    if target.get("quarantine_strategy") is not None:
        if target["quarantine_strategy"] not in QUARANTINES:
            raise ValueError(f"unknown quarantine strategy {target['quarantine_strategy']!r}")
        if not keys:
            raise ValueError("quarantine_strategy needs key_columns")
    if target.get("unknown_record") and not target.get("identity") and len(keys) != 1:
        raise ValueError("unknown_record needs an identity or a single key column")
    if not spec.get("query"):
        raise ValueError("at least one query is required")
    return spec


def run_queries(spark: SparkSession, spec: dict, resolver: Callable[[dict], DataFrame], since=None) -> DataFrame:
    """Register the sources, run the queries in order, each visible to the next; the last one's rows.

    The views exist only while the chain is analysed; the returned frame no longer needs them.
    """
    names = []
    try:
        for source in spec.get("source") or []:
            df = resolver(source)
            if source.get("incremental"):
                df = incremental_source(df, MODIFIED, since)
            df.createOrReplaceTempView(source["name"])
            names.append(source["name"])
        for query in spec["query"]:
            result = spark.sql(query["sql"]).drop(*(query.get("drop") or []))
            result.createOrReplaceTempView(query["name"])
            names.append(query["name"])
        return result
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def identity_name(target: dict) -> str | None:
    return (target.get("identity_column_name") or f"{target['table']}_key") if target.get("identity") else None


def load_target(target: dict, existing: DataFrame | None, rows: DataFrame, batch_time: datetime, strategy: str | None = None) -> DataFrame:
    """The target's new state: identity, load strategy, unknown member.

    Without an identity the unknown member is the row whose only key is -1, which needs a key of a number type.
    """
    how = strategy or target["load_strategy"]
    keys = target.get("key_columns") or []
    # The chain's joins run once: identity and key checks below read the rows several times.
    rows = cut(mask_to_null(rows, target.get("pii_columns") or []), "chain")
    identity = identity_name(target)
    if how == "type_two":
        out = scd2_apply(existing.drop(identity) if existing is not None and identity else existing, rows, keys,
                         [c for c in rows.columns if c not in keys], batch_time)
        if identity:
            out = cut(out, "versions")
            # A version is identified by its key and start, so each new version gets a number of its own.
            known = existing.select(identity, *keys, "effective_from") if existing is not None else None
            out = assign_identity(known, out, [*keys, "effective_from"], identity)
    else:
        if identity and how == "append":
            # Every appended row is a new member, also one with a key that is there already.
            last = existing.agg(F.max(identity)).first()[0] if existing is not None else None
            rows = dense_number(rows, keys or rows.columns, identity, max(last or 0, 0) + 1).select(identity, *rows.columns)
        elif identity:
            rows = assign_identity(existing, rows, keys or rows.columns, identity)
        if existing is None or how == "overwrite":
            out = rows
        elif how == "append":
            t, s = sync_columns(existing, rows)
            out = t.unionByName(s)
        elif how == "overwrite_by_key":
            out = overwrite_by_key(existing, rows, keys)
        else:
            out = merge_upsert(existing, rows, keys)
    if target.get("unknown_record"):
        member = identity or keys[0]
        if not isinstance(out.schema[member].dataType, NumericType):
            raise ValueError(f"the unknown member needs a number in {member!r}")
        out = ensure_unknown_member(out, member)
    return out


def split_repeated(target: dict, rows: DataFrame, run_id: str, when: datetime) -> tuple[DataFrame, DataFrame | None]:
    """The rows to load, and those to quarantine: with a ``quarantine_strategy``, all rows of a key that repeats (which
    would otherwise stop the load)."""
    if target.get("quarantine_strategy") is None or target["load_strategy"] in ("append", "overwrite_by_key"):
        return rows, None
    marked = cut(mark_duplicates(rows, target["key_columns"], QUARANTINE_ALL, out="dq_copy"), "marked")
    return marked.filter("NOT dq_copy").drop("dq_copy"), quarantine(marked.filter("dq_copy").drop("dq_copy"), run_id, when)


def run_chain(
    spark: SparkSession, spec: dict, resolver: Callable[[dict], DataFrame], existing: DataFrame | None, batch_time: datetime, since=None
) -> DataFrame:
    """Queries plus load: the new state of the target table."""
    check_spec(spec)
    return load_target(spec["target"], existing, run_queries(spark, spec, resolver, since), batch_time)


def load_chain(spark: SparkSession, spec: dict, resolver: Callable[[dict], DataFrame], path: str, batch_time: datetime, run_id: str) -> Runs:
    """Run a document and store what comes of it under ``path`` as one run: the target, partitioned by ``partition_by``,
    and the quarantine.

    Incremental sources are read from the start of the last run that ended. The ``merge`` quarantine holds each row once,
    however often a run meets it, the ``append`` one every time. A run that fails leaves the table, the quarantine and
    that time as they were; intermediate tables are removed at the end of a run.
    """
    target = check_spec(spec)["target"]
    runs = Runs(spark, path)
    with scratch(spark):
        run = runs.begin()
        rows, repeated = split_repeated(target, run_queries(spark, spec, resolver, run.state.get("since")), run_id, batch_time)
        run.write(TARGET, load_target(target, runs.read(TARGET), rows, batch_time), parts=target.get("partition_by"))
        if repeated is not None:
            repeated = mask_to_null(repeated, target.get("pii_columns") or [])
            held = runs.read(QUARANTINE)
            if target["quarantine_strategy"] == "merge" and held is not None:
                what = [c for c in repeated.columns if c in rows.columns]
                repeated = join_null_safe(repeated, held.select(*what).distinct(), what, "left_anti")
            run.write(QUARANTINE, repeated, append=True)
        run.commit(since=batch_time)
    return runs
