"""Config-driven ingest: project, stamp, deduplicate, check rules, load, count, and keep what came of it.

A batch is worked out and written once, with a mark for each row that duplicates put out and a flag per rule, but without
the technical columns and the row hash, which follow from the rest. Everything else reads that batch: the rows to load, the quarantine, its log, the rule metrics and the next high-water mark, so a
source that grows meanwhile changes nothing. ``ingest_table`` stores all of it as one run (``sources.runs``).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.functions.columns import add_technical_columns, lit_like, project, row_hash, technical_values, validate_keys
from tarnwork.operators.merge import INSERTED, Derived, LoadCounts, merge_on_hash, sync_columns
from tarnwork.operators.quality import UNIQUE_RULES, Rule, drop_rule_flags, judge, quarantine, quarantine_log, rules_succeeded, with_rule_flags
from tarnwork.operators.windows import RETAIN_ALL, RETAIN_ONE, mark_duplicates
from tarnwork.session import cut, scratch
from tarnwork.sources.extracts import advance_watermark
from tarnwork.sources.runs import Runs

LOAD_TYPES = {"merge", "overwrite", "append"}
COPY, MARK, ACTION = "dq_copy", "dl_mark", "dl_action"
# Outputs of a run.
TARGET, QUARANTINE, LOG, RULES, METRICS = "target", "quarantine", "quarantine_log", "rule_metrics", "load_metrics"


@dataclass
class Batch:
    """A batch that stands still: all rows with their marks, cut into what is loaded and what is not."""

    rows: DataFrame
    columns: list[str]
    keys: list[str]
    rules: list[Rule]
    policy: str | None
    clean: DataFrame
    duplicates: DataFrame
    failed: DataFrame
    rule_metrics: DataFrame
    derived: Derived

    @property
    def accepted(self) -> bool:
        """Whether every rule succeeded."""
        return not self.rules or rules_succeeded(self.rule_metrics)


def check_config(config: dict) -> dict:
    """Validated settings of the curated step."""
    props = config.get("curatedProperties") or {}
    kind = props.get("targetLoadType", "merge")
    if kind not in LOAD_TYPES:
        raise ValueError(f"unknown targetLoadType {kind!r}")
    keys = props.get("primaryKeyList") or []
    if (kind == "merge" or props.get("duplicateCheckEnabled")) and not keys:
        raise ValueError("primaryKeyList is required for merge and for the duplicate check")
    return props


def prepare(
    config: dict, source: DataFrame, batch_time: datetime, elt_id: str, run_id: str, rules: list[Rule] | None = None, order: list[Column] | None = None,
    mark: str | None = None,
) -> Batch:
    """Work a batch out and write it once. ``order`` picks the survivor of a duplicate key. ``mark``, an expression over
    the source, is kept for the high-water mark, also where the projection leaves its columns out."""
    props, rules = check_config(config), rules or []
    exprs = [*(props.get("columnList") or ["*"]), *([f"({mark}) AS {MARK}"] if mark else [])]
    plain = project(source, exprs)
    keys = validate_keys(plain, props.get("primaryKeyList") or [], required=False)
    same = technical_values(batch_time, elt_id, run_id)
    policy = props.get("duplicateCheckQuarantineType", RETAIN_ONE) if props.get("duplicateCheckEnabled") else None
    rows = plain
    if policy:
        # Sorting moves the rows, so the technical columns come later unless the order needs them.
        if not (order and _orders(plain, order)):
            rows = add_technical_columns(plain, batch_time, elt_id, run_id)
        rows = mark_duplicates(rows, keys, policy, order or [F.col("dl_rowhash")], COPY)
    else:
        rows = rows.withColumn(COPY, F.lit(False))

    def derived(prefix: str = "") -> dict[str, Column]:
        return {"dl_rowhash": row_hash(plain, prefix=prefix), **same}

    stays = F.lit(True) if policy == RETAIN_ALL else ~F.col(COPY)
    if any(r.type in UNIQUE_RULES for r in rules):
        rows = cut(rows.drop(*derived()), "deduplicated")  # such a rule counts keys first
    # What is the same for all rows is not written with them, nor is their hash, which is larger than most rows.
    rows = cut(with_rule_flags(rows.withColumns(derived()), rules, stays).drop(*derived()), "batch").withColumns(derived())
    columns = [*(c for c in plain.columns if c != MARK), "dl_rowhash", *same]
    clean, failed, metrics = judge(rows.filter(stays), rules, columns)
    return Batch(rows, columns, keys, rules, policy, clean, drop_rule_flags(rows.filter(COPY)).select(*columns), failed, metrics, derived)


def _orders(df: DataFrame, order: list[Column]) -> bool:
    """Whether all columns of an order are there."""
    try:
        return bool(df.orderBy(*order).columns)
    except AnalysisException:
        return False


def load_plan(config: dict, batch: Batch, target: DataFrame | None) -> DataFrame:
    """The rows to write, with ``dl_action``: the table's next state, or for an append the added rows alone."""
    kind = check_config(config).get("targetLoadType", "merge")
    if kind == "merge" and target is not None:
        return merge_on_hash(target, batch.clean, batch.keys, action=ACTION, derived=batch.derived)
    rows = batch.clean
    if kind == "append" and target is not None:
        rows = sync_columns(target, rows)[1]
    return rows.withColumn(ACTION, F.lit(INSERTED))


def quarantined(batch: Batch, run_id: str, when: datetime) -> DataFrame:
    """All rows of the batch that are not loaded, and why: duplicates (also reported ones that stay), broken rules."""
    twice = batch.duplicates.withColumns({"quarantine_type": F.lit("Duplicate"), "failed_rules": F.lit(None).cast("string")})
    broken = batch.failed.withColumn("quarantine_type", F.lit("Rule"))
    return quarantine(twice.unionByName(broken), run_id, when)


def ingest_table(
    spark: SparkSession, config: dict, source: DataFrame, path: str, batch_time: datetime, elt_id: str, run_id: str,
    rules: list[Rule] | None = None, order: list[Column] | None = None, mark: str | None = None, stop_on_failure: bool = True, names: dict | None = None,
) -> Runs:
    """Ingest a batch into the table under ``path`` as one run: target, quarantine, its log, rule metrics, load metrics
    and the high-water mark of the column ``mark`` count together once the run's marker exists, and not before.

    Rows that break a rule or are duplicates are quarantined. When a rule fails and ``stop_on_failure`` is set, the table
    and the mark stay as they are and the rest is stored. ``names`` (product, feed, source_system, dataset) describe the
    batch in the log. Read the outputs with ``Runs.read`` and the mark with ``Runs.state()["mark"]``. Intermediate tables
    are removed at the end; after a failure they stay.
    """
    runs, props = Runs(spark, path), check_config(config)
    with scratch(spark):
        run = runs.begin()
        before = run.state.get("mark")
        if mark and before is not None:
            source = source.filter(F.expr(mark) > lit_like(source, mark, before))
        batch = prepare(config, source, batch_time, elt_id, run_id, rules, order, mark)
        loaded = not stop_on_failure or batch.accepted
        kind, held = props.get("targetLoadType", "merge"), runs.read(TARGET)
        tally = LoadCounts(ACTION)
        about = {"product": "", "feed": "", "source_system": "", "dataset": path.rsplit("/", 1)[-1]} | (names or {})
        entries = [quarantine_log(df, run_id=run_id, keys=batch.keys, when=batch_time, kind=why, **about) for df, why in ((batch.duplicates, "Duplicate"), (batch.failed, "Rule"))]
        # All of them read the batch that stands still, so they are written side by side.
        writes = [(QUARANTINE, quarantined(batch, run_id, batch_time), True, None), (LOG, entries[0].unionByName(entries[1]).filter("total_rows > 0"), True, None)]
        if batch.rules:
            writes.append((RULES, batch.rule_metrics.withColumns({"elt_id": F.lit(elt_id), "run_id": F.lit(run_id)}), True, None))
        if loaded:
            writes.insert(0, (TARGET, tally.watch(load_plan(config, batch, held)), kind == "append", props.get("partitionKeyList")))
        run.write_all(writes)

        state, counts = {}, {"rows_inserted": 0, "rows_updated": 0, "rows_deleted": 0}
        if loaded:
            found = tally.counts()
            counts |= {k: found[k] for k in ("rows_inserted", "rows_updated")}
            if kind == "overwrite":
                counts["rows_deleted"] = run.state.get("rows_total", 0)
            state["rows_total"] = found["rows_total"] + (run.state.get("rows_total", 0) if kind == "append" else 0)
            if mark:
                # Of all rows of the batch, also the quarantined ones: they have been dealt with.
                state["mark"] = advance_watermark(batch.rows, MARK, before).first()[0]
        metrics = batch.rows.agg(F.count(F.lit(1)).alias("source_rows"), F.count(F.when(F.col(COPY), 1)).alias("duplicate_rows")).select(
            F.lit(elt_id).alias("elt_id"), F.lit(run_id).alias("run_id"), F.lit(batch_time).alias("batch_time"), F.lit(loaded).alias("success"),
            "source_rows", "duplicate_rows", *[F.lit(n).cast("long").alias(k) for k, n in counts.items()],
        )
        run.write(METRICS, metrics, append=True)
        run.commit(**state)
    return runs
