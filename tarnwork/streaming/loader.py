"""Micro-batch loads: the load strategies inside ``foreachBatch``.

``foreachBatch`` may hand over a batch again after a failure. Every batch therefore writes a folder or version named by
its id and reads only what smaller ids left, so a repeat gives the same result.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnwork.operators.joins import scd2_join
from tarnwork.operators.merge import absent, check_source, merge_insert_only, merge_upsert, scd2_apply, sync_columns
from tarnwork.operators.runlog import finish_rollup, ingestion_log, merge_states, parse_messages, rollup_state
from tarnwork.session import scratch
from tarnwork.sources.buckets import BUCKETS, BucketTable
from tarnwork.sources.runs import read_file, write_file
from tarnwork.sources.writer import path_exists, publish

Transform = Callable[[DataFrame], DataFrame]


def trigger_options(name: str) -> dict:
    """Trigger by config name. Bounded modes all run as ``availableNow``; continuous polls every five seconds."""
    kinds = {
        "availablenow": {"availableNow": True}, "once": {"availableNow": True}, "batch": {"availableNow": True},
        "continuous": {"processingTime": "5 seconds"},
    }
    try:
        return kinds[name.lower()]
    except KeyError:
        raise ValueError(f"unknown trigger {name!r}") from None


def compose(*steps: Transform) -> Transform:
    """One transform that runs the given ones in order."""
    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = step(df)
        return df

    return run


def batch_load(
    target: DataFrame | None, source: DataFrame, strategy: str, keys: list[str] | None = None, steps: Transform | None = None
) -> DataFrame:
    """The batch twin: overwrite, append_all, append_new or merge; type two is refused and an unknown name appends."""
    rows = steps(source) if steps else source
    if strategy == "scd2":
        raise ValueError("scd2 is not supported for batch loads")
    if target is None or strategy == "overwrite":
        return rows
    if strategy == "append_new":
        return merge_insert_only(target, rows, keys)
    if strategy == "merge":
        return merge_upsert(target, rows, keys, [c for c in rows.columns if c not in keys])
    t, s = sync_columns(target, rows)
    return t.unionByName(s)


def read_batches(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """Rows of an append-only stream table, optionally of the batches before ``below``."""
    if not path_exists(spark, path):
        return None
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if below is not None:
        df = df.filter(F.col("batch_id") < below)
    return df.drop("batch_id")


def _append(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a table that ``append_new``, ``merge`` or ``scd2`` loads, as of its newest version."""
    return BucketTable(spark, path).read()


def time_range(spark: SparkSession, path: str, batch_id: int, batch: DataFrame, time_col: str) -> tuple[datetime | None, datetime | None]:
    """The first and last time of a batch's rows, noted under ``path`` the first time the batch comes: one that is handed
    over again gets the same answer, whatever its source holds by then."""
    note = f"{path}/_batches/{batch_id}.json"
    if not path_exists(spark, note):
        found = batch.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi"), F.count(F.lit(1)).alias("n")).first()
        lo, hi = (None if v is None else v.isoformat() for v in (found["lo"], found["hi"]))
        write_file(spark, note, json.dumps({"batch": batch_id, "from": lo, "to": hi, "rows": found["n"]}))
    kept = json.loads(read_file(spark, note))
    return tuple(None if kept[k] is None else datetime.fromisoformat(kept[k]) for k in ("from", "to"))


def load_batch(
    batch: DataFrame, batch_id: int, strategy: str, path: str, keys: list[str] | None = None, tracked: list[str] | None = None,
    batch_time: datetime | None = None, buckets: int = BUCKETS,
) -> None:
    """Apply one micro-batch to the table at ``path``; a batch that is handed over again changes nothing.

    ``append_all`` adds a folder and ``overwrite`` writes a new version. ``append_new``, ``merge`` and ``scd2`` read and
    write only the buckets that the batch's keys fall into; files of versions that no repeated batch can need are removed.
    """
    spark = batch.sparkSession
    if strategy == "append_all":
        _append(batch, path, batch_id)
    elif strategy == "overwrite":
        if not batch.isEmpty():
            publish(batch, path, version=batch_id)
    elif strategy in ("append_new", "merge", "scd2"):
        if strategy == "scd2" and batch_time is None:
            raise ValueError("scd2 needs batch_time: a repeated batch must get the same time")
        others = [c for c in batch.columns if c not in keys]

        def merge(held: DataFrame | None, source: DataFrame) -> DataFrame:
            if strategy == "append_new":
                small = check_source(source, keys)
                return source if held is None else absent(source, held, keys, small)
            if strategy == "merge":
                return merge_upsert(held, source, keys, others)
            return scd2_apply(held, source, keys, tracked or others, batch_time)

        table = BucketTable(spark, path, keys, buckets)
        table.load(batch, batch_id, merge, append=strategy == "append_new")
        table.expire()
    else:
        raise ValueError(f"unknown load strategy {strategy!r}")


def stream_load(
    stream: DataFrame, strategy: str, path: str, checkpoint: str, keys: list[str] | None = None, trigger: str = "availableNow",
    steps: Transform | None = None, tracked: list[str] | None = None, time_col: str | None = None,
    batch_time: Callable[[datetime, datetime], datetime] | None = None, buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start a streaming load. The per-batch ``steps`` run first, in order; progress lives in ``checkpoint``.

    ``batch_time`` gives a batch's time from the first and last ``time_col`` of its rows (before the steps); a batch
    without any time is an error for type two. What a batch writes in between is removed at its end.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            when = None
            if batch_time is not None:
                lo, hi = time_range(spark, path, batch_id, batch, time_col)
                when = batch_time(lo, hi) if hi is not None else None
            load_batch(steps(batch) if steps else batch, batch_id, strategy, path, keys, tracked, when, buckets)

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger)).start()


def stream_run_logs(stream: DataFrame, log_path: str, rollup_path: str, checkpoint: str, trigger: str = "availableNow", column: str = "value", buckets: int = BUCKETS) -> StreamingQuery:
    """Run-log messages to the flat log and the roll-up per run and zone.

    The log is append-only. The roll-up is kept as states that can be merged: a batch's own states join those held for
    its runs, and no earlier log is read. ``read_rollup`` gives the roll-up.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            _append(ingestion_log(parse_messages(batch, column)), log_path, batch_id)
            own = rollup_state(spark.read.parquet(f"{log_path}/batch_id={batch_id}"))
            table = BucketTable(spark, rollup_path, ["run_id", "zone"], buckets)
            table.load(own, batch_id, lambda held, new: merge_states(new if held is None else held.unionByName(new)))
            table.expire()

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger)).start()


def read_rollup(spark: SparkSession, path: str) -> DataFrame | None:
    """The roll-up per run and zone that ``stream_run_logs`` keeps."""
    states = BucketTable(spark, path).read()
    return None if states is None else finish_rollup(states)


def stream_versioned_facts(
    stream: DataFrame, dim: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str, start: str, end: str, values: list[str],
    fallback: str | None = "latest", trigger: str = "availableNow",
) -> StreamingQuery:
    """Streaming facts against a versioned dimension: the batch form of the temporal join per micro-batch."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _append(scd2_join(batch, dim, keys, ts, start, end, values, fallback), path, batch_id)

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger_options(trigger)).start()
