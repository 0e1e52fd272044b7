"""Streaming loads: all events, replayed in slices of their time."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tarnwork.operators.windows import latest_per_key
from tarnwork.queries.catalog import MESSAGES_SQL, messages
from tarnwork.queries.joins import HIT, VERSIONS, signup_versions
from tarnwork.queries.registry import query
from tarnwork.session import cut, run_dir
from tarnwork.sources.files import read_stream
from tarnwork.sources.writer import load_append
from tarnwork.streaming import loader

START = datetime(2024, 1, 1)
BUCKETS = 16  # of the small tables made here
WEEK_SQL = "CAST(floor(CAST(datediff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) AS DOUBLE) / 7) AS INTEGER)"


def week_of(ts):
    return F.floor(F.datediff(ts, F.lit(START.date())) / 7).cast("int")


def replay(t, df, start, fmt="parquet"):
    """Append ``df`` to a folder week by week and after each week run the stream that ``start`` opens on it: one
    micro-batch per week that has rows, each continuing from the checkpoint of the one before. Rows without a time come
    first."""
    path = run_dir(t.spark, "feed")
    week = week_of(F.col("ts"))
    weeks = sorted((r[0] for r in df.select(week).distinct().collect()), key=lambda w: (w is not None, w))
    for w in weeks:
        part = df.filter(week.eqNullSafe(F.lit(w)))
        if fmt == "text":
            part.select("value").write.mode("append").text(path)
        else:
            load_append(part, path)
        start(read_stream(t.spark, path, fmt, "value string" if fmt == "text" else df.schema)).awaitTermination()


def week_end(lo, hi):
    """The end of the week of a batch's last row."""
    return START + timedelta(days=7 * ((hi - START).days // 7 + 1))


def last_per(*keys):
    return lambda df: latest_per_key(df, list(keys), [F.col("ts").desc(), F.col("event_id").desc()])


COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


@query("stream_merge", """
    SELECT user_id, event_id, event_type, value, 'loaded' AS note FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_merge(t):
    """Latest event per user, merged batch by batch; the per-batch steps deduplicate, then add a column."""
    path, checkpoint = run_dir(t.spark, "table"), run_dir(t.spark, "checkpoint")
    steps = loader.compose(last_per("user_id"), lambda df: df.withColumn("note", F.lit("loaded")))
    replay(t, t.events.select(*COLUMNS), lambda s: loader.stream_load(s, "merge", path, checkpoint, ["user_id"], "availableNow", steps, buckets=BUCKETS))
    return loader.read_table(t.spark, path).select("user_id", "event_id", "event_type", "value", "note")


@query("stream_append_new", """
    SELECT user_id, event_type, w AS first_week FROM (SELECT user_id, event_type, MIN(""" + WEEK_SQL + """) AS w FROM events GROUP BY user_id, event_type)""")
def stream_append_new(t):
    """First week in which a user shows an event type; later batches add unseen keys only."""
    path, checkpoint = run_dir(t.spark, "table"), run_dir(t.spark, "checkpoint")
    steps = loader.compose(last_per("user_id", "event_type"), lambda df: df.select("user_id", "event_type", week_of("ts").alias("first_week")))
    replay(t, t.events.select(*COLUMNS), lambda s: loader.stream_load(s, "append_new", path, checkpoint, ["user_id", "event_type"], "once", steps, buckets=BUCKETS))
    return loader.read_table(t.spark, path)


@query("stream_scd2", f"""
    WITH s AS (SELECT * FROM (SELECT user_id, event_type, value, {WEEK_SQL} AS w, ROW_NUMBER() OVER (PARTITION BY user_id, {WEEK_SQL} ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
         c AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY w) AS before FROM s), v AS (SELECT *, TIMESTAMP '2024-01-08' + to_days(7 * w) AS effective_from FROM c WHERE before IS NULL OR before <> event_type)
    SELECT user_id, event_type, value, effective_from, LEAD(effective_from) OVER (PARTITION BY user_id ORDER BY w) AS effective_to, CASE WHEN LEAD(w) OVER (PARTITION BY user_id ORDER BY w) IS NULL THEN 1 ELSE 0 END AS is_current FROM v""")
def stream_scd2(t):
    """Weekly type-two versions of each user's latest event type; a batch's time comes from its rows."""
    path, checkpoint = run_dir(t.spark, "table"), run_dir(t.spark, "checkpoint")
    steps = loader.compose(last_per("user_id"), lambda df: df.select("user_id", "event_type", "value"))
    replay(t, t.events.select(*COLUMNS), lambda s: loader.stream_load(
        s, "scd2", path, checkpoint, ["user_id"], "batch", steps, ["event_type"], "ts", week_end, BUCKETS
    ))
    return loader.read_table(t.spark, path).select("user_id", "event_type", "value", "effective_from", "effective_to", "is_current")


@query("stream_run_logs", f"""
    SELECT concat('run-', CAST(user_id AS VARCHAR)) AS run_id, zone, MIN(CASE WHEN event_type <> 'signup' THEN ts END) AS zone_start, MAX(CASE WHEN event_type <> 'signup' THEN ts END) AS zone_end,
           CASE WHEN bool_or(failed) THEN 'Failed' ELSE 'Success' END AS zone_status, CAST(CASE WHEN bool_or(failed) THEN 0 ELSE SUM(k) END AS BIGINT) AS total_size FROM ({MESSAGES_SQL}) GROUP BY user_id, zone""")
def stream_run_logs(t):
    log, rollup, checkpoint = run_dir(t.spark, "log"), run_dir(t.spark, "rollup"), run_dir(t.spark, "checkpoint")
    timed = messages(t).join(t.events.select("event_id", "ts"), "event_id")
    replay(t, timed, lambda s: loader.stream_run_logs(s, log, rollup, checkpoint, buckets=BUCKETS), fmt="text")
    out = loader.read_rollup(t.spark, rollup)
    return out.select("run_id", "zone", F.col("zone_start").cast("timestamp_ntz").alias("zone_start"), F.col("zone_end").cast("timestamp_ntz").alias("zone_end"), "zone_status", "total_size")


@query("stream_late_fact", f"""
    WITH {VERSIONS}, {HIT}, latest AS (SELECT user_id, plan FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY v_start DESC) AS rn FROM versions) WHERE rn = 1)
    SELECT h.event_id, h.user_id, h.ts, h.value, CASE WHEN h.v_start IS NOT NULL THEN h.plan ELSE l.plan END AS plan FROM hit h LEFT JOIN latest l ON h.user_id = l.user_id""")
def stream_late_fact(t):
    path, checkpoint = run_dir(t.spark, "facts"), run_dir(t.spark, "checkpoint")
    dim = cut(signup_versions(t), "versions")
    facts = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    replay(t, facts, lambda s: loader.stream_versioned_facts(s, dim, path, checkpoint, ["user_id"], "ts", "v_start", "v_end", ["plan"]))
    return loader.read_batches(t.spark, path)
