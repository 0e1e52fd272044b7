"""Tables of buckets, batches by the time of their rows, and mergeable run-log states."""

import os
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import SF, rows
from oracle import compare
from pyspark.sql import functions as F

from tarnwork.operators import merge as m
from tarnwork.operators import runlog
from tarnwork.queries import ORACLES, QUERIES, streams
from tarnwork.session import Tables, run_dir
from tarnwork.sources import files
from tarnwork.sources.buckets import BUCKET, BucketTable, bucket_of
from tarnwork.streaming import loader


def data_files(path):
    return {os.path.join(folder, n)[len(path):] for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def upsert(held, new):
    return m.merge_upsert(held, new, ["id"])


def test_a_load_leaves_the_files_of_other_buckets(spark):
    path = run_dir(spark, "t")
    table = BucketTable(spark, path, ["id"], buckets=16)
    first = spark.range(1000).select("id", F.lit("a").alias("v"))
    assert table.load(first, 0, upsert)
    before = data_files(path)
    change = spark.createDataFrame([(7, "b"), (2000, "c")], "id bigint, v string")
    hit = {r[0] for r in change.select(bucket_of(["id"], 16)).collect()}
    assert table.load(change, 1, upsert)
    after = data_files(path)
    assert before <= after and {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in after - before} == hit
    want = sorted([(i, "b" if i == 7 else "a") for i in range(1000)] + [(2000, "c")], key=str)
    assert rows(table.read()) == want and rows(table.read(below=1)) == rows(first)
    # Only the replaced buckets' old files go when the version below is no longer needed.
    table.expire(keep=1)
    left = data_files(path)
    assert after - left == {f for f in before if int(f.split(f"{BUCKET}=")[1].split("/")[0]) in hit} and rows(table.read()) == want
    assert table.versions() == [1]


def test_a_batch_that_comes_again_changes_nothing(spark):
    path = run_dir(spark, "t")
    table = BucketTable(spark, path, ["id"], buckets=4)
    batches = [spark.createDataFrame([(1, n), (n, n)], "id int, n int") for n in (2, 3, 4)]
    for number, batch in enumerate(batches):
        loader.load_batch(batch, number, "merge", path, ["id"], buckets=4)
    state, names = rows(table.read()), data_files(path)
    for batch in batches[1:]:
        loader.load_batch(batch, 2, "merge", path, ["id"], buckets=4)
    assert rows(table.read()) == state == [(1, 4), (2, 2), (3, 3), (4, 4)] and data_files(path) == names


def test_a_batch_killed_before_its_manifest_is_done_again(spark, monkeypatch):
    from tarnwork.sources import buckets

    path = run_dir(spark, "t")
    table = BucketTable(spark, path, ["id"], buckets=4)
    loader.load_batch(spark.createDataFrame([(1, 1)], "id int, n int"), 0, "merge", path, ["id"])
    with monkeypatch.context() as patch:
        patch.setattr(buckets, "write_file", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            loader.load_batch(spark.createDataFrame([(1, 2)], "id int, n int"), 1, "merge", path, ["id"])
    assert rows(table.read()) == [(1, 1)]
    loader.load_batch(spark.createDataFrame([(1, 2)], "id int, n int"), 1, "merge", path, ["id"])
    assert rows(table.read()) == [(1, 2)]


def test_columns_that_come_later_and_rows_that_would_move(spark):
    table = BucketTable(spark, run_dir(spark, "t"), ["id"], buckets=8)
    table.load(spark.range(20).select("id"), 0, lambda held, new: new)
    table.load(spark.createDataFrame([(3, "x"), (None, "y")], "id bigint, v string"), 1, upsert)
    assert rows(table.read().filter("v IS NOT NULL")) == [(3, "x"), (None, "y")] and table.read().count() == 21
    with pytest.raises(ValueError, match="moved rows"):
        table.load(spark.createDataFrame([(3, "z")], "id bigint, v string"), 2, lambda held, new: new.withColumn("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long")))))
    with pytest.raises(ValueError, match="type"):
        table.load(spark.createDataFrame([(3, 5)], "id bigint, v int"), 2, lambda held, new: new)
    assert table.versions() == [0, 1]


def test_append_new_reads_the_keys_of_its_buckets_only(spark, monkeypatch):
    path = run_dir(spark, "t")
    read = []
    monkeypatch.setattr(BucketTable, "_rows", lambda self, man, only=None, f=BucketTable._rows: read.append(only) or f(self, man, only))
    for number, ids in enumerate(([1, 2, 3], [3, 4], [4])):
        loader.load_batch(spark.createDataFrame([(i, number) for i in ids], "id int, n int"), number, "append_new", path, ["id"], buckets=1000)
    assert rows(loader.read_table(spark, path)) == [(1, 0), (2, 0), (3, 0), (4, 1)]
    assert [len(r) for r in read if r is not None] == [2, 1]


def shifted(spark, weeks):
    """A folder like the test data's, its events dealt over the given weeks."""
    path = run_dir(spark, "data")
    events = Tables(spark, SF).events
    week = F.array(*[F.lit(w) for w in weeks])[F.pmod(F.xxhash64("event_id"), F.lit(len(weeks))).cast("int")]
    inside = F.expr("ts - make_dt_interval(7 * cast(floor(datediff(ts, DATE'2024-01-01') / 7) AS int))")
    moved = events.withColumn("ts", inside + F.make_dt_interval(week * 7))
    moved.coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("weeks", [list(range(10)), [3], [0, 1, 6], [-2, 0]])
def test_versions_by_the_time_of_the_rows(spark, weeks):
    folder = shifted(spark, weeks)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    assert compare(QUERIES["stream_scd2"](spark, folder), con, ORACLES["stream_scd2"]) == []


def test_the_time_of_a_batch_is_noted_once(spark):
    path = run_dir(spark, "t")
    t0 = datetime(2024, 5, 6, 7, 8, 9, 123)
    batch = spark.createDataFrame([(t0,), (t0 + timedelta(days=1),), (None,)], "ts timestamp_ntz")
    assert loader.time_range(spark, path, 0, batch, "ts") == (t0, t0 + timedelta(days=1))
    assert loader.time_range(spark, path, 0, batch.limit(0), "ts") == (t0, t0 + timedelta(days=1))
    assert loader.time_range(spark, path, 1, batch.limit(0), "ts") == (None, None)
    assert streams.week_end(t0, datetime(2023, 12, 31, 23)) == datetime(2024, 1, 1)
    with pytest.raises(ValueError, match="batch_time"):
        loader.load_batch(batch, 0, "scd2", path, ["ts"])


LOG = "run_id string, zone string, start_time timestamp_ntz, status string, data_written bigint"


def test_states_merge_to_the_rollup_of_all(spark):
    t0 = datetime(2024, 1, 1)
    log = [(f"r{i % 3}", f"z{i % 2}", t0 + timedelta(hours=i * 7 % 11), "Failed" if i == 4 else "Success", None if i % 5 == 0 else i) for i in range(30)]
    log += [("r9", "z", None, "Success", None), ("r9", "z", t0, "Failed", 2), (None, None, t0, "Success", 3)]
    whole = spark.createDataFrame(log, LOG)
    pieces = None
    for part in (log[:7], log[7:8], log[8:]):
        state = runlog.rollup_state(spark.createDataFrame(part, LOG))
        pieces = state if pieces is None else runlog.merge_states(pieces.unionByName(state))
    columns = ["run_id", "zone", "zone_start", "zone_end", "zone_status", "total_size"]
    assert rows(runlog.finish_rollup(pieces), *columns) == rows(runlog.run_zone_rollup(whole), *columns)
    assert rows(runlog.finish_rollup(pieces).filter("run_id = 'r9'"), "latest_status") == [("Failed",)]


def message(run, zone, at, size):
    return '{"run_id": "%s", "zone": "%s", "start_time": "%s", "end_time": "%s", "metadata": "{\\"dataWritten\\": %d}"}' % (run, zone, at, at, size)


def test_run_logs_read_no_earlier_log(spark, monkeypatch):
    feed, log, rollup, checkpoint = (run_dir(spark, n) for n in ("feed", "log", "rollup", "checkpoint"))
    for day in (1, 2, 3):
        text = [(message("a", "Raw", f"2024-01-0{day} 00:00:00", day),), (message(f"b{day}", "Raw", f"2024-01-0{day} 00:00:00", 10),)]
        spark.createDataFrame(text, "value string").coalesce(1).write.mode("append").text(feed)
        stream = files.read_stream(spark, feed, "text", "value string")
        loader.stream_run_logs(stream, log, rollup, checkpoint).awaitTermination()
        # Nothing before this batch can be needed from the log.
        for n in range(day - 1):
            for name in os.listdir(f"{log}/batch_id={n}"):
                if name.endswith(".parquet"):
                    spark.createDataFrame([], "other int").write.mode("overwrite").parquet(f"{log}/batch_id={n}")
                    break
    got = rows(loader.read_rollup(spark, rollup), "run_id", "total_size")
    assert got == [("a", 6), ("b1", 10), ("b2", 10), ("b3", 10)]
    before = data_files(rollup)
    table = BucketTable(spark, rollup, ["run_id", "zone"])
    again = runlog.rollup_state(spark.read.parquet(f"{log}/batch_id=2"))
    assert not table.load(again, 2, lambda held, new: runlog.merge_states(held.unionByName(new)))
    assert rows(loader.read_rollup(spark, rollup), "run_id", "total_size") == got and data_files(rollup) == before


def test_streams_leave_no_intermediate_tables(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = Counter(p.split("-")[0] for p in os.listdir(shared))
    QUERIES["stream_merge"](spark, SF)
    after = Counter(p.split("-")[0] for p in os.listdir(shared))
    assert after - before == Counter(feed=1, table=1, checkpoint=1)
