"""Merges, sinks, streaming loads and the two drivers."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tarnwork.functions import columns as c
from tarnwork.operators import merge as m
from tarnwork.operators.keys import assert_unique
from tarnwork.operators.quality import Rule
from tarnwork.plans import chain, ingest
from tarnwork.session import run_dir
from tarnwork.sources import extracts, files, writer
from tarnwork.sources import runs as runs_module
from tarnwork.streaming import loader

T = datetime(2025, 1, 1)


@pytest.fixture()
def old(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "id int, v string, x double")


@pytest.fixture()
def new(spark):
    return spark.createDataFrame([(2, "b", 9.0), (3, "c", 3.0), (None, "m", 5.0)], "id int, v string, x double")


@pytest.mark.parametrize("size", [10**9, 0])
def test_upsert_on_both_plans(old, new, settings, size):
    settings(broadcastBytes=size)
    out = m.merge_upsert(old, new, ["id"])
    # a null key matches nothing, so both null rows stay
    assert rows(out) == sorted([(1, "a", 1.0), (2, "b", 9.0), (3, "c", 3.0), (None, "n", 0.0), (None, "m", 5.0)], key=str)
    keyed = new.filter("id IS NOT NULL")
    once = m.merge_upsert(old, keyed, ["id"])
    assert rows(m.merge_upsert(once, keyed, ["id"])) == rows(once)


def test_condition_and_kept_columns(old, new):
    out = m.merge_upsert(old, new.filter("id IS NOT NULL"), ["id"], condition=["v"])
    assert (2, "b", 2.0) in rows(out)
    out = m.merge_upsert(old, new.filter("id IS NOT NULL"), ["id"], keep=["x"])
    assert (2, "b", 2.0) in rows(out) and (3, "c", 3.0) in rows(out)


def test_duplicate_source_keys_are_refused(old, new):
    twice = new.union(new)
    for load in (m.merge_upsert, m.merge_insert_only):
        with pytest.raises(ValueError, match="occurs more than once"):
            load(old, twice, ["id"])
    assert_unique(new, ["id"])


def test_null_safe_update(old, new):
    out = m.merge_update_columns(old, new, ["id"], ["x"])
    assert rows(out) == sorted([(1, "a", 1.0), (2, "b", 9.0), (None, "n", 5.0)], key=str)


def test_metrics_and_unknown_member(old, new):
    before, after = old.filter("id IS NOT NULL"), m.merge_upsert(old, new, ["id"]).filter("id IS NOT NULL AND id <> 1")
    assert rows(m.merge_metrics(before, after, ["id"])) == [(1, 1, 1)]
    once = m.ensure_unknown_member(before, "id", {"v": "?"})
    assert rows(once) == rows(m.ensure_unknown_member(once, "id", {"v": "?"})) and (-1, "?", None) in rows(once)


def test_identity_continues_and_is_stable(spark):
    a = spark.createDataFrame([("b",), ("a",)], "k string")
    first = m.assign_identity(None, a, ["k"], "id")
    assert rows(first, "k", "id") == [("a", 1), ("b", 2)]
    both = m.assign_identity(first, spark.createDataFrame([("0",), ("b",), ("c",)], "k string"), ["k"], "id")
    assert rows(both, "k", "id") == [("0", 3), ("b", 2), ("c", 4)]


def test_failed_load_leaves_the_prior_version(spark, old):
    path = run_dir(spark, "t")
    writer.publish(old, path)
    broken = old.withColumn("x", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="boom"):
        writer.publish(broken, path)
    assert rows(writer.read_current(spark, path)) == rows(old)
    writer.publish(old.filter("id = 1"), path)
    assert rows(writer.read_current(spark, path)) == [(1, "a", 1.0)]


def test_overwrite_skips_empty_and_expires(spark, old):
    path = run_dir(spark, "t")
    assert writer.load_overwrite(old, path)
    assert not writer.load_overwrite(old.filter("id > 99"), path, skip_empty=True)
    assert rows(writer.read_current(spark, path)) == rows(old)
    for _ in range(3):
        writer.load_overwrite(old, path)
    writer.expire_versions(spark, path, keep=2)
    assert len(writer.versions(spark, path)) == 2


def test_partitioned_write(spark, old):
    path = run_dir(spark, "t")
    writer.load_append(old, path, ["v"])
    assert rows(spark.read.parquet(f"{path}/v=a")) == [(1, 1.0)]


def test_triggers():
    assert loader.trigger_options("once") == loader.trigger_options("batch") == loader.trigger_options("availableNow") == {"availableNow": True}
    assert loader.trigger_options("continuous") == {"processingTime": "5 seconds"}
    with pytest.raises(ValueError):
        loader.trigger_options("sometimes")


def test_stream_restart_does_not_apply_a_batch_again(spark, old, new):
    feed, path, checkpoint = (run_dir(spark, n) for n in ("feed", "table", "checkpoint"))
    def run():
        stream = files.read_stream(spark, feed, "parquet", old.schema, max_files=1)
        loader.stream_load(stream, "append_all", path, checkpoint).awaitTermination()

    old.coalesce(1).write.mode("append").parquet(feed)
    run()
    run()
    assert loader.read_batches(spark, path).count() == 3
    new.coalesce(1).write.mode("append").parquet(feed)
    run()
    assert rows(loader.read_batches(spark, path)) == rows(old.union(new))


def test_replayed_batch_writes_the_same_version(spark, old, new):
    path = run_dir(spark, "table")
    a, b = old.filter("id IS NOT NULL"), new.filter("id IS NOT NULL")
    for batch, number in ((a, 0), (b, 1), (b, 1)):
        loader.load_batch(batch, number, "merge", path, ["id"])
    assert rows(loader.read_table(spark, path)) == rows(m.merge_upsert(a, b, ["id"]))
    inserts = run_dir(spark, "inserts")
    for batch, number in ((a, 0), (b, 1), (b, 1)):
        loader.load_batch(batch, number, "append_new", inserts, ["id"])
    assert rows(loader.read_table(spark, inserts)) == rows(m.merge_insert_only(a, b, ["id"]))
    with pytest.raises(ValueError):
        loader.load_batch(a, 2, "upside_down", path, ["id"])


def test_batch_twin(old, new):
    a, b = old.filter("id IS NOT NULL"), new.filter("id IS NOT NULL")
    with pytest.raises(ValueError, match="scd2"):
        loader.batch_load(a, b, "scd2", ["id"])
    assert loader.batch_load(a, b, "anything else", ["id"]).count() == 4
    assert rows(loader.batch_load(None, b, "merge", ["id"])) == rows(b)


def test_chain_document_is_checked():
    good = {"target": {"lakehouse": "l", "schema": "s", "table": "t", "load_strategy": "overwrite"}, "query": [{"name": "q", "sql": "SELECT 1"}]}
    assert chain.check_spec(good) is good
    for path, value in (("load_strategy", "sideways"), ("table", None), ("load_strategy", "merge")):
        with pytest.raises(ValueError):
            chain.check_spec({**good, "target": {**good["target"], path: value}})
    with pytest.raises(ValueError):
        chain.check_spec({**good, "query": []})


@pytest.mark.parametrize("strategy,expected", [
    ("append", [(1, "a"), (2, "b"), (2, "B"), (3, "C")]), ("overwrite", [(2, "B"), (3, "C")]), ("merge", [(1, "a"), (2, "B"), (3, "C")]), ("overwrite_by_key", [(1, "a"), (2, "B"), (3, "C")]),
])
def test_chain_strategies(spark, strategy, expected):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    src = spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string")
    spec = {
        "target": {"lakehouse": "l", "schema": "s", "table": "t", "load_strategy": strategy, "key_columns": ["id"]}, "source": [{"name": "chain_src", "table": "x"}],
        "query": [{"name": "chain_one", "sql": "SELECT id, upper(v) AS v, 1 AS extra FROM chain_src", "drop": ["extra"]}, {"name": "chain_two", "sql": "SELECT * FROM chain_one"}],
    }
    out = chain.run_chain(spark, spec, lambda s: src, have, T)
    assert rows(out, "id", "v") == sorted(expected, key=str)
    assert not spark.catalog.tableExists("chain_src") and not spark.catalog.tableExists("chain_one")


def in_shared(spark):
    return {p for p in os.listdir(spark.conf.get("spark.checkpoint.dir"))}


def chain_spec(strategy="merge", **target):
    return {"target": {"lakehouse": "l", "schema": "s", "table": "t", "load_strategy": strategy, **target}, "source": [{"name": "chain_src", "table": "x"}],
            "query": [{"name": "chain_one", "sql": "SELECT * FROM chain_src"}]}


def test_chain_numbers_every_appended_row(spark):
    path, src = run_dir(spark, "t"), spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    spec = chain_spec("append", identity=True, key_columns=["id"])
    for n in range(2):
        runs = chain.load_chain(spark, spec, lambda s: src, path, T, f"r{n}")
    out = runs.read(chain.TARGET)
    assert sorted(r["t_key"] for r in out.collect()) == [1, 2, 3, 4, 5, 6] and rows(out, "id", "v") == sorted([(1, "a")] * 4 + [(2, "b")] * 2)


def test_chain_unknown_record_without_identity(spark):
    path, src = run_dir(spark, "t"), spark.createDataFrame([(1, "a")], "id int, v string")
    for n in range(2):
        runs = chain.load_chain(spark, chain_spec(key_columns=["id"], unknown_record=True), lambda s: src, path, T, f"r{n}")
    assert rows(runs.read(chain.TARGET), "id", "v") == [(-1, None), (1, "a")]
    for bad in ({"key_columns": ["id", "v"], "unknown_record": True}, {"key_columns": ["id"], "quarantine_strategy": "burn"}, {"key_columns": ["id"], "colour": "red"}):
        with pytest.raises(ValueError):
            chain.load_chain(spark, chain_spec(**bad), lambda s: src, run_dir(spark, "t"), T, "r")
    with pytest.raises(ValueError, match="number"):
        chain.load_chain(spark, chain_spec(key_columns=["v"], unknown_record=True), lambda s: src, run_dir(spark, "t"), T, "r")


@pytest.mark.parametrize("strategy, times", [("merge", 1), ("append", 2)])
def test_chain_quarantines_repeated_keys(spark, strategy, times):
    path, src = run_dir(spark, "t"), spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "n")], "id int, v string")
    before = in_shared(spark)
    for n in range(2):
        runs = chain.load_chain(spark, chain_spec(key_columns=["id"], quarantine_strategy=strategy, partition_by=["v"]), lambda s: src, path, T, f"r{n}")
    assert in_shared(spark) - before == {path.rsplit("/", 1)[-1]}
    assert rows(runs.read(chain.QUARANTINE), "id", "v") == sorted([(2, "b"), (2, "c")] * times)
    assert (1, "a") in rows(runs.read(chain.TARGET), "id", "v") and any("v=a" in f for _, names, _ in os.walk(f"{path}/target") for f in names)
    with pytest.raises(ValueError, match="source"):
        chain.load_chain(spark, chain_spec(key_columns=["id"]), lambda s: src, path, T, "r")
    assert runs.numbers() == [0, 1]


def test_chain_reads_incremental_sources_since_the_last_run(spark):
    path = run_dir(spark, "t")
    src = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in (1, 2, 3)], "id int, dl_lastmodifiedutc timestamp_ntz")
    spec = chain_spec("append")
    spec["source"][0]["incremental"] = True
    chain.load_chain(spark, spec, lambda s: src.filter("id < 3"), path, datetime(2024, 1, 2), "r1")
    runs = chain.load_chain(spark, spec, lambda s: src, path, datetime(2024, 1, 4), "r2")
    assert rows(runs.read(chain.TARGET), "id") == [(1,), (2,), (2,), (3,)] and runs.state()["since"] == datetime(2024, 1, 4)


CONFIG = {"curatedProperties": {"primaryKeyList": ["ID"], "duplicateCheckEnabled": True, "duplicateCheckQuarantineType": "quarantine_all_duplicates", "targetLoadType": "merge"}}


def test_ingest_advances_the_mark_only_after_the_load(spark):
    path = run_dir(spark, "t")
    src = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0)], "id int, v string, x double")
    strict = [Rule("small", "expect_column_values_to_be_between", {"column": "x", "max_value": 0.5})]
    runs = ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r", strict, mark="x")
    assert runs.read(ingest.TARGET) is None and "mark" not in runs.state()
    assert rows(runs.read(ingest.QUARANTINE), "id", "quarantine_type", "failed_rules") == [(1, "Rule", "small"), (2, "Duplicate", None), (2, "Duplicate", None)]
    runs = ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r", mark="x")
    assert runs.state()["mark"] == 3.0 and rows(runs.read(ingest.TARGET), "id", "v") == [(1, "a")]
    again = ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r2", mark="x")
    assert rows(again.read(ingest.TARGET), "id", "dl_runid") == [(1, "r")] and again.state()["mark"] == 3.0
    assert rows(again.read(ingest.METRICS), "run_id", "success", "source_rows", "rows_inserted", "rows_updated", "rows_deleted") == [
        ("r", False, 3, 0, 0, 0), ("r", True, 3, 1, 0, 0), ("r2", True, 0, 0, 0, 0)]
    assert rows(again.read(ingest.LOG), "etl_id", "quarantine_type", "total_rows", "primary_key_list") == [("r", "Duplicate", 2, "id"), ("r", "Duplicate", 2, "id"), ("r", "Rule", 1, "id")]


def test_a_run_counts_as_a_whole_or_not_at_all(spark, monkeypatch):
    """Killed before each of its writes in turn, a run leaves what was there, and the next one starts from the old mark."""
    path = run_dir(spark, "t")
    first, second = ([(i, "a", float(i)) for i in ids] for ids in (range(1, 4), range(1, 8)))
    kind = "id int, v string, x double"
    ingest.ingest_table(spark, CONFIG, spark.createDataFrame(first, kind), path, T, "e", "r1", mark="x")
    write, at = runs_module.Run.write, [0]
    for stop in range(5):
        def failing(self, *args, stop=stop, **more):
            at[0] += 1
            if at[0] == stop + 1:
                raise RuntimeError("killed")
            return write(self, *args, **more)

        at[0] = 0
        with monkeypatch.context() as patch:
            if stop < 4:
                patch.setattr(runs_module.Run, "write", failing)
            else:
                patch.setattr(runs_module.Run, "commit", lambda self, **state: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError, match="killed"):
                ingest.ingest_table(spark, CONFIG, spark.createDataFrame(second, kind), path, T, "e", "r2", mark="x")
        held = runs_module.Runs(spark, path)
        assert held.state()["mark"] == 3.0 and rows(held.read(ingest.TARGET), "id") == [(1,), (2,), (3,)] and held.read(ingest.METRICS).count() == 1
    held = ingest.ingest_table(spark, CONFIG, spark.createDataFrame(second, kind), path, T, "e", "r2", mark="x")
    assert held.state()["mark"] == 7.0 and rows(held.read(ingest.TARGET), "id", "dl_runid") == [(i, "r1" if i < 4 else "r2") for i in range(1, 8)]
    held.expire()
    assert len(os.listdir(f"{path}/target")) == 1 and len(os.listdir(f"{path}/load_metrics")) == 2
    assert rows(held.read(ingest.METRICS), "run_id", "source_rows") == [("r1", 3), ("r2", 4)]


def test_a_source_that_grows_during_the_load_loses_nothing(spark, monkeypatch):
    path, feed = run_dir(spark, "t"), run_dir(spark, "feed")
    kind = "id int, v string, x double"
    spark.createDataFrame([(1, "a", 1.0)], kind).write.parquet(feed)
    plan = ingest.load_plan

    def slow(*args):
        spark.createDataFrame([(2, "b", 2.0)], kind).write.mode("append").parquet(feed)
        return plan(*args)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "load_plan", slow)
        runs = ingest.ingest_table(spark, CONFIG, spark.read.parquet(feed), path, T, "e", "r1", mark="x")
    assert runs.state()["mark"] == 1.0 and rows(runs.read(ingest.TARGET), "id") == [(1,)]
    runs = ingest.ingest_table(spark, CONFIG, spark.read.parquet(feed), path, T, "e", "r2", mark="x")
    assert runs.state()["mark"] == 2.0 and rows(runs.read(ingest.TARGET), "id") == [(1,), (2,)]


def test_two_runs_from_one_marker_cannot_both_end(spark):
    runs = runs_module.Runs(spark, run_dir(spark, "t"))
    one, two = runs.begin(), runs.begin()
    for run, value in ((one, 1), (two, 2)):
        run.write("target", spark.range(value))
    one.commit(mark=datetime(2024, 1, 2, 3, 4, 5, 6), day=date(2024, 1, 2), size=Decimal("1.50"))
    with pytest.raises(FileExistsError):
        two.commit()
    assert runs.read("target").count() == 1 and runs.numbers() == [0]
    assert runs.state() == {"mark": datetime(2024, 1, 2, 3, 4, 5, 6), "day": date(2024, 1, 2), "size": Decimal("1.50")}
    with pytest.raises(ValueError, match="already"):
        run = runs.begin()
        run.write("target", spark.range(1))
        run.write("target", spark.range(1))


@pytest.mark.parametrize("kind, want, counts", [
    ("overwrite", [(2, "B"), (3, "c")], [(2, 0, 0), (2, 0, 2)]), ("append", [(1, "a"), (2, "B"), (2, "b"), (3, "c")], [(2, 0, 0), (2, 0, 0)]),
    ("merge", [(1, "a"), (2, "B"), (3, "c")], [(1, 1, 0), (2, 0, 0)]),
])
def test_load_types_are_counted_while_written(spark, kind, want, counts):
    config = {"curatedProperties": {"primaryKeyList": ["id"], "targetLoadType": kind, "columnList": ["id", "v"]}}
    path = run_dir(spark, "t")
    for n, data in enumerate([[(1, "a", 1), (2, "b", 1)], [(2, "B", 2), (3, "c", 2)]]):
        runs = ingest.ingest_table(spark, config, spark.createDataFrame(data, "id int, v string, at int"), path, T, "e", f"r{n}", mark="at + 0")
    assert rows(runs.read(ingest.TARGET), "id", "v") == want and runs.state()["mark"] == 2
    assert rows(runs.read(ingest.METRICS), "rows_inserted", "rows_updated", "rows_deleted") == counts


def test_intermediate_tables_go_with_the_run(spark, monkeypatch):
    path = run_dir(spark, "t")
    src = spark.createDataFrame([(1, "a", 1.0)], "id int, v string, x double")
    ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r1")
    before = in_shared(spark)
    ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r2")
    assert in_shared(spark) == before
    with monkeypatch.context() as patch:
        patch.setattr(runs_module.Run, "commit", lambda self, **state: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            ingest.ingest_table(spark, CONFIG, src, path, T, "e", "r3")
    left = in_shared(spark) - before
    assert left and all(spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/{p}").count() == 1 for p in left)


@pytest.mark.parametrize("limit", ["1", "67108864"])
def test_a_table_merged_with_itself_has_no_changes(spark, settings, limit):
    settings(broadcastBytes=limit)
    table = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    assert rows(m.merge_metrics(table, table, ["id"])) == [(0, 0, 0)]
    tally = m.LoadCounts("done")
    merged = tally.watch(m.merge_upsert(table.filter("id = 1"), table, ["id"], ["v"], action="done"))
    assert rows(merged, "id", "v") == [(1, "a"), (None, "b")] and tally.counts() == {"rows_total": 2, "rows_inserted": 1, "rows_updated": 0}


@pytest.mark.parametrize("limit", ["0", "67108864"])
def test_a_hash_is_worked_out_where_the_rows_meet(spark, settings, limit):
    """Neither the stored batch nor the join of a merge carries the row hash and the columns that are the same for all."""
    settings(broadcastBytes=limit)
    early = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0)], "id int, v string, x double")
    later = spark.createDataFrame([(2, None, 2.0), (3, "d", 3.0), (4, None, None), (None, "n", 0.0)], "id int, v string, x double")
    first, second = (ingest.prepare(CONFIG, df, T, "e", run) for df, run in ((early, "r1"), (later, "r2")))
    for batch in (first, second):
        stored = spark.read.parquet(*batch.rows.inputFiles()).columns
        assert not {"dl_rowhash", "dl_runid", "dl_createddateutc"} & set(stored)
    target = ingest.load_plan(CONFIG, first, None).drop(ingest.ACTION)
    hashes = rows(early.withColumn("h", c.row_hash(early)), "id", "h")
    assert rows(target, "id", "dl_rowhash") == hashes
    path = run_dir(spark, "target")
    target.write.parquet(path)
    merged = ingest.load_plan(CONFIG, second, spark.read.parquet(path))
    plain = m.merge_on_hash(spark.read.parquet(path), second.clean, second.keys, action=ingest.ACTION)
    assert rows(merged) == rows(plain)
    assert rows(merged, "id", "dl_runid", ingest.ACTION) == [(1, "r1", None), (2, "r1", None), (3, "r2", "updated"), (4, "r2", "inserted"), (None, "r2", "inserted")]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and (limit != "0" or "sha2" not in plan[plan.index("Join FullOuter"):])


def test_config_errors():
    with pytest.raises(ValueError):
        ingest.check_config({"curatedProperties": {"targetLoadType": "merge"}})
    with pytest.raises(ValueError):
        ingest.check_config({"curatedProperties": {"targetLoadType": "sideways", "primaryKeyList": ["a"]}})


def test_keys_options_and_filters(spark, old):
    assert c.validate_keys(old, ["ID "]) == ["id"]
    for bad in ([], ["nope"]):
        with pytest.raises(ValueError):
            c.validate_keys(old, bad)
    assert files.reader_options({"header": True, "delimiter": "|", "inferColumnTypes": False}) == {"header": "true", "sep": "|", "inferSchema": "false"}
    with pytest.raises(ValueError):
        files.reader_options({"colour": "red"})
    with pytest.raises(ValueError):
        files.read_files(spark, "/nowhere", "xlsx")
    assert extracts.clean_filter(" WHERE name = 'Where AND'") == "name = 'Where AND'" and extracts.clean_filter("and x > 1") == "x > 1" and extracts.clean_filter("  ") is None
    assert extracts.start_mark({"identifier": "a", "value": "5"}, "a", "0") == "5"
    assert extracts.start_mark({"identifier": "b", "value": "5"}, "a", "0") == extracts.start_mark({"identifier": "a", "value": ""}, "a", "0") == "0"


def test_multi_line_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "name": "x",\n "keys": ["a", "b"]\n}')
    (tmp_path / "b.json").write_text('{\n "name": "y"\n}')
    out = files.read_json_docs(spark, str(tmp_path), "name string, keys array<string>, missing int")
    assert rows(out) == [("x", ["a", "b"], None), ("y", None, None)]


@pytest.mark.parametrize("split", ["16", "1000000"])
def test_rows_above_a_sheet_are_skipped_in_every_file(spark, tmp_path, split):
    """Also where the first lines of a file lie in several splits, and where several files share a task."""
    want = []
    for k in range(7):
        body = [f"{k * 100 + i};name {k} {i}" for i in range(5 + 20 * k)]
        want += [(k * 100 + i, f"name {k} {i}") for i in range(len(body))]
        (tmp_path / f"{k}.csv").write_text("\n".join([f"Title {k} that is rather long", "", "id;name", *body[:3], "", *body[3:]]) + "\n")
    (tmp_path / "short.csv").write_text("Title only\n")
    (tmp_path / "empty.csv").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")  if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        out = files.read_sheet_csv(spark, str(tmp_path), "id int, name string", 2, {"header": True, "delimiter": ";"})
        assert rows(out) == sorted(want, key=str)
        whole = files.read_sheet_csv(spark, str(tmp_path), "id int, name string", 0, {"delimiter": ";"})
        assert whole.count() == len(want) + 7 * 2 + 1
        spark.conf.set("tarnwork.broadcastBytes", "1")
        assert rows(files.read_sheet_csv(spark, str(tmp_path), "id int, name string", 3, {"delimiter": ";"})) == sorted(want, key=str)
    finally:
        spark.conf.unset("tarnwork.broadcastBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for k, v in before.items():
            spark.conf.set(k, v)
    for bad in ({"multiline": True}, {"encoding": "UTF-16"}):
        with pytest.raises(ValueError):
            files.read_sheet_csv(spark, str(tmp_path), "id int", 1, bad)


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    hashes = [r[0] for r in df.select(c.row_hash(df)).collect()]
    assert len(set(hashes)) == 3 and all(len(h) == 64 for h in hashes)
    assert [r[0] for r in df.select(c.row_hash(df.select("y", "x"))).collect()] == hashes


def test_watermark_is_strict_and_keeps_the_previous(spark, old):
    assert rows(extracts.watermark_extract(old, "x", 1.0, ["id"])) == [(2, 2.0)]
    assert extracts.advance_watermark(old.filter("id > 99"), "x", 7.5).first()[0] == 7.5


def test_shared_folder_comes_from_the_session(spark):
    from tarnwork import session

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    class Fake:
        """A session without the setting, on a cluster or local."""

        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master, "applicationId": f"test-{master}"})()
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake("yarn"))
    local = Fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
