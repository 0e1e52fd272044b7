"""Small worked cases with rows written by hand."""

from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from tarnwork.operators import merge as m
from tarnwork.operators.joins import scd2_join
from tarnwork.operators.hierarchy import hierarchy_paths
from tarnwork.plans.dimensions import status_hierarchy

NOW = datetime(2025, 3, 1)
BEFORE = datetime(2025, 1, 1)


def target(spark):
    return spark.createDataFrame([
        ("POL1", "CA", 50000.0, 2500.0, BEFORE, BEFORE, 1, 0),
        ("POL2", "NY", 60000.0, 3000.0, BEFORE, BEFORE, 1, 0),
    ], "code string, state string, exposure double, premium double, dl_createddateutc timestamp_ntz, dl_lastmodifiedutc timestamp_ntz, dl_iscurrent int, dl_is_deleted int")


FEED = "code string, state string, exposure double, premium double, op int, lsn long, seq long"


def test_change_feed_insert_update_delete(spark):
    feed = spark.createDataFrame([
        ("POL3", "TX", 70000.0, 3500.0, 2, 10, 1), ("POL1", "CA", 55000.0, 2750.0, 4, 11, 1), ("POL2", "NY", None, None, 1, 12, 1),
    ], FEED)
    out = m.cdc_apply(target(spark), feed, ["code", "state"], NOW, "op", "lsn", "seq")
    assert rows(out, "code", "exposure", "premium", "dl_lastmodifiedutc", "dl_iscurrent", "dl_is_deleted") == [
        ("POL1", 55000.0, 2750.0, NOW, 1, 0), ("POL2", 60000.0, 3000.0, NOW, 0, 1), ("POL3", 70000.0, 3500.0, NOW, 1, 0),
    ]
    assert {"op", "lsn", "seq"}.isdisjoint(out.columns)
    again = m.cdc_apply(out, feed, ["code", "state"], NOW, "op", "lsn", "seq")
    assert rows(again, *out.columns) == rows(out)


def test_change_feed_edge_cases(spark):
    feed = spark.createDataFrame([
        ("POL1", "CA", None, None, 1, 20, 1), ("POL1", "CA", 1.0, 2.0, 2, 20, 2),  # delete, then insert in one transaction
        ("POL9", "ZZ", None, None, 1, 21, 1),  # delete of an unknown key
        ("POL2", "NY", 9.0, 9.0, 3, 22, 1),  # before-image
        ("POL2", "NY", 7.0, 7.0, 4, 5, 1),  # not after the last sequence number
    ], FEED)
    out = m.cdc_apply(target(spark), feed, ["code", "state"], NOW, "op", "lsn", "seq", last_lsn=6)
    assert rows(out, "code", "exposure", "dl_is_deleted") == [("POL1", 1.0, 0), ("POL2", 60000.0, 0)]


def test_deleted_row_returns_with_the_same_values(spark):
    gone = spark.createDataFrame([("POL1", "CA", None, None, 1, 1, 1)], FEED)
    back = spark.createDataFrame([("POL1", "CA", 50000.0, 2500.0, 2, 2, 1)], FEED)
    out = m.cdc_apply(m.cdc_apply(target(spark), gone, ["code"], NOW, "op", "lsn", "seq"), back, ["code"], NOW, "op", "lsn", "seq")
    assert rows(out, "code", "premium", "dl_is_deleted", "dl_iscurrent") == [("POL1", 2500.0, 0, 1), ("POL2", 3000.0, 0, 1)]


def test_net_changes(spark):
    feed = spark.createDataFrame([
        ("A", "CA", 1.0, 1.0, 2, 1, 1), ("A", "CA", 2.0, 2.0, 3, 2, 1), ("A", "CA", 3.0, 3.0, 4, 2, 2),
        ("B", "NY", 1.0, 1.0, 1, 3, 1), ("B", "NY", 5.0, 5.0, 2, 3, 2), ("C", "TX", 1.0, 1.0, 1, 4, 1), ("D", "TX", 1.0, 1.0, 3, 4, 2),
    ], FEED)
    out = m.cdc_net_changes(feed, ["code", "state"], "op", "lsn", "seq")
    assert rows(out, "code", "exposure", "op", "is_deleted") == [("A", 3.0, 4, 0), ("B", 5.0, 2, 0), ("C", 1.0, 1, 1)]
    assert rows(m.cdc_net_changes(feed, ["code", "state"], "op", "lsn", "seq", last_lsn=3), "code") == [("C",)]


def test_late_arriving_facts(spark, settings):
    t = datetime
    dim = spark.createDataFrame([
        (1, "CustomerA", "New York", t(2023, 1, 1, 10), t(2023, 6, 1, 9)), (1, "CustomerA", "Boston", t(2023, 6, 1, 9, 0, 1), t(9999, 12, 31)), (2, "CustomerB", "Chicago", t(2023, 1, 1, 10), t(9999, 12, 31)),
    ], "customer_id int, customer_name string, location string, s timestamp_ntz, e timestamp_ntz")
    facts = spark.createDataFrame([
        (101, 1, t(2023, 5, 1, 12)), (102, 1, t(2023, 7, 1, 15)), (103, 2, t(2023, 2, 1, 8)), (104, 1, t(2022, 1, 1)), (105, 3, t(2023, 5, 1)), (106, 1, t(2023, 6, 1, 9)),
    ], "fact_id int, customer_id int, ts timestamp_ntz")
    expected = [(101, "New York"), (102, "Boston"), (103, "Chicago"), (104, "Boston"), (105, None), (106, "New York")]
    strict = [(f, None if f == 104 else w) for f, w in expected]
    for size in (10**9, 0):  # the broadcast form and the as-of form
        settings(broadcastBytes=size)
        args = (facts, dim, ["customer_id"], "ts", "s", "e", ["location"])
        assert rows(scd2_join(*args, fallback="latest"), "fact_id", "location") == expected
        assert rows(scd2_join(*args), "fact_id", "location") == strict


def test_status_hierarchy_paths(spark):
    # (level code, status, parent status) of a status tree
    tree = [
        ("LN0", "NB - New Submission", None), ("LN1", "NB - Completed Submission", "NB - New Submission"), ("LN1_1", "NB - Quoted", "NB - Completed Submission"),
        ("LN1_1_1", "NB - Total Written", "NB - Quoted"), ("LN1_1_1_1", "NB - Issued", "NB - Total Written"), ("LN1_2", "NB - Open Completed Submission", "NB - Completed Submission"), ("LZ0", "Other - Exception", None),
    ]
    df = spark.createDataFrame(tree, "level string, status string, parent string")
    out = {r["level"]: [r[f"l{i}_level"] for i in range(5)] for r in status_hierarchy(df, "status", "parent").collect()}
    assert out["LN1_1_1_1"] == ["NB - New Submission", "NB - Completed Submission", "NB - Quoted", "NB - Total Written", "NB - Issued"]
    assert out["LN1_2"] == ["NB - New Submission", "NB - Completed Submission", "NB - Open Completed Submission", None, None]
    assert out["LZ0"] == ["Other - Exception", None, None, None, None]


def test_status_hierarchy_without_a_root_has_no_path(spark):
    chain = [(f"d{i}", f"d{i - 1}" if i else None) for i in range(7)]  # deeper than the levels there are
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None), ("e", "absent"), *chain], "code string, parent string")
    out = {r["code"]: r["l0_level"] for r in status_hierarchy(df, "code", "parent").collect()}
    assert out == {"a": None, "b": None, "c": "c", "e": None, **{f"d{i}": "d0" if i < 5 else None for i in range(7)}}


def test_scd2_two_changes(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    two = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    out = m.scd2_apply(m.scd2_apply(None, one, ["id"], ["v"], BEFORE), two, ["id"], ["v"], NOW)
    assert rows(out, "id", "v", "effective_from", "effective_to", "is_current") == [
        (1, "a", BEFORE, None, 1), (2, "b", BEFORE, NOW, 0), (2, None, NOW, None, 1), (3, "c", NOW, None, 1),
    ]
    assert rows(m.scd2_apply(out, two, ["id"], ["v"], datetime(2025, 4, 1)), *out.columns) == rows(out)
    assert out.filter("is_current = 1").groupBy("id").count().filter("count > 1").count() == 0
    overlap = out.alias("x").join(out.alias("y"), (F.col("x.id") == F.col("y.id")) & (F.col("x.effective_from") < F.col("y.effective_from")) & (F.coalesce("x.effective_to", F.lit(datetime(9999, 1, 1))) > F.col("y.effective_from")))
    assert overlap.count() == 0


def test_hierarchies_of_any_depth_say_what_they_are(spark):
    deep = [(f"d{i}", f"d{i - 1}" if i else None) for i in range(200)]
    ring = [(f"r{i}", f"r{(i + 1) % 7}") for i in range(7)] + [("below", "r3"), ("self", "self")]
    other = [("leaf", "absent"), ("twig", "leaf"), (None, "d0"), ("alone", None)]
    df = spark.createDataFrame(deep + ring + other, "code string, parent string")
    out = {r["code"]: (r["level_count"], r["hierarchy_state"], r["l0_level"]) for r in hierarchy_paths(df, "code", "parent", 5).collect()}
    for i in range(200):
        assert out[f"d{i}"] == (i + 1, "complete" if i < 5 else "too deep", "d0" if i < 5 else None)
    assert all(out[c] == (None, "cycle", None) for c in [*(f"r{i}" for i in range(7)), "below", "self"])
    assert out["leaf"] == out["twig"] == (None, "no root", None) and out["alone"] == (1, "complete", "alone") and out[None] == (2, "complete", "d0")
    six = {r["code"]: [r[f"l{i}_level"] for i in range(6)] for r in hierarchy_paths(df.filter("code like 'd%'"), "code", "parent", 6).collect()}
    assert six["d5"] == [f"d{i}" for i in range(6)] and six["d6"] == [None] * 6


def test_hierarchy_of_an_empty_table(spark):
    out = hierarchy_paths(spark.createDataFrame([], "code string, parent string"), "code", "parent", 2)
    assert out.columns == ["code", "parent", "l0_level", "l1_level", "level_count", "hierarchy_state"] and out.count() == 0
