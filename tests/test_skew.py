"""Hot keys: one key with a third of the rows, and a third of the rows identical copies."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tarnwork.operators import joins, skew, windows


@pytest.fixture()
def skewed(spark):
    """3,000 rows; key 7 and null hold a third each; values are partly null; times tie."""
    rnd = random.Random(5)
    data = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else None if i % 3 == 1 else rnd.randrange(100, 400)
        data.append((i, key, rnd.randrange(0, 500), rnd.choice(["a", "b", None])))
    return spark.createDataFrame(data, "id int, k int, ts int, v string").repartition(6, "id")


OUTPUTS = {"n": ("row_number",), "prev": ("lag", "v"), "last": ("last", "v"), "total": ("sum", "id")}


def test_running_is_the_same_with_and_without_hot_keys(skewed, settings):
    plain = rows(windows.running(skewed, ["k"], ["ts", "id"], OUTPUTS))
    settings(hotRows=50)
    hot = windows.running(skewed, ["k"], ["ts", "id"], OUTPUTS)
    assert rows(hot) == plain


def test_hot_key_is_cut_into_balanced_chunks(skewed, settings):
    settings(hotRows=100)
    bounds = skew.chunk_bounds(skewed, ["k"], ["ts", "id"])
    assert sorted(rows(bounds, "k"), key=str) == [(7,), (None,)]
    sizes = skew.with_chunks(skewed, ["k"], ["ts", "id"], bounds).filter("_hot").groupBy("k", "_chunk").count()
    found = [r["count"] for r in sizes.collect()]
    assert len(found) >= 4 and max(found) < 700


def test_no_hot_key_no_extra_plan(skewed):
    assert skew.hot_keys(skewed, ["k"]) is None


@pytest.mark.parametrize("policy", [windows.QUARANTINE_ALL, windows.RETAIN_ONE])
def test_split_with_identical_copies(spark, settings, policy):
    """A third of the rows are copies of one row; clean and duplicates must still add up to the input."""
    base = spark.range(900).select((F.col("id") % 200).alias("k"), (F.col("id") % 7).alias("v"))
    copies = spark.range(450).select(F.lit(5).cast("long").alias("k"), F.lit(-1).cast("long").alias("v"))
    df = base.unionByName(copies).repartition(5)
    order = [F.col("v")]
    plain = [rows(x) for x in windows.split_duplicates(df, ["k"], policy, order)]
    settings(hotRows=20)
    clean, out = windows.split_duplicates(df, ["k"], policy, order)
    assert [rows(clean), rows(out)] == plain
    assert sorted(rows(clean) + rows(out)) == sorted(rows(df))


def test_retain_all_reports_only(skewed):
    clean, out = windows.split_duplicates(skewed, ["k"], windows.RETAIN_ALL)
    assert rows(clean) == rows(skewed) and out.count() > 2000


def test_dense_numbers_are_gap_free(skewed, settings):
    plain = rows(windows.dense_number(skewed, ["ts", "id"], "n", 11), "id", "n")
    settings(hotRows=300)
    assert rows(windows.dense_number(skewed, ["ts", "id"], "n", 11), "id", "n") == plain
    assert sorted(n for _, n in plain) == list(range(11, 3011))


def test_asof_with_hot_key_against_brute_force(spark, settings):
    rnd = random.Random(3)
    left = [(i, rnd.choice([1, 1, 2]), rnd.randrange(100)) for i in range(300)]
    right = [(i, rnd.choice([1, 1, 3]), rnd.randrange(100), f"v{i}") for i in range(200)]
    expected = []
    for i, k, ts in left:
        hits = [(r[2], r[0], r[3]) for r in right if r[1] == k and r[2] <= ts]
        expected.append((i, max(hits)[2] if hits else None))
    a = spark.createDataFrame(left, "id int, k int, ts int")
    b = spark.createDataFrame(right, "rid int, k int, rts int, v string")
    for limit in (10**6, 20):
        settings(hotRows=limit)
        out = joins.asof_latest(a, b, ["k"], "ts", "rts", ["v"], tie="rid")
        assert rows(out, "id", "v") == sorted(expected, key=str)


def test_measured_bytes_counts_text(spark):
    small = spark.createDataFrame([("x" * 10,)], "a string")
    large = spark.createDataFrame([("x" * 10000,)], "a string")
    assert skew.measured_bytes(large) - skew.measured_bytes(small) == 9990


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_limited_before_the_shuffle(tables):
    plan = plan_of(windows.latest_per_key(tables.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")]))
    assert "row_number(), 1, Partial" in plan


def test_filters_and_columns_reach_the_scan(tables):
    from datetime import datetime

    from tarnwork.sources.extracts import watermark_extract

    plan = plan_of(watermark_extract(tables.orders, "o_orderdate", datetime(2000, 1, 1), ["o_orderkey"]))
    assert "GreaterThan(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_small_source_leaves_the_target_unshuffled(tables):
    from tarnwork.operators.merge import merge_rows

    t = tables.orders.select("o_orderkey", "o_totalprice")
    s = t.filter("o_totalprice > 100000")
    cols = {c: F.col(f"s_{c}") for c in t.columns}
    plan = plan_of(merge_rows(t, s, ["o_orderkey"], {"o_totalprice": cols["o_totalprice"]}, cols))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
