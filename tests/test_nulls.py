"""Null keys, null times and repeated runs of operators that the given tables never show."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tarnwork.functions.columns import row_hash, total_of
from tarnwork.operators.aggregates import customer_360
from tarnwork.operators.joins import asof_latest, scd2_join
from tarnwork.operators.merge import capture_deletes
from tarnwork.operators.quality import Rule, apply_rules, check_constraint


def test_customer_360_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None, 10, "a"), (1, None, 11, "b"), (2, "x", 12, "a")], "c bigint, g string, p bigint, k string")
    out = customer_360(df, ["c", "g"], "p", {"n": F.count(F.lit(1))}, "k")
    assert rows(out, "c", "total_policies", "n", "categories") == [(1, 2, 2, "a, b"), (2, 1, 1, "a")]


def test_capture_deletes_twice_and_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, v string")
    snapshot = spark.createDataFrame([(1,), (None,)], "k bigint")
    once = capture_deletes(target, snapshot, ["k"])
    again = capture_deletes(once, snapshot.filter("k = 1"), ["k"])
    assert rows(once, "v", "is_deleted") == [("a", 0), ("b", 1), ("c", 0)]
    assert again.columns == ["k", "v", "is_deleted"] and rows(again, "v", "is_deleted") == [("a", 0), ("b", 1), ("c", 1)]


def test_asof_ignores_rows_without_key_or_time(spark):
    t = datetime(2024, 1, 2)
    left = spark.createDataFrame([(1, t), (None, t), (1, None)], "k bigint, t timestamp_ntz")
    right = spark.createDataFrame([(1, None, 7), (None, datetime(2024, 1, 1), 8), (1, datetime(2024, 1, 1), 9)], "k bigint, r timestamp_ntz, v int")
    out = asof_latest(left, right, ["k"], "t", "r", ["v"])
    assert rows(out, "k", "v") == [(1, 9), (1, None), (None, None)]
    assert rows(asof_latest(left, right.filter("r is null"), ["k"], "t", "r", ["v"]), "v") == [(None,)] * 3


def test_stream_replay_takes_every_event(spark, tmp_path):
    from tarnwork.queries import QUERIES

    events = [(1, 1, datetime(2019, 5, 1)), (2, 2, datetime(2024, 1, 3)), (3, 3, datetime(2030, 1, 1)), (4, 4, None)]
    df = spark.createDataFrame([(e, t, u, "click", 1.0) for e, u, t in events], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    df.write.parquet(str(tmp_path / "events.parquet"))
    assert rows(QUERIES["stream_merge"](spark, str(tmp_path)), "user_id") == [(1,), (2,), (3,), (4,)]


def test_both_plans_of_the_temporal_join_agree(spark):
    day = lambda d: datetime(2024, 1, d)
    facts = spark.createDataFrame([(1, 1, day(2)), (2, 1, day(6)), (3, 1, day(20)), (4, None, day(2)), (5, 1, None), (6, 2, day(3)), (7, 9, day(3))], "f int, k bigint, t timestamp_ntz")
    dim = spark.createDataFrame([
        (1, day(1), day(10), "a"), (1, day(5), day(8), "b"), (1, day(5), day(7), "c"), (None, day(1), day(9), "n"), (2, None, day(9), "x"), (2, day(1), None, "y"),
    ], "k bigint, s timestamp_ntz, e timestamp_ntz, v string")
    wanted = [(1, "a"), (2, "b"), (3, None), (4, None), (5, None), (6, None), (7, None)]
    latest = [(1, "a"), (2, "b"), (3, "b"), (4, None), (5, "b"), (6, "y"), (7, None)]
    for size in ("67108864", "0"):
        spark.conf.set("tarnwork.broadcastBytes", size)
        try:
            assert rows(scd2_join(facts, dim, ["k"], "t", "s", "e", ["v"]), "f", "v") == wanted
            assert rows(scd2_join(facts, dim, ["k"], "t", "s", "e", ["v"], fallback="latest"), "f", "v") == latest
        finally:
            spark.conf.unset("tarnwork.broadcastBytes")


def test_row_hash_has_no_second_reading(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("~", "c"), (None, "c"), ("1:a", "c")], "x string, y string")
    assert len({r[0] for r in df.select(row_hash(df).alias("h")).collect()}) == 5


def test_totals_keep_decimal_places_and_refuse_finer_doubles(spark):
    df = spark.createDataFrame([(Decimal("0.0049"), 0.25), (Decimal("0.0049"), 0.5)], "d decimal(19,4), x double")
    assert df.agg(total_of(df, "d").alias("d"), total_of(df, "x").alias("x")).first() == (Decimal("0.0098"), Decimal("0.75"))
    fine = spark.createDataFrame([(0.0049,)], "x double")
    assert fine.agg(total_of(fine, "x", 4).alias("x")).first()[0] == Decimal("0.0049")
    with pytest.raises(Exception, match="more than 2 places"):
        fine.agg(total_of(fine, "x").alias("x")).collect()


def test_constraint_kinds_are_those_of_the_top_level(spark):
    docs = [
        ('{"type":5,"kwargs":{"type":"x"}}', 0), ('{"type":"t","kwargs":{},"meta":null}', 0), ('{"type":"","kwargs":{}}', 1), ('{"type":"t","kwargs":{"a":[1]},"meta":{}}', 1),
        ('{"type":"t","kwargs":"{}"}', 0), ('{"type":"t"}', 0), ('["type"]', 0), ("no json", 0), (None, 0), ("", 0),
    ]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(docs)], "i int, doc string")
    assert rows(check_constraint(df, "doc"), "i", "is_valid") == [(i, v) for i, (_, v) in enumerate(docs)]


def test_rules_follow_mostly_and_refuse_unknown_options(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (40,)], "x int")
    kind = "expect_column_values_to_be_between"
    for share, good in ((0.75, True), (0.8, False)):
        clean, failed, metrics = apply_rules(df, [Rule("r", kind, {"column": "x", "max_value": 9, "mostly": share})])
        assert (clean.count(), failed.count()) == (3, 1) and metrics.first()["success"] is good
    with pytest.raises(ValueError, match="strict_min"):
        apply_rules(df, [Rule("r", kind, {"column": "x", "min_value": 1, "strict_min": True})])
    twice = spark.createDataFrame([(1,), (1,), (None,), (None,)], "x int")
    assert apply_rules(twice, [Rule("u", "expect_column_values_to_be_unique", {"column": "x"})])[1].count() == 2
