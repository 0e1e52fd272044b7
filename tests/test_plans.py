"""Plans that must hold at scale: what moves, what is read, how often."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnwork.operators import aggregates, joins, skew
from tarnwork.operators import merge as m
from tarnwork.plans import transactions
from tarnwork.queries.fixtures import HOUSE, POLICY, frames
from tarnwork.session import cut


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(df):
    """Exchanges of rows between tasks (broadcasts are none)."""
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange rangepartitioning") + plan(df).count("Exchange RoundRobin")


def test_date_roles_do_not_move_the_fact(spark, settings):
    fact = cut(spark.range(1000).select("id", *[F.date_add(F.lit(datetime(2024, 1, 1)), (F.col("id") % n).cast("int")).alias(c) for n, c in ((7, "a"), (9, "b"), (400, "c"))]))
    dates = spark.range(366).select(F.date_add(F.lit(datetime(2024, 1, 1)), F.col("id").cast("int")).alias("date"), F.col("id").alias("date_key")).distinct()  # derived, so Spark knows no size
    roles = {"ka": "a", "kb": "b", "kc": "c"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.date_roles(fact, dates, roles)
        assert plan(out).count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan(out)
        got = {tuple(r) for r in out.select("id", "ka", "kb", "kc").collect()}
        settings(broadcastBytes=1)
        large = joins.date_roles(fact, dates, roles)
        assert "SortMergeJoin" in plan(large) and {tuple(r) for r in large.select("id", "ka", "kb", "kc").collect()} == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(i, i % 7, i % 9, i % 400 if i % 400 < 366 else -1) for i in range(1000)}


def test_star_dimensions_are_measured_together(spark, settings):
    fact = cut(spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 10).alias("b")))
    small = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("small_key")).distinct()
    large = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 3).alias("large_key")).distinct()
    dims = [(large, {"a": "k"}, {"large_key": "large_key"}), (small, {"b": "k"}, {"small_key": "small_key"})]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        settings(broadcastBytes=1000)  # the small one has 480 bytes
        out = joins.star_lookup(fact, dims)
        assert plan(out).count("BroadcastHashJoin") == 1 and plan(out).count("SortMergeJoin") == 1
        assert {tuple(r) for r in out.collect()} == {(i, i % 10, 3 * i if i < 900 else -1, i % 10 * 2) for i in range(1000)}
        settings(broadcastBytes=10**6)
        assert "SortMergeJoin" not in plan(joins.star_lookup(fact, dims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_customer_view_scans_its_input_once(spark):
    rows = cut(spark.createDataFrame([(1, "p", "x", 1.0), (1, "q", "x", 2.0), (1, "q", None, 4.0), (None, "r", "y", 8.0), (None, "s", "z", 16.0)], "c int, id string, cat string, v double"))
    out = aggregates.customer_360(rows, ["c"], "id", {"total": F.sum("v")}, "cat")
    assert plan(out).count("FileScan") == 1
    assert {tuple(r) for r in out.collect()} == {(1, 2, 7.0, "x", 1), (None, 2, 24.0, "y, z", 2)}


COLUMNS = "id int, v string, dl_is_deleted int, dl_iscurrent int, dl_lastmodifiedutc timestamp_ntz"


def test_a_small_feed_with_deletes_does_not_move_the_target(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2025, 1, 1)
    target = cut(spark.createDataFrame([(i, "a", 0, 1, t0) for i in range(50)], COLUMNS))
    feed = cut(spark.createDataFrame([(1, "x", 1, 1, 1), (2, "b", 4, 1, 2), (99, "n", 2, 1, 3), (77, "gone", 1, 1, 4)], "id int, v string, op int, lsn int, seq int"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = m.cdc_apply(target, feed, ["id"], t1, "op", "lsn", "seq")
        text = plan(out)
        # All that is dealt anew are the few keys that the feed and the target share.
        assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") <= 1
        got = {tuple(r) for r in out.collect()}
        spark.conf.set("tarnwork.broadcastBytes", "1")
        assert {tuple(r) for r in m.cdc_apply(target, feed, ["id"], t1, "op", "lsn", "seq").collect()} == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("tarnwork.broadcastBytes")
    assert got == {*((i, "a", 0, 1, t0) for i in range(50) if i not in (1, 2)), (1, "a", 1, 0, t1), (2, "b", 0, 1, t1), (99, "n", 0, 1, t1)}


def test_overwrite_by_few_keys_does_not_move_the_target(spark):
    target = cut(spark.createDataFrame([(i, "a") for i in range(50)] + [(None, "n")], "id int, v string"))
    source = cut(spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id int, v string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = m.overwrite_by_key(target, source, ["id"])
        assert "SortMergeJoin" not in plan(out)
        assert sorted(map(tuple, out.filter("id = 1 OR id IS NULL").collect()), key=str) == [(1, "x"), (1, "y"), (None, "n"), (None, "z")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot", [False, True])
def test_transactions_move_once_and_count_as_often_as_the_source_has_them(tables, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(transactions, "dealt", lambda df, key: df)
    t = frames(tables, POLICY)
    given = cut(t["mgtrans"])
    t["mgtrans"] = given.unionByName(given.filter("trancnt = 1")).unionByName(given.filter("trancnt = 1 AND transno % 2 = 0"))
    written, _ = transactions.transaction_rows(t)
    codes = written.select("code_n").distinct()
    flags = transactions.reconciliation(codes, written, t).select("code_n", "dq_rule_544", "dq_rule_553").collect()
    kinds = {}
    for r in t["mgtrans"].collect():
        kinds.setdefault(r["code"].strip().upper(), []).append(r)
    extras = {r["code_n"]: r["n"] for r in transactions.extra_rows(t).groupBy("code_n").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {}
    for code, found in kinds.items():
        once = {tuple(r): r for r in found}.values()
        fact = sum(round(r["amount"] * 100) for r in once) * extras.get(code, 1)
        want[code] = int(fact == sum(round(r["amount"] * 100) for r in found))
    assert {r["code_n"]: r["dq_rule_544"] for r in flags} == want and set(want.values()) == {0, 1}
    assert {r["dq_rule_553"] for r in flags} == {0}  # a total of nulls fails
    if not hot:
        assert moved(written.groupBy("code_n").agg(F.sum("prem_amt"))) == 1


def test_rows_of_a_hot_key_are_not_dealt_by_it(spark, settings):
    df = cut(spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("k"), "id"))
    assert moved(skew.dealt(df, "k")) == 1
    settings(hotRows=1)
    assert moved(skew.dealt(df, "k")) == 0


def test_payroll_classes_of_the_policies_that_use_them(tables):
    t = frames(tables, POLICY)
    order = [F.col("exposure").desc(), F.col("premium").desc(), F.col("state"), F.col("classcode"), F.col("classuffix")]
    policies = transactions.master_policies(t, None)
    every = {r["code_n"]: tuple(r) for r in transactions.payroll_class(t, order, policies).collect()}
    some = policies.filter("lob_n = 'WC'")
    wanted = {r["code_n"] for r in some.select("code_n").collect()}
    assert {r["code_n"]: tuple(r) for r in transactions.payroll_class(t, order, some).collect()} == {k: v for k, v in every.items() if k in wanted}


def test_rows_whose_keys_are_not_wanted_do_not_move(spark):
    wanted = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"))
    a = cut(spark.range(5000).select((F.col("id") * 2).alias("x"), "id"))
    b = cut(spark.range(5000).select(F.col("id").alias("q"), (F.col("id") % 7).alias("t")))
    view = a.join(b, F.col("id") == F.col("q")).select(F.trim(F.concat(F.col("x").cast("string"), F.lit(" "))).alias("k"), "t")
    exact = {tuple(r) for r in view.join(wanted, "k", "left_semi").collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for size, most in ((2**22, 20), (2**15, 200)):  # 1000 keys: others stay by chance
            bits = skew.key_bits(wanted, ["k"], size)
            for below in (False, True):
                got = skew.likely(view, ["k"], bits, below).collect()
                assert exact <= {tuple(r) for r in got} and len(got) <= len(exact) + most
        text = plan(skew.likely(view.filter("t < 3").union(view.filter("t > 2")).distinct(), ["k"], bits, below_joins=True))
        assert text.index("HashAggregate") < text.index("SortMergeJoin") < text.index("getbit")
        text = plan(skew.likely(skew.dealt(a.select(F.col("x").cast("string").alias("k"), "id"), "k"), ["k"], bits))
        assert text.index("REPARTITION_BY_COL") < text.index("getbit")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Numbers that are equal in a join are found whatever their width; of keys that cannot be compared by a hash all stay.
    numbers = skew.key_bits(spark.range(10).select(F.col("id").cast("int").alias("n")), ["n"])
    assert skew.likely(spark.range(100), ["id"], numbers).count() == 10 and skew.likely(view, ["k"], numbers).count() == 5000
    none = skew.key_bits(wanted.filter("k = 'x'"), ["k"])
    assert [skew.likely(view, ["k"], none, below).count() for below in (False, True)] == [0, 0]


def test_hot_keys_among_large_groups_of_keys(spark, settings, monkeypatch):
    monkeypatch.setattr(skew, "KEY_GROUPS", 1)
    settings(hotRows=10)
    rows = cut(spark.range(1000).select("id", F.when(F.col("id") >= 700, F.col("id")).alias("k")))
    assert skew.hot_keys(rows, ["id"]) is None
    assert [(r["k"], r["_n"]) for r in skew.hot_keys(rows, ["k"]).collect()] == [(None, 700)]


def test_rows_of_other_policies_are_left_out_before_they_move(tables):
    t = frames(tables, POLICY)
    some = cut(transactions.master_policies(t, None).filter("lob_n = 'BP'").select("code_n"))
    every = [*transactions.transaction_rows(t), transactions.building_class(t, transactions.master_policies(t, None))]
    few = [*transactions.transaction_rows(t, skew.key_bits(some, ["code_n"])), transactions.building_class(t, some)]
    for a, b in zip(every, few, strict=True):
        a, b = cut(a), cut(b)
        theirs = a.join(some, "code_n", "left_semi")
        assert theirs.count() > 0 and theirs.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert b.count() < theirs.count() * 1.1 < a.count()


def test_the_fact_works_its_policies_out_once(tables):
    text = plan(transactions.fact_transactions(frames(tables, POLICY), HOUSE))
    dealt = [u.split("FileScan parquet", 1) for u in text.split("REPARTITION_BY_COL")[1:]]
    policies = [above for above, scan in dealt if scan.startswith(" [code_n")]
    # All read what was written, and none is filtered in a way of its own, so they share one exchange.
    assert len(policies) > 1 and not any("getbit" in above for above in policies)
    assert "c_acctbal" not in text
