"""Window operators."""

from decimal import Decimal

from pyspark.sql import functions as F

from tarnwork.functions.columns import units
from tarnwork.operators import windows as w
from tarnwork.operators.merge import cdc_latest
from tarnwork.queries.registry import query
from tarnwork.queries.sources import FEED

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER_SQL = "l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


def line_order():
    rest = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return [F.col("l_shipdate").desc(), *[F.col(c) for c in rest]]


@query("latest_per_key", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM
      (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return w.latest_per_key(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("dups_quarantine_all", """
    SELECT l.*, CASE WHEN n = 1 THEN 'clean' ELSE 'duplicate' END AS part FROM lineitem l
    JOIN (SELECT l_orderkey AS k, l_linenumber AS m, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) ON k = l_orderkey AND m = l_linenumber""")
def dups_quarantine_all(t):
    clean, out = w.split_duplicates(t.lineitem, LINE_KEYS, w.QUARANTINE_ALL)
    return clean.withColumn("part", F.lit("clean")).unionByName(out.withColumn("part", F.lit("duplicate")))


@query("dups_retain_one", f"""
    SELECT * EXCLUDE (rn), CASE WHEN rn = 1 THEN 'clean' ELSE 'duplicate' END AS part FROM
      (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem)""")
def dups_retain_one(t):
    clean, out = w.split_duplicates(t.lineitem, LINE_KEYS, w.RETAIN_ONE, line_order())
    return clean.withColumn("part", F.lit("clean")).unionByName(out.withColumn("part", F.lit("duplicate")))


@query("drop_dups_subset", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""")
def drop_dups_subset(t):
    return w.drop_dups(t.lineitem, LINE_KEYS, line_order())


@query("cdc_latest", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn FROM (SELECT {', '.join(FEED)} FROM events)) WHERE rn = 1""")
def latest_change(t):
    return cdc_latest(t.events.selectExpr(*FEED), ["user_id"], "lsn", "seq")


@query("dominant_class", """
    SELECT l_orderkey, p_brand, exposure, premium FROM (
      SELECT l_orderkey, p_brand, exposure, premium, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY exposure DESC, premium DESC, p_brand) AS rn FROM (
        SELECT l_orderkey, p_brand, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS exposure, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS premium
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)) WHERE rn = 1""")
def dominant_class(t):
    from tarnwork.plans.transactions import dominant

    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return dominant(rows, ["l_orderkey"], ["p_brand"], {"exposure": "l_quantity", "premium": "l_extendedprice"}, [F.col("exposure").desc(), F.col("premium").desc(), F.col("p_brand")])


@query("top_building", f"""
    SELECT l_orderkey, l_partkey, l_extendedprice, l_quantity FROM
      (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_quantity DESC, {LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""")
def top_building(t):
    order = [F.col("l_extendedprice").desc(), F.col("l_quantity").desc(), *line_order()]
    return w.top_n_per_key(t.lineitem, ["l_orderkey"], order, 1).select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")


@query("first_value_frame", """
    SELECT o_orderkey, o_custkey, FIRST_VALUE(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS latest_priority FROM orders""")
def first_value_frame(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    out = w.first_value(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], "o_orderpriority", "latest_priority")
    return out.select("o_orderkey", "o_custkey", "latest_priority")


@query("days_in_status", """
    SELECT event_id, user_id, event_type, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type,
           CAST(datediff('day', LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS INTEGER) AS days_in_status FROM events""")
def days_in_status(t):
    rows = w.with_previous(t.events.select("event_id", "user_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"], {"previous_type": "event_type", "prev_ts": "ts"})
    return rows.select("event_id", "user_id", "event_type", "previous_type", F.datediff("ts", "prev_ts").alias("days_in_status"))


@query("window_sum", "SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS customer_total FROM orders")
def window_sum(t):
    out = w.window_sum(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], {"customer_total": units("o_totalprice")})
    return out.select("o_orderkey", "o_custkey", (F.col("customer_total") * Decimal("0.01")).cast("double").alias("customer_total"))


@query("sequence_in_key", "SELECT event_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def sequence_in_key(t):
    return w.sequence(t.events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "seq")


@query("prev_row_change", """
    WITH s AS (SELECT event_id, user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rcount FROM events)
    SELECT a.event_id, a.rcount, b.rcount AS prev_rcount, b.event_type AS prev_type, CASE WHEN a.event_type = b.event_type THEN 'N' ELSE 'Y' END AS changed
    FROM s a LEFT JOIN s b ON a.user_id = b.user_id AND a.rcount - 1 = b.rcount""")
def prev_row_change(t):
    rows = w.running(
        t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], {"rcount": ("row_number",), "prev_type": ("lag", "event_type")}
    )
    return rows.select(
        "event_id", "rcount", F.when(F.col("rcount") > 1, F.col("rcount") - 1).alias("prev_rcount"), "prev_type",
        F.when(F.col("event_type") == F.col("prev_type"), "N").otherwise("Y").alias("changed"),
    )


@query("surrogate_dense", "SELECT p_partkey, p_name, ROW_NUMBER() OVER (ORDER BY p_name, p_partkey) AS part_key FROM part")
def surrogate_dense(t):
    return w.dense_number(t.part.select("p_partkey", "p_name"), ["p_name", "p_partkey"], "part_key", 1)
