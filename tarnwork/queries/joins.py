"""Joins and set operations."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tarnwork.functions.columns import money_sum, units
from tarnwork.operators import joins as j
from tarnwork.operators import sets
from tarnwork.queries.registry import query

FAR = datetime(9999, 12, 31)


@query("join_inner", """
    SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_left", """
    SELECT c.c_custkey, c.c_name, o.order_count, o.total FROM customer c LEFT JOIN
      (SELECT o_custkey, COUNT(*) AS order_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) o
      ON o.o_custkey = c.c_custkey""")
def join_left(t):
    sums = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("order_count"), money_sum("o_totalprice").alias("total"))
    return j.left_lookup(t.customer.select("c_custkey", "c_name"), sums, ["c_custkey"])


@query("star_lookup", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, COALESCE(CAST(o.o_orderkey AS BIGINT), -1) AS order_key, COALESCE(p.p_partkey, -1) AS part_key,
           COALESCE(s.s_suppkey, -1) AS supplier_key, COALESCE(c.c_custkey, -1) AS customer_key, COALESCE(n.n_nationkey, -1) AS nation_key, c.c_mktsegment AS segment
    FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON o.o_custkey = c.c_custkey
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON s.s_nationkey = n.n_nationkey""")
def star_lookup(t):
    """Line items against five dimensions that lack their inactive members."""
    dims = [
        (t.orders.filter("o_orderstatus <> 'P'"), {"l_orderkey": "o_orderkey"}, {"order_key": "o_orderkey"}, {"custkey": "o_custkey"}),
        (t.part.filter("p_size > 10"), {"l_partkey": "p_partkey"}, {"part_key": "p_partkey"}),
        (t.supplier.filter("s_acctbal > 0"), {"l_suppkey": "s_suppkey"}, {"supplier_key": "s_suppkey"}, {"snation": "s_nationkey"}),
        (t.customer.filter("c_mktsegment <> 'BUILDING'"), {"custkey": "c_custkey"}, {"customer_key": "c_custkey"}, {"segment": "c_mktsegment"}),
        (t.nation.filter("n_regionkey < 3"), {"snation": "n_nationkey"}, {"nation_key": "n_nationkey"}),
    ]
    return j.star_lookup(t.lineitem, dims).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "order_key", "part_key", "supplier_key", "customer_key", "nation_key", "segment"
    )


@query("join_norm_key", """
    WITH brands AS (SELECT p_brand, COUNT(*) AS brand_parts FROM part GROUP BY p_brand)
    SELECT p.p_partkey, b.brand_parts FROM part p JOIN brands b ON upper(trim(p.p_brand)) = upper(trim(b.p_brand))""")
def join_norm_key(t):
    brands = t.part.groupBy(F.concat(F.lit(" "), F.lower("p_brand"), F.lit("  ")).alias("brand")).agg(F.count(F.lit(1)).alias("brand_parts"))
    return j.join_norm(t.part, brands, {"p_brand": "brand"}).select("p_partkey", "brand_parts")


DATE_KEY = "CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INT)"


@query("role_playing_date", """
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
         dim AS (SELECT d, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS k FROM d)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, COALESCE(a.k, -1) AS order_dt_key, COALESCE(b.k, -1) AS ship_dt_key, COALESCE(e.k, -1) AS due_dt_key
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN dim a ON CAST(o.o_orderdate AS DATE) = a.d LEFT JOIN dim b ON CAST(l.l_shipdate AS DATE) = b.d
    LEFT JOIN dim e ON CAST(o.o_orderdate + INTERVAL 90 DAY AS DATE) = e.d""")
def role_playing_date(t):
    dim = t.orders.select(F.to_date("o_orderdate").alias("date")).distinct().selectExpr("date", DATE_KEY.format(c="date") + " AS date_key")
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("due", F.expr("o_orderdate + INTERVAL 90 DAYS"))
    roles = {"order_dt_key": "o_orderdate", "ship_dt_key": "l_shipdate", "due_dt_key": "due"}
    return j.date_roles(fact, dim, roles).select("l_orderkey", "l_linenumber", "l_partkey", *roles)


@query("join_composite", """
    WITH d AS (SELECT p_brand, p_type, p_size, MIN(p_partkey) AS first_part, COUNT(*) AS n FROM part GROUP BY p_brand, p_type, p_size)
    SELECT p.p_partkey, d.first_part, d.n FROM part p JOIN d ON p.p_brand = d.p_brand AND p.p_type = d.p_type AND p.p_size = d.p_size""")
def join_composite(t):
    keys = ["p_brand", "p_type", "p_size"]
    dim = t.part.groupBy(*keys).agg(F.min("p_partkey").alias("first_part"), F.count(F.lit(1)).alias("n"))
    return t.part.join(dim, keys).select("p_partkey", "first_part", "n")


@query("join_case_key", """
    WITH dim AS (SELECT o_orderpriority AS cls, o_orderstatus AS suffix, MIN(o_orderkey) AS class_key FROM orders WHERE o_orderstatus <> 'O' GROUP BY o_orderpriority, o_orderstatus
                 UNION ALL SELECT 'not applicable', 'not applicable', -9)
    SELECT o.o_orderkey, d.class_key FROM orders o LEFT JOIN dim d
      ON d.cls = CASE WHEN o.o_totalprice > 200000 THEN '1-URGENT' WHEN o.o_orderstatus = 'O' THEN 'not applicable' ELSE o.o_orderpriority END
     AND d.suffix = CASE WHEN o.o_totalprice > 200000 THEN 'F' WHEN o.o_orderstatus = 'O' THEN 'not applicable' ELSE o.o_orderstatus END""")
def join_case_key(t):
    dim = t.orders.filter("o_orderstatus <> 'O'").groupBy(F.col("o_orderpriority").alias("cls"), F.col("o_orderstatus").alias("suffix")).agg(F.min("o_orderkey").alias("class_key"))
    dim = dim.unionByName(t.spark.createDataFrame([("not applicable", "not applicable", -9)], dim.schema))
    big, is_open = F.col("o_totalprice") > 200000, F.col("o_orderstatus") == "O"
    on = {
        "cls": F.when(big, "1-URGENT").when(is_open, "not applicable").otherwise(F.col("o_orderpriority")),
        "suffix": F.when(big, "F").when(is_open, "not applicable").otherwise(F.col("o_orderstatus")),
    }
    return j.join_on_exprs(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), dim, on).select("o_orderkey", "class_key")


CODES = [
    ("ORDERS", "STATUS", "f", "Finished"), ("orders", "status", "O", "Open"), ("Orders", "Status", "P", "Pending"),
    ("orders", "priority", "1-URGENT", "Urgent"), ("orders", "PRIORITY", "2-high", "High"), ("orders", "priority", "3-MEDIUM", "Medium"),
    ("customer", "segment", "BUILDING", "Builder"), ("customer", "segment", "machinery", "Machines"), ("other", "status", "F", "wrong program"),
]
CODE_VALUES = ", ".join(str(r) for r in CODES)


@query("lookup_codes", f"""
    WITH codes(programid, keyfield, vals, descrip) AS (VALUES {CODE_VALUES})
    SELECT o.o_orderkey, a.descrip AS status_desc, b.descrip AS priority_desc, d.descrip AS segment_desc
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN codes a ON upper(a.programid) = 'ORDERS' AND upper(a.keyfield) = 'STATUS' AND upper(a.vals) = upper(o.o_orderstatus)
    LEFT JOIN codes b ON upper(b.programid) = 'ORDERS' AND upper(b.keyfield) = 'PRIORITY' AND upper(b.vals) = upper(o.o_orderpriority)
    LEFT JOIN codes d ON upper(d.programid) = 'CUSTOMER' AND upper(d.keyfield) = 'SEGMENT' AND upper(d.vals) = upper(c.c_mktsegment)""")
def lookup_codes(t):
    codes = t.spark.createDataFrame(CODES, "programid string, keyfield string, vals string, descrip string")
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    wanted = [("orders", "status", "o_orderstatus", "status_desc"), ("orders", "priority", "o_orderpriority", "priority_desc"), ("customer", "segment", "c_mktsegment", "segment_desc")]
    return j.lookup_codes(o, codes, wanted).select("o_orderkey", "status_desc", "priority_desc", "segment_desc")


# Versions: each signup of a user starts one; it ends a microsecond before the next.
VERSIONS = """versions AS (SELECT user_id, value AS plan, ts AS v_start,
    COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - INTERVAL 1 MICROSECOND, TIMESTAMP '9999-12-31') AS v_end
    FROM events WHERE event_type = 'signup')"""
HIT = """hit AS (SELECT f.event_id, f.user_id, f.ts, f.value, v.plan, v.v_start FROM events f
    LEFT JOIN versions v ON f.user_id = v.user_id AND f.ts BETWEEN v.v_start AND v.v_end WHERE f.event_type = 'purchase')"""


def signup_versions(t):
    """The next start comes from the running form read backwards in time, so a hot user is split like any other."""
    from tarnwork.operators.windows import running

    signups = t.events.filter("event_type = 'signup'").select("user_id", "event_id", "ts", F.col("value").alias("plan"))
    back = signups.withColumns({"_t": -F.unix_micros(F.col("ts").cast("timestamp")), "_e": -F.col("event_id")})
    nxt = running(back, ["user_id"], ["_t", "_e"], {"next_start": ("lag", "ts")})
    return nxt.select(
        "user_id", "plan", F.col("ts").alias("v_start"),
        F.coalesce(F.expr("next_start - INTERVAL '0.000001' SECOND"), F.lit(FAR)).cast("timestamp_ntz").alias("v_end"),
    )


def purchases(t):
    return t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


@query("join_scd2_asof", f"WITH {VERSIONS}, {HIT} SELECT event_id, user_id, ts, value, plan FROM hit")
def join_scd2_asof(t):
    return j.scd2_join(purchases(t), signup_versions(t), ["user_id"], "ts", "v_start", "v_end", ["plan"])


@query("late_arriving_fact", f"""
    WITH {VERSIONS}, {HIT}, latest AS (SELECT user_id, plan FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY v_start DESC) AS rn FROM versions) WHERE rn = 1)
    SELECT h.event_id, h.user_id, h.ts, h.value, CASE WHEN h.v_start IS NOT NULL THEN h.plan ELSE l.plan END AS plan
    FROM hit h LEFT JOIN latest l ON h.user_id = l.user_id""")
def late_arriving_fact(t):
    return j.scd2_join(purchases(t), signup_versions(t), ["user_id"], "ts", "v_start", "v_end", ["plan"], fallback="latest")


@query("join_asof_latest", """
    SELECT a.event_id, a.user_id, a.ts, b.value AS click_value, b.event_id AS click_id FROM
      (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') b
      ON a.user_id = b.user_id AND a.ts >= b.ts""")
def join_asof_latest(t):
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = t.events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("click_ts"), F.col("value").alias("click_value"), F.col("event_id").alias("click_id"))
    return j.asof_latest(buys, clicks, ["user_id"], "ts", "click_ts", ["click_value", "click_id"], tie="click_id")


@query("next_in_chain", """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, LAG(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS renew_of,
                      CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey + 1 END AS renewed_by FROM orders),
         refs AS (SELECT renew_of, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY renew_of ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM o WHERE renew_of IS NOT NULL) WHERE rn = 1)
    SELECT o.o_orderkey, n.o_orderkey AS next_id, n.o_orderstatus AS next_o_orderstatus
    FROM o LEFT JOIN refs r ON r.renew_of = o.o_orderkey LEFT JOIN o n ON n.o_orderkey = COALESCE(o.renewed_by, r.o_orderkey)""")
def next_in_chain(t):
    from tarnwork.operators.windows import with_previous

    o = with_previous(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"), ["o_custkey"], ["o_orderdate", "o_orderkey"], {"renew_of": "o_orderkey"})
    o = o.withColumn("renewed_by", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey") + 1))
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return j.next_in_chain(o, "o_orderkey", "renewed_by", "renew_of", order, ["o_orderstatus"]).select("o_orderkey", "next_id", "next_o_orderstatus")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_anti(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(urgent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def join_semi(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("exists_flag", """
    SELECT o.o_orderkey, CASE WHEN l.l_orderkey IS NOT NULL THEN 1 ELSE 0 END AS has_return
    FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) l ON l.l_orderkey = o.o_orderkey""")
def exists_flag(t):
    returned = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 45")
    return j.exists_flag(t.orders.select("o_orderkey"), returned, {"o_orderkey": "l_orderkey"}, "has_return")


@query("join_null_safe", """
    WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st FROM orders), s AS (SELECT st, COUNT(*) AS status_orders FROM o GROUP BY st)
    SELECT o.o_orderkey, o.st, s.status_orders FROM o JOIN s ON o.st IS NOT DISTINCT FROM s.st""")
def join_null_safe(t):
    o = t.orders.select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("st"))
    return j.join_null_safe(o, o.groupBy("st").agg(F.count(F.lit(1)).alias("status_orders")), ["st"])


@query("correlated_sum", """
    SELECT o_orderkey, o_totalprice,
      (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem WHERE l_orderkey = o_orderkey) AS line_total,
      (SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem WHERE l_orderkey = o_orderkey) AS line_quantity FROM orders""")
def correlated_sum(t):
    sums = {"line_total": units("l_extendedprice"), "line_quantity": units("l_quantity")}
    out = j.with_child_sums(t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, {"o_orderkey": "l_orderkey"}, sums)
    return out.withColumns({c: (F.col(c) * Decimal("0.01")).cast("double") for c in sums})


@query("changed_rows", """
    WITH s AS (SELECT o_orderkey, md5(concat(o_orderstatus, o_orderpriority)) AS h FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
         t AS (SELECT o_orderkey, md5(concat(CASE WHEN o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END, o_orderpriority)) AS h FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
    SELECT s.o_orderkey, s.h FROM s JOIN t ON s.o_orderkey = t.o_orderkey WHERE s.h <> t.h""")
def changed_rows(t):
    s = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01'").select("o_orderkey", F.md5(F.concat("o_orderstatus", "o_orderpriority")).alias("h"))
    old = F.when(F.col("o_totalprice") > 100000, "X").otherwise(F.col("o_orderstatus"))
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").select("o_orderkey", F.md5(F.concat(old, "o_orderpriority")).alias("h"))
    return j.changed_rows(s, target, ["o_orderkey"], "h")


@query("join_choice_fk", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, n.n_name AS choice_name FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = CASE WHEN l.l_returnflag = 'R' THEN c.c_nationkey ELSE s.s_nationkey END""")
def join_choice_fk(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    keyed = j.choice_key(rows, F.col("l_returnflag") == "R", "c_nationkey", "s_nationkey", "choice")
    return keyed.join(t.nation, F.col("choice") == F.col("n_nationkey"), "left").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("n_name").alias("choice_name"))


# Set operations and order ---------------------------------------------------------------------------------------------

CUT = "TIMESTAMP '1998-01-01'"


@query("union_all", f"""
    SELECT o_orderkey, o_totalprice, 'archive' AS src FROM orders WHERE o_orderdate < {CUT}
    UNION ALL SELECT o_orderkey, o_totalprice, 'current' FROM orders WHERE o_orderdate >= {CUT}
    UNION ALL SELECT o_orderkey, o_totalprice, 'current' FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < {CUT}""")
def union_all(t):
    cols = ["o_orderkey", "o_totalprice"]
    old, new = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'"), t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'")
    cur = new.unionAll(old.filter("o_orderstatus = 'P'")).select(*cols, F.lit("current").alias("src"))
    return old.select(*cols, F.lit("archive").alias("src")).union(cur)


@query("union_distinct", "SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 30")
def union_distinct(t):
    a = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
    b = t.lineitem.filter("l_quantity > 30").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))
    return a.union(b).distinct()


@query("union_by_name", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation""")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    n = t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("id"))
    return sets.union_all_by_name(a, b, n)


@query("dim_two_branch", """
    SELECT DISTINCT concat('CUS-', CAST(c_custkey AS VARCHAR)) AS party_bus_key, c_name AS party_nm, c_mktsegment AS party_type, 0 AS external_flg, c_acctbal AS limit_amt FROM customer
    UNION ALL SELECT DISTINCT concat('SUP-', CAST(s_suppkey AS VARCHAR)), concat(trim(s_name), '(', CAST(s_nationkey AS VARCHAR), ')'), 'NA', 1, 0.0::DOUBLE FROM supplier""")
def dim_two_branch(t):
    text = "string"
    return sets.two_branch(t.customer, t.supplier, {
        "party_bus_key": (F.concat(F.lit("CUS-"), F.col("c_custkey").cast(text)), F.concat(F.lit("SUP-"), F.col("s_suppkey").cast(text))),
        "party_nm": (F.col("c_name"), F.concat(F.trim("s_name"), F.lit("("), F.col("s_nationkey").cast(text), F.lit(")"))),
        "party_type": (F.col("c_mktsegment"), F.lit("NA")),
        "external_flg": (F.lit(0), F.lit(1)),
        "limit_amt": (F.col("c_acctbal"), F.lit(0.0)),
    })


@query("permission_diff", """
    WITH cur AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 25 AND p_brand <> 'Brand#3'), des AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 20 AND p_brand <> 'Brand#5'),
    f AS (SELECT COALESCE(c.p_brand, d.p_brand) AS p_brand, COALESCE(c.p_type, d.p_type) AS p_type, c.p_type AS c, d.p_type AS d
          FROM cur c FULL JOIN des d ON c.p_brand = d.p_brand AND c.p_type = d.p_type),
    g AS (SELECT p_brand, COALESCE(string_agg(CASE WHEN c IS NULL THEN p_type END, ',' ORDER BY p_type), '') AS added,
                 COALESCE(string_agg(CASE WHEN d IS NULL THEN p_type END, ',' ORDER BY p_type), '') AS removed, COUNT(c) AS nc, COUNT(d) AS nd FROM f GROUP BY p_brand)
    SELECT p_brand, added, removed, CASE WHEN nc = 0 THEN 'new' WHEN nd = 0 THEN 'removed' WHEN added = '' AND removed = '' THEN 'unchanged' ELSE 'changed' END AS change FROM g""")
def permission_diff(t):
    cur = t.part.filter("p_size <= 25 AND p_brand <> 'Brand#3'")
    des = t.part.filter("p_size > 20 AND p_brand <> 'Brand#5'")
    return sets.list_diff(cur, des, "p_brand", "p_type")


@query("order_by", "SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders ORDER BY 1 ASC NULLS FIRST, 2 DESC NULLS LAST, 3")
def order_by(t):
    return t.orders.select("o_orderstatus", "o_totalprice", "o_orderkey").orderBy(F.col("o_orderstatus").asc_nulls_first(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey")


@query("top_k", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def top_k(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate").orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(25)
