"""Aggregations and the analytic reports."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tarnwork.functions.columns import money_sum, units
from tarnwork.operators import aggregates as a
from tarnwork.operators.runlog import run_zone_rollup
from tarnwork.queries.registry import query

AS_OF = date(2000, 6, 30)
MONEY = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"
TOTAL = MONEY.format(c="o_totalprice")


@query("agg_totals", f"""
    SELECT l_returnflag, l_linestatus, {MONEY.format(c='l_quantity')} AS sum_qty, {MONEY.format(c='l_extendedprice')} AS sum_price, {MONEY.format(c='l_tax')} AS sum_tax,
           COUNT(*) AS line_count, MAX(l_discount) AS max_discount FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_totals(t):
    return a.totals(t.lineitem, ["l_returnflag", "l_linestatus"], {
        "sum_qty": money_sum("l_quantity"), "sum_price": money_sum("l_extendedprice"), "sum_tax": money_sum("l_tax"),
        "line_count": F.count(F.lit(1)), "max_discount": F.max("l_discount"),
    })


@query("agg_min_max", "SELECT o_custkey, MIN(o_orderdate) AS min_o_orderdate, MAX(o_orderdate) AS max_o_orderdate FROM orders GROUP BY o_custkey")
def agg_min_max(t):
    return a.min_max(t.orders, ["o_custkey"], "o_orderdate")


STAGES = {"submission": "signup", "quote": "click", "bind": "purchase"}
PAIRS = [("submission", "quote"), ("quote", "bind"), ("submission", "bind")]
FUNNEL = """SELECT n.n_name, c.c_mktsegment, COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS submission_count, COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS quote_count,
    COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS bind_count FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey
    GROUP BY n.n_name, c.c_mktsegment"""


def funnel(t):
    rows = t.events.join(t.customer, F.col("c_custkey") == F.col("user_id")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return a.funnel(rows, ["n_name", "c_mktsegment"], "event_type", STAGES)


@query("funnel_counts", FUNNEL)
def funnel_counts(t):
    return funnel(t)


@query("funnel_ratios", f"""
    SELECT *, CAST(quote_count AS DOUBLE) / nullif(CAST(submission_count AS DOUBLE), 0) AS submission_to_quote_ratio, CAST(bind_count AS DOUBLE) / nullif(CAST(quote_count AS DOUBLE), 0) AS quote_to_bind_ratio,
           CAST(bind_count AS DOUBLE) / nullif(CAST(submission_count AS DOUBLE), 0) AS submission_to_bind_ratio FROM ({FUNNEL})""")
def funnel_ratios(t):
    return a.funnel_ratios(funnel(t), PAIRS)


@query("inforce_book", f"""
    SELECT c.c_mktsegment, n.n_name, p.p_type, COUNT(*) AS inforce_count, {MONEY.format(c='l_extendedprice')} AS total_premium
    FROM (SELECT *, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE l_shipdate END AS end_date FROM lineitem) l
    JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN part p ON p.p_partkey = l.l_partkey
    WHERE end_date IS NULL OR end_date >= DATE '2000-06-30' GROUP BY c.c_mktsegment, n.n_name, p.p_type""")
def inforce_book(t):
    return a.inforce(policies(t), ["c_mktsegment", "n_name", "p_type"], "end_date", money_sum("l_extendedprice"), AS_OF)


def policies(t):
    """Line items as policies: open ones have no end date."""
    is_open = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    lines = t.lineitem.withColumn("end_date", F.when(~is_open, F.col("l_shipdate")))
    rows = lines.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return rows.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey"))


C360 = f"""SELECT c_custkey, c_name, c_mktsegment, COUNT(DISTINCT o_orderkey) AS total_policies, {MONEY.format(c='l_extendedprice')} AS total_premium, {MONEY.format(c='l_quantity')} AS total_exposure,
    string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS categories, COUNT(DISTINCT p_type) AS category_count
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
    WHERE (l_linestatus = 'O' AND l_returnflag = 'N') OR l_shipdate >= DATE '2001-06-30' GROUP BY c_custkey, c_name, c_mktsegment"""


def c360(t):
    alive = policies(t).filter(F.col("end_date").isNull() | (F.col("end_date") >= F.lit(date(2001, 6, 30))))
    measures = {"total_premium": money_sum("l_extendedprice"), "total_exposure": money_sum("l_quantity")}
    return a.customer_360(alive, ["c_custkey", "c_name", "c_mktsegment"], "o_orderkey", measures, "p_type")


@query("customer_360", C360)
def customer_360(t):
    return c360(t)


@query("cross_sell", f"SELECT c_custkey, c_mktsegment, category_count, CASE WHEN category_count = 1 AND c_mktsegment = 'BUILDING' THEN 'High' ELSE 'Low' END AS cross_sell_priority FROM ({C360})")
def cross_sell(t):
    return a.cross_sell(c360(t), "c_mktsegment", "BUILDING").select("c_custkey", "c_mktsegment", "category_count", "cross_sell_priority")


@query("bucket_counts_at", """
    SELECT event_type, COUNT(*) AS policy_count FROM (SELECT event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-16')
    WHERE rn = 1 GROUP BY event_type""")
def bucket_counts_at(t):
    return a.bucket_counts(t.events, ["user_id"], "ts", "event_type", date(2024, 1, 15), tie="event_id")


@query("monthly_totals", f"SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS order_count, {TOTAL} AS total FROM orders GROUP BY 1, 2")
def monthly_totals(t):
    return a.monthly(t.orders, "o_orderdate", {"order_count": F.count(F.lit(1)), "total": money_sum("o_totalprice")})


@query("yoy_compare", """
    WITH y AS (SELECT year(o_orderdate) AS y, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS p FROM orders GROUP BY 1)
    SELECT 2000 AS year, CAST(a.n AS DOUBLE) AS orders_current, CAST(b.n AS DOUBLE) AS orders_prior, CAST(a.n - b.n AS DOUBLE) AS orders_delta,
           CAST(a.p AS DOUBLE) AS price_current, CAST(b.p AS DOUBLE) AS price_prior, CAST(a.p - b.p AS DOUBLE) AS price_delta FROM y a JOIN y b ON a.y = 2000 AND b.y = 1999""")
def yoy_compare(t):
    return a.yoy(t.orders, "o_orderdate", {"orders": F.lit(1), "price": units("o_totalprice") * Decimal("0.01")}, 2000)


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("order_count"), money_sum("o_totalprice").alias("total"))


@query("ytd", f"SELECT o_orderstatus, COUNT(*) AS order_count, {TOTAL} AS total FROM orders WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-07-01' GROUP BY o_orderstatus")
def ytd(t):
    return _by_status(a.ytd(t.orders, "o_orderdate", AS_OF))


@query("rolling_12m", f"SELECT o_orderstatus, COUNT(*) AS order_count, {TOTAL} AS total FROM orders WHERE o_orderdate >= DATE '1999-07-01' AND o_orderdate < DATE '2000-07-01' GROUP BY o_orderstatus")
def rolling_12m(t):
    return _by_status(a.rolling_12m(t.orders, "o_orderdate", AS_OF))


@query("prior_year_period", f"""
    SELECT 'ytd' AS period, o_orderstatus, COUNT(*) AS order_count, {TOTAL} AS total FROM orders WHERE o_orderdate >= DATE '1999-01-01' AND o_orderdate < DATE '1999-07-01' GROUP BY o_orderstatus
    UNION ALL SELECT 'rolling_12m', o_orderstatus, COUNT(*), {TOTAL} FROM orders WHERE o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1999-07-01' GROUP BY o_orderstatus""")
def prior_year_period(t):
    parts = [_by_status(a.prior_year(t.orders, "o_orderdate", AS_OF, p)).select(F.lit(p).alias("period"), "o_orderstatus", "order_count", "total") for p in ("ytd", "rolling_12m")]
    return parts[0].unionByName(parts[1])


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


@query("collect_sorted", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, COUNT(*) AS n FROM nation GROUP BY n_regionkey")
def collect_sorted(t):
    lists = a.collect_sorted(t.nation, ["n_regionkey"], "n_name", "names")
    return lists.select("n_regionkey", F.array_join("names", ",").alias("names"), F.size("names").cast("long").alias("n"))


@query("quoted_list", """SELECT r_name, concat('''', string_agg(n_name, ''',''' ORDER BY n_name), '''') AS quoted FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def quoted_list(t):
    return a.quoted_list(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), ["r_name"], "n_name")


GATE = """SELECT MIN(COALESCE(good, 0)) FROM (VALUES {v}) w(k) LEFT JOIN (SELECT event_type, MIN(CASE WHEN value {c} THEN 1 ELSE 0 END) AS good FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-16' GROUP BY event_type) e ON e.event_type = w.k"""


@query("completeness_gate", f"""
    SELECT 'all present' AS gate, CAST(({GATE.format(v="('click'), ('view'), ('error')", c='> -1')}) AS INTEGER) AS complete
    UNION ALL SELECT 'one missing', CAST(({GATE.format(v="('click'), ('view'), ('refund')", c='> -1')}) AS INTEGER)
    UNION ALL SELECT 'one not good', CAST(({GATE.format(v="('click'), ('view'), ('error')", c='> 50')}) AS INTEGER)""")
def completeness_gate(t):
    day = date(2024, 1, 16)
    def gate(name, expected, low):
        rows = t.events.withColumn("state", (F.col("value") > low).cast("int"))
        return a.completeness_gate(rows, "event_type", expected, "ts", day, "state", 1).select(F.lit(name).alias("gate"), "complete")

    first = gate("all present", ["click", "view", "error"], -1).unionByName(gate("one missing", ["click", "view", "refund"], -1))
    return first.unionByName(gate("one not good", ["click", "view", "error"], 50))


@query("reconcile_sums", """
    WITH f AS (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS a, SUM(CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS b FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_orderkey),
         s AS (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS a, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS b FROM lineitem GROUP BY l_orderkey)
    SELECT f.k AS l_orderkey, CASE WHEN f.a = s.a THEN 1 ELSE 0 END AS price_ok, CASE WHEN f.b = s.b THEN 1 ELSE 0 END AS quantity_ok FROM f LEFT JOIN s ON f.k = s.k""")
def reconcile_sums(t):
    fact = t.lineitem.filter("l_returnflag <> 'A'").withColumn("q", F.when(F.col("l_linenumber") != 7, F.col("l_quantity")))
    return a.reconcile(fact, t.lineitem, ["l_orderkey"], {"price_ok": ("l_extendedprice", "l_extendedprice"), "quantity_ok": ("q", "l_quantity")})


ZONE_LOG_SQL = """SELECT user_id, event_type, event_id, ts, CASE WHEN event_type = 'error' OR value > 150 THEN 'Failed' ELSE 'Success' END AS status, CAST(json_extract(props, '$.k') AS BIGINT) AS size FROM events"""


def zone_log(t):
    """Events as run-log rows: run = user, zone = type, size = the number in the properties."""
    failed = (F.col("event_type") == "error") | (F.col("value") > 150)
    return t.events.select("user_id", "event_type", "event_id", "ts", F.when(failed, "Failed").otherwise("Success").alias("status"), F.from_json("props", "k bigint")["k"].alias("size"))


@query("run_zone_rollup", f"""
    WITH l AS ({ZONE_LOG_SQL}), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM l)
    SELECT user_id, event_type, MIN(ts) AS zone_start, MAX(ts) AS zone_end, MAX(CASE WHEN rn = 1 THEN status END) AS latest_status,
           CASE WHEN bool_or(status = 'Failed') THEN 'Failed' ELSE 'Success' END AS zone_status, CAST(CASE WHEN bool_or(status = 'Failed') THEN 0 ELSE SUM(size) END AS BIGINT) AS total_size
    FROM r GROUP BY user_id, event_type""")
def zone_rollup(t):
    return run_zone_rollup(zone_log(t), "user_id", "event_type", "ts", "status", "size", tie="event_id")
