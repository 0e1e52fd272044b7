"""Data quality."""

from datetime import datetime

from pyspark.sql import functions as F

from tarnwork.operators import quality as q
from tarnwork.operators import sets
from tarnwork.operators import windows as w
from tarnwork.queries.registry import query
from tarnwork.queries.windows import LINE_KEYS, LINE_ORDER_SQL, line_order

WHEN = datetime(2025, 1, 1, 6)
RANKED = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem"
STAMP = "TIMESTAMP '2025-01-01 06:00:00'"


def ntz(df, *cols):
    """Literal times come as instants; the given tables hold local times."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def quarantined(t):
    _, out = w.split_duplicates(t.lineitem, LINE_KEYS, w.RETAIN_ONE, line_order())
    return ntz(q.quarantine(out, "run-7", WHEN, ["l_tax", "l_discount"]), "quarantined_date_time")


@query("quarantine_rows", f"SELECT * EXCLUDE (rn, l_tax, l_discount), {STAMP} AS quarantined_date_time, 'run-7' AS etl_id, 'Quarantined' AS log_status FROM ({RANKED}) WHERE rn > 1")
def quarantine_rows(t):
    return quarantined(t)


@query("unified_view", f"""
    SELECT * EXCLUDE (rn, l_tax, l_discount), CASE WHEN rn > 1 THEN {STAMP} END AS quarantined_date_time, CASE WHEN rn > 1 THEN 'run-7' END AS etl_id,
           CASE WHEN rn > 1 THEN 'Quarantined' END AS log_status FROM ({RANKED})""")
def unified_view(t):
    clean, _ = w.split_duplicates(t.lineitem, LINE_KEYS, w.RETAIN_ONE, line_order())
    return sets.unified_view(clean.drop("l_tax", "l_discount"), quarantined(t))


def logs(t):
    """Three log rows: duplicates of line items, of line items per supplier and part, and of orders (none)."""
    def log(df, dataset, keys):
        _, out = w.split_duplicates(df, keys, w.QUARANTINE_ALL)
        return q.quarantine_log(out, "sales", "daily", "erp", dataset, "run-7", keys, WHEN)

    first = log(t.lineitem, "lineitem", LINE_KEYS).unionByName(log(t.lineitem, "shipments", ["l_suppkey", "l_partkey"]))
    return first.unionByName(log(t.orders, "orders", ["o_orderkey"]))


COUNTS = """(SELECT CAST(COALESCE(SUM(n), 0) AS INTEGER) FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k} HAVING COUNT(*) > 1))"""
LOGS = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset_name, {COUNTS.format(t=tab, k=', '.join(k))} AS total_rows, '{'~'.join(k)}' AS primary_key_list"
    for d, tab, k in [("lineitem", "lineitem", LINE_KEYS), ("shipments", "lineitem", ["l_suppkey", "l_partkey"]), ("orders", "orders", ["o_orderkey"])]
)


@query("quarantine_log", f"""
    SELECT 'sales' AS product_name, 'daily' AS feed_name, 'erp' AS source_system, dataset_name, 'run-7' AS etl_id, total_rows, 'Duplicate' AS quarantine_type, 'Standard' AS quarantine_level, primary_key_list,
           DATE '2025-01-01' AS log_date, {STAMP} AS log_datetime, FALSE AS is_notification_enabled, CAST(NULL AS TIMESTAMP) AS notification_datetime FROM ({LOGS})""")
def quarantine_log(t):
    return ntz(logs(t), "log_datetime", "notification_datetime")


@query("duplicate_alert", f"SELECT dataset_name, 'Duplicate' AS quarantine_type, 'Standard' AS quarantine_level, 'run-7' AS etl_id, CAST(total_rows AS BIGINT) AS duplicate_rows FROM ({LOGS}) WHERE total_rows > 0")
def duplicate_alert(t):
    return q.duplicate_alert(logs(t), "run-7")


LINE_RULES = [
    q.Rule("flag_known", "expect_column_values_to_be_in_set", {"column": "l_returnflag", "value_set": ["A", "N"]}),
    q.Rule("quantity_range", "expect_column_values_to_be_between", {"column": "l_quantity", "min_value": 3, "max_value": 48}),
    q.Rule("status_pattern", "expect_column_values_to_match_regex", {"column": "l_linestatus", "regex": "^[OF]$"}),
    q.Rule("tax_given", "expect_column_values_to_not_be_null", {"column": "tax_or_null"}),
    q.Rule("line_unique", "expect_compound_columns_to_be_unique", {"column_list": LINE_KEYS}),
    q.Rule("flag_length", "expect_column_value_lengths_to_be_between", {"column": "l_returnflag", "min_value": 1, "max_value": 1}),
    q.Rule("some_rows", "expect_table_row_count_to_be_between", {"min_value": 1, "max_value": None}),
]
FLAGS = """SELECT *, l_returnflag NOT IN ('A', 'N') AS b1, NOT (l_quantity BETWEEN 3 AND 48) AS b2, FALSE AS b3, l_tax = 0.08 AS b4,
    COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS b5 FROM lineitem"""


def lines(t):
    return t.lineitem.withColumn("tax_or_null", F.when(F.col("l_tax") != 0.08, F.col("l_tax")))


@query("dq_rules_rowlevel", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN b1 OR b2 OR b3 OR b4 OR b5 THEN 'failed' ELSE 'clean' END AS part,
           concat_ws(',', CASE WHEN b1 THEN 'flag_known' END, CASE WHEN b2 THEN 'quantity_range' END, CASE WHEN b4 THEN 'tax_given' END, CASE WHEN b5 THEN 'line_unique' END) AS failed_rules FROM ({FLAGS})""")
def dq_rules_rowlevel(t):
    clean, failed, _ = q.apply_rules(lines(t), LINE_RULES)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    a = clean.select(*cols, F.lit("clean").alias("part"), F.lit("").alias("failed_rules"))
    return a.unionByName(failed.select(*cols, F.lit("failed").alias("part"), "failed_rules"))


@query("dq_rule_metrics", f"""
    WITH f AS (SELECT COUNT(*) AS n, COUNT(CASE WHEN b1 THEN 1 END) AS f1, COUNT(CASE WHEN b2 THEN 1 END) AS f2, COUNT(CASE WHEN b4 THEN 1 END) AS f4, COUNT(CASE WHEN b5 THEN 1 END) AS f5 FROM ({FLAGS}))
    SELECT 'flag_known' AS rule_name, 'expect_column_values_to_be_in_set' AS rule_type, n AS evaluated_rows, f1 AS failed_rows, f1 = 0 AS success FROM f
    UNION ALL SELECT 'quantity_range', 'expect_column_values_to_be_between', n, f2, f2 = 0 FROM f UNION ALL SELECT 'status_pattern', 'expect_column_values_to_match_regex', n, 0, TRUE FROM f
    UNION ALL SELECT 'tax_given', 'expect_column_values_to_not_be_null', n, f4, f4 = 0 FROM f UNION ALL SELECT 'line_unique', 'expect_compound_columns_to_be_unique', n, f5, f5 = 0 FROM f
    UNION ALL SELECT 'flag_length', 'expect_column_value_lengths_to_be_between', n, 0, TRUE FROM f UNION ALL SELECT 'some_rows', 'expect_table_row_count_to_be_between', n, 0, TRUE FROM f""")
def dq_rule_metrics(t):
    return q.apply_rules(lines(t), LINE_RULES)[2]


SHEET = """SELECT p_partkey, concat('R', lpad(CAST(p_partkey AS VARCHAR), 12, '0')) AS rid, p_name, p_brand, p_type, p_size, p_retailprice FROM part"""


@query("rule_table_build", f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY rid) AS INTEGER) AS dq_rule_master_key, rid AS dq_rule_id, 'sales' AS data_product_name, p_name AS dq_rule_description, concat('{{"type":"', p_type, '"}}') AS dq_rule_constraint,
           CAST(p_retailprice AS DOUBLE) AS dq_rule_severity_score, TRUE AS is_current_flag, {STAMP} AS row_effective_date, TIMESTAMP '2099-12-31 23:59:59' AS row_expiration_date
    FROM ({SHEET}) WHERE p_size > 5 AND p_brand <> 'Brand#7'""")
def rule_table_build(t):
    """Parts as the rows of a rule sheet, with untidy text, rows without a constraint and inactive groups."""
    sheet = t.part.select(
        F.concat(F.lit(" R"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"), F.lit(" ")).alias("dq_rule_id"), F.lit("sales ").alias("data_product_name"),
        F.concat("p_name", F.lit("  ")).alias("dq_rule_description"),
        F.when(F.col("p_size") > 5, F.concat(F.lit('{"type":"'), "p_type", F.lit('"}'))).otherwise(" ").alias("dq_rule_constraint"),
        F.when(F.col("p_brand") == "Brand#7", "Not Active").otherwise("active").alias("group"), F.col("p_retailprice").cast("string").alias("dq_rule_severity_score"),
    )
    return ntz(q.build_rule_table(sheet, WHEN, group="group"), "row_effective_date", "row_expiration_date")


CONSTRAINT = """CASE event_type WHEN 'click' THEN concat('{"type":"between","kwargs":{"column":"c","min_value":', CAST(event_id AS VARCHAR), '}}')
    WHEN 'view' THEN '{"type":"set","kwargs":{"column":"c"},"meta":{"owner":"x"}}' WHEN 'error' THEN '{"type":"set","kwargs":[1]}' WHEN 'signup' THEN '{"kwargs":{"column":"c"}}'
    ELSE CASE WHEN value > 50 THEN 'not json' WHEN value > 25 THEN '{"type":5,"kwargs":{}}' ELSE '{"type":"set","kwargs":{"column":"c"},"meta":3}' END END"""


@query("constraint_valid", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS is_valid FROM events")
def constraint_valid(t):
    docs = t.events.selectExpr("event_id", CONSTRAINT.replace("VARCHAR", "STRING") + " AS doc")
    return q.check_constraint(docs, "doc").select("event_id", "is_valid")


@query("rule_flags", """
    SELECT o.o_orderkey, CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') AND o.o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS dq_rule_1,
           CASE WHEN c.c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND nullif(o.o_orderstatus, 'P') IS NOT NULL THEN 0 ELSE 1 END AS dq_rule_2 FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def rule_flags(t):
    o = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    listed = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    bad = {"dq_rule_1": listed & (F.col("o_orderpriority") == "1-URGENT"), "dq_rule_2": ~listed & F.expr("nullif(o_orderstatus, 'P') IS NOT NULL")}
    return q.add_rule_flags(o, bad).select("o_orderkey", *bad)


@query("validate_counts", """
    WITH s AS (SELECT COUNT(*) AS n FROM orders), a AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT COUNT(*) AS n FROM lineitem)
    SELECT 'filtered' AS step, s.n AS source_rows, a.n AS processed_rows, 'ok' AS status, 'ok' AS message FROM s, a UNION ALL SELECT 'joined', s.n, b.n, 'warning', 'more rows than the source' FROM s, b
    UNION ALL SELECT 'emptied', s.n, 0, 'failed', 'no rows after processing' FROM s UNION ALL SELECT 'too few', s.n, a.n, 'failed', 'fewer rows than expected' FROM s, a""")
def validate_counts(t):
    done = t.orders.filter("o_orderstatus = 'F'")
    steps = [("filtered", done, 1), ("joined", t.lineitem, 1), ("emptied", t.orders.filter("o_totalprice < 0"), 1), ("too few", done, 10**12)]
    parts = [q.validate_counts(t.orders, df, least).select(F.lit(n).alias("step"), "*") for n, df, least in steps]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("contract_check", """
    SELECT 'orders' AS dataset_name, COUNT(*) AS row_count, CAST(COUNT(nullif(o_orderstatus, 'P')) AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS completeness_pct,
           CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS uniqueness_pct,
           CAST(COUNT(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 END) AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS validity_pct, datediff('day', MAX(o_orderdate), TIMESTAMP '2001-12-31') AS age_days,
           CASE WHEN COUNT(nullif(o_orderstatus, 'P')) * 100.0 / COUNT(*) >= 50 THEN 1 ELSE 0 END AS completeness_met, CASE WHEN COUNT(DISTINCT o_custkey) * 100.0 / COUNT(*) >= 99 THEN 1 ELSE 0 END AS uniqueness_met,
           CASE WHEN COUNT(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 END) * 100.0 / COUNT(*) >= 50 THEN 1 ELSE 0 END AS validity_met,
           CASE WHEN datediff('day', MAX(o_orderdate), TIMESTAMP '2001-12-31') <= 30 THEN 1 ELSE 0 END AS freshness_met FROM orders""")
def contract_check(t):
    o = t.orders.withColumn("st", F.expr("nullif(o_orderstatus, 'P')"))
    sla = {"completeness": 50.0, "uniqueness": 99.0, "validity": 50.0, "freshness_days": 30}
    return q.contract_check(o, "orders", ["st"], ["o_custkey"], {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}, "o_orderdate", sla, datetime(2001, 12, 31))
