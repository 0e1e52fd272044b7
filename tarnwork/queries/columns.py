"""Projections, predicates, technical columns and scalar functions."""

from datetime import datetime

from pyspark.sql import functions as F

from tarnwork.functions import columns as c
from tarnwork.queries.registry import query

KEY = "0123456789abcdef"


@query("project_exprs", """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, upper(l_returnflag) AS flag FROM lineitem""")
def project_exprs(t):
    return c.project(t.lineitem, ["l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net", "upper(l_returnflag) AS flag"])


@query("technical_columns", """
    SELECT c_custkey, c_name, '20250101' AS dl_partitionkey, 1 AS dl_iscurrent, TIMESTAMP '2025-01-01 06:00:00' AS dl_recordstartdateutc,
           CAST(NULL AS TIMESTAMP) AS dl_recordenddateutc, TIMESTAMP '2025-01-01 06:00:00' AS dl_createddateutc,
           TIMESTAMP '2025-01-01 06:00:00' AS dl_lastmodifiedutc, 'customer.parquet' AS dl_sourcefilename, 'elt-1' AS dl_eltid,
           'run-1' AS dl_runid, 0 AS dl_is_deleted, 64 AS hash_length
    FROM customer""")
def technical_columns(t):
    """The stamp, with the file name from the scan; the hash itself is checked by ``row_hash``."""
    df = t.customer.select("c_custkey", "c_name", F.col("_metadata.file_name").alias("dl_file"))
    out = c.add_technical_columns(df, datetime(2025, 1, 1, 6), "elt-1", "run-1", file_name=F.col("dl_file"))
    stamp = ["dl_recordstartdateutc", "dl_recordenddateutc", "dl_createddateutc", "dl_lastmodifiedutc"]
    out = out.withColumns({s: F.col(s).cast("timestamp_ntz") for s in stamp})
    return out.withColumn("hash_length", F.length("dl_rowhash")).drop("dl_file", "dl_sourcefilepath", "dl_rowhash")


def hashed(*cols):
    """SQL of the row hash over columns given in the order of their names."""
    texts = [f"CAST({c} AS VARCHAR)" for c in cols]
    return f"sha256(concat_ws('|', {', '.join(f"COALESCE(length({x}) || ':' || {x}, '~')" for x in texts)}))"


@query("row_hash", f"""
    SELECT n_nationkey AS id, {hashed('n_name', 'n_nationkey', 'n_regionkey')} AS dl_rowhash FROM nation
    UNION ALL SELECT r_regionkey + 1000, {hashed('r_name', 'r_regionkey')} FROM region
    UNION ALL SELECT o_orderkey + 10000, {hashed('o_custkey', 'o_orderkey', "nullif(o_orderstatus, 'P')")} FROM orders""")
def row_hash(t):
    n = t.nation.select(F.col("n_nationkey").cast("long").alias("id"), c.row_hash(t.nation).alias("dl_rowhash"))
    r = t.region.select((F.col("r_regionkey") + 1000).cast("long").alias("id"), c.row_hash(t.region).alias("dl_rowhash"))
    o = t.orders.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    o = o.select((F.col("o_orderkey") + 10000).alias("id"), c.row_hash(o, ["o_orderstatus", "o_orderkey", "o_custkey"]).alias("dl_rowhash"))
    return n.unionByName(r).unionByName(o)


@query("norm_keys", "SELECT p_partkey, upper(trim(concat('  ', lower(p_brand), ' '))) AS brand_norm FROM part")
def norm_keys(t):
    padded = t.part.select("p_partkey", F.concat(F.lit("  "), F.lower("p_brand"), F.lit(" ")).alias("brand"))
    return c.with_norm_keys(padded, ["brand"]).drop("brand")


@query("filter_predicates", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE (l_quantity BETWEEN 5 AND 40 AND l_returnflag IN ('A', 'R')) OR (NOT l_linestatus = 'F' AND l_discount >= 0.05 AND l_tax <> 0.02)
       OR (l_returnflag NOT IN ('A', 'N') AND l_extendedprice < 1000 AND l_shipdate IS NOT NULL)""")
def filter_predicates(t):
    q, flag = F.col("l_quantity"), F.col("l_returnflag")
    first = q.between(5, 40) & flag.isin("A", "R")
    second = ~(F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.05) & (F.col("l_tax") != 0.02)
    third = ~flag.isin("A", "N") & (F.col("l_extendedprice") < 1000) & F.col("l_shipdate").isNotNull()
    return t.lineitem.filter(first | second | third).select("l_orderkey", "l_linenumber", "l_quantity")


@query("classify_status", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'closed large' WHEN o_orderstatus = 'F' THEN 'closed'
      WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' ELSE 'normal' END AS order_class FROM orders""")
def classify_status(t):
    closed = F.col("o_orderstatus") == "F"
    rules = [(closed & (F.col("o_totalprice") > 100000), "closed large"), (closed, "closed"), (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "rush")]
    return t.orders.select("o_orderkey", c.classify(rules, "normal").alias("order_class"))


@query("prefer_source", """
    WITH l AS (SELECT l_orderkey, MAX(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS returned FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey)
    SELECT o.o_orderkey, CASE WHEN l.l_orderkey IS NOT NULL THEN l.returned ELSE o.o_orderdate END AS effective_date
    FROM orders o LEFT JOIN l ON l.l_orderkey = o.o_orderkey""")
def prefer_source(t):
    lines = t.lineitem.filter("l_linenumber <= 3").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("returned"))
    j = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.select("o_orderkey", c.prefer(F.col("l_orderkey"), F.col("returned"), F.col("o_orderdate")).alias("effective_date"))


@query("redacted_fallback", """
    WITH cur AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'redacted' ELSE c_name END AS name, c_acctbal FROM customer)
    SELECT cur.c_custkey, CASE WHEN lower(cur.name) = 'redacted' THEN a.c_name ELSE cur.name END AS name,
           CASE WHEN lower(cur.name) = 'redacted' THEN a.c_acctbal ELSE cur.c_acctbal END AS c_acctbal
    FROM cur LEFT JOIN customer a ON a.c_custkey = cur.c_custkey AND a.c_acctbal > 0""")
def redacted_fallback(t):
    cur = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "redacted").otherwise(F.col("c_name")).alias("name"), "c_acctbal")
    old = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("old_name"), F.col("c_acctbal").alias("old_bal"))
    j = cur.join(old, F.col("c_custkey") == F.col("k"), "left")
    gone = F.lower("name") == "redacted"
    # Both replacements read the name before either is replaced.
    return c.replace_when(j, gone, {"name": (F.col("old_name"), F.col("name")), "c_acctbal": (F.col("old_bal"), F.col("c_acctbal"))}).select("c_custkey", "name", "c_acctbal")


@query("project_drop", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def project_drop(t):
    return t.part.drop("p_size", "p_retailprice", "no_such_column")


@query("mask_null", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer")
def mask_null(t):
    return c.mask_to_null(t.customer, ["c_name", "c_acctbal"])


@query("encrypt_roundtrip", "SELECT c_custkey, c_name, c_acctbal, 1 AS was_hidden FROM customer")
def encrypt_roundtrip(t):
    hidden = c.encrypt_columns(t.customer.withColumn("plain", F.col("c_name")), ["c_name", "c_acctbal"], KEY)
    shown = c.decrypt_columns(hidden.withColumn("was_hidden", (F.col("c_name") != F.col("plain")).cast("int")), ["c_name", "c_acctbal"], KEY, {"c_acctbal": "double"})
    return shown.select("c_custkey", "c_name", "c_acctbal", "was_hidden")


PII = [("db", "dbo", "customer", "C_NAME", 0), ("db", "dbo", "customer", "c_acctbal", 0), ("db", "dbo", "customer", "c_mktsegment", 1), ("db", "dbo", "orders", "c_custkey", 0)]


@query("safe_projection", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def safe_projection(t):
    pii = t.spark.createDataFrame(PII, "database_name string, dataset_schema string, dataset_name string, column_name string, include_in_load int")
    return c.safe_projection(t.customer, "customer", pii)


@query("row_policy", """
    SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
    UNION ALL SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0""")
def row_policy(t):
    """One role by predicate, one by an entitlement table."""
    slim = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    granted = t.nation.filter("n_regionkey = 2").select(F.lit("asia").alias("role"), F.col("n_nationkey").alias("c_nationkey"))
    a = c.entitled_rows(slim, granted, "asia", ["c_nationkey"])
    b = c.row_policy(slim, "builder", {"builder": "c_mktsegment = 'BUILDING' AND c_acctbal > 0"})
    return a.unionByName(b).select("c_custkey", "c_nationkey")


@query("clean_strings", """
    SELECT doc_id, length(trim(replace(text, chr(160), ''), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS clean_chars,
           md5(trim(replace(text, chr(160), ''), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS clean_md5, trim(source) AS source
    FROM documents""")
def clean_strings(t):
    noisy = t.documents.select("doc_id", F.concat(F.lit("  "), "text", F.lit("  \n")).alias("text"), "source")
    clean = c.drop_all_null(c.clean_strings(noisy))
    return clean.select("doc_id", F.length("text").cast("long").alias("clean_chars"), F.md5("text").alias("clean_md5"), "source")


@query("lower_all", "SELECT p_partkey, lower(p_name) AS p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type, p_size, p_retailprice FROM part")
def lower_all(t):
    return c.lower_all(t.part)


@query("business_key", """
    SELECT s_suppkey, concat('SUP-', CAST(s_suppkey AS VARCHAR), '-', upper(trim(s_name)), '-', lpad(CAST(s_nationkey AS VARCHAR), 3, '0')) AS bus_key FROM supplier""")
def business_key(t):
    return t.supplier.select("s_suppkey", c.business_key("SUP", "s_suppkey", c.norm("s_name"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias("bus_key"))


# Scalar function families ---------------------------------------------------------------------------------------------

@query("fn_string", """
    SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_type || ' ') AS trimmed, concat(p_brand, '/', p_type) AS cat,
           p_brand || '-' || p_type AS cat_op, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, replace(p_name, ' ', '_') AS replaced,
           left(p_name, 3) AS first3, split_part(p_name, ' ', 2) AS word2, concat_ws('|', p_brand, p_type) AS ws,
           CASE WHEN regexp_matches(p_brand, '^Brand#1') THEN 1 ELSE 0 END AS is_brand1, regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked
    FROM part""")
def fn_string(t):
    return t.part.selectExpr(
        "p_partkey", "upper(p_name) AS up", "lower(p_brand) AS low", "trim('  ' || p_type || ' ') AS trimmed", "concat(p_brand, '/', p_type) AS cat",
        "p_brand || '-' || p_type AS cat_op", "lpad(CAST(p_size AS STRING), 4, '0') AS padded", "replace(p_name, ' ', '_') AS replaced",
        "left(p_name, 3) AS first3", "split(p_name, ' ')[1] AS word2", "concat_ws('|', p_brand, p_type) AS ws",
        "CASE WHEN p_brand RLIKE '^Brand#1' THEN 1 ELSE 0 END AS is_brand1", "regexp_replace(p_name, '[aeiou]', '*') AS masked",
    )


@query("fn_datetime", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(o_orderdate AS DATE) AS d,
           concat(CAST(year(o_orderdate) AS VARCHAR), '-', lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')) AS ym,
           CAST(datediff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age_days, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) AS next_year, o_orderdate >= DATE '1999-01-01' AS is_recent
    FROM orders""")
def fn_datetime(t):
    return t.orders.selectExpr(
        "o_orderkey", "year(o_orderdate) AS y", "month(o_orderdate) AS m", "CAST(o_orderdate AS DATE) AS d",
        "concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0')) AS ym",
        "datediff(DATE '2002-01-01', o_orderdate) AS age_days", "CAST(trunc(o_orderdate, 'month') AS DATE) AS month_start",
        "add_months(CAST(o_orderdate AS DATE), 12) AS next_year", "o_orderdate >= DATE '1999-01-01' AS is_recent",
    )


@query("fn_parse_ts", """
    WITH s AS (SELECT event_id, ts, CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
               WHEN 'error' THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txt FROM events)
    SELECT event_id, txt, COALESCE(try_strptime(txt, '%Y-%m-%dT%H:%M:%S.%f'), try_strptime(txt, '%Y-%m-%d %H:%M:%S.%f'), try_strptime(txt, '%Y-%m-%d %H:%M:%S')) AS parsed FROM s""")
def fn_parse_ts(t):
    from tarnwork.operators.runlog import TIME_FORMATS

    kind = F.col("event_type")
    txt = (
        F.when(kind == "click", F.date_format("ts", TIME_FORMATS[0])).when(kind == "view", F.date_format("ts", TIME_FORMATS[1]))
        .when(kind == "error", "not a time").otherwise(F.date_format("ts", TIME_FORMATS[2]))
    )
    s = t.events.select("event_id", txt.alias("txt"))
    return s.withColumn("parsed", c.parse_timestamp("txt", TIME_FORMATS).cast("timestamp_ntz"))


@query("fn_conditional", """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, COALESCE(nullif(o_orderstatus, 'P'), 'none') AS st_or, nullif(o_orderstatus, 'P') IS NULL AS is_null,
           nullif(o_orderstatus, 'P') IS NOT DISTINCT FROM nullif('P', 'P') AS null_eq, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS code
    FROM orders""")
def fn_conditional(t):
    return t.orders.selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS st", "coalesce(nullif(o_orderstatus, 'P'), 'none') AS st_or", "nullif(o_orderstatus, 'P') IS NULL AS is_null",
        "nullif(o_orderstatus, 'P') <=> nullif('P', 'P') AS null_eq", "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS code",
    )


@query("fn_cast", """
    SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS i, CAST(l_linenumber AS DOUBLE) AS d, CAST(l_linenumber AS VARCHAR) AS s,
           CAST(CASE WHEN l_returnflag = 'N' THEN 'N' ELSE 'Y' END AS BOOLEAN) AS b, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ts, TRY_CAST(l_returnflag AS INTEGER) AS bad,
           CAST(l_linenumber AS TINYINT) AS tiny FROM lineitem""")
def fn_cast(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "CAST(floor(l_quantity) AS INT) AS i", "CAST(l_linenumber AS DOUBLE) AS d", "CAST(l_linenumber AS STRING) AS s",
        "CAST(CASE WHEN l_returnflag = 'N' THEN 'N' ELSE 'Y' END AS BOOLEAN) AS b", "CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP_NTZ) AS ts",
        "try_cast(l_returnflag AS INT) AS bad", "CAST(l_linenumber AS TINYINT) AS tiny",
    )


@query("fn_array", """
    SELECT page_id, len(string_split(url, '/')) AS n_parts, list_contains(string_split(url, '/'), 'en') AS has_en,
           replace(upper(url), '/', '>') AS upper_path,
           len(regexp_extract_all(url, '[^/]+')) AS n_full FROM pages""")
def fn_array(t):
    parts = F.split("url", "/")
    return t.pages.select(
        "page_id", F.size(parts).cast("long").alias("n_parts"), F.array_contains(parts, "en").alias("has_en"),
        F.array_join(F.transform(parts, F.upper), ">").alias("upper_path"),
        (F.size(parts) - F.size(F.filter(parts, lambda x: x == ""))).cast("long").alias("n_full"),
    )


@query("explode_values", """
    SELECT val, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS docs
    FROM (SELECT doc_id, unnest(string_split(COALESCE(text, ''), ' ')) AS val FROM documents) WHERE trim(val) <> '' GROUP BY val""")
def explode_values(t):
    """Split and explode, blanks dropped. Pairs combine first, so a frequent word does not carry its rows to one task."""
    words = t.documents.select("doc_id", F.explode(F.split(F.coalesce("text", F.lit("")), " ")).alias("val")).filter("trim(val) <> ''")
    per_doc = words.groupBy("val", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("val").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))


@query("fn_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, concat('{"id":', CAST(event_id AS VARCHAR), ',"kind":"', event_type, '"}') AS doc FROM events""")
def fn_json(t):
    return t.events.select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("doc")
    )


@query("fn_math", """
    SELECT l_orderkey, l_linenumber, l_quantity + 1 AS a, l_extendedprice - l_quantity AS b, l_quantity * 2 AS m, l_extendedprice / l_quantity AS unit_price,
           l_extendedprice / nullif(l_tax, 0) AS safe_ratio FROM lineitem""")
def fn_math(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity + 1 AS a", "l_extendedprice - l_quantity AS b", "l_quantity * 2 AS m", "l_extendedprice / l_quantity AS unit_price",
        "l_extendedprice / nullif(l_tax, 0) AS safe_ratio",
    )
