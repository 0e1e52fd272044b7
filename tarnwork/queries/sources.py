"""Sources, extracts and sinks."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tarnwork.functions.columns import with_year_month
from tarnwork.operators.merge import cdc_net_changes
from tarnwork.queries.registry import query
from tarnwork.session import run_dir
from tarnwork.sources import extracts, files, writer


@query("scan_csv_options", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_options(t):
    """Customers written as CSV under config options and read back with the same options."""
    path = run_dir(t.spark, "csv")
    options = {"header": True, "delimiter": "|", "escape": "\\", "encoding": "UTF-8", "multiline": False}
    writer.write_csv(t.customer, path, {k: v for k, v in options.items() if k != "multiline"})
    return files.read_files(t.spark, path, "csv", options, schema=t.customer.schema)


@query("sheet_pivot", """
    SELECT o_orderstatus,
           COUNT(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS "1-URGENT",
           COUNT(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END) AS "2-HIGH",
           COUNT(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey END) AS "5-LOW"
    FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus""")
def sheet_pivot(t):
    keep = ["1-URGENT", "2-HIGH", "5-LOW"]
    return files.shape_sheet(
        t.orders, ["o_orderstatus", "o_orderpriority", "o_orderkey"], "o_totalprice > 1000",
        {"columns": "o_orderpriority", "values": "o_orderkey", "keep": keep}, aggregate="count",
    ).na.fill(0, keep)


@query("json_fixed_schema", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def json_fixed_schema(t):
    """Event properties as a directory of JSON documents under a fixed schema with a field the documents lack."""
    path = run_dir(t.spark, "json")
    props = F.from_json("props", "k int")
    writer.write_json(t.events.select("event_id", props["k"].alias("k")), path)
    return files.read_json_docs(t.spark, path, "event_id bigint, k int, missing string", multi_line=False)


def write_lines(lines, path):
    """One text file (or more) for each value of ``k``, its lines in the order of ``at``."""
    lines.repartition("k").sortWithinPartitions("k", "at").select("k", "line").write.partitionBy("k").text(path)


@query("sheet_skip_rows", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def sheet_skip_rows(t):
    """Orders as sheets, one file for each priority, under a title, an empty line and a header."""
    path = run_dir(t.spark, "sheets")
    table = t.orders.select("o_orderpriority", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    priority = F.col("o_orderpriority").alias("k")
    above = table.select(priority).distinct().select("k", F.posexplode(F.array(F.concat(F.lit("Orders;"), "k"), F.lit(""), F.lit("key;status;price;day"))).alias("n", "line"))
    above = above.select("k", (F.col("n") - 3).cast("long").alias("at"), "line")
    line = F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    write_lines(table.select(priority, F.col("o_orderkey").alias("at"), line.alias("line")).unionByName(above), path)
    options = {"header": True, "delimiter": ";", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    return files.read_sheet_csv(t.spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz", 2, options, recursive=True)


@query("sheet_first", """
    SELECT o_custkey, MIN(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS "F", MIN(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END) AS "O"
    FROM orders GROUP BY o_custkey""")
def sheet_first(t):
    """A pivot with the first value per cell."""
    return files.shape_sheet(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority"], None, {"columns": "o_orderstatus", "values": "o_orderpriority", "keep": ["F", "O"]})


@query("json_multi_line", "SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR) AS missing, s_nationkey FROM supplier")
def json_multi_line(t):
    """Suppliers as documents that go over several lines, one array of them for each nation."""
    path = run_dir(t.spark, "docs")
    first = t.supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("lowest"))
    doc = F.to_json(F.struct("s_suppkey", "s_name", "s_acctbal", F.struct("s_nationkey").alias("nation")), {"pretty": "true"})
    rows = t.supplier.join(first, "s_nationkey").select(
        F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("at"), F.concat(F.when(F.col("s_suppkey") == F.col("lowest"), "[").otherwise(","), doc).alias("line"))
    ends = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg((F.max("s_suppkey") + 1).alias("at")).withColumn("line", F.lit("]"))
    write_lines(rows.unionByName(ends), path)
    out = files.read_json_docs(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double, missing string, nation struct<s_nationkey: int>")
    return out.select("s_suppkey", "s_name", "s_acctbal", "missing", F.col("nation.s_nationkey").alias("s_nationkey"))


@query("json_map_parse", "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, 1 AS n_keys FROM events")
def json_map_parse(t):
    """Two levels: the outer document and its nested map."""
    docs = t.events.withColumn("json", F.concat(F.lit('{"kind":"'), "event_type", F.lit('","props":'), "props", F.lit("}")))
    m = files.parse_json_map(docs, "json", ["props"])
    return m.select("event_id", m["doc"]["kind"].alias("event_type"), m["props"]["k"].alias("k"), F.size(F.map_keys("props")).alias("n_keys"))


@query("path_segment_filter", """
    SELECT page_id, url FROM pages WHERE concat('/', lower(url), '/') NOT LIKE '%/en/%'""")
def path_segment_filter(t):
    return files.exclude_path_segment(t.pages, "url", "EN").select("page_id", "url")


@query("extract_full", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def extract_full(t):
    return extracts.full_extract(t.orders, ["o_orderkey", "o_custkey", "o_totalprice"], "WHERE o_orderstatus = 'F'")


@query("extract_watermark", """
    SELECT o_orderkey, o_totalprice, o_orderdate AS dl_watermark FROM orders
    WHERE o_orderdate > TIMESTAMP '1999-12-31 00:00:00' AND o_orderstatus <> 'P'""")
def extract_watermark(t):
    state = {"identifier": "o_orderdate", "value": datetime(1999, 12, 31)}
    last = extracts.start_mark(state, "o_orderdate", datetime(1900, 1, 1))
    return extracts.watermark_extract(t.orders, "o_orderdate", last, ["o_orderkey", "o_totalprice"], "and o_orderstatus <> 'P'")


@query("extract_watermark_coalesce", """
    WITH last_ship AS (SELECT l_orderkey, MAX(l_shipdate) AS updateon FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey)
    SELECT o.o_orderkey, s.updateon, o.o_orderdate AS enteredon, COALESCE(s.updateon, o.o_orderdate) AS dl_watermark,
           CAST(year(COALESCE(s.updateon, o.o_orderdate)) AS INTEGER) AS dl_watermark_year,
           CAST(month(COALESCE(s.updateon, o.o_orderdate)) AS INTEGER) AS dl_watermark_month
    FROM orders o LEFT JOIN last_ship s ON o.o_orderkey = s.l_orderkey
    WHERE COALESCE(s.updateon, o.o_orderdate) > TIMESTAMP '1998-06-30 00:00:00'""")
def extract_watermark_coalesce(t):
    ship = t.lineitem.filter("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("updateon"))
    o = t.orders.join(ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    rows = o.select("o_orderkey", "updateon", F.col("o_orderdate").alias("enteredon"))
    return with_year_month(extracts.watermark_extract(rows, "coalesce(updateon, enteredon)", datetime(1998, 6, 30)), "dl_watermark")


# The events table as a change feed: operation, log sequence number and order within the transaction.
FEED = ["user_id", "event_type", "value", "CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 4 END AS op", "ts AS lsn", "event_id AS seq"]


@query("cdc_net_changes", f"""
    WITH feed AS (SELECT {', '.join(FEED)} FROM events)
    SELECT user_id, event_type, value, op, lsn, seq, CASE WHEN op = 1 THEN 1 ELSE 0 END AS is_deleted
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn
          FROM feed WHERE op IN (1, 2, 4) AND lsn > TIMESTAMP '2024-01-10 00:00:00') WHERE rn = 1""")
def net_changes(t):
    return cdc_net_changes(t.events.selectExpr(*FEED), ["user_id"], "op", "lsn", "seq", datetime(2024, 1, 10))


@query("extract_top_n", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def extract_top_n(t):
    return extracts.limit_rows(t.orders.select("o_orderkey", "o_totalprice"), 100, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("watermark_advance", "SELECT MAX(o_orderdate) AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '1999-12-31 00:00:00'")
def watermark_advance(t):
    last = datetime(1999, 12, 31)
    batch = extracts.watermark_extract(t.orders, "o_orderdate", last, ["o_orderkey"])
    return extracts.advance_watermark(batch, "dl_watermark", last)


@query("incremental_source", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-30 00:00:00'")
def incremental_source(t):
    return extracts.incremental_source(t.orders, "o_orderdate", datetime(2000, 6, 30)).select("o_orderkey", "o_orderdate")


STATUS = [("F", "Finished", 1), ("O", "Open", 2), ("P", "Pending", 3), ("X", "Cancelled", 4)]


@query("values_status_dim", """
    WITH dim(status_cd, status_desc, sort_no) AS (VALUES ('F','Finished',1), ('O','Open',2), ('P','Pending',3), ('X','Cancelled',4))
    SELECT d.status_cd, d.status_desc, d.sort_no, COUNT(o.o_orderkey) AS order_count
    FROM dim d LEFT JOIN orders o ON o.o_orderstatus = d.status_cd GROUP BY d.status_cd, d.status_desc, d.sort_no""")
def values_status_dim(t):
    """Constant rows as a dimension, with the orders of each status."""
    dim = files.values_table(t.spark, STATUS, "status_cd string, status_desc string, sort_no int")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("o_orderkey").alias("n"))
    joined = dim.join(counts, dim["status_cd"] == counts["o_orderstatus"], "left")
    return joined.select("status_cd", "status_desc", "sort_no", F.coalesce("n", F.lit(0)).alias("order_count"))


# Sinks --------------------------------------------------------------------------------------------------------------

@query("load_overwrite", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE o_orderstatus <> 'P'""")
def load_overwrite(t):
    """Two loads into a partitioned table; the second replaces the first, an empty third leaves it."""
    path = run_dir(t.spark, "overwrite")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("o_year"))
    writer.load_overwrite(rows.drop("o_orderstatus"), path, ["o_year"])
    writer.load_overwrite(rows.filter("o_orderstatus <> 'P'").drop("o_orderstatus"), path, ["o_year"])
    writer.load_overwrite(rows.filter("o_totalprice < 0").drop("o_orderstatus"), path, ["o_year"], skip_empty=True)
    return writer.read_current(t.spark, path)


@query("load_append", """
    SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def load_append(t):
    """A second load brings a new column."""
    path = run_dir(t.spark, "append")
    cut = F.lit(date(1998, 1, 1))
    writer.load_append(t.orders.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_totalprice"), path)
    writer.load_append(t.orders.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return writer.read_appended(t.spark, path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("json_struct_out", "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders")
def json_struct_out(t):
    """Orders as JSON documents with a nested part, read back flat."""
    path = run_dir(t.spark, "json-out")
    doc = F.struct("o_orderkey", F.struct("o_orderstatus", "o_custkey").alias("detail"))
    writer.write_json(t.orders.select(F.to_json(doc).alias("doc")), path)
    back = files.read_json_docs(t.spark, path, "doc string", multi_line=False)
    parsed = back.select(F.from_json("doc", "o_orderkey bigint, detail struct<o_orderstatus:string,o_custkey:bigint>").alias("d"))
    return parsed.select("d.o_orderkey", "d.detail.o_orderstatus", "d.detail.o_custkey")


@query("merge_partitions", """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders
    WHERE NOT (o_orderdate >= TIMESTAMP '1999-06-01' AND o_orderstatus = 'F')
    UNION ALL SELECT o_orderkey, o_totalprice + 1, CAST(year(o_orderdate) AS INTEGER) FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1999-06-01'""")
def merge_partitions(t):
    """An upsert that rewrites only the year partitions it touches."""
    path, stage = run_dir(t.spark, "years"), run_dir(t.spark, "stage")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", F.year("o_orderdate").alias("o_year"))
    kept = ["o_orderkey", "o_totalprice", "o_year"]
    writer.load_append(rows.select(*kept), path, ["o_year"])
    news = rows.filter("o_orderstatus = 'F'").filter(F.col("o_orderdate") >= F.lit(date(1999, 6, 1)))
    writer.merge_partitions(
        t.spark, path, news.withColumn("o_totalprice", F.col("o_totalprice") + 1).select(*kept), ["o_orderkey", "o_year"], ["o_year"], stage
    )
    return t.spark.read.parquet(path)
