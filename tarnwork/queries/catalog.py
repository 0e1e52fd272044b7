"""Catalog and operational tables."""

from pyspark.sql import functions as F

from tarnwork.operators import catalog as c
from tarnwork.operators import runlog as r
from tarnwork.queries.registry import query
from tarnwork.sources.files import parse_json_map

# Run-log messages made from events: raw zone, prepared zone for purchases; errors, cancellations and odd times occur.
MESSAGES_SQL = """SELECT event_id, user_id, event_type, ts, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type = 'purchase' THEN 'Prepared' ELSE 'Raw' END AS zone,
    event_type = 'error' OR (event_type = 'view' AND value > 50) OR (event_type = 'purchase' AND value > 150) AS failed FROM events"""


def messages(t, timed=True):
    k = F.from_json("props", "k bigint")["k"]
    prepared = F.col("event_type") == "purchase"
    start = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).when(F.col("event_type") == "signup", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    status = F.when((F.col("event_type") == "view") & (F.col("value") > 50), "Canceled").otherwise("Succeeded")
    raw = F.to_json(F.struct(
        F.when(F.col("event_type") == "error", F.array(F.lit("copy failed"))).otherwise(F.array().cast("array<string>")).alias("errors"),
        F.array(F.struct(status.alias("status"), start.alias("start"))).alias("executionDetails"), F.when(F.col("event_type") == "click", k).alias("filesRead"),
        F.when(F.col("event_type") != "click", k).alias("rowsRead"), k.alias("dataRead"), k.alias("dataWritten"), F.col("value").alias("throughput"),
    ))
    output = F.struct(F.when(F.col("value") > 150, "boom").alias("error_message"), F.when(F.col("value") > 20, k).alias("total_rows_read"), k.alias("total_rows_written"))
    doc = F.struct(
        F.concat(F.lit("run-"), "user_id").alias("run_id"), F.lit("sales").alias("product_name"), F.lit("web").alias("source_system"), F.col("event_type").alias("dataset_name"), F.lit("daily").alias("feed_name"),
        F.when(prepared, "Prepared").otherwise("Raw").alias("zone"), F.when(prepared, "Transformation").otherwise("Ingestion").alias("stage"), F.col("user_id").alias("etl_id"), start.alias("start_time"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("end_time"), F.col("event_id").cast("string").alias("inserted_by"), F.when(prepared, F.to_json(F.struct(output.alias("runOutput")))).otherwise(raw).alias("metadata"),
    )
    return t.events.select("event_id", F.to_json(doc).alias("value"))


@query("log_status", f"SELECT CAST(event_id AS VARCHAR) AS event_id, zone, CASE WHEN failed THEN 'Failed' ELSE 'Success' END AS status FROM ({MESSAGES_SQL})")
def log_status(t):
    return r.derive_status(r.parse_messages(messages(t))).select(F.col("inserted_by").alias("event_id"), "zone", "status")


@query("ingestion_log_flat", f"""
    SELECT concat('run-', CAST(user_id AS VARCHAR)) AS run_id, event_type AS dataset_name, zone, CASE WHEN event_type <> 'signup' THEN ts END AS start_time, date_trunc('second', ts) AS end_time,
           CASE WHEN zone = 'Prepared' AND value <= 20 THEN -1 ELSE k END AS data_read, k AS data_written, CASE WHEN zone = 'Raw' THEN CAST(k AS INTEGER) END AS files_read,
           CASE WHEN failed THEN 'Failed' ELSE 'Success' END AS status, CASE WHEN zone = 'Raw' THEN value END AS throughput, CAST(event_id AS VARCHAR) AS inserted_by FROM ({MESSAGES_SQL})""")
def ingestion_log_flat(t):
    log = r.ingestion_log(r.parse_messages(messages(t)))
    return log.select(
        "run_id", "dataset_name", "zone", F.col("start_time").cast("timestamp_ntz").alias("start_time"), F.col("end_time").cast("timestamp_ntz").alias("end_time"),
        "data_read", "data_written", "files_read", "status", "throughput", "inserted_by",
    )


@query("pending_tasks", f"""
    SELECT 'pending' AS part, event_id, zone, status FROM (SELECT event_id, zone, CASE WHEN failed THEN 'Failed' ELSE 'Success' END AS status, user_id FROM ({MESSAGES_SQL})) WHERE status <> 'Success' AND user_id = 7
    UNION ALL SELECT 'other', event_id, zone, CASE WHEN failed THEN 'Failed' ELSE 'Success' END FROM ({MESSAGES_SQL}) WHERE user_id = 7 AND event_type = 'view'""")
def pending_tasks(t):
    """The open tasks of one run, and its records outside the standard zone and stage pairs."""
    log = r.derive_status(r.parse_messages(messages(t)), out="zone_status").withColumn("event_id", F.col("inserted_by").cast("long"))
    log = log.withColumn("stage", F.when(F.col("dataset_name") == "view", "Check").otherwise(F.col("stage")))
    a = r.pending_tasks(log, 7).select(F.lit("pending").alias("part"), "event_id", "zone", F.col("zone_status").alias("status"))
    return a.unionByName(r.other_records(log, 7).select(F.lit("other").alias("part"), "event_id", "zone", F.col("zone_status").alias("status")))


@query("catalog_upsert", """
    WITH docs AS (SELECT lower(event_type) AS shortcut, concat('user-', CAST(user_id AS VARCHAR)) AS dataset, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, event_id FROM events),
         d AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY shortcut, dataset ORDER BY event_id DESC) AS rn FROM docs) WHERE rn = 1),
         c AS (SELECT DISTINCT event_type AS shortcut, concat('user-', CAST(c_custkey AS VARCHAR)) AS dataset FROM (SELECT DISTINCT event_type FROM events WHERE event_type IN ('click', 'view')), customer)
    SELECT COALESCE(c.shortcut, d.shortcut) AS shortcut, COALESCE(c.dataset, d.dataset) AS dataset, CASE WHEN d.shortcut IS NULL THEN 'old' ELSE d.k END AS k FROM c FULL JOIN d ON c.shortcut = d.shortcut AND c.dataset = d.dataset""")
def catalog_upsert(t):
    """Documents with string-map properties, in two lots, over a catalog that knows every customer's clicks and views."""
    kinds = t.spark.createDataFrame([("click",), ("view",)], "shortcut string")
    known = t.customer.select(F.concat(F.lit("user-"), "c_custkey").alias("dataset"), F.explode(F.array(F.lit("click"), F.lit("view"))).alias("shortcut"))
    known = known.join(kinds, "shortcut").select("shortcut", "dataset", F.lit("old").alias("k"))
    docs = parse_json_map(t.events, "props").select(F.upper("event_type").alias("shortcut"), F.concat(F.lit("User-"), "user_id").alias("dataset"), F.col("doc")["k"].alias("k"), "event_id")
    errors, rest = docs.filter("shortcut = 'ERROR'"), docs.filter("shortcut <> 'ERROR'").select("event_id", "k", "dataset", "shortcut")
    return c.catalog_upsert(known.withColumn("event_id", F.lit(None).cast("long")), [errors, rest], ["shortcut", "dataset"], [F.col("event_id").desc()]).drop("event_id")


@query("feed_explode", """
    SELECT r_name AS feed_name, lower(n_name) AS dataset_name, lower(r_name) AS folder_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 5""")
def feed_explode(t):
    """One feed document per region: its nations as database datasets, the first five nations as files."""
    kind = F.when(F.col("n_nationkey") >= 5, "database").otherwise("file")
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("kind", kind)
    sections = rows.groupBy("r_name", "kind").agg(F.collect_list(F.struct(F.col("n_name").alias("fileName"), F.lower("r_name").alias("sourceConfigFolderName"))).alias("datasets"))
    feeds = sections.groupBy(F.col("r_name").alias("feedName")).agg(F.collect_list(F.struct(F.col("kind").alias("datasetType"), "datasets")).alias("datasetsConfig"))
    return c.feed_rows(feeds)


@query("feed_build", """
    SELECT DISTINCT concat('db', CAST(c_nationkey AS VARCHAR)) AS database_name, c_mktsegment AS dataset_name,
           concat('{"fileName":"', c_mktsegment, '","sourceConfigFolderName":"iis_db', CAST(c_nationkey AS VARCHAR), '","databaseName":"db', CAST(c_nationkey AS VARCHAR), '"}') AS entry FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING'""")
def feed_build(t):
    cat = t.customer.select(
        F.concat(F.lit("db"), "c_nationkey").alias("database_name"), F.col("c_mktsegment").alias("dataset_name"),
        F.when(F.col("c_acctbal") > 0, "database").otherwise("file").alias("dataset_type_name"), F.when(F.col("c_mktsegment") == "BUILDING", "ext").otherwise("dbo").alias("dataset_schema"),
    )
    return c.feed_document(cat, "iis_")


@query("config_derive", """
    WITH cols AS (SELECT s_name AS d, col, ord, CASE WHEN col = 'shape' THEN 'geography' ELSE 'varchar' END AS typ FROM supplier,
           (VALUES ('code', 1), ('shape', 2), ('secret', 3), ('updateon', 4), ('enteredon', 5)) v(col, ord)
           WHERE NOT (col = 'updateon' AND s_nationkey < 8) AND NOT (col = 'enteredon' AND s_nationkey BETWEEN 5 AND 15) AND col <> 'secret'),
         g AS (SELECT d, string_agg(CASE WHEN typ = 'geography' THEN concat('CAST(', col, ' AS VARCHAR(255)) AS ', col) ELSE upper(col) END, ', ' ORDER BY ord) AS l, bool_or(col = 'updateon') AS u, bool_or(col = 'enteredon') AS e FROM cols GROUP BY d),
         p AS (SELECT *, CASE WHEN u THEN 'updateon' WHEN e THEN 'enteredon' END AS part FROM g)
    SELECT d AS dataset_name, CASE WHEN part IS NULL THEN l ELSE concat(l, ', YEAR(', upper(part), ') AS ', part, '_year, MONTH(', upper(part), ') AS ', part, '_month') END AS select_list,
           CASE WHEN part IS NULL THEN 'full' ELSE 'watermark' END AS ingest_type, CASE WHEN u AND e THEN 'COALESCE(UPDATEON, ENTEREDON)' ELSE upper(part) END AS watermark_id,
           part || '_year,' || part || '_month' AS partition_keys, CASE WHEN s_acctbal > 0 THEN 'merge' ELSE 'overwrite' END AS target_load_type FROM p JOIN supplier ON s_name = d""")
def config_derive(t):
    """Suppliers as datasets: nations decide which time columns exist, the balance whether there is a key."""
    names = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("column_ordinal")) for i, n in enumerate(["code", "shape", "secret", "updateon", "enteredon"], 1)])
    cols = t.supplier.select(F.col("s_name").alias("dataset_name"), "s_nationkey", F.explode(names).alias("c")).select("dataset_name", "s_nationkey", "c.*")
    cols = cols.filter("NOT (column_name = 'updateon' AND s_nationkey < 8) AND NOT (column_name = 'enteredon' AND s_nationkey BETWEEN 5 AND 15)")
    cols = cols.withColumn("column_data_type", F.when(F.col("column_name") == "shape", "geography").otherwise("varchar"))
    pii = t.supplier.select(F.upper("s_name").alias("dataset_name"), F.lit("SECRET").alias("column_name"), F.lit(0).alias("include_in_load"))
    sets = t.supplier.select(F.col("s_name").alias("dataset_name"), F.when(F.col("s_acctbal") > 0, "code, id").alias("primary_key_list"))
    return c.derive_configs(cols, pii, sets)


@query("column_profile", """
    SELECT 'orders' AS table_name, o AS column_ordinal, c AS column_name, ty AS column_data_type, CASE WHEN c = 'o_orderstatus' THEN (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P') ELSE 0 END AS null_count,
           (SELECT COUNT(*) FROM orders) AS row_count, c = 'o_orderstatus' AS is_nullable_flag
    FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'), (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string')) v(o, c, ty)""")
def column_profile(t):
    return c.column_profile(t.orders.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")), "orders")
