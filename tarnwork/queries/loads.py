"""Load strategies over the order table: yesterday's state as target, the increment as source."""

from datetime import datetime

from pyspark.sql import functions as F

from tarnwork.functions.columns import lit_like, row_hash
from tarnwork.operators import merge as m
from tarnwork.queries.registry import query
from tarnwork.queries.sources import FEED
from tarnwork.streaming.loader import batch_load

COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
# Target: orders placed before 2000, urgent ones at an outdated price. Source: orders from 1999 on, so 1999 overlaps.
TARGET = """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"""
SOURCE = f"SELECT {', '.join(COLS)} FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"
UPSERTED = f"SELECT * FROM ({SOURCE}) UNION ALL SELECT * FROM ({TARGET}) t WHERE t.o_orderdate < TIMESTAMP '1999-01-01'"


def target(t):
    old = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))
    return t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").withColumn("o_totalprice", old).select(*COLS)


def source(t):
    return t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'").select(*COLS)


@query("merge_first_load", SOURCE)
def merge_first_load(t):
    return m.merge_upsert(None, source(t), ["o_orderkey"])


@query("merge_insert_only", f"SELECT * FROM ({TARGET}) UNION ALL SELECT * FROM ({SOURCE}) s WHERE s.o_orderdate >= TIMESTAMP '2000-01-01'")
def merge_insert_only(t):
    return m.merge_insert_only(target(t), source(t), ["o_orderkey"])


@query("merge_upsert", UPSERTED)
def merge_upsert(t):
    return m.merge_upsert(target(t), source(t), ["o_orderkey"])


@query("merge_on_hash", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus WHEN t.o_orderkey IS NULL OR t.o_orderpriority = '1-URGENT' THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice WHEN t.o_orderkey IS NULL OR t.o_totalprice <> s.o_totalprice THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
           CASE WHEN t.o_orderkey IS NULL THEN 2 ELSE 1 END AS created_by, CASE WHEN s.o_orderkey IS NULL OR t.o_totalprice = s.o_totalprice THEN 1 ELSE 2 END AS modified_by
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def merge_on_hash(t):
    """Only rows whose hash differs are rewritten; creation stays with the first load."""
    kept = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    def stamp(df, run):
        df = df.select(*kept)
        return df.withColumns({"dl_rowhash": row_hash(df), "dl_createddateutc": F.lit(run), "dl_lastmodifiedutc": F.lit(run)})

    out = m.merge_on_hash(stamp(target(t), 1), stamp(source(t), 2), ["o_orderkey"])
    return out.select(*kept, F.col("dl_createddateutc").alias("created_by"), F.col("dl_lastmodifiedutc").alias("modified_by"))


@query("merge_update_only", f"""
    WITH t AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, o_totalprice FROM ({TARGET})), s AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, o_totalprice AS p FROM ({SOURCE}))
    SELECT t.o_orderkey, t.st, CASE WHEN s.o_orderkey IS NOT NULL THEN s.p ELSE t.o_totalprice END AS o_totalprice
    FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND t.st IS NOT DISTINCT FROM s.st""")
def merge_update_only(t):
    st = F.expr("nullif(o_orderstatus, 'P')").alias("st")
    return m.merge_update_columns(target(t).select("o_orderkey", st, "o_totalprice"), source(t).select("o_orderkey", st, "o_totalprice"), ["o_orderkey", "st"], ["o_totalprice"])


@query("update_where", """
    SELECT o_orderkey, CASE WHEN lower(o_orderpriority) = '5-low' AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN lower(o_orderpriority) = '5-low' AND o_orderstatus = 'O' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders""")
def update_where(t):
    hit = (F.lower("o_orderpriority") == "5-low") & (F.col("o_orderstatus") == "O")
    return m.update_where(t.orders.withColumn("hit", hit), F.col("hit"), {"o_orderstatus": "X", "o_totalprice": 0.0}).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("overwrite_by_key", f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01')
    UNION ALL SELECT l_orderkey, l_linenumber, l_extendedprice + 1 FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01'""")
def overwrite_by_key(t):
    cols = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    old = t.lineitem.filter("l_shipdate < TIMESTAMP_NTZ '1999-01-01'").select(*cols)
    new = t.lineitem.filter("l_shipdate >= TIMESTAMP_NTZ '1998-06-01'").withColumn("l_extendedprice", F.col("l_extendedprice") + 1).select(*cols)
    return m.overwrite_by_key(old, new, ["l_orderkey"])


@query("capture_deletes", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS is_deleted FROM orders")
def capture_deletes(t):
    snapshot = t.orders.filter("o_orderpriority <> '5-LOW'")
    return m.capture_deletes(t.orders.select("o_orderkey", "o_orderstatus"), snapshot, ["o_orderkey"], "is_deleted")


@query("unknown_member", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT -1, 'Unknown', -1, NULL")
def unknown_member(t):
    once = m.ensure_unknown_member(t.supplier, "s_suppkey", {"s_name": "Unknown", "s_nationkey": -1})
    return m.ensure_unknown_member(once, "s_suppkey", {"s_name": "Unknown", "s_nationkey": -1})


@query("identity_assign", """
    WITH a AS (SELECT p_name AS name, p_brand AS brand, ROW_NUMBER() OVER (ORDER BY p_name, p_brand) AS id FROM (SELECT DISTINCT p_name, p_brand FROM part WHERE p_size <= 20)),
         s AS (SELECT DISTINCT p_name AS name, p_brand AS brand FROM part WHERE p_size > 10)
    SELECT s.name, s.brand, COALESCE(a.id, (SELECT MAX(id) FROM a) + ROW_NUMBER() OVER (PARTITION BY a.id IS NULL ORDER BY s.name, s.brand)) AS id
    FROM s LEFT JOIN a ON a.name = s.name AND a.brand = s.brand""")
def identity_assign(t):
    names = [F.col("p_name").alias("name"), F.col("p_brand").alias("brand")]
    first = m.assign_identity(None, t.part.filter("p_size <= 20").select(*names).distinct(), ["name", "brand"], "id")
    return m.assign_identity(first, t.part.filter("p_size > 10").select(*names).distinct(), ["name", "brand"], "id").select("name", "brand", "id")


@query("schema_evolution", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
    UNION ALL SELECT o_orderkey, NULL, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def schema_evolution(t):
    """The increment brings a new column and lacks an old one."""
    old = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return m.merge_upsert(old, source(t).select("o_orderkey", "o_totalprice", "o_orderpriority"), ["o_orderkey"])


@query("merge_metrics", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT COUNT(CASE WHEN t.o_orderkey IS NULL THEN 1 END) AS rows_inserted, COUNT(CASE WHEN t.o_totalprice <> s.o_totalprice THEN 1 END) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def merge_metrics(t):
    before = target(t)
    return m.merge_metrics(before, m.merge_upsert(before, source(t), ["o_orderkey"]), ["o_orderkey"])


SEED = [("F", "Finished", True), ("O", "Open", True), ("X", "Cancelled", False)]


@query("seed_merge", """
    SELECT o_orderstatus AS status_cd, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE concat('status ', o_orderstatus) END AS status_desc,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN TRUE ELSE NULL END AS is_active FROM (SELECT DISTINCT o_orderstatus FROM orders)
    UNION ALL SELECT 'X', 'Cancelled', FALSE""")
def seed_merge(t):
    """Constant rows over the statuses found in the data, merged twice."""
    have = t.orders.select(F.col("o_orderstatus").alias("status_cd")).distinct().withColumn("status_desc", F.concat(F.lit("status "), "status_cd"))
    seed = t.spark.createDataFrame(SEED, "status_cd string, status_desc string, is_active boolean")
    once = m.seed_merge(have, seed, ["status_cd"])
    return m.seed_merge(once, seed, ["status_cd"])


@query("load_dispatch", f"""
    SELECT 'overwrite' AS strategy, * FROM ({SOURCE}) UNION ALL SELECT 'append_all', * FROM ({TARGET}) UNION ALL SELECT 'append_all', * FROM ({SOURCE})
    UNION ALL SELECT 'append_new', * FROM ({TARGET}) UNION ALL SELECT 'append_new', * FROM ({SOURCE}) s WHERE s.o_orderdate >= TIMESTAMP '2000-01-01'
    UNION ALL SELECT 'merge', * FROM ({UPSERTED})""")
def load_dispatch(t):
    parts = [batch_load(target(t), source(t), s, ["o_orderkey"]).select(F.lit(s).alias("strategy"), *COLS) for s in ("overwrite", "append_all", "append_new", "merge")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# Type two: the state before 16 January, then the state at the end of the month.
LATEST = "SELECT user_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '{d}') WHERE rn = 1"
OLD = f"SELECT * FROM ({LATEST.format(d='2024-01-16')}) WHERE event_type <> 'view'"
NEW = LATEST.format(d="2024-01-31")
T0, T1 = datetime(2024, 1, 16), datetime(2024, 1, 31)


def latest_event(t, before):
    rows = t.events.filter(F.col("ts") < lit_like(t.events, "ts", before)).select("user_id", "event_type", "value", "ts", "event_id")
    return m.latest_per_key(rows, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts", "event_id")


@query("scd2_apply", f"""
    WITH o AS ({OLD}), n AS ({NEW})
    SELECT o.user_id, o.event_type, o.value, TIMESTAMP '2024-01-16' AS effective_from, CASE WHEN n.user_id IS NOT NULL AND n.event_type <> o.event_type THEN TIMESTAMP '2024-01-31' END AS effective_to,
           CASE WHEN n.user_id IS NOT NULL AND n.event_type <> o.event_type THEN 0 ELSE 1 END AS is_current FROM o LEFT JOIN n ON n.user_id = o.user_id
    UNION ALL SELECT n.user_id, n.event_type, n.value, TIMESTAMP '2024-01-31', NULL, 1 FROM n LEFT JOIN o ON n.user_id = o.user_id WHERE o.user_id IS NULL OR o.event_type <> n.event_type""")
def scd2_apply(t):
    first = m.scd2_apply(None, latest_event(t, T0).filter("event_type <> 'view'"), ["user_id"], ["event_type"], T0)
    return m.scd2_apply(first, latest_event(t, T1), ["user_id"], ["event_type"], T1)


@query("cdc_apply", f"""
    WITH o AS ({OLD}), feed AS (SELECT {', '.join(FEED)} FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
         n AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn FROM feed WHERE op IN (1, 2, 4)) WHERE rn = 1)
    SELECT COALESCE(o.user_id, n.user_id) AS user_id, CASE WHEN n.user_id IS NULL OR n.op = 1 THEN o.event_type ELSE n.event_type END AS event_type,
           CASE WHEN n.user_id IS NULL OR n.op = 1 THEN o.value ELSE n.value END AS value, CASE WHEN n.op = 1 THEN 1 ELSE 0 END AS dl_is_deleted, CASE WHEN n.op = 1 THEN 0 ELSE 1 END AS dl_iscurrent,
           CASE WHEN n.user_id IS NULL THEN TIMESTAMP '2024-01-16' WHEN n.op <> 1 AND o.user_id IS NOT NULL AND o.event_type = n.event_type AND o.value = n.value THEN TIMESTAMP '2024-01-16' ELSE TIMESTAMP '2024-01-31' END AS dl_lastmodifiedutc
    FROM o FULL JOIN n ON o.user_id = n.user_id WHERE NOT (o.user_id IS NULL AND n.op = 1)""")
def cdc_apply(t):
    old = latest_event(t, T0).filter("event_type <> 'view'")
    base = old.withColumns({"dl_is_deleted": F.lit(0), "dl_iscurrent": F.lit(1), "dl_lastmodifiedutc": F.lit(T0).cast("timestamp_ntz")})
    changes = t.events.filter(F.col("ts") >= lit_like(t.events, "ts", T0)).selectExpr(*FEED)
    return m.cdc_apply(base, changes, ["user_id"], T1, "op", "lsn", "seq")
