"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs, median), BENCH_QUERIES (comma-
separated names, or ``all``). Each query is warmed up once and then executed in full into the ``noop`` sink. ``pairs``
compares four rewrites with their naive plans.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = [
    "fact_transactions", "fact_detail", "dim_lifecycle", "stg_transfers", "star_lookup", "role_playing_date", "join_scd2_asof", "late_arriving_fact", "join_asof_latest",
    "agg_totals", "inforce_book", "customer_360", "monthly_totals", "yoy_compare", "rolling_12m", "reconcile_sums", "correlated_sum", "latest_per_key", "dominant_class",
    "dups_retain_one", "dups_quarantine_all", "prev_row_change", "days_in_status", "surrogate_dense", "merge_upsert", "merge_on_hash", "scd2_apply", "cdc_apply",
    "dq_rules_rowlevel", "dq_rule_metrics", "funnel_ratios", "run_zone_rollup", "ingest_run", "row_hash", "explode_values",
]


def pairs(t):
    """name -> (naive, rewritten), as functions without arguments."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from tarnwork.functions.columns import norm
    from tarnwork.operators import joins, windows
    from tarnwork.queries import QUERIES

    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = t.events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("cts"), F.col("value").alias("click"), F.col("event_id").alias("cid"))

    def range_join():
        hit = buys.join(clicks.withColumnRenamed("user_id", "u"), (F.col("user_id") == F.col("u")) & (F.col("cts") <= F.col("ts")), "left")
        return hit.withColumn("rn", F.row_number().over(W.partitionBy("event_id").orderBy(F.col("cts").desc(), F.col("cid").desc()))).filter("rn = 1")

    def subqueries():
        cols = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
        subs = ", ".join(f"(SELECT sum(l.{c}) FROM {{li}} l WHERE l.l_orderkey = o.o_orderkey) AS s{i}" for i, c in enumerate(cols))
        return t.spark.sql(f"SELECT o.o_orderkey, {subs} FROM {{o}} o", li=t.lineitem, o=t.orders)

    def one_aggregate():
        return joins.with_child_sums(t.orders.select("o_orderkey"), t.lineitem, {"o_orderkey": "l_orderkey"}, {f"s{i}": F.col(c) for i, c in enumerate(["l_extendedprice", "l_quantity", "l_discount", "l_tax"])})

    li = t.lineitem.withColumn("k", F.concat(F.lit(" p"), F.col("l_orderkey").cast("string")))
    o = t.orders.withColumn("k", F.concat(F.lit("P"), F.col("o_orderkey").cast("string"), F.lit(" ")))

    def norm_in_on():
        a = li.join(o.select(F.col("k").alias("k1"), "o_totalprice"), norm("k") == norm("k1"))
        return a.join(o.select(F.col("k").alias("k2"), "o_orderdate"), norm("k") == norm("k2"))

    def norm_once():
        a = li.withColumn("kn", norm("k"))
        b = o.withColumn("kn", norm("k"))
        return a.join(b.select("kn", "o_totalprice", "o_orderdate"), "kn")

    return {
        "asof": (range_join, lambda: QUERIES["join_asof_latest"](t.spark, t.folder)),
        "reconcile": (subqueries, one_aggregate),
        "surrogate_key": (
            lambda: t.lineitem.withColumn("id", F.row_number().over(W.orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))),
            lambda: windows.dense_number(t.lineitem, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]),
        ),
        "normalise_once": (norm_in_on, norm_once),
    }


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from tarnwork.queries import QUERIES
    from tarnwork.session import Tables, build_session

    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else [n for n in HEADLINE if n in QUERIES]
    results = {}
    for name in names:
        run = lambda name=name: QUERIES[name](spark, FOLDER)
        timed(run)
        results[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    compared = {}
    if not asked:
        for name, (naive, rewritten) in pairs(Tables(spark, FOLDER)).items():
            timed(naive), timed(rewritten)
            compared[name] = {"naive": round(statistics.median(timed(naive) for _ in range(RUNS)), 3), "rewritten": round(statistics.median(timed(rewritten) for _ in range(RUNS)), 3)}
    print(json.dumps({
        "metric": "total query time", "value": round(sum(results.values()), 3), "unit": "sec", "queries": results, "pairs": compared, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
