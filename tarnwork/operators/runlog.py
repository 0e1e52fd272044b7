"""Run logs: one JSON document per zone run, flattened, judged and rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import parse_timestamp

# Accepted timestamp spellings of a log message (fixed values).
TIME_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss"]

RAW_METADATA = (
    "errors array<string>, executionDetails array<struct<status:string,start:string>>, filesRead int, rowsRead int, "
    "filesWritten int, rowsCopied int, throughput double, dataRead bigint, dataWritten bigint, copyDuration int"
)
PREPARED_METADATA = (
    "error_message string, runOutput struct<error_message:string,total_rows_read:bigint,total_rows_written:bigint,"
    "total_data_written:bigint,zone_start_date_time:string>"
)
MESSAGE = (
    "run_id string, product_name string, source_system string, dataset_name string, feed_name string, zone string, "
    "stage string, etl_id bigint, start_time string, end_time string, inserted_by string, modified_by string, metadata string"
)


def raw_failed(meta: Column) -> Column:
    """A raw-zone run failed: it lists errors, or its first execution was canceled."""
    errors = F.coalesce(F.size(meta["errors"]) > 0, F.lit(False))
    canceled = F.coalesce(F.get(meta["executionDetails"], F.lit(0))["status"] == "Canceled", F.lit(False))
    return errors | canceled


def prepared_failed(meta: Column) -> Column:
    return F.coalesce(meta["runOutput"]["error_message"], meta["error_message"]).isNotNull()


def parse_once(df: DataFrame, **docs: Column) -> DataFrame:
    """Add parsed JSON columns. ``inline`` keeps the parsing in one place; as plain columns the optimizer would copy the
    parser into every field that is read from it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in docs.items()]))))


def with_metadata(df: DataFrame, meta: str, zone: str) -> DataFrame:
    """``_r`` and ``_p``: the metadata document of a raw and of a prepared run, the other one null."""
    prepared = F.coalesce(F.col(zone) == "Prepared", F.lit(False))
    return parse_once(
        df, _r=F.from_json(F.when(~prepared, F.col(meta)), RAW_METADATA), _p=F.from_json(F.when(prepared, F.col(meta)), PREPARED_METADATA)
    )


def status_column(zone: str) -> Column:
    bad = F.when(F.col(zone) == "Prepared", prepared_failed(F.col("_p"))).otherwise(raw_failed(F.col("_r")))
    return F.when(bad, "Failed").otherwise("Success")


def derive_status(df: DataFrame, meta: str = "metadata", zone: str = "zone", out: str = "status") -> DataFrame:
    """``Failed`` or ``Success`` from the metadata document of a raw or prepared run."""
    return with_metadata(df, meta, zone).withColumn(out, status_column(zone)).drop("_r", "_p")


def parse_messages(raw: DataFrame, col: str = "value") -> DataFrame:
    """JSON messages to columns; ``metadata`` stays a JSON text."""
    return raw.select(F.inline(F.array(F.from_json(F.col(col), MESSAGE))))


def ingestion_log(messages: DataFrame) -> DataFrame:
    """The flat log. A prepared run without row counts shows -1; a timestamp in no known format shows null."""
    prepared = F.col("zone") == "Prepared"
    return with_metadata(messages, "metadata", "zone").select(
        "run_id", "product_name", "source_system", "dataset_name", "feed_name", "metadata",
        parse_timestamp("start_time", TIME_FORMATS).alias("start_time"), parse_timestamp("end_time", TIME_FORMATS).alias("end_time"),
        F.when(prepared, F.coalesce("_p.runOutput.total_rows_read", F.lit(-1))).otherwise(F.col("_r.dataRead")).alias("data_read"),
        F.when(prepared, F.coalesce("_p.runOutput.total_rows_written", F.lit(-1))).otherwise(F.col("_r.dataWritten")).alias("data_written"),
        F.coalesce("_r.filesRead", "_r.rowsRead").alias("files_read"),
        F.coalesce("_r.filesWritten", "_r.rowsCopied").alias("files_written"),
        status_column("zone").alias("status"),
        F.col("_r.throughput").alias("throughput"),
        F.col("_r.copyDuration").alias("copy_duration"),
        "inserted_by", "modified_by", "zone",
    )


def run_zone_rollup(
    log: DataFrame, run: str = "run_id", zone: str = "zone", ts: str = "start_time", status: str = "status", size: str = "data_written",
    tie: str | None = None,
) -> DataFrame:
    """Per run and zone: first start, last time, latest status, overall status (failed if any row failed) and the
    total size, which counts only when the zone succeeded. One aggregation; every part combines in the map tasks."""
    order = F.struct(ts, *([tie] if tie else []))
    any_failed = F.bool_or(F.col(status) == "Failed")
    return log.groupBy(run, zone).agg(
        F.min(ts).alias("zone_start"), F.max(ts).alias("zone_end"), F.max_by(F.col(status), order).alias("latest_status"),
        F.when(any_failed, "Failed").otherwise("Success").alias("zone_status"),
        F.when(any_failed, F.lit(0)).otherwise(F.sum(size)).cast("long").alias("total_size"),
    )


def rollup_state(log: DataFrame, run: str = "run_id", zone: str = "zone", ts: str = "start_time", status: str = "status", size: str = "data_written") -> DataFrame:
    """What ``run_zone_rollup`` needs to know of a piece of the log, per run and zone, so that pieces can be merged. Of
    rows with the same last time the greatest status counts as the latest."""
    latest = F.max(F.struct(F.col(ts).alias("at"), F.col(status).alias("status")))
    return log.groupBy(F.col(run).alias("run_id"), F.col(zone).alias("zone")).agg(
        F.min(ts).alias("zone_start"), F.max(ts).alias("zone_end"), latest.alias("latest"),
        F.bool_or(F.col(status) == "Failed").alias("any_failed"), F.sum(size).cast("long").alias("size_sum"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per run and zone from several."""
    return states.groupBy("run_id", "zone").agg(
        F.min("zone_start").alias("zone_start"), F.max("zone_end").alias("zone_end"), F.max("latest").alias("latest"),
        F.bool_or("any_failed").alias("any_failed"), F.sum("size_sum").alias("size_sum"),
    )


def finish_rollup(states: DataFrame) -> DataFrame:
    """The roll-up that the states stand for."""
    return states.select(
        "run_id", "zone", "zone_start", "zone_end", F.col("latest.status").alias("latest_status"),
        F.when(F.col("any_failed"), "Failed").otherwise("Success").alias("zone_status"),
        F.when(F.col("any_failed"), F.lit(0)).otherwise(F.col("size_sum")).cast("long").alias("total_size"),
    )


def pending_tasks(zone_log: DataFrame, run_id) -> DataFrame:
    """Zone rows of a run that did not succeed."""
    return zone_log.filter((F.col("etl_id") == run_id) & (F.col("zone_status") != "Success"))


def other_records(zone_log: DataFrame, run_id) -> DataFrame:
    """Zone rows of a run other than raw ingestion and prepared transformation."""
    standard = ((F.col("zone") == "Raw") & (F.col("stage") == "Ingestion")) | ((F.col("zone") == "Prepared") & (F.col("stage") == "Transformation"))
    return zone_log.filter((F.col("etl_id") == run_id) & ~standard)
