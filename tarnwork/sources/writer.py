"""Sinks on plain Parquet.

A table that is rewritten lives in version folders ``v=<number>``. Spark's committer writes ``_SUCCESS`` last, and the
current version is the highest folder that has it, so a failed load leaves the previous version in place and a path is
never overwritten while it is read. Where the session's catalog supports MERGE, ``merge_table`` uses that instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.merge import merge_upsert
from tarnwork.operators.skew import fits_broadcast
from tarnwork.sources.files import reader_options


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a table, or ``None`` before the first load."""
    done = versions(spark, path)
    return spark.read.parquet(f"{path}/v={done[-1]}") if done else None


def publish(df: DataFrame, path: str, version: int | None = None, parts: list[str] | None = None) -> int:
    """Write ``df`` as the next version; with an explicit ``version`` a repeat writes the same folder again."""
    spark = df.sparkSession
    done = versions(spark, path)
    number = version if version is not None else (done[-1] + 1 if done else 0)
    _writer(df, parts).mode("overwrite").parquet(f"{path}/v={number}")
    return number


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` complete versions."""
    fs, _ = _fs(spark, path)
    for number in versions(spark, path)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={number}"), True)


def _writer(df: DataFrame, parts: list[str] | None):
    """Partitioned writes shuffle on the partition columns through REBALANCE, which splits a large partition over
    several files, so one value with a third of the rows does not become one task."""
    if not parts:
        return df.write
    return df.hint("rebalance", *[F.col(p) for p in parts]).write.partitionBy(*parts)


def load_overwrite(df: DataFrame, path: str, parts: list[str] | None = None, skip_empty: bool = False) -> bool:
    """Replace the whole table. With ``skip_empty`` an empty batch leaves it unchanged. True if something was written."""
    if skip_empty and df.isEmpty():
        return False
    publish(df, path, parts=parts)
    return True


def load_append(df: DataFrame, path: str, parts: list[str] | None = None) -> None:
    """Add files to a plain folder; columns may differ between loads."""
    _writer(df, parts).mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """A folder of appended loads with the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, options: dict | None = None) -> None:
    mapped = reader_options(options)
    mapped.pop("inferSchema", None)
    df.write.mode("overwrite").options(**mapped).csv(path)


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: list[str], parts: list[str], stage: str) -> None:
    """Upsert into a partitioned folder, rewriting only the partitions the source touches (the partition columns are
    part of the key). The merged partitions are staged first, so no folder is overwritten while it is read; dynamic
    partition overwrite then replaces exactly those."""
    if not set(parts) <= set(keys):
        raise ValueError("the partition columns must be part of the key")
    target = spark.read.parquet(path)
    hit = source.select(*parts).distinct()
    touched = target.join(F.broadcast(hit) if fits_broadcast(hit) else hit, parts, "left_semi")
    publish(merge_upsert(touched, source, keys), stage)
    staged = read_current(spark, stage)
    _writer(staged, parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def merge_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str], condition: list[str] | None = None) -> None:
    """MERGE into a catalog table that supports row-level changes. Parquet tables do not; use ``publish`` there."""
    on = reduce(lambda a, b: a & b, [F.expr(f"{table}.{k} = source.{k}") for k in keys])
    differs = None
    if condition:
        differs = reduce(lambda a, b: a | b, [F.expr(f"NOT ({table}.{c} <=> source.{c})") for c in condition])
    merge = source.alias("source").mergeInto(table, on)
    (merge.whenMatched(differs) if differs is not None else merge.whenMatched()).updateAll().whenNotMatched().insertAll().merge()
