"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.skew import fits_broadcast
from tarnwork.session import passing, run_dir

_SHIPPED: set[str] = set()
_REMEMBERED: list[dict] = []
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that it need not be installed there, and keep Arrow
    batches small enough for long texts unless the session says otherwise."""
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, "2m")
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tarnwork-code-"), "tarnwork_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tarnwork", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder, let Spark drop the shuffle files behind it, and read it back. Inside a
    ``scratch`` block of the session the folder goes when the block ends."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        path = run_dir(spark, label)
        df.write.parquet(path)
        passing(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """Gap-free numbers from 0 along ``order``.

    One range shuffle sorts the rows; each range numbers its own, the numbers are written (so a retry cannot change
    them), and the sizes of the earlier ranges, one row per shuffle partition, are added. Rows that tie in ``order``
    get different numbers in any order.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in order]
    ranged = df.repartitionByRange(parts(spark), *keys).sortWithinPartitions(*keys)
    kept = settle(ranged.withColumn("_m", F.monotonically_increasing_id()), "numbered")
    place = F.shiftright("_m", 33)
    sizes = {r["p"]: r["n"] for r in kept.groupBy(place.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, seen = [], 0
    for p in sorted(sizes):
        offsets.append((p, seen))
        seen += sizes[p]
    table = spark.createDataFrame(offsets, "_p bigint, _off bigint")
    joined = kept.withColumn("_p", place).join(F.broadcast(table), "_p")
    within = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.select(*df.columns, (F.col("_off") + within).alias(out))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def small(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint if its measured size allows it; without one it is joined by a shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df


def remembered() -> dict:
    """An empty dict for what a worker keeps from task to task, until an operator that needs the memory calls ``release``."""
    _REMEMBERED.append({})
    return _REMEMBERED[-1]


def release() -> None:
    """In a task: forget what tasks of other operators remembered in this worker, and hand freed memory back to the machine."""
    import pyarrow as pa

    for kept in _REMEMBERED:
        kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
