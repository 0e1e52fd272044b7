"""Shards cut along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``BITS`` bits, the cell's index along the curve orders the rows, and the order is cut
into runs whose row counts differ by one at most. Cells follow the order of the values, and neighbours on the curve are
neighbours in every dimension, so each shard covers ranges of each and readers can skip files by any of them. Rows with equal text share one cell, made
from the smallest metadata among them, so they lie side by side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import numbered, parts, settle, ship

BITS = 6


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of each row of ``cells`` (rows x dimensions, integers below ``2 ** bits``).

    From the highest bit down, a set bit inverts the lower bits of the first coordinate and a clear one exchanges them
    with the first coordinate's; then the coordinates are Gray coded and their bits interleaved.
    """
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    if dims * bits > 62:
        raise ValueError("too many dimensions for a 64-bit index")
    for b in range(bits - 1, 0, -1):
        below = (1 << b) - 1
        for i in range(dims):
            on = (x[i] >> b & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(on, below, swap)
            x[i] ^= swap if i else 0
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | x[i] >> b & 1
    return index


def placed(value: Column, cuts: list[tuple], bits: int) -> Column:
    """Cell of a value: that of the last cut not above it; null and values below all cuts have cell 0."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(c) for c, _ in cuts]), lambda c: c <= value))
    return F.coalesce(F.get(F.array(F.lit(0), *[F.lit(cell) for _, cell in cuts]), below), F.lit(0)).cast("int")


def ordered_cells(df: DataFrame, name: str, bits: int = BITS) -> Column:
    """Cell of a column along its order: about as many rows lie in each, and rows of neighbouring values lie in the same
    or in neighbouring cells, so a shard covers a range of them.

    The cuts come from the counts of all distinct values: these are dealt to ranges, each range adds its own counts up, and
    the sums of the earlier ranges, one a shuffle partition, are added. Fetched are these sums and the cuts, at most one a
    cell, which become constants of the plan.
    """
    spark = df.sparkSession
    counts = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    ranged = settle(counts.repartitionByRange(parts(spark), name).withColumn("_p", F.spark_partition_id()), "values")
    sizes = {r["_p"]: r["n"] for r in ranged.groupBy("_p").agg(F.sum("_n").alias("n")).collect()}
    offsets, total = [], 0
    for p in sorted(sizes):
        offsets.append((p, total))
        total += sizes[p]
    earlier = Window.partitionBy("_p").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    seen = ranged.withColumn("_seen", within).join(F.broadcast(spark.createDataFrame(offsets, "_p int, _off bigint")), "_p")
    cell = F.expr(f"shiftleft(2 * (_seen + _off) + _n, {bits}) div {max(2 * total, 1)}L")
    first = seen.groupBy(cell.alias("_cell")).agg(F.min(name).alias("_value")).orderBy("_cell").collect()
    return placed(F.col(name), [(r["_value"], r["_cell"]) for r in first], bits)


def shard_rows(df: DataFrame, dims: list[Column], tie: list[str], shards: int, bits: int = BITS) -> DataFrame:
    """Add ``shard`` and ``slot``: equal runs along the curve, ties in the order of ``tie``. Row counts of shards differ
    by one at most, also with fewer rows than shards; identical rows get different slots."""
    ship(df.sparkSession)

    @F.pandas_udf("bigint")
    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    names = [f"d{i}" for i in range(len(dims))]
    coded = df.withColumn("_h", index(F.struct(*[d.alias(n) for d, n in zip(dims, names, strict=True)])))
    ranked = numbered(coded, ["_h", *tie], "_rank")
    total = ranked.count()
    n = max(total, 1)
    first = F.expr(f"(_shard * {n}L + {shards - 1}L) div {shards}L")
    return ranked.withColumn("_shard", F.expr(f"(_rank * {shards}L) div {n}L")).select(*df.columns, F.col("_shard").cast("int").alias("shard"), (F.col("_rank") - first).alias("slot"))


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """``id_col, size, text_crc32, law, shard, slot, grown_shard`` for documents with ``lang`` and ``source``.

    Null text has size 1 and the checksum of nothing; null metadata and null ids sort first. The texts are read once;
    only sizes, hashes and metadata are moved. Repeated rows are rows; an empty table has no shards.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = df.select(
        F.col(id_col), F.col("lang").alias("_lang"), F.col("source").alias("_source"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_text"),
    )
    key = ["_text", "text_crc32", "size"]
    cell = settle(slim.groupBy(*key).agg(F.min("_lang").alias("_lang"), F.min("_source").alias("_source")), "cells")
    rows = slim.select(id_col, *key).join(cell, key)
    cells = [ordered_cells(cell, c) for c in ("_lang", "_source", "size")]
    out = shard_rows(rows, cells, ["_text", id_col], shards)
    return out.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
