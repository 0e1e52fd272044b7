"""Finding hot keys and cutting them into ordered chunks.

A window over ``partitionBy(key)`` puts each key into one task, and adaptive execution splits skewed joins only, never
windows. The operators that need such a window therefore look first for keys too large for one task. The search is one
partial aggregation over the key columns; in the usual case it finds none and the plain plan runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.keys import join_null_safe
from tarnwork.session import cut

# A key with at most this many rows is left to one task whatever its share. Session setting: tarnwork.hotRows.
HOT_ROWS = 2_000_000
# Sampled rows per chunk when boundaries are picked; only balance depends on it.
SAMPLE_PER_CHUNK = 40
# Most bytes, measured, that a frame may have to be broadcast. Session setting: tarnwork.broadcastBytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# Groups of keys, by hash, that are counted before single keys are.
KEY_GROUPS = 65536
# Bits of a bitmap of keys, powers of two: 32 MB to be broadcast; 8 MB, as Spark's own filters, as a constant of a filter.
FILTER_BITS = 2**28
CONSTANT_BITS = 2**26
BITMAP_BITS = 32768  # of one of Spark's bitmaps
WIDER = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


def hot_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("tarnwork.hotRows", str(HOT_ROWS)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys with more rows than ``max(hotRows, total / shuffle partitions)``, with their row count ``_n``.

    Fewer keys than there are shuffle partitions can each hold more than ``total / partitions`` rows, so the list is
    bounded whatever the data size; it is fetched and handed back as a constant frame.
    """
    spark = df.sparkSession
    # Groups of keys are counted first: they are few, so hardly a row moves, and without a large group no key is hot.
    group = F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))
    groups = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    total = groups.agg(F.sum("_n").alias("total"), F.max("_n").alias("largest")).first()
    if total["total"] is None:
        return None
    limit = max(hot_rows(spark), total["total"] // shuffle_partitions(spark))
    if total["largest"] <= limit:
        return None
    large = [r["_group"] for r in groups.filter(F.col("_n") > limit).collect()]
    counts = df.filter(group.isin(large)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.filter(F.col("_n") > limit).withColumn("_chunks", F.ceil(F.col("_n") / F.lit(limit)).cast("int"))
    hot = found.collect()
    return spark.createDataFrame(hot, found.schema) if hot else None


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt by ``key``, so that every later grouping by it (and more) and every join on it uses this one shuffle.
    With hot keys the frame stays as it is, and each step spreads them in its own way."""
    return df.repartition(key) if hot_keys(df, [key]) is None else df


@dataclass(frozen=True)
class KeyBits:
    """The keys of a frame as one bitmap of ``size`` bits: ``parts`` has it in pieces, written once. It does not grow with
    the frame: of n keys' bits another key meets one by chance in a share of at most ``n / size``."""

    parts: DataFrame
    size: int
    types: list[str]


def _hashed(df: DataFrame, keys: list[str]) -> tuple[list[str], Column]:
    """The types that the keys are hashed in, and the hash: numbers that are equal in a join must be equal here too."""
    types = [WIDER.get(t, t) for t in (df.schema[k].dataType.simpleString() for k in keys)]
    return types, F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types, strict=True)])


def key_bits(df: DataFrame, keys: list[str], size: int | None = None) -> KeyBits:
    size, (types, key) = size or FILTER_BITS, _hashed(df, keys)
    part = F.shiftright("_at", BITMAP_BITS.bit_length() - 1).alias("_part")
    places = df.select(F.pmod(key, F.lit(size)).alias("_at"))
    return KeyBits(cut(places.groupBy(part).agg(F.bitmap_construct_agg(F.col("_at") % BITMAP_BITS).alias("_bits")), "bits"), size, types)


def _has_bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1


def likely(df: DataFrame, keys: list[str], wanted: KeyBits, below_joins: bool = False) -> DataFrame:
    """The rows of ``df`` whose keys ``wanted`` may hold: all that it holds, and by hash chance some others. For rows that a
    join with the wanted keys drops anyway: those left out here do not move for it.

    The bitmap is broadcast. With ``below_joins`` it is a constant of a filter, which Spark carries below the joins and
    groupings that ``df`` is made of; every task of such a filter gets a copy, so this is for small bitmaps. Keys of other
    types than the wanted ones cannot be told by a hash, and all rows stay."""
    types, key = _hashed(df, keys)
    if types != wanted.types:
        return df
    at = F.pmod(key, F.lit(wanted.size))
    if not below_joins:
        there = (F.shiftright(at, BITMAP_BITS.bit_length() - 1) == F.col("_part")) & _has_bit(F.col("_bits"), at % BITMAP_BITS)
        return df.join(F.broadcast(wanted.parts), there, "left_semi")
    every = df.sparkSession.range(wanted.size // BITMAP_BITS).select(F.col("id").alias("_part"))
    filled = every.join(wanted.parts, "_part", "left").select("_part", F.coalesce("_bits", F.lit(bytes(BITMAP_BITS // 8))).alias("_bits"))
    return df.filter(_has_bit(filled.agg(F.expr("listagg(_bits, X'') WITHIN GROUP (ORDER BY _part)")).scalar(), at))


def _bounds(sample: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the cut positions of its ``_chunks`` chunks, taken at equal steps of a sorted sample."""
    chosen = sample.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*order))).alias("_s"), F.max("_chunks").alias("_c")
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_c") - 1),
        lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / F.col("_c")).cast("int")),
    )
    return chosen.filter("_c > 1").select(*keys, F.array_distinct(F.filter(cuts, lambda c: c.isNotNull())).alias("_bounds"))


def position(bounds: Column, coarse: Column, step: Column, here: Column) -> Column:
    """How many sorted boundaries lie below ``here``. ``coarse`` holds every ``step``-th boundary: searching it first
    and then one stretch of ``step`` keeps the comparisons per row near the square root of the number of boundaries."""
    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda b: b < here))

    skipped = below(coarse) * step
    return skipped + below(F.slice(bounds, skipped + 1, step))


def chunk_bounds(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame | None:
    """Chunk boundaries for the hot keys of ``df`` along ``order``; ``None`` when no key is hot.

    The boundaries are fetched once and become constants of the plan, so every branch and every retried task cuts the
    same way. At most two boundaries per shuffle partition exist in total.
    """
    hot = hot_keys(df, keys)
    if hot is None:
        return None
    spark = df.sparkSession
    wanted = hot.agg(F.sum("_n").alias("rows"), F.sum("_chunks").alias("chunks")).first()
    share = min(1.0, SAMPLE_PER_CHUNK * wanted["chunks"] / wanted["rows"])
    rows = df.select(*dict.fromkeys([*keys, *order]))
    rows = join_null_safe(rows, F.broadcast(hot.select(*keys, "_chunks")), keys).sample(share, seed=7)
    picked = _bounds(rows, keys, order)
    return spark.createDataFrame(picked.collect(), picked.schema)


def with_chunks(df: DataFrame, keys: list[str], order: list[str], bounds: DataFrame) -> DataFrame:
    """Add ``_hot`` and ``_chunk``: the number of boundaries below the row; 0 for ordinary keys."""
    here = F.struct(*order)
    step = F.ceil(F.sqrt(F.size("_bounds"))).cast("int")
    table = bounds.withColumn("_step", step).withColumn("_coarse", F.filter("_bounds", lambda b, i: (i + 1) % F.col("_step") == 0))
    joined = join_null_safe(df, F.broadcast(table), keys, "left")
    return joined.withColumns({
        "_hot": F.col("_bounds").isNotNull(),
        "_chunk": F.when(F.col("_bounds").isNull(), 0).otherwise(position(F.col("_bounds"), F.col("_coarse"), F.col("_step"), here)),
    }).drop("_bounds", "_coarse", "_step")


def range_bounds(df: DataFrame, order: list[str]) -> list:
    """Boundaries that cut the whole frame along ``order`` into pieces of about ``hotRows`` rows.

    At most one boundary per shuffle partition; an empty list when the frame fits one task.
    """
    spark = df.sparkSession
    total = df.count()
    pieces = min(shuffle_partitions(spark), -(-total // hot_rows(spark)))
    if pieces < 2:
        return []
    share = min(1.0, SAMPLE_PER_CHUNK * pieces / total)
    sample = df.select(*order).sample(share, seed=7).withColumn("_chunks", F.lit(pieces))
    found = _bounds(sample, [], order).first()
    return [] if found is None else list(found["_bounds"])


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: text by its length, nested values by their JSON, the rest by width."""
    width = 16
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(F.col(f"`{field.name}`")))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))))
        else:
            width += 16
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts], F.lit(width)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Data size of the frame by one aggregation."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()["b"]


def measured_all(frames: list[DataFrame]) -> list[int]:
    """Data sizes of several frames by one job."""
    sizes = [df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).select(F.lit(i).alias("i"), "b") for i, df in enumerate(frames)]
    found = {r["i"]: r["b"] for r in reduce(DataFrame.unionByName, sizes).collect()} if sizes else {}
    return [found[i] for i in range(len(frames))]


def key_profile(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(most rows of one key, measured bytes) in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))
    row = per_key.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")).first()
    return row["most"], row["bytes"]


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get("tarnwork.broadcastBytes", str(BROADCAST_BYTES)))


def fits_broadcast(df: DataFrame) -> bool:
    return measured_bytes(df) <= broadcast_limit(df.sparkSession)


def hinted(frames: list[DataFrame]) -> list[DataFrame]:
    """The frames with a broadcast hint where their measured size allows it, the smallest first until together they reach
    the limit; all are measured by one job."""
    if not frames:
        return []
    left, out = broadcast_limit(frames[0].sparkSession), list(frames)
    for size, i in sorted((size, i) for i, size in enumerate(measured_all(frames))):
        if size > left:
            break
        left, out[i] = left - size, F.broadcast(frames[i])
    return out
