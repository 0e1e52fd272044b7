"""File and document sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators.skew import fits_broadcast

# Config option name -> Spark reader option, per format.
OPTION_NAMES = {
    "encoding": "encoding", "header": "header", "inferColumnTypes": "inferSchema", "multiline": "multiLine",
    "delimiter": "sep", "escape": "escape", "quote": "quote", "timestampFormat": "timestampFormat", "dateFormat": "dateFormat",
}
FORMATS = {"parquet", "csv", "json", "orc"}


def reader_options(options: dict[str, object] | None) -> dict[str, str]:
    """Config options in Spark's names; an unknown one is an error."""
    mapped = {}
    for name, value in (options or {}).items():
        if name not in OPTION_NAMES:
            raise ValueError(f"unknown file option {name!r}")
        mapped[OPTION_NAMES[name]] = str(value).lower() if isinstance(value, bool) else str(value)
    return mapped


def read_files(spark: SparkSession, path: str, fmt: str, options: dict | None = None, schema=None, recursive: bool = False) -> DataFrame:
    """Batch file source. Give a schema for large text files: inference reads them once more."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file type {fmt!r}")
    reader = spark.read.format(fmt).options(**reader_options(options))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def with_line_numbers(lines: DataFrame, upto: int) -> DataFrame:
    """Lines of text files (with ``_metadata``) with ``_line``: the number of the line in its file, from 0, for the first
    ``upto`` lines at least; null for lines far behind them.

    Within one split of a file rows keep their order, and the splits are told by their offsets in the file. So a count per
    split (one small row each) says where a split begins, and only splits that begin among the first lines are looked up;
    all others pass untouched. Nothing is sorted and no file is read by one task alone.
    """
    place = lines.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_id")
    )
    splits = place.groupBy("_file", "_from").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(W.partitionBy("_file").orderBy("_from").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    heads = splits.withColumn("_before", ahead).filter(F.col("_before") < upto).select("_file", "_from", "_first", "_before")
    heads = F.broadcast(heads) if fits_broadcast(heads) else heads
    numbered = place.join(heads, ["_file", "_from"], "left").withColumn("_line", F.col("_id") - F.col("_first") + F.col("_before"))
    return numbered.drop("_file", "_from", "_id", "_first", "_before")


def read_sheet_csv(spark: SparkSession, path: str, schema: str, skip_rows: int = 0, options: dict | None = None, recursive: bool = False) -> DataFrame:
    """CSV files that were sheets: ``skip_rows`` lines above the table are dropped in every file, then with ``header`` one
    more, and the rest is read under the schema. A record is one line; empty lines are no records but count as lines.
    """
    mapped = reader_options(options)
    if mapped.pop("multiLine", "false") == "true":
        raise ValueError("lines cannot be skipped in files whose records go over several lines")
    encoding = mapped.pop("encoding", "UTF-8")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        raise ValueError(f"lines of files in {encoding} cannot be told apart")
    mapped.pop("inferSchema", None)
    skip = skip_rows + (mapped.pop("header", "false") == "true")
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    lines = with_line_numbers(reader.text(path), skip).filter(F.coalesce(F.col("_line") >= skip, F.lit(True))) if skip else reader.text(path)
    kept = lines.filter(F.length(F.trim("value")) > 0)
    return kept.select(F.inline(F.array(F.from_csv("value", schema, mapped))))


def read_json_docs(spark: SparkSession, path: str, schema, multi_line: bool = True) -> DataFrame:
    """JSON documents under a fixed schema; absent fields are null, broken documents are all null. A multi-line file
    is one document (or array) and is read by one task; large data belongs into one document per line."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)


def read_stream(spark: SparkSession, path: str, fmt: str, schema, options: dict | None = None, max_files: int | None = None) -> DataFrame:
    """Streaming file source; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**reader_options(options))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_json_map(df: DataFrame, col: str, nested: list[str] | None = None, out: str = "doc") -> DataFrame:
    """A JSON object as map<string,string> in ``out``; each name in ``nested`` becomes a map column of its own."""
    kind = T.MapType(T.StringType(), T.StringType())
    parsed = df.withColumn(out, F.from_json(F.col(col), kind))
    return parsed.withColumns({n: F.from_json(F.col(out)[n], kind) for n in nested or []})


def path_has_segment(path: str | Column, segment: str) -> Column:
    """True when a '/'-separated segment equals ``segment``, case-insensitively."""
    p = F.col(path) if isinstance(path, str) else path
    return F.exists(F.split(p, "/"), lambda s: F.lower(s) == segment.lower())


def exclude_path_segment(df: DataFrame, path: str | Column, segment: str) -> DataFrame:
    return df.filter(~path_has_segment(path, segment))


def values_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Inline constant rows."""
    return spark.createDataFrame(rows, schema)


def shape_sheet(df: DataFrame, columns: list[str] | None = None, where: str | None = None, pivot: dict | None = None, aggregate: str = "first") -> DataFrame:
    """Shape tabular input: keep ``columns``, apply ``where``, pivot ``{"columns": name, "values": name, "keep": [...]}``.

    ``keep`` names the pivot values; without it Spark looks them up with a job of its own. ``aggregate`` is the value
    chosen per cell: ``first`` (the smallest, so that it does not depend on row order), ``sum`` or ``count``.
    """
    out = df.filter(where) if where else df
    out = out.select(*columns) if columns else out
    if not pivot:
        return out
    by, value = pivot["columns"], pivot["values"]
    rest = [c for c in out.columns if c not in (by, value)]
    chosen = {"first": F.min, "sum": F.sum, "count": F.count}[aggregate](value)
    return out.groupBy(*rest).pivot(by, pivot.get("keep")).agg(chosen)
