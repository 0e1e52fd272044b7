"""Catalog tables: datasets, feeds, derived load configs, column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.merge import merge_upsert
from tarnwork.operators.sets import union_all_by_name
from tarnwork.operators.windows import drop_dups


def catalog_upsert(catalog: DataFrame | None, docs: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """Union the document frames by name, lower-case and deduplicate on the keys, then upsert."""
    rows = union_all_by_name(*docs)
    rows = rows.withColumns({k: F.lower(k) for k in keys})
    return merge_upsert(catalog, drop_dups(rows, keys, order), keys)


def feed_rows(feed: DataFrame, kind: str = "database") -> DataFrame:
    """Feed documents ``datasetsConfig[].datasets[]`` to one row per dataset of the given kind, names lower-cased."""
    sections = feed.select("feedName", F.explode("datasetsConfig").alias("c")).filter(F.col("c.datasetType") == kind)
    rows = sections.select("feedName", F.explode("c.datasets").alias("d"))
    return rows.select(
        F.col("feedName").alias("feed_name"), F.lower("d.fileName").alias("dataset_name"), F.col("d.sourceConfigFolderName").alias("folder_name"),
    ).filter(F.col("dataset_name").isNotNull())


def feed_document(catalog: DataFrame, prefix: str, kind: str = "database", schema: str = "dbo") -> DataFrame:
    """Dataset entries of a feed: one JSON text per distinct dataset of the given kind and schema."""
    chosen = catalog.filter((F.col("dataset_type_name") == kind) & (F.col("dataset_schema") == schema))
    names = chosen.groupBy("database_name", "dataset_schema", "dataset_name").agg(F.count(F.lit(1)).alias("_n"))
    entry = F.struct(
        F.col("dataset_name").alias("fileName"), F.concat(F.lit(prefix), "database_name").alias("sourceConfigFolderName"),
        F.col("database_name").alias("databaseName"),
    )
    return names.select("database_name", "dataset_name", F.to_json(entry).alias("entry"))


def derive_configs(columns: DataFrame, pii: DataFrame, datasets: DataFrame) -> DataFrame:
    """Load settings of every dataset at once.

    From the column catalog ``(dataset_name, column_name, column_data_type, column_ordinal)`` minus the columns the PII
    list excludes: the select list, the ingest type and watermark expression (update and entry time decide), partition
    columns and the load type (merge when the dataset has keys). One grouping serves all datasets.
    """
    hidden = pii.filter("include_in_load = 0").select(F.lower("dataset_name").alias("_d"), F.lower("column_name").alias("_c")).distinct()
    lower = F.lower("column_name")
    kept = columns.join(hidden, (F.lower("dataset_name") == F.col("_d")) & (lower == F.col("_c")), "left_anti")
    shown = F.when(
        F.lower("column_data_type") == "geography", F.concat(F.lit("CAST("), lower, F.lit(" AS VARCHAR(255)) AS "), lower)
    ).otherwise(F.upper("column_name"))
    grouped = kept.groupBy("dataset_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("column_ordinal", shown.alias("x")))), lambda s: s["x"]).alias("_cols"),
        F.coalesce(F.bool_or(lower == "updateon"), F.lit(False)).alias("_u"),
        F.coalesce(F.bool_or(lower == "enteredon"), F.lit(False)).alias("_e"),
    )
    part = F.when(F.col("_u"), "updateon").when(F.col("_e"), "enteredon")
    years = F.array(
        F.concat(F.lit("YEAR("), F.upper(part), F.lit(") AS "), part, F.lit("_year")),
        F.concat(F.lit("MONTH("), F.upper(part), F.lit(") AS "), part, F.lit("_month")),
    )
    keyed = grouped.join(datasets.select("dataset_name", "primary_key_list"), "dataset_name", "left")
    keys = F.trim(F.coalesce("primary_key_list", F.lit("")))
    return keyed.select(
        "dataset_name",
        F.array_join(F.when(part.isNull(), F.col("_cols")).otherwise(F.concat("_cols", years)), ", ").alias("select_list"),
        F.when(part.isNull(), "full").otherwise("watermark").alias("ingest_type"),
        F.when(F.col("_u") & F.col("_e"), "COALESCE(UPDATEON, ENTEREDON)").otherwise(F.upper(part)).alias("watermark_id"),
        F.when(part.isNotNull(), F.concat(part, F.lit("_year,"), part, F.lit("_month"))).alias("partition_keys"),
        F.when(keys != "", "merge").otherwise("overwrite").alias("target_load_type"),
    )


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: position, name, type, nulls and the row count, from a single aggregation."""
    names = df.columns
    sums = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(names)])
    entries = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(i + 1).alias("column_ordinal"), F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("column_data_type"), (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"),
            F.col("_rows").alias("row_count"), (F.col("_rows") > F.col(f"_c{i}")).alias("is_nullable_flag"),
        )
        for i, c in enumerate(names)
    ]
    return sums.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
