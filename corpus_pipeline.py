"""A corpus pipeline: language, near duplicates, repeated strings, benchmark passages, packing.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``; every stage's rows are written and read again by the next.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import decontam, langid, packing, simhash, suffix
from tarnwork.llm.common import settle
from tarnwork.session import scratch

# Bytes from which a repeated string is cut out: the least of 51 words, one byte each with a space between.
REPEAT_BYTES = 101


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts and texts without a letter. Where no document names its language
    there is nothing to judge by, and all texts with a letter stay."""
    profiles = langid.fit_profiles(docs)
    if not profiles:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    longest = max(map(len, docs.columns))
    lang, score = "_" * (longest + 1), "_" * (longest + 2)  # names that no column has
    named = langid.predict(docs, profiles, docs.columns, out=(lang, score))
    return named.filter(F.col(lang) != langid.UNKNOWN).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of similar ones."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings out that already stand in a document with a smaller id; documents left without a letter go."""
    cleaned = suffix.clean_texts(docs, length=REPEAT_BYTES)
    return cleaned.filter(F.col("text").rlike(r"\p{L}")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their place in sequences."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark), ("packed", packed)]

# Hash fingerprints, token merges and packing are not for SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        # What a stage writes on its way is removed once its rows are written.
        with scratch(spark) as passing:
            docs = settle(stage(spark, docs, sf_dir), name)
            passing.pop()
    return STAGES[-1][1](spark, docs, sf_dir)
