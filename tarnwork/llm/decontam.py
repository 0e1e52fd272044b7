"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Texts become arrays of word hashes. A mask is laid over every position of a text; the words it selects make one seed,
the words between them are ignored, so a passage with substituted words still shares seeds with its original. Seeds of
documents are joined with the seeds of benchmark items; each hit proposes an alignment of the item with the document,
and the alignment is verified in full: at least ``similarity`` of the item's words must stand in the document at their
place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import settle, small

# Selected positions of each mask, from 0: five words each. The first takes five words running.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 5, 7))
SIMILARITY = 0.8
BETWEEN = r"[^\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words (runs of letters and digits); null text has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(hashes: str, mask: tuple[int, ...], number: int) -> Column:
    """Seed of every position of the array column, in order: an array as long as positions where the mask fits."""
    last = F.size(hashes) - F.lit(mask[-1])
    at = F.sequence(F.lit(1), last)
    made = F.transform(at, lambda i: F.xxhash64(F.lit(number), *[F.element_at(F.col(hashes), i + F.lit(k)) for k in mask]))
    return F.when(last > 0, made).otherwise(F.array().cast("array<bigint>"))


def exploded(df: DataFrame, keep: list[str], masks=MASKS) -> DataFrame:
    """One row per seed: ``keep``, ``seed``, ``at`` (position from 0)."""
    every = F.array(*[seeds("_w", m, k) for k, m in enumerate(masks)])
    one = df.select(*keep, F.explode(every).alias("_s"))
    return one.select(*keep, F.posexplode("_s").alias("at", "seed"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", similarity: float = SIMILARITY, masks=MASKS) -> DataFrame:
    """``id_col, item_col, n_words, n_matched, start``: one row per document and benchmark item found in it.

    ``n_matched`` of the item's ``n_words`` words stand at their place in the best alignment, which begins at word
    ``start`` (the first of equals; negative if the item's head is missing). Items of fewer words than the shortest mask
    spans (five) cannot be found. Rows with a null id or text, and items likewise, take part in nothing; repeated rows of
    a document or an item count once.
    """
    doc = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("_doc"), word_hashes(F.col(text_col)).alias("_w"))
    # As a text, not as hashes, the benchmark is small; its size is measured all the same.
    item = settle(items.filter(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(item_col).alias("_item"), word_hashes(F.col(text_col)).alias("_iw")).distinct(), "items")
    item_seeds = settle(exploded(item.select("_item", F.col("_iw").alias("_w"), F.size("_iw").alias("_n")), ["_item", "_n"], masks).withColumnRenamed("at", "_iat").distinct(), "seeds")

    hits = exploded(doc, ["_doc"], masks).join(small(item_seeds), "seed")
    # One row per alignment, combined before the shuffle.
    found = settle(hits.groupBy("_doc", "_item", (F.col("at") - F.col("_iat")).alias("_shift")).agg(F.max("_n").alias("_n")), "alignments")
    # Only documents with a hit are read again, and their words cut to the aligned stretch.
    again = doc.join(small(found), "_doc")
    stretch = F.slice("_w", F.greatest(F.col("_shift"), F.lit(0)) + 1, F.greatest(F.col("_n") + F.least(F.col("_shift"), F.lit(0)), F.lit(0)))
    aligned = again.select("_doc", "_item", "_shift", stretch.alias("_dw")).join(small(item), "_item")
    own = F.slice("_iw", F.greatest(-F.col("_shift"), F.lit(0)) + 1, F.greatest(F.size("_dw"), F.lit(0)))
    same = F.size(F.filter(F.zip_with("_dw", own, lambda a, b: a == b), lambda x: x))
    scored = aligned.select("_doc", "_item", "_shift", F.size("_iw").alias("n_words"), same.alias("n_matched"))
    kept = scored.filter(F.col("n_matched") >= F.col("n_words") * F.lit(similarity))
    best = kept.groupBy("_doc", "_item").agg(F.max_by(F.struct("n_words", "n_matched", "_shift"), F.struct("n_matched", -F.col("_shift"))).alias("_b"))
    return best.select(F.col("_doc").alias(id_col), F.col("_item").alias(item_col), "_b.n_words", "_b.n_matched", F.col("_b._shift").alias("start"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; rows with a null id stay."""
    found = settle(contaminated(docs, items, id_col, **options).select(F.col(id_col).alias("_found")).distinct(), "found")
    return docs.join(small(found), docs[id_col] == found["_found"], "left_anti")


SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
dl AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS l FROM d),
il AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS l FROM i),
dw AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM dl),
iw AS (SELECT item_id, len(l) AS n, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM il),
m AS (
  SELECT doc_id, item_id, n, dw.p - iw.p AS shift, list(iw.p ORDER BY iw.p) AS ps FROM dw JOIN iw ON dw.w = iw.w GROUP BY ALL HAVING count(*) >= 5),
s AS (
  SELECT doc_id, item_id, n, shift, len(ps) AS k FROM m
  WHERE len(ps) >= n * CAST(0.8 AS DOUBLE) AND len(list_filter(ps, lambda x:
    list_has_all(ps, [x + 1, x + 2, x + 3, x + 4]) OR list_has_all(ps, [x + 1, x + 3, x + 4, x + 6]) OR list_has_all(ps, [x + 2, x + 3, x + 5, x + 7]))) > 0)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_words, CAST(k AS INTEGER) AS n_matched, CAST(shift AS INTEGER) AS start
FROM s QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY k DESC, shift) = 1
"""
