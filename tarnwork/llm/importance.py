"""Importance resampling towards a target by hashed n-grams, whose checksums come from running checksums.

Method: prefix-CRC substrings. A text is normalised once (A-Z lower-cased, words joined by one separator byte) and
scanned once; the running CRC-32 at every word's start and end is kept. The CRC of any n-gram follows from two of them:
``crc(B) = crc(AB) xor shift(crc(A), len(B))``, where the shift multiplies by ``x ** (8 * len)`` in the field of the
checksum's polynomial. No n-gram is cut out or hashed by itself, whatever its length.

Hashed bags of n-grams of all documents and of the target give each bucket a gain, the log ratio of its two smoothed
frequencies. A document's weight is the sum of its gains; a Gumbel draw of its id is added, and the highest scores are a
sample without replacement with probabilities by weight.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import numbered, settle, ship, text_or_empty

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
# The reversed polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320
# Text scanned together: bounds what a worker holds besides one Arrow batch.
SCAN_BYTES = 2_000_000
# Digits, a-z and everything beyond ASCII make words; A-Z become a-z, all other bytes separate.
LETTERS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


BYTE = _byte_table()


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values for each of the four bytes."""
    return tables[0][c & 255] ^ tables[1][c >> 8 & 255] ^ tables[2][c >> 16 & 255] ^ tables[3][c >> 24]


def _shift_tables() -> list[np.ndarray]:
    """Maps that append 1, 2, 4, 8 … zero bytes: each one is the one before applied twice."""
    value = np.arange(256, dtype=np.uint32)
    one = np.stack([BYTE, *[(value << np.uint32(8 * i)) >> 8 for i in (1, 2, 3)]])
    found = [one]
    for _ in range(31):
        found.append(np.stack([_apply(found[-1], found[-1][i]) for i in range(4)]))
    return found


SHIFTS = _shift_tables()


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What each checksum becomes when ``length`` zero bytes follow (without the checksum's own pre- and postfix)."""
    out = crc.copy()
    most = int(length.max()) if len(length) else 0
    for bit, tables in enumerate(SHIFTS):
        if most >> bit == 0:
            break
        hit = np.flatnonzero(length >> bit & 1)
        out[hit] = _apply(tables, out[hit])
    return out


class Scan:
    """Running checksums of several texts at every word."""

    def __init__(self, texts: list[bytes]):
        pieces: list[bytes] = []
        ends = [0]
        for t in texts:
            words = t.translate(LETTERS).split()
            if words:  # the separator goes with the word behind it
                pieces += (b" " + b"\0 ".join(words)).split(b"\0")
            ends.append(len(pieces))
        # Words of text i: first[i] to first[i + 1].
        self.first = np.array(ends, np.int64)
        c, crc = 0, zlib.crc32
        self.end = np.array([c := crc(p, c) for p in pieces], np.uint32)
        before = np.concatenate([np.zeros(1, np.uint32), self.end[:-1]]) if pieces else self.end
        flipped = ~before
        self.start = ~(BYTE[(flipped ^ np.uint32(32)) & 255] ^ flipped >> 8)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.to = np.cumsum(size)
        self.at = self.to - size + 1

    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Checksums of all runs of ``n`` words in order, and for each text where its runs begin (and the last end)."""
        per_text = np.maximum(self.n_words() - n + 1, 0)
        begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_text)])
        left = np.repeat(self.first[:-1] - begin[:-1], per_text) + np.arange(begin[-1])
        right = left + n - 1
        return self.end[right] ^ shift(self.start[left], self.to[right] - self.at[left]), begin


def _scans(column: pa.Array) -> Iterator[tuple[int, int, Scan]]:
    texts = column.cast(pa.binary()).to_pylist()
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SCAN_BYTES:
            yield lo, i, Scan(texts[lo:i])
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts), Scan(texts[lo:])


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> dict[int, int]:
    """How many n-grams of up to ``longest`` words of the whole table fall into each bucket: one row per bucket and task
    is moved, and at most ``buckets`` counts reach the driver."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, scan in _scans(batch.column(0)):
                for k in range(1, longest + 1):
                    n += np.bincount(scan.grams(k)[0] % buckets, minlength=buckets)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(n[hit])], names=["b", "n"])

    rows = df.select(text_or_empty(text_col).alias("_t")).mapInArrow(run, "b bigint, n bigint")
    return {r["b"]: r["n"] for r in rows.groupBy("b").agg(F.sum("n").alias("n")).collect()}


def gains(every: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket ``floor(1000 * ln(ratio))`` of its frequency in the target to its frequency in all documents, one
    added to every count."""
    s, t = sum(every.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * float(s) / ((every.get(b, 0) + 1) * float(t)))) for b in range(buckets)], np.int64)


def chance(id_text: str, seed: int) -> int:
    """The Gumbel draw of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{id_text}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(
    docs: DataFrame, target: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS,
    seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """Every row of ``docs``: the columns ``keep``, then ``n_words, n_features, weight, score, rank``, all long.

    ``rank`` counts from 1 along falling scores, ties to the smaller id (null first), over the drawn rows: ``percent`` of
    the rows with at least ``min_words`` words, rounded down. All others have none. Null text has no words and weight 0;
    a null id draws as the empty text; repeated rows are counted, weighed and drawn each, in any order among themselves.
    An empty table gives no rows; an empty target leaves the smoothing alone to decide. A kept column with the name of a
    result is an error, other columns are not read.
    """
    clash = {"n_words", "n_features", "weight", "score", "rank"} & set(keep)
    if clash:
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    ship(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target, text_col, longest, buckets), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, words, weight = [], [], []
            for _, _, scan in _scans(batch.column(batch.num_columns - 1)):
                total, features = np.zeros(len(scan.first) - 1, np.int64), np.zeros(len(scan.first) - 1, np.int64)
                for k in range(1, longest + 1):
                    crc, begin = scan.grams(k)
                    running = np.concatenate([np.zeros(1, np.int64), np.cumsum(gain[crc % buckets])])
                    total += running[begin[1:]] - running[begin[:-1]]
                    features += np.diff(begin)
                count.append(features)
                words.append(scan.n_words())
                weight.append(total)
            if not count:
                continue
            weight = np.concatenate(weight)
            luck = np.array([chance(i, seed) for i in batch.column(batch.num_columns - 2).to_pylist()], np.int64)
            found = [np.concatenate(words), np.concatenate(count), weight, weight + luck]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *map(pa.array, found)], names=names)

    # Inner names by position, so that no column of the caller can clash.
    kept = [f"k{i}" for i in range(len(keep))]
    names = [*kept, "i", "n_words", "n_features", "weight", "score"]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.col(f"`{id_col}`").alias("i"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("h"), text_or_empty(f"`{text_col}`").alias("t"),
    )
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    scored = settle(rows.mapInArrow(run, f"{types}, n_words bigint, n_features bigint, weight bigint, score bigint"), "scored")
    drawn = scored.filter(F.col("n_words") >= min_words).count() * percent // 100
    # Rows too short to be drawn come last, so that one numbering serves all.
    placed = numbered(scored.withColumns({"short": F.col("n_words") < min_words, "down": -F.col("score")}), ["short", "down", "i", "n_features"], "place")
    rank = F.when(~F.col("short") & (F.col("place") < drawn), F.col("place") + 1)
    return placed.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "n_words", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, which must not have names of results."""
    return importance(docs, target, docs.columns, **options).filter("rank IS NOT NULL").select(*[f"`{c}`" for c in docs.columns])


SQL = r"""
WITH RECURSIVE
bits AS (SELECT CAST(b AS BIGINT) AS b, CAST(b AS BIGINT) AS c, 0 AS k FROM range(256) r(b) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
byte AS (SELECT b, c FROM bits WHERE k = 8),
texts AS (SELECT 0 AS side, doc_id, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
listed AS (
  SELECT side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
bag AS (SELECT side, r, w, count(*) AS n FROM (SELECT side, r, unnest(words) AS w FROM listed) GROUP BY ALL),
hexed AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM bag),
steps AS (
  SELECT w, x, 1 AS p, CAST(4294967295 AS BIGINT) AS c FROM hexed UNION ALL
  SELECT s.w, s.x, s.p + 2, xor(t.c, s.c >> 8) FROM steps s JOIN byte t ON t.b = xor(s.c, CAST('0x' || substr(s.x, s.p, 2) AS BIGINT)) & 255 WHERE s.p < length(s.x)),
bucket AS (SELECT w, xor(c, 4294967295) % 10000 AS b FROM steps WHERE p > length(x)),
counts AS (SELECT b, CAST(sum(n) FILTER (side = 0) AS BIGINT) AS s, CAST(sum(n) FILTER (side = 1) AS BIGINT) AS t FROM bag JOIN bucket USING (w) GROUP BY b),
totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t FROM counts),
gain AS (
  SELECT b, CAST(floor(1000 * ln((coalesce(c.t, 0) + 1) * (x.s + 10000) / ((coalesce(c.s, 0) + 1) * (x.t + 10000)))) AS BIGINT) AS g
  FROM counts c, totals x),
weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight FROM bag JOIN bucket USING (w) JOIN gain USING (b) WHERE side = 0 GROUP BY r),
scored AS (
  SELECT l.doc_id, l.r, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(l.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM listed l LEFT JOIN weights w ON w.r = l.r WHERE l.side = 0),
summed AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place, count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn
  FROM summed)
SELECT doc_id, n_features, n_features AS n_words, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""
