"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is its letters' vectors, permuted by their place, bound by
multiplication. A document bundles (adds) the vectors of its trigrams, a language bundles its documents, and a document
gets the language of the largest cosine. The vectors follow from a seed, so every worker makes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import release, ship

DIM = 512
SEED = 20_251
UNKNOWN = "und"
SYMBOLS = 64  # 0: not a letter, 1 to 26: a to z, above: other letters by their code
# Characters of one text turned into trigrams at a time.
STEP = 1_000_000
# Trigram vectors added up at a time.
BLOCK = 2048


class Space:
    """Letter vectors and the trigram vectors made from them so far; one per task, SYMBOLS^3 vectors at most."""

    def __init__(self, dim: int, seed: int):
        rng = np.random.default_rng(seed)
        letters = rng.choice(np.array([-1, 1], np.int8), (SYMBOLS, dim))
        self.shifted = [np.roll(letters, k, axis=1) for k in (2, 1, 0)]
        self.dim = dim
        self.row = np.full(SYMBOLS ** 3, -1, np.int32)
        self.vectors = np.empty((1024, dim), np.int8)
        self.used = 0
        self.symbol = np.full(0x110000, 255, np.uint8)

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        got = self.symbol[codes]
        if (new := codes[got == 255]).size:
            for c in set(new.tolist()):
                ch = chr(c)
                self.symbol[c] = 0 if not ch.isalpha() else c - 96 if 97 <= c <= 122 else 27 + c * 31 % (SYMBOLS - 27)
            got = self.symbol[codes]
        return got.astype(np.int32)

    def rows(self, trigrams: np.ndarray) -> np.ndarray:
        at = self.row[trigrams]
        if (new := trigrams[at < 0]).size:
            a, b, c = new // SYMBOLS ** 2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
            made = self.shifted[0][a] * self.shifted[1][b] * self.shifted[2][c]
            while self.used + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            self.vectors[self.used:self.used + len(new)] = made
            self.row[new] = np.arange(self.used, self.used + len(new), dtype=np.int32)
            self.used += len(new)
            at = self.row[trigrams]
        return at

    def bundle(self, text: str) -> np.ndarray | None:
        """Unit vector of the text's trigrams; None if it has no letter."""
        total, seen = np.zeros(self.dim, np.float64), False
        for lo in range(0, len(text), STEP):
            s = self.symbols(text[lo:lo + STEP + 2])
            s = np.concatenate([[0], s, [0]]).astype(np.int32)
            seen = seen or bool(s.any())
            grams = s[:-2] * SYMBOLS ** 2 + s[1:-1] * SYMBOLS + s[2:]
            grams, n = np.unique(grams[grams > 0], return_counts=True)
            if len(grams):
                at = self.rows(grams)  # may make room for new vectors
                weight = np.sqrt(n).astype(np.float32)
                for k in range(0, len(at), BLOCK):
                    total += weight[k:k + BLOCK] @ self.vectors[at[k:k + BLOCK]].astype(np.float32)
        if not seen:
            return None
        size = np.linalg.norm(total)
        return total / size if size else total


def fit_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Language -> sum of the unit vectors of all its documents. Rows with null text, null language or no letter teach
    nothing. Every task adds up its own documents; one row per language and dimension comes back."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dim, seed), {}
        for batch in batches:
            release()
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = space.bundle(text)
                if v is not None:
                    sums[lang] = sums[lang] + v if lang in sums else v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * dim), "i": pa.array(range(dim), pa.int32()), "v": pa.array(v, pa.float64())})

    rows = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("_t"), F.col(lang_col).alias("_l"))
    summed = rows.mapInArrow(run, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum(F.round("v", 6)).alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["v"]
    return {k: out[k] for k in sorted(out)}


def predict(
    df: DataFrame, profiles: dict[str, np.ndarray], keep: list[str], text_col: str = "text", dim: int = DIM, seed: int = SEED, out: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep`` with the language and a score in 0 to 1, named by ``out``. Null text, a text without a letter, or
    no profile: ``und``, 0.

    The mean of the profiles is taken from each of them, so that what all languages share does not count. Repeated rows
    are predicted each; an empty table gives no rows. A kept column with a name in ``out`` is an error.
    """
    if clash := set(keep) & set(out):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    ship(df.sparkSession)
    langs = list(profiles)
    unit = np.array([profiles[k] / (np.linalg.norm(profiles[k]) or 1) for k in langs]).reshape(len(langs), dim)
    centred = unit - unit.mean(axis=0) if len(langs) > 1 else unit
    centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12) if langs else centred

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(dim, seed)
        for batch in batches:
            release()
            names, scores = [], []
            for text in batch.column(given).to_pylist():
                v = space.bundle(text) if langs and text else None
                if v is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = centred @ v
                best = int(np.argmax(cosines))
                names.append(langs[best])
                scores.append(float(min(1.0, max(0.0, (1 + cosines[best]) / 2))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "l", "s"])

    # Inner names by position, so that no column can clash. A text that is kept is not handed over twice.
    kept = [f"k{i}" for i in range(len(keep))]
    given = keep.index(text_col) if text_col in keep else len(keep)
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], *([] if text_col in keep else [F.col(f"`{text_col}`").alias("t")]))
    schema = ", ".join(f"{k} {df.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept, strict=True))
    named = rows.mapInArrow(run, f"{schema}, l string, s double")
    return named.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], F.col("l").alias(out[0]), F.col("s").alias(out[1]))
