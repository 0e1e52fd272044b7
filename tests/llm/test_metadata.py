"""Shards along ordered dimensions, and language profiles against a plain version."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarnwork.llm import langid, sharding
from tarnwork.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def signed(text):
    n = xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (1 << 64) if n >> 63 else n


def plainly(rows, shards=16):
    """Shards by the definition: cells by share of the rows below a value, the curve, equal texts side by side."""
    groups = defaultdict(list)
    for d, t, lang, source, _ in rows:
        groups[t or ""].append((d, lang, source))
    low = {t: (min((x[1] for x in g if x[1] is not None), default=None), min((x[2] for x in g if x[2] is not None), default=None), len(t.encode()) + 1) for t, g in groups.items()}
    cells = []
    for k in range(3):
        counts = Counter(v[k] for v in low.values() if v[k] is not None)
        total, seen, cell, last = sum(counts.values()), 0, {None: 0}, 0
        for value in sorted(counts):
            last = max(last, (2 * seen + counts[value]) * 64 // (2 * total))
            cell[value] = last
            seen += counts[value]
        cells.append(cell)
    order = []
    for d, t, *_ in rows:
        at = np.array([[cells[k][low[t or ""][k]] for k in range(3)]])
        order.append((int(sharding.hilbert_index(at)[0]), signed(t or ""), (d is not None, d), t or ""))
    order.sort()
    out, n = [], len(order)
    for rank, (_, _, d, t) in enumerate(order):
        shard = rank * shards // n
        out.append((d[1], len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", shard, rank - (shard * n + shards - 1) // shards, None))
    return sorted(out, key=str)


def test_shards_as_by_the_definition(spark):
    rng = np.random.default_rng(10)
    rows = [(i, f"text {rng.integers(0, 150)} " + "x" * int(rng.integers(0, 300)) if i % 9 else None, [None, "de", "en", "fr"][int(rng.integers(0, 4))], [None, *"abcdefgh"][int(rng.integers(0, 9))], 1) for i in range(400)]
    rows += [(None, "no id", "en", "a", 1), (7, "", None, None, 1), (8, "twice", "en", "b", 1), (8, "twice", "en", "b", 1)]
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    for n in (1, 6):
        docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("_text", "size", "shard", "_n", "_h", "d0")}).repartition(n)
        assert sorted((tuple(r) for r in sharding.shard_documents(docs).select(*columns).collect()), key=str) == plainly(rows)
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_cells_come_from_all_values(spark):
    """Many distinct sources of very uneven counts: the cells are those of all of them."""
    rows = [(i, f"text {i}", "en", f"s{i:05d}" if i % 3 else f"t{i % 7}", 1) for i in range(9000)]
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    out = sharding.shard_documents(spark.createDataFrame(rows, DOCS)).select(*columns).collect()
    assert sorted((tuple(r) for r in out), key=str) == plainly(rows)


def test_a_filter_touches_few_shards(spark):
    """A language, or a stretch of the sources, lies in some of the shards and not in all."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    placed = sharding.shard_documents(docs).join(docs, "doc_id")
    langs, sources = defaultdict(set), defaultdict(set)
    names = sorted({r[0] for r in docs.select("source").distinct().collect() if r[0]})
    for r in placed.select("shard", "lang", "source").collect():
        langs[r["lang"]].add(r["shard"])
        if r["source"]:
            sources[names.index(r["source"]) * 4 // len(names)].add(r["shard"])
    touched = [len(v) for k, v in langs.items() if k]
    # Of 64 pairs of a language and a shard; the most frequent language alone fills half of the shards.
    assert len(touched) == 4 and sum(touched) <= 32 and min(touched) <= 5
    assert sum(len(v) for v in sources.values()) <= 44  # of 64, four stretches


def plain_language(docs, dim=langid.DIM, seed=langid.SEED):
    """Profiles and predictions by single loops."""
    letters = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (langid.SYMBOLS, dim)).astype(float)

    def vector(text):
        s = [0, *(0 if not c.isalpha() else ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) * 31 % (langid.SYMBOLS - 27) for c in text.lower()), 0]
        total = np.zeros(dim)
        for gram, n in Counter(zip(s, s[1:], s[2:], strict=False)).items():
            if any(gram):
                total += np.sqrt(n) * np.roll(letters[gram[0]], 2) * np.roll(letters[gram[1]], 1) * letters[gram[2]]
        return total / np.linalg.norm(total) if any(s) and total.any() else None

    taught = defaultdict(lambda: np.zeros(dim))
    for d, t, lang in docs:
        if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2 and (v := vector(t)) is not None:
            taught[lang] += v
    names = sorted(taught)
    unit = np.array([taught[k] / np.linalg.norm(taught[k]) for k in names])
    unit -= unit.mean(axis=0)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for d, t, _ in docs:
        v = vector(t) if t else None
        cos = unit @ v if v is not None else None
        out[d] = ("und", 0.0) if v is None else (names[int(cos.argmax())], float((1 + cos.max()) / 2))
    return out


def test_languages_as_by_single_loops(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = plain_language(docs)
    got = {r["doc_id"]: r for r in QUERIES["op9_language"](spark, folder).collect()}
    assert len(got) == len(want)
    for d, (lang, score) in want.items():
        assert got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert got[d]["lang_pred"] == lang and abs(got[d]["score"] - score) < 1e-4


def test_languages_of_odd_tables(spark):
    rows = [(1, "some words", "en", None, 1), (1, "some words", "en", None, 1), (2, None, "en", None, 1), (3, "12 !", "xx", None, 1), (4, "noch ein Wort", None, None, 1), (None, "des mots", "fr", None, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("l", "s", "t", "k0")})
    profiles = langid.fit_profiles(docs)
    assert sorted(profiles) == ["en", "fr"]
    out = langid.predict(docs, profiles, ["doc_id", "k0", "l"])
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in out.collect())[:4] == [(0, "fr"), (1, "en"), (1, "en"), (2, "und")]
    assert langid.predict(docs.limit(0), profiles, ["doc_id"]).count() == 0 and langid.fit_profiles(docs.limit(0)) == {}
    with pytest.raises(ValueError, match="score"):
        langid.predict(docs.withColumnRenamed("k0", "score"), profiles, ["score"])
