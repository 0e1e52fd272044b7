"""Importance resampling against a plain version."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, connect  # noqa: E402

from tarnwork.llm import importance  # noqa: E402
from tarnwork.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None), (2, ""), (3, " \t\n--"), (4, "a"), (5, "Ärger ÄRGER ärger 日本語 x1 Y2 z\x7f3 \x80\x85 q"), (6, "one two three four five " * 4000), (7, "one two three four five " * 5),
    (7, "one two three four five " * 5), (8, "one two three four five " * 5), (None, "one Two three " * 9), (9, "x" * 5000 + " y"), (10, "w " * 19), (11, "w " * 20),
]


def grams(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, longest=1, buckets=10_000):
    def bag(rows):
        return Counter(zlib.crc32(g.encode()) % buckets for t in rows for g in grams(t, longest)[1])

    s, t = bag(x for _, x in docs), bag(target)
    total_s, total_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for d, x in docs:
        w, g = grams(x, longest)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t))) for b in (zlib.crc32(v.encode()) % buckets for v in g))
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(w), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for place, r in enumerate(able, 1):
        r.append(place if place <= len(able) * 10 // 100 else None)
    return sorted([tuple([*r, None][:6]) for r in out], key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def test_any_substring_from_two_prefixes():
    rng = np.random.default_rng(11)
    texts = [" ".join(bytes(rng.integers(97, 123, int(rng.integers(1, 40))).tolist()).decode() for _ in range(int(rng.integers(0, 60)))) for _ in range(20)] + ["z" * 70_000 + " ü", ""]
    scan = importance.Scan([t.encode() for t in texts])
    for n in (1, 2, 3, 7):
        crc, begin = scan.grams(n)
        for i, t in enumerate(texts):
            w = t.split()
            assert crc[begin[i]:begin[i + 1]].tolist() == [zlib.crc32(" ".join(w[j:j + n]).encode()) for j in range(len(w) - n + 1)]


def test_shift_is_appending_zero_bytes():
    crc = np.array([0, 1, 0x80000000, 0xFFFFFFFF, 123456789], np.uint32)
    for n in (0, 1, 2, 3, 1000, 2**20 + 5):
        # The register without pre- and postfix: undo both around zlib's own run over the zeros.
        want = [zlib.crc32(bytes(n), int(c) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for c in crc]
        assert importance.shift(crc, np.full(len(crc), n)).tolist() == want


@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (3, 97)])
def test_odd_rows(spark, longest, buckets):
    docs, target = spark.createDataFrame(ODD, DOCS), [None, "", "one two", "WORDS and three words"]
    found = importance.importance(docs, spark.createDataFrame([(t,) for t in target], "text string"), ["doc_id"], longest=longest, buckets=buckets)
    assert got(found) == plain(ODD, target, longest, buckets)


def test_table_in_any_layout(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()])
    for n in (1, 9):
        assert got(importance.importance(docs.repartition(n), target, ["doc_id"])) == want
    assert sum(r[5] is not None for r in want) == sum(r[1] >= 20 for r in want) // 10 > 0


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    docs = spark.createDataFrame([(i, "word " * 30, "a", 1, 2) for i in range(40)], DOCS + ", h string, k0 int, place int")
    assert got(importance.importance(none, none, ["doc_id"])) == []
    drawn = importance.resample(docs, none)
    assert drawn.columns == docs.columns and drawn.count() == 4
    with pytest.raises(ValueError, match="rank"):
        importance.importance(docs.withColumnRenamed("h", "rank"), none, ["rank"])


def test_query_and_sql(spark):
    assert compare(QUERIES["op11_importance"](spark, SF), connect(SF), ORACLES["op11_importance"]) == []
