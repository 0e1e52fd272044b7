"""The prefix trie against a plain version, with containers of many sizes."""

import hashlib
import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, connect  # noqa: E402

from tarnwork.llm import trie  # noqa: E402
from tarnwork.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        own_saved = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += own_saved
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p, m in members.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def branching(rng, n):
    """Conversations that share beginnings of many lengths; some with copies, null turns, ties and nothing of their own."""
    rows = []
    for c in rng.choice(3000, n, replace=False).tolist():
        for k in range(int(rng.integers(1, 9))):
            rows.append((c, k if rng.random() < 0.95 else None, str(rng.choice(["user", "assistant"])), "t" * int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("container", [1, 3, 1000])
def test_as_by_brute_force(spark, container):
    rows = branching(np.random.default_rng(container), 250)
    rows += [(c, k, "user", "copy 🙂") for c in range(4000, 4080) for k in range(3)] + [(7000, k, "user", "a" * (k % 3)) for k in range(300)]
    rows += [(7099, 0, None, None), (None, 0, "user", "x"), (8050, 0, "user", "one")]
    df = spark.createDataFrame(rows, ROWS)
    want = plain(rows)
    assert got(trie.prefix_trie(df.repartition(5), container=container)) == want
    # One very small bound of a broadcast: the heads are joined by a shuffle.
    spark.conf.set("tarnwork.broadcastBytes", "1")
    try:
        assert got(trie.prefix_trie(df, container=container)) == want
    finally:
        spark.conf.unset("tarnwork.broadcastBytes")


def test_conversations_without_turns(spark):
    # 105 takes more turns from a leader that does not exist than it has of its own.
    quiet = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0]
    rows = [(c, 0, "user", "gone") for c in quiet]
    want = plain(rows)
    assert len(want) == 1 and want[0][3] == len(quiet)
    assert got(trie.prefix_trie(spark.createDataFrame(rows, ROWS))) == want


def test_long_runs_of_copies_are_cut(spark, monkeypatch):
    ids = np.random.default_rng(3).permutation(5000)
    df = spark.createDataFrame([(int(i),) for i in ids], "conv bigint").withColumn("end", F.when(F.col("conv") % 5 == 0, F.lit(bytearray(b"b"))).otherwise(F.lit(bytearray(b"a"))))
    monkeypatch.setattr(trie, "RUN_CHARS", 300)
    out = {bytes(r["end"]): r["sha"] for r in trie.id_digests(df.select("end", "conv")).collect()}
    assert out == {k: hashlib.sha256(",".join(str(i) for i in range(5000) if (i % 5 == 0) == (k == b"b")).encode()).hexdigest() for k in (b"a", b"b")}


def test_empty_table_and_further_columns(spark):
    assert trie.prefix_trie(spark.createDataFrame([], ROWS)).count() == 0
    row = (100, 0, "user", "a")
    clash = spark.createDataFrame([(*row, 5, "b", 1)], ROWS + ", conv bigint, name string, depth int")
    assert got(trie.prefix_trie(clash)) == plain([row])


def test_query_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefix_trie"](spark, SF)) == plain(rows)
    assert compare(QUERIES["op13_prefix_trie"](spark, SF), connect(SF), ORACLES["op13_prefix_trie"]) == []
