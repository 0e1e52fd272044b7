"""Prefix trie of conversations: one row per distinct beginning, with what sharing it saves.

Method: burst trie. A turn is known by an id (a hash of its role and text), a conversation by its string of turn ids. All
conversations start in one container under the root. A container of more than ``CONTAINER`` distinct strings bursts: its
head becomes a trie node and the strings are dealt to containers by their next turn id. Since a head is just a prefix that
more than ``CONTAINER`` distinct strings share, one count of prefixes finds all bursts at once, at every depth. The
remaining containers are dealt to tasks (the shards), sorted, and swept once: neighbours share their common prefix, so a
stack as deep as a conversation is all that a sweep holds. The totals of the heads are added up from their containers.

Equal conversations are one string with a count and a range of ids, so a group of copies neither bursts nor meets in one
task; its ids are joined where they lie, in sorted runs, before they are hashed in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarnwork.llm.common import parts, settle, ship, small

# Distinct strings that a container holds without bursting; decides where work is done, never the result.
CONTAINER = 1000
# Conversations rebuilt on a common beginning: the group's first one lends up to LENT - 1 turns.
GROUP, LENT = 100, 6
# Bytes of a turn id: 128 bits of SHA-256.
ID = 16
# Characters of joined ids that one row carries.
RUN_CHARS = 1_000_000
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_rows(table: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``conv, pos, turn_id, chars`` of a table of one row per turn (``turn, role, text``).

    Turns are counted from 0 along ``turn`` (null first, ties by role and text). Null roles and texts are empty; rows
    without a conversation are left out; other columns are not read.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = table.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col("turn").alias("turn"), F.unhex(F.substring(F.sha2(named, 256), 1, 2 * ID)).alias("turn_id"),
        F.length(text).cast("long").alias("chars"), F.struct(role, text).alias("tie"),
    )
    place = F.row_number().over(W.partitionBy("conv").orderBy("turn", "tie")) - 1
    return rows.select("conv", place.alias("pos"), "turn_id", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv, part, pos, turn_id, chars``: the first turns of the group's first conversation (part 0), then the
    conversation's own turns behind them (part 1). Every conversation has a row, without turn id if need be (part 0,
    position -1)."""
    lent = F.crc32(F.col("conv").cast("string").cast("binary")) % LENT
    leader = F.col("conv") - F.col("conv") % GROUP
    begin = turns.filter("pos = 0").select("conv", leader.alias("leader"), lent.alias("lent"))
    stock = turns.filter((F.col("conv") % GROUP == 0) & (F.col("pos") < LENT - 1)).select(F.col("conv").alias("leader"), "pos", "turn_id", "chars")
    lead = begin.join(stock, "leader").filter("pos < lent").select("conv", F.lit(0).alias("part"), "pos", "turn_id", "chars")
    own = turns.filter(F.col("pos") >= lent).select("conv", F.lit(1).alias("part"), "pos", "turn_id", "chars")
    there = begin.select("conv", F.lit(0).alias("part"), F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("turn_id"), F.lit(0).cast("long").alias("chars"))
    return lead.unionByName(own).unionByName(there)


def strings(rows: DataFrame) -> DataFrame:
    """``conv, ids, chars, heads``: each conversation as the string of its turn ids, the code points of each turn, and
    the string of the names of its prefixes (a running hash, as long as a turn id). The rows of a conversation follow
    each other in a sorted task and are never gathered by Spark; one conversation's 40 bytes a turn stand in a row, as its
    text would."""
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "part", "pos").select("conv", "turn_id", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(of: list) -> pa.RecordBatch:
            heads = []
            for _, ids, _ in of:
                h, names = hashlib.blake2b(digest_size=ID), []
                for i in ids:
                    h.update(i)
                    names.append(h.copy().digest())
                heads.append(b"".join(names))
            convs, ids, chars = zip(*of, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(convs, pa.int64()), pa.array([b"".join(i) for i in ids], pa.binary()), pa.array(chars, pa.list_(pa.int64())), pa.array(heads, pa.binary())],
                names=["conv", "ids", "chars", "heads"],
            )

        now: list = []
        for batch in batches:
            for conv, turn_id, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not now or now[-1][0] != conv:
                    if len(now) >= 1000:
                        yield named(now)
                        now = []
                    now.append((conv, [], []))
                if turn_id is not None:
                    now[-1][1].append(turn_id)
                    now[-1][2].append(n)
        if now:
            yield named(now)

    return dealt.mapInArrow(run, "conv bigint, ids binary, chars array<bigint>, heads binary")


def id_digests(ends: DataFrame) -> DataFrame:
    """``end, sha``: SHA-256 of the decimal ``conv`` of each ``end``, ascending, joined by commas.

    Ranges along (end, conv) give sorted runs, so a group of copies is spread over tasks; each task joins the ids of a run
    to few long rows, and only those meet for the digest, which must be taken in order.
    """
    runs = ends.repartitionByRange(parts(ends.sparkSession), "end", "conv").sortWithinPartitions("end", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(of: list) -> pa.RecordBatch:
            end, first, ids = zip(*of, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(end, pa.binary()), pa.array(first, pa.int64()), pa.array([",".join(i) for i in ids])], names=["end", "first", "ids"])

        now, chars = [], 0
        for batch in batches:
            for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not now or now[-1][0] != end or chars > RUN_CHARS:
                    if chars > RUN_CHARS:
                        yield made(now)
                        now, chars = [], 0
                    now.append((end, conv, []))
                now[-1][2].append(str(conv))
                chars += 21
        if now:
            yield made(now)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(of: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e for e, _ in of], pa.binary()), pa.array([h.hexdigest() for _, h in of])], names=["end", "sha"])

        now: list = []
        for batch in batches:
            for end, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now and now[-1][0] == end:
                    now[-1][1].update(f",{ids}".encode())
                    continue
                if len(now) >= 1000:
                    yield made(now)
                    now = []
                now.append((end, hashlib.sha256(ids.encode())))
        if now:
            yield made(now)

    joined = runs.mapInArrow(join, "end binary, first bigint, ids string")
    return joined.repartition("end").sortWithinPartitions("end", "first").select("end", "ids").mapInArrow(digest, "end binary, sha string")


class Sweep:
    """Nodes of containers from their sorted strings. ``stack`` holds the open nodes from the container's top down:
    ``[smallest id, members, children, leaves, saved below, code points, digest, closed children]``; a node's row waits at
    its parent until the parent's smallest member is known."""

    def __init__(self):
        self.stack: list[list] = []
        self.rows: list[tuple] = []
        self.before, self.top = b"", (None, 0, b"")

    def close(self, depth: int) -> None:
        """Finish all open nodes deeper than ``depth`` turns below the container's head."""
        while len(self.stack) > depth:
            first, n, children, leaves, saved, chars, sha, closed = self.stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * chars
            self.rows += [(*row, first, *more) for row, more in closed]
            here = self.top[1] + len(self.stack) + 1
            more = (n, children, leaves, saved, sha or NOTHING)
            if self.stack:
                up = self.stack[-1]
                up[0], up[1], up[2], up[3], up[4] = min(up[0], first), up[1] + n, up[2] + 1, up[3] + leaves, up[4] + saved
                up[7].append(((None, first, here), more))
            else:
                self.rows.append((self.top[2], first, here, None, *more))

    def add(self, ids: bytes, chars: list[int], conv: int, n: int, sha: str) -> None:
        """The next string of the container, without the turns of its head: distinct and in order."""
        same, most = 0, min(len(ids), len(self.before))
        while same < most and ids[same:same + ID] == self.before[same:same + ID]:
            same += ID
        self.close(same // ID)
        for c in chars[same // ID:]:
            self.stack.append([conv, 0, 0, 0, 0, c, None, []])
        last = self.stack[-1]
        last[0], last[1], last[6] = min(last[0], conv), last[1] + n, sha
        self.before = ids


def swept(contained: DataFrame) -> DataFrame:
    """``path, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of all nodes in
    containers. Only the top node of a container has a ``path`` (the names of its heads) and no parent yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        sweep, now = Sweep(), None
        for batch in batches:
            for name, burst, ids, chars, heads, conv, n, sha in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != now:
                    sweep.close(0)
                    sweep.before, sweep.top, now = b"", (None, burst, heads[:ID * burst]), name
                sweep.add(ids[ID * burst:], chars[burst:], conv, n, sha)
                if len(sweep.rows) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*sweep.rows, strict=True), kinds, strict=True)], names=names)
                    sweep.rows = []
        sweep.close(0)
        if sweep.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*sweep.rows, strict=True), kinds, strict=True)], names=names)

    dealt = contained.repartition("name").sortWithinPartitions("name", "ids").select("name", "burst", "ids", "chars", "heads", "conv", "n", "sha")
    return dealt.mapInArrow(run, "path binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")


def prefix_trie(table: DataFrame, id_col: str = "conv_id", container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``,
    all but the last long.

    See ``turn_rows`` for nulls, ties and further columns; repeated turns of a conversation are turns. An empty table has
    no trie, not even a root. The result does not depend on ``container``.
    """
    ship(table.sparkSession)
    turns = settle(turn_rows(table, id_col), "turns")
    every = settle(strings(rebuilt(turns)), "strings").withColumn("depth", (F.octet_length("ids") / ID).cast("int"))
    end = F.when(F.col("depth") > 0, F.substring("heads", ID * (F.col("depth") - 1) + 1, F.lit(ID))).otherwise(F.lit(b""))
    every = every.withColumn("end", end)
    # Copies are one string: smallest id, number, and the digest of their ids.
    distinct = every.groupBy("end").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.any_value("ids").alias("ids"), F.any_value("chars").alias("chars"),
        F.any_value("heads").alias("heads"), F.any_value("depth").alias("depth"),
    )
    known = settle(distinct.join(id_digests(every.select("end", "conv")), "end"), "distinct")

    # Every prefix of every string, root included; those shared by too many strings burst, and the root always does.
    at = known.select("end", "conv", "n", "chars", "heads", F.explode(F.sequence(F.lit(0), "depth")).alias("d"))
    name = F.when(F.col("d") > 0, F.substring("heads", ID * (F.col("d") - 1) + 1, F.lit(ID))).otherwise(F.lit(b""))
    prefix = at.select("end", "conv", "n", "d", name.alias("name"), F.substring("heads", F.lit(1), ID * F.col("d")).alias("path"), F.when(F.col("d") > 0, F.get("chars", F.col("d") - 1)).otherwise(0).alias("chars"))
    counted = prefix.groupBy("name").agg(
        F.count(F.lit(1)).alias("strings"), F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"), F.any_value("d").alias("d"), F.any_value("path").alias("path"), F.any_value("chars").alias("chars")
    )
    heads = settle(counted.filter((F.col("strings") > container) | (F.col("d") == 0)), "heads")
    lookup = small(heads.select("name"))
    depth_of = prefix.join(lookup, "name").groupBy("end").agg(F.max("d").alias("burst"))
    dealt = settle(known.join(depth_of, "end"), "dealt")

    below = dealt.filter(F.col("depth") > F.col("burst")).withColumn("name", F.substring("heads", ID * F.col("burst") + 1, F.lit(ID)))
    nodes = settle(swept(below), "nodes")

    # A container's top and each head count for all heads above them (a head also for itself).
    def last(path: str):
        return F.when(F.octet_length(path) > 0, F.substring(path, F.octet_length(path) - ID + 1, F.lit(ID))).otherwise(F.lit(b""))

    def above(df: DataFrame, *sums: str) -> DataFrame:
        up = df.select(*sums, "path", F.explode(F.sequence(F.lit(0), (F.octet_length("path") / ID).cast("int"))).alias("d"))
        return up.select(*sums, F.when(F.col("d") > 0, F.substring("path", ID * (F.col("d") - 1) + 1, F.lit(ID))).otherwise(F.lit(b"")).alias("name"))

    tops = nodes.filter("path IS NOT NULL")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    sums = above(tops.withColumnRenamed("saved_tokens", "saved"), "n_leaves", "saved").unionByName(
        above(heads.select(F.lit(0).cast("long").alias("n_leaves"), saved.alias("saved"), "path"), "n_leaves", "saved")
    ).groupBy("name").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parent_path = F.substring("path", F.lit(1), F.octet_length("path") - ID)
    kids = tops.select(last("path").alias("name")).unionByName(
        heads.filter("d > 0").select(parent_path.alias("path")).select(last("path").alias("name"))
    ).groupBy("name").agg(F.count(F.lit(1)).alias("n_children"))
    ends = dealt.filter("depth = burst").select(F.col("end").alias("name"), "sha")

    names = small(heads.select(F.col("name").alias("up"), F.col("conv_id").alias("up_conv")))
    upper = heads.select("name", "conv_id", F.col("d").cast("long").alias("depth"), "n_convs", F.when(F.col("d") > 0, parent_path).alias("up_path"))
    upper = upper.withColumn("up", F.when(F.col("up_path").isNotNull(), last("up_path"))).join(names, "up", "left")
    upper = upper.join(sums, "name").join(kids, "name", "left").join(ends, "name", "left").select(
        "conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.greatest("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), "saved_tokens", F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"),
    )
    inner = nodes.withColumn("up", F.when(F.col("path").isNotNull(), last("path"))).join(names, "up", "left")
    return upper.unionByName(inner.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ))


SQL = r"""
WITH RECURSIVE
bits AS (SELECT CAST(b AS BIGINT) AS b, CAST(b AS BIGINT) AS v, 0 AS k FROM range(256) r(b) UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
byte AS (SELECT b, v FROM bits WHERE k = 8),
t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (
  SELECT c, CAST(c AS VARCHAR) AS s, 1 AS p, CAST(4294967295 AS BIGINT) AS v FROM t WHERE pos = 0 UNION ALL
  SELECT a.c, a.s, a.p + 1, xor(byte.v, a.v >> 8) FROM steps a JOIN byte ON byte.b = xor(a.v, ascii(substr(a.s, a.p, 1))) & 255 WHERE a.p <= length(a.s)),
lent AS (SELECT c, xor(v, 4294967295) % 6 AS h FROM steps WHERE p > length(s)),
moved AS (
  SELECT lent.c, 0 AS part, t.pos, t.x FROM lent JOIN t ON t.c = lent.c - lent.c % 100 AND t.pos < h UNION ALL
  SELECT lent.c, 1, t.pos, t.x FROM lent JOIN t ON t.c = lent.c AND t.pos >= h),
seqs AS (SELECT lent.c, coalesce(list(x ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS l FROM lent LEFT JOIN moved ON moved.c = lent.c GROUP BY lent.c),
prefixes AS (SELECT c, d, l[1:d] AS p FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM seqs)),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE length(p[-1].t) END AS chars FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
owned AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON kids.p = node.p),
below AS (
  SELECT p[1:k] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * chars) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM owned) GROUP BY ALL),
ends AS (SELECT l AS p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM seqs GROUP BY l)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM owned o JOIN below b ON b.p = o.p LEFT JOIN node u ON o.d > 0 AND u.p = o.p[1:o.d - 1] LEFT JOIN ends e ON e.p = o.p
"""
