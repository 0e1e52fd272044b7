"""Packing token sequences into as few fixed-size windows as possible.

Method: Martello-Toth dominance reduction, then best fit decreasing. Lengths lie between 1 and the capacity, so the
instance is a histogram of at most ``capacity`` counts however many documents there are. A set that provably dominates
every other way to fill the window of its largest item is fixed for good, with its whole multiplicity at once; what is
left goes by best fit, again by classes of equal length. The plan is a list of segments "ranks r.. of length s go to
windows w.. at offset o", and every row finds its segment by its rank among the rows of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import numbered, settle, ship, text_or_empty
from tarnwork.llm.tokens import Vocabulary, slices

CAPACITY = 1024
END_ID = 2
# Rows of pieces per Arrow batch given back.
EMIT = 20_000


class Plan:
    """Windows built so far. ``segments``: (length, first rank, count, first window, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        if any(s < 1 or s > capacity for s in counts):
            raise ValueError("a length is outside 1..capacity")
        self.left = {s: n for s, n in counts.items() if n}
        self.capacity = capacity
        self.rank: dict[int, int] = {}
        self.windows = 0
        self.segments: list[tuple[int, int, int, int, int]] = []

    def put(self, size: int, count: int, window: int, offset: int) -> None:
        rank = self.rank.get(size, 0)
        self.segments.append((size, rank, count, window, offset))
        self.rank[size] = rank + count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]

    def fix(self, pattern: list[int], count: int) -> None:
        offset = 0
        for size in pattern:
            self.put(size, count, self.windows, offset)
            offset += size
        self.windows += count

    def reduce(self) -> None:
        """Fix sets that dominate all others with the same largest item.

        Two items that fill the window exactly dominate: whatever else stood beside the one could stand where the other
        stood. An item beside which nothing fits stands alone. If only one more item fits, the longest that fits
        dominates.
        """
        c = self.capacity
        if c in self.left:
            self.fix([c], self.left[c])
        for s in sorted(self.left, reverse=True):
            if s in self.left and c - s in self.left and 2 * s >= c:
                n = self.left[s] // 2 if 2 * s == c else min(self.left[s], self.left[c - s])
                if n:
                    self.fix([s, c - s], n)
        sizes = sorted(self.left)
        for s in sorted(self.left, reverse=True):
            while self.left.get(s, 0):
                sizes = [x for x in sizes if x in self.left]
                room = c - s
                others = [x for x in sizes if x != s or self.left[s] > 1]
                if not others or others[0] > room:
                    self.fix([s], self.left[s] if not others or others[0] != s else 1)
                    continue
                low = others[0]
                spare = self.left[low] - (low == s)
                second = low if spare > 1 else next((x for x in others if x != low), None)
                if second is not None and low + second <= room:
                    break  # two more may fit: not proved
                t = others[bisect_left(others, room + 1) - 1]
                n = self.left[s] // 2 if t == s else min(self.left[s], self.left[t])
                if not n:
                    break
                self.fix([s, t], n)

    def best_fit(self) -> None:
        """Longest first, each into the fullest window that still takes it."""
        open_: dict[int, list[tuple[int, int]]] = {}  # room -> windows as (first, count)
        rooms: list[int] = []

        def add(room: int, first: int, count: int) -> None:
            if room:
                if room not in open_:
                    open_[room] = []
                    insort(rooms, room)
                open_[room].append((first, count))

        for s in sorted(self.left, reverse=True):
            while self.left.get(s, 0):
                at = bisect_left(rooms, s)
                if at == len(rooms):
                    each = self.capacity // s
                    full, over = divmod(self.left[s], each)
                    for count, items in ((full, each), (1 if over else 0, over)):
                        if count:
                            for k in range(items):
                                self.put(s, count, self.windows, k * s)
                            add(self.capacity - items * s, self.windows, count)
                            self.windows += count
                    continue
                room = rooms[at]
                first, count = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
                n = min(count, self.left[s])
                self.put(s, n, first, self.capacity - room)
                add(room - s, first, n)
                if count > n:
                    add(room, first + n, count - n)


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plan = Plan(counts, capacity)
    plan.reduce()
    plan.best_fit()
    return plan


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` of every piece of every row's token ids, the end id included.

    Null text counts as empty: one piece that holds the end id. Only rows of more than ``capacity`` ids are cut; the
    first piece takes the remainder.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(path)
        names = [id_col, "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows: list[tuple[int, int, int, int, int]] = []

            def out() -> pa.RecordBatch:
                row, *rest = zip(*rows, strict=True)
                cols = [batch.column(0).take(pa.array(row))] + [pa.array(v, t) for v, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                return pa.RecordBatch.from_arrays(cols, names=names)

            for lo, hi in slices(texts):
                for i, ids in enumerate(vocabulary.encode(texts[lo:hi]), lo):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    start, stop, k = 0, (n - 1) % capacity + 1, 0
                    while start < n:
                        rows.append((i, k, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                        start, stop, k = stop, stop + capacity, k + 1
                if len(rows) > EMIT:
                    yield out()
                    rows = []
            if rows:
                yield out()

    rows = df.select(id_col, text_or_empty(text_col).alias("_t"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def place(rows: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` between 1 and ``capacity``.

    The histogram (``capacity`` counts at most) and the segments (their number depends on the distinct lengths, not on
    the rows) are all that passes through the driver. An empty frame stays empty.
    """
    spark = rows.sparkSession
    kept = settle(rows, "pieces")
    counts = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_windows(counts, capacity)
    before, seen = {}, 0
    for s in sorted(counts):
        before[s] = seen
        seen += counts[s]
    table = spark.createDataFrame([(s, before[s] + r, before[s] + r + n, w, o) for s, r, n, w, o in plan.segments], "length bigint, _lo bigint, _hi bigint, _w bigint, _o bigint")
    ranked = numbered(kept, ["length", *order], "_rank")
    found = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))).drop(table["length"])
    return found.select(*rows.columns, (F.col("_w") + F.col("_rank") - F.col("_lo")).alias("sequence_id"), F.col("_o").alias("offset"))


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every row with its window and its place there. See ``pieces`` and ``place``."""
    return place(pieces(df, id_col, text_col, path, capacity, end_id), [id_col, "piece"], capacity)
