"""Exact removal of byte strings that already stand in a document with a smaller id.

Method: a logarithmic family of suffix indexes. A batch of documents gets a sorted array of its suffixes. Batches are
merge-scanned with each other: equal prefixes that meet are long matches, of which the larger document's is given out and
the smaller's stays. Arrays of equal size merge, so that a family of about log2(batches) levels is held.

Not all suffixes are needed. Of the ``LENGTH - q + 1`` q-byte strings in a window of ``LENGTH`` bytes the one with the
smallest hash (the leftmost of equals) is the window's anchor; equal windows have equal anchors at the same place. The
array holds one suffix per anchor, ordered by the anchor's string ``g``, then by ``a``: all that is covered by the anchor's
windows. Equal ``a`` decide all these windows at once. Where one ``g`` has several ``a`` (a match that begins or ends
there, or chance) the single windows are compared in a second round by the same family, with the window as key.

A batch is resolved in the task that reads it, so a passage that a third of all documents share leaves each task once.
Families live in tasks; each holds the keys of one bucket. Strings are compared by 88 and 96 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import parts, release, settle, ship

LENGTH = 50
# Text bytes whose suffixes are sorted as one batch, and bytes hashed together.
BATCH, BLOCK = 4_000_000, 250_000
# Rows that go into a family as one array.
LEAF = 200_000
# Distinct ``a`` of one ``g`` in a batch from which its windows are compared without asking the family.
CROWD = 4
SEED = 11
ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

# What a suffix and a window take in a parcel, in bytes: a key of two hashes, the document, and in one number the first window
# (32 bits), further windows (8), a mark (1) and the tag of the document's text (23).
SUFFIX = [("g", 5), ("a", 6), ("doc", 8), ("at", 8)]
WINDOW = [("g", 8), ("a", 4), ("doc", 8), ("at", 8)]
TAGS = 1 << 23
# Text bytes whose keys make a bucket on average. A batch sends one parcel to each bucket, so there are never more parcels
# than rows, and their number depends on the text and not on the number of tasks.
BUCKET = 8_000_000
# Rows that tasks hand over: parcels of keys; or matched bytes, or first windows asked for, ``lo`` to ``hi`` of a document.
KEYS, SPANS, ASKED = 0, 1, 2
KINDS = {"kind": pa.int8(), "bucket": pa.int64(), "blob": pa.binary(), "doc": pa.int64(), "tag": pa.int32(), "lo": pa.int64(), "hi": pa.int64()}
KEPT = ["kind", "doc", "tag", "lo", "hi"]
ROWS = "kind tinyint, bucket bigint, blob binary, doc bigint, tag int, lo bigint, hi bigint"

Columns = dict[str, np.ndarray]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def pack(rows: Columns, layout: list[tuple[str, int]]) -> bytes:
    """Columns of numbers as so many low bytes each, one column after the other."""
    return b"".join(np.ascontiguousarray(rows[c].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes() for c, n in layout)


def unpack(blob: bytes, layout: list[tuple[str, int]]) -> Columns:
    width = sum(n for _, n in layout)
    count, at, out = len(blob) // width, 0, {}
    for c, n in layout:
        wide = np.zeros((count, 8), np.uint8)
        wide[:, :n] = np.frombuffer(blob, np.uint8, count * n, at).reshape(count, n)
        out[c] = wide.view("<i8").reshape(-1)
        at += count * n
    return out


def shipped(rows: Columns, layout: list[tuple[str, int]]) -> Columns:
    """Keys cut to the bytes that are shipped, so that all places compare alike."""
    return rows | {c: rows[c] & ((1 << 8 * n) - 1) for c, n in layout if n < 8}


def take(rows: Columns, which) -> Columns:
    return {k: v[which] for k, v in rows.items()}


def stack(many: list[Columns]) -> Columns:
    return {k: np.concatenate([m[k] for m in many]) for k in many[0]}


def powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``multiplier ** i`` and its inverse modulo 2^64."""
    if multiplier not in _POWERS or len(_POWERS[multiplier][0]) < n:
        n = max(n, BLOCK)
        inverse = pow(multiplier, -1, 1 << 64)
        made = []
        for m in (multiplier, inverse):
            p = np.ones(1, np.uint64)
            while len(p) < n:
                p = np.concatenate([p, p * np.uint64(pow(m, len(p), 1 << 64))])
            made.append(p[:n])
        _POWERS[multiplier] = tuple(made)
    return _POWERS[multiplier]


class Hashes:
    """Hashes of all substrings of some bytes, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray, multiplier: int):
        rng = np.random.default_rng(multiplier & 0xFFFF)
        table = rng.integers(1, MASK, 256, np.uint64)
        up, self.down = powers(multiplier, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:len(data)], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        return mixed((self.sums[length:] - self.sums[:-length]) * self.down[:len(self.sums) - length])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram(length: int) -> int:
    """Bytes of an anchor: shorter ones are fewer, longer ones repeat less by chance."""
    return max(1, min(length, max(22, 2 * length // 5)))


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the distance to its leftmost smallest, by doubling."""
    low, off, done = values, np.zeros(len(values), np.uint8 if width < 256 else np.uint32), 1
    while done < width:
        step = min(done, width - done)
        later = low[step:] < low[:-step]
        off = np.where(later, off[step:] + off.dtype.type(step), off[:-step])
        low = np.minimum(low[:-step], low[step:])
        done += step
    return off


def located(docs: list[int], tags: list[int], who: np.ndarray, lo: np.ndarray, more) -> Columns:
    """Document and place of rows: ``who`` counts documents, ``lo`` bytes from the document's start."""
    at = lo.astype(np.int64) << 32 | np.asarray(more, np.int64) << 24 | np.array(tags, np.int64)[who]
    return {"doc": np.array(docs, np.int64)[who], "at": at}


def first_window(at: np.ndarray) -> np.ndarray:
    return at >> 32


def further(at: np.ndarray) -> np.ndarray:
    return at >> 24 & 255


def is_mark(at: np.ndarray) -> np.ndarray:
    return (at >> 23 & 1).astype(bool)


def nothing(*names: str) -> Columns:
    return {c: np.zeros(0, np.int64) for c in names or ("g", "a", "doc", "at")}


def block_suffixes(texts: list[bytes], docs: list[int], tags: list[int], length: int) -> Columns:
    """Anchors of all windows of some documents."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return nothing()
    h = Hashes(data, ODD)
    q = gram(length)
    g = h.every(q)
    place = first_smallest(g, length - q + 1)
    start = np.cumsum(sizes) - sizes
    long = sizes >= length
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, start[long], 1)
    np.add.at(inside, (start + sizes - length + 1)[long], -1)
    i = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    if not len(i):
        return nothing()
    p = i + place[i]
    new = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (i[1:] != i[:-1] + 1)))
    lo, hi, p = i[new], i[np.append(new[1:], len(i)) - 1], p[new]
    who = np.searchsorted(start, lo, side="right") - 1
    a = h.at(lo, length) * np.uint64(ODD) + h.at(hi, length)
    a = mixed(a + ((p - lo) * 65_537 + (hi - lo)).astype(np.uint64))
    return {"g": g[p].view(np.int64), "a": a.view(np.int64)} | located(docs, tags, who, lo - start[who], hi - lo)


def resolve(rows: Columns) -> tuple[Columns, Columns]:
    """Rows sorted by key and document, parted into those of each key's smallest document and all others."""
    if not len(rows["g"]):
        return rows, rows
    order = np.lexsort((rows["doc"], rows["a"], rows["g"]))
    rows = take(rows, order)
    new = np.append(True, (rows["g"][1:] != rows["g"][:-1]) | (rows["a"][1:] != rows["a"][:-1]))
    at = np.flatnonzero(new)
    first = np.repeat(rows["doc"][at], np.diff(np.append(at, len(new))))
    kept = rows["doc"] == first
    return take(rows, kept), take(rows, ~kept)


class Family:
    """Levels of sorted arrays of doubling size. What ``add`` and ``close`` give out are matches: rows whose key stands
    in a smaller document."""

    def __init__(self):
        self.levels: list[Columns | None] = []

    def add(self, batch: Columns) -> Iterator[Columns]:
        level = 0
        while True:
            while len(self.levels) <= level:
                self.levels.append(None)
            if self.levels[level] is None:
                self.levels[level] = batch
                return
            batch, found = resolve(stack([self.levels[level], batch]))
            self.levels[level] = None
            yield found
            level += 1

    def close(self) -> Iterator[Columns]:
        """Merge all levels into one, ``self.whole``."""
        rest = [x for x in self.levels if x is not None]
        self.levels = []
        whole = rest[0] if rest else None
        for x in rest[1:]:
            whole, found = resolve(stack([whole, x]))
            yield found
        self.whole = whole


def crowded(rows: Columns, least: int) -> np.ndarray:
    """Of rows sorted by key: those whose ``g`` has at least ``least`` distinct ``a``."""
    if not len(rows["g"]):
        return np.zeros(0, bool)
    new_g = np.append(True, rows["g"][1:] != rows["g"][:-1])
    new = new_g | np.append(True, rows["a"][1:] != rows["a"][:-1])
    at = np.flatnonzero(new_g)
    return np.repeat(np.add.reduceat(new.astype(np.int64), at) >= least, np.diff(np.append(at, len(new_g))))


def parcels(rows: Columns, layout: list[tuple[str, int]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows dealt to buckets by their key, packed."""
    if not len(rows["g"]):
        return
    bucket = (mixed(rows["g"].view(np.uint64) ^ np.uint64(0xA5A5)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = take(rows, order), bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    blobs = [pack(take(rows, slice(lo, hi)), layout) for lo, hi in zip(at, np.append(at[1:], len(bucket)), strict=True)]
    yield handed(KEYS, len(at), bucket=pa.array(bucket[at]), blob=pa.array(blobs, pa.binary()))


def handed(kind: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
    filled = {"kind": pa.array(np.full(n, kind, np.int8)), **columns}
    return pa.RecordBatch.from_arrays([filled.get(c, pa.nulls(n, t)) for c, t in KINDS.items()], names=list(KINDS))


def spans_of(kind: int, found: Columns, add: int) -> Iterator[pa.RecordBatch]:
    """The first windows of rows, or with ``add`` bytes for each the bytes they cover, as maximal runs for each text."""
    found = take(found, ~is_mark(found["at"])) if len(found["doc"]) else found
    if not len(found["doc"]):
        return
    tag = found["at"] & (TAGS - 1)
    lo = first_window(found["at"])
    end = lo + further(found["at"]) + add
    order = np.lexsort((lo, tag, found["doc"]))
    doc, tag, lo, end = found["doc"][order], tag[order], lo[order], end[order]
    text = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    # Ends are carried forward within a text: texts are set apart by more than any offset.
    far = np.maximum.accumulate(end + (text << 33)) - (text << 33)
    new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (lo[1:] > far[:-1])))
    doc, last = doc[new], far[np.append(new[1:], len(lo)) - 1]
    spread = doc ^ lo[new] >> 4  # these rows only pass through the next shuffle
    yield handed(kind, len(new), bucket=pa.array(spread), doc=pa.array(doc), tag=pa.array(tag[new].astype(np.int32)), lo=pa.array(lo[new]), hi=pa.array(last))


def batched(source: Iterator[list[list]], make: Callable, size: int) -> Iterator[Columns]:
    """Rows of blocks of documents, gathered to batches of ``size`` bytes of text."""
    held, have = [], 0
    for texts, *rest in source:
        held.append(make(texts, *rest))
        have += sum(map(len, texts))
        if have >= size:
            yield stack(held)
            held, have = [], 0
    if held:
        yield stack(held)


def slices_of(column: pa.ListArray) -> list[np.ndarray]:
    """The numbers of each list. Null is an empty list."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return np.split(column.flatten().to_numpy(), np.cumsum(n)[:-1]) if len(n) else []


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[list[list]]:
    """Texts as bytes, documents, tags and whatever further columns there are, in lists of about ``size`` bytes of text."""
    held, have = None, 0
    for batch in batches:
        for doc, text, *rest in zip(*(slices_of(c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns), strict=True):
            raw = text.encode()
            row = [raw, doc, *rest]
            held = held or [[] for _ in row]
            for column, value in zip(held, row, strict=True):
                column.append(value)
            have += len(raw)
            if have >= size:
                yield held
                held, have = None, 0
    if held:
        yield held


def matches(df: DataFrame, id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """``doc, tag, lo, hi``: the bytes of a text that repeated windows of ``length`` bytes cover, as two lists of the begins
    and ends of runs, which may touch or overlap; at most one row for a text."""
    if not 8 <= length <= 256:
        raise ValueError("length must be 8 to 256")
    spark = df.sparkSession
    ship(spark)
    tasks = parts(spark)
    rows = documents(df, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = size // BUCKET + 1

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for array in batched(blocks(batches), lambda t, d, g: block_suffixes(t, d, g, length), BATCH):
            kept, found = resolve(shipped(array, SUFFIX))
            yield from spans_of(SPANS, found, length)
            many = crowded(kept, CROWD)
            asked, kept = take(kept, many), take(kept, ~many)
            yield from spans_of(ASKED, asked, 1)
            # One row in the name of a crowded g: two different a tell the family that windows are compared.
            new = np.flatnonzero(np.append(True, asked["g"][1:] != asked["g"][:-1])) if len(asked["g"]) else np.zeros(0, np.int64)
            mark = take(asked, new)
            mark["at"] = mark["at"] | TAGS
            yield from parcels(stack([kept, mark, mark | {"a": mark["a"] ^ 1}]), SUFFIX, buckets)
            array = kept = found = asked = mark = None
        release()

    def family(layout: list[tuple[str, int]], ask: bool) -> Callable:
        def ended(index: Family) -> Iterator[pa.RecordBatch]:
            for found in index.close():
                yield from spans_of(SPANS, found, length)
            if ask and index.whole is not None:
                yield from spans_of(ASKED, take(index.whole, crowded(index.whole, 2)), 1)

        def joined(index: Family, held: list[Columns]) -> Iterator[pa.RecordBatch]:
            if held:
                batch, found = resolve(stack(held))
                yield from spans_of(SPANS, found, length)
                for found in index.add(batch):
                    yield from spans_of(SPANS, found, length)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Buckets come one after the other; one family is held at a time."""
            release()
            now, index, held, have = None, Family(), [], 0
            for batch in batches:
                keys = pc.equal(batch.column(0), KEYS)
                if pc.any(pc.invert(keys)).as_py():
                    yield batch.filter(pc.invert(keys))
                    batch = batch.filter(keys)
                for bucket, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if bucket != now or have >= LEAF:
                        yield from joined(index, held)
                        held, have = [], 0
                    if bucket != now:
                        yield from ended(index)
                        now, index = bucket, Family()
                    held.append(unpack(blob, layout))
                    have += len(held[-1]["g"])
            yield from joined(index, held)
            held = []
            yield from ended(index)
            index = None
            release()

        return run

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(tasks, "bucket").sortWithinPartitions("kind", "bucket")

    first = settle(dealt(rows.mapInArrow(first_round, ROWS)).mapInArrow(family(SUFFIX, True), ROWS).select(*KEPT), "suffixes")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys of the windows that were asked for."""
        release()
        for array in batched(blocks(batches), lambda t, d, g, lo, hi: block_windows(t, d, g, lo, hi, length), BATCH):
            kept, found = resolve(shipped(array, WINDOW))
            yield from spans_of(SPANS, found, length)
            yield from parcels(kept, WINDOW, buckets)
            array = kept = found = None
        release()

    lists = [F.collect_list(c).alias(c) for c in ("lo", "hi")]
    asked = settle(first.filter(F.col("kind") == ASKED).groupBy("doc", "tag").agg(*lists), "asked")
    windows = rows.join(asked, ["doc", "tag"]).select("doc", "text", "tag", "lo", "hi")
    second = settle(dealt(windows.mapInArrow(ask, ROWS)).mapInArrow(family(WINDOW, False), ROWS).select(*KEPT), "windows")
    spans = first.filter(F.col("kind") == SPANS).unionByName(second.filter(F.col("kind") == SPANS))
    return spans.groupBy("doc", "tag").agg(*lists)


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that can match: with an id and a text, and a tag that tells texts of one id apart."""
    rows = df.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), text_tag(F.col(text_col)).alias("tag"))


def text_tag(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(TAGS)).cast("int")


def block_windows(texts: list[bytes], docs: list[int], tags: list[int], lo: list[np.ndarray], hi: list[np.ndarray], length: int) -> Columns:
    """Keys of the windows asked for, of some documents; a window asked for twice comes once."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    asked = np.zeros(len(data) + 1, np.int32)
    for b, x, y in zip(begin, lo, hi, strict=True):
        np.add.at(asked, b + x, 1)
        np.add.at(asked, b + y, -1)
    starts = np.flatnonzero(np.cumsum(asked[:-1]))
    who = np.searchsorted(begin, starts, side="right") - 1
    one, two = Hashes(data, ODD), Hashes(data, 0xC2B2AE3D27D4EB4F)
    return {"g": one.at(starts, length).view(np.int64), "a": two.at(starts, length).view(np.int64)} | located(docs, tags, who, starts - begin[who], 0)


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Runs that touch or overlap become one."""
    if not len(lo):
        return []
    order = np.argsort(lo)
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[new].tolist(), hi[np.append(new[1:], len(lo)) - 1].tolist(), strict=True))


def without_repeats(df: DataFrame, id_col: str, text_col: str, change: Callable[[bytes, list[tuple[int, int]]], tuple], schema: str, length: int = LENGTH, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` with what ``change(text, spans removed)`` gives for it (fields of ``schema``).

    A byte goes if a string of ``length`` bytes around it also starts in a row with a smaller id; judged on the input.
    Null texts are empty; rows with a null id neither lose anything nor make others lose it; rows with the same id are
    one document's parts: none is smaller.
    """
    spark = df.sparkSession
    keep = keep or [id_col]
    spans = matches(df, id_col, text_col, length)
    fields = spark.createDataFrame([], schema).schema.fields
    arrow = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}
    kinds = [arrow[f.dataType.simpleString()] for f in fields]
    names = [f"k{i}" for i in range(len(keep))]  # inner names, so that no column can clash
    rows = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"), text_tag(F.col(f"`{text_col}`")).alias("tag"),
    )
    types = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts, found = batch.column(len(names)).to_pylist(), zip(*(slices_of(batch.column(len(names) + k)) for k in (1, 2)), strict=True)
            made = [change(t.encode(), merged(*x)) for t, x in zip(texts, found, strict=True)]
            cols = list(zip(*made, strict=True)) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[*names, *(f"c{i}" for i in range(len(fields)))])
        release()

    # Rows without an id lose nothing and stay out of the join, where they would meet in one task.
    marked = rows.filter("doc IS NOT NULL").join(settle(spans, "spans"), ["doc", "tag"], "left").select(*names, "t", "lo", "hi")
    other = rows.filter("doc IS NULL").select(*names, "t", *[F.lit(None).cast("array<bigint>").alias(c) for c in ("lo", "hi")])
    made = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    out = marked.unionByName(other).mapInArrow(finish, f"{types}, {made}")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], *[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)])


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in spans:
        out.append(text[at:lo])
        at = hi
    return b"".join([*out, text[at:]])


def digest(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, int, str]:
    return len(text), sum(hi - lo for lo, hi in spans), len(spans), hashlib.sha256(cut_out(text, spans)).hexdigest()


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256``. See ``without_repeats``."""
    return without_repeats(df, id_col, text_col, digest, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", length)


def clean_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with repeated strings cut out of its texts; characters cut in two go as a whole, null texts stay null."""
    others = [c for c in df.columns if c != text_col]
    empty, new = "_" * (1 + max(map(len, df.columns))), "_" * (2 + max(map(len, df.columns)))  # longer than any other name
    marked = df.withColumn(empty, F.col(f"`{text_col}`").isNull())
    kept = without_repeats(marked, id_col, text_col, lambda t, s: (cut_out(t, s).decode("utf-8", "ignore"),), f"{new} string", length, [*others, empty])
    return kept.select(*[F.when(~F.col(empty), F.col(new)).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
