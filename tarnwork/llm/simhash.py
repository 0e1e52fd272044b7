"""Near-duplicate documents by SimHash fingerprints.

Method: anchor-point covering. Two stretches of 23 bits of the fingerprint are read as points of the binary Golay code's
space: every point lies within 3 bits of exactly one code word, so the pairs of code words cover all fingerprints. A
fingerprint belongs to the anchor (pair of code words) nearest to it and is copied to every anchor within the covering
radius plus the threshold. If two fingerprints differ in at most ``THRESHOLD`` bits, one's own anchor holds a copy of the
other. Fingerprints are compared within an anchor only, in full, and each anchor gives back the links of a spanning
forest, so dense groups stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import parts, release, settle, ship, small, text_or_empty
from tarnwork.llm.components import components

THRESHOLD = 2
SHINGLE = 3
SEED = 42
RADIUS = 3  # covering radius of the Golay code
GOLAY = 0b101011100011  # generator polynomial, a fixed value of the code
LENGTH, DATA = 23, 12
# Share of the distinct shingles of two texts that similar texts have in common, as a fraction.
SIMILARITY = (4, 5)
# Fingerprints of 64 bits of a text in the search for similar ones; two stretches of 23 bits of each are searched.
PRINTS = 10
# Anchors of a fingerprint are the code words within this many bits of it, its own within RADIUS.
REACH = RADIUS + 1
# One-bit minimum hashes of a text, and in how many of them two texts may differ to be compared by their shingles: a
# similarity of 0.8 gives a tenth, 26 with a deviation of 5.
MIN_BITS, MIN_LIMIT = 256, 54
# The same for the first half of them, by which texts are told that have no others near them: 13 with a deviation of 3.4.
FIRST_BITS, FIRST_LIMIT = 128, 32
# Texts, and shingles of them, that a block of a group holds: a task compares two blocks.
BLOCK_TEXTS, BLOCK_SHINGLES = 2_048, 2_000_000
# Shingles looked up at a time.
LOOKED_UP = 1_000_000
# Groups with more pairs than this are searched by flipping bits instead of pair by pair.
PAIRS = 4_000_000
# Shingles hashed at a time.
STEP = 65_536


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles, repeats included. No words: 0."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    del words
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ends) - width + 1]
    ends = ends[width - 1:]
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(starts), STEP):
        places = zip(starts[lo:lo + STEP].tolist(), ends[lo:lo + STEP].tolist(), strict=True)
        h = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in places), np.uint64, min(STEP, len(starts) - lo))
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(starts)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


@cache
def codewords() -> np.ndarray:
    """All 4096 code words: the multiples of the generator polynomial."""
    words = np.zeros(1, np.uint32)
    for k in range(DATA):
        words = np.concatenate([words, words ^ np.uint32(GOLAY << k)])
    return words


@cache
def leaders() -> np.ndarray:
    """Remainder by the generator polynomial -> the error of at most 3 bits that leaves it."""
    table = np.zeros(1 << (LENGTH - DATA), np.uint32)
    errors = [0] + [1 << i for i in range(LENGTH)]
    errors += [a | b for i, a in enumerate(errors[1:]) for b in errors[i + 2:]]
    errors += [e | 1 << i for e in errors[LENGTH + 1:] for i in range(e.bit_length(), LENGTH)]
    errors = np.array(errors, np.uint32)
    table[remainder(errors)] = errors
    return table


def remainder(points: np.ndarray) -> np.ndarray:
    r = points.astype(np.uint32).copy()
    for k in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        r ^= np.where(r >> np.uint32(k) & np.uint32(1), np.uint32(GOLAY << (k - (LENGTH - DATA))), np.uint32(0))
    return r


@cache
def near_errors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every remainder, the patterns that lead to a code word within RADIUS + THRESHOLD: flat, with where they
    start, and their weights. A point and its remainder have the same patterns."""
    words = codewords()
    flat, start = [], [0]
    for lead in leaders():
        e = words ^ lead
        e = e[np.bitwise_count(e) <= RADIUS + THRESHOLD]
        flat.append(e)
        start.append(start[-1] + len(e))
    flat = np.concatenate(flat)
    return flat, np.array(start), np.maximum(np.bitwise_count(flat).astype(np.int64) - RADIUS, 0)


def anchors(prints: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, whether it is its own anchor) for all anchors in reach."""
    if threshold > THRESHOLD:
        raise ValueError(f"at most {THRESHOLD} bits")
    mask = np.uint64((1 << LENGTH) - 1)
    halves = [(prints & mask).astype(np.uint32), (prints >> np.uint64(LENGTH) & mask).astype(np.uint32)]
    flat, start, over = near_errors()
    rem = [remainder(h) for h in halves]
    sizes = [start[r + 1] - start[r] for r in rem]
    n = sizes[0] * sizes[1]
    who = np.repeat(np.arange(len(prints)), n)
    k = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    a = start[rem[0]][who] + k // sizes[1][who]
    b = start[rem[1]][who] + k % sizes[1][who]
    keep = over[a] + over[b] <= threshold
    who, a, b = who[keep], a[keep], b[keep]
    anchor = (halves[1][who] ^ flat[b]).astype(np.int64) << LENGTH | (halves[0][who] ^ flat[a]).astype(np.int64)
    own = (np.bitwise_count(flat[a]) <= RADIUS) & (np.bitwise_count(flat[b]) <= RADIUS)
    return who, anchor, own


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class Trees:
    """Trees over positions that start with the given labels (below their number) and are joined by many pairs at once."""

    def __init__(self, label: np.ndarray):
        self.label = label

    def join(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs ``i, j`` joined two trees: at most one less than there are trees, and all pairs end in one."""
        at, taken = np.arange(len(i)), [np.zeros(0, np.int64)]
        while True:
            a, b = self.label[i[at]], self.label[j[at]]
            apart = a != b
            at, a, b = at[apart], a[apart], b[apart]
            if not len(at):
                return np.concatenate(taken)
            high, first = np.unique(np.maximum(a, b), return_index=True)
            taken.append(at[first])
            up = np.arange(len(self.label))
            up[high] = np.minimum(a, b)[first]
            while not np.array_equal(up, further := up[up]):
                up = further
            self.label = up[self.label]


def group_links(prints: np.ndarray, own: np.ndarray, threshold: int = THRESHOLD, most: int = PAIRS) -> Iterator[tuple[int, int]]:
    """Pairs of positions that link the group as all its pairs within ``threshold`` would, own against all."""
    forest, mine = Forest(len(prints)), np.flatnonzero(own)
    if len(mine) * len(prints) <= most:
        step = max(1, 1_000_000 // max(1, len(prints)))
        for lo in range(0, len(mine), step):
            block = mine[lo:lo + step]
            for i, j in zip(*np.nonzero(np.bitwise_count(prints[block, None] ^ prints[None, :]) <= threshold), strict=True):
                if forest.join(block[i], j):
                    yield block[i], j
        return
    order = np.argsort(prints)
    ranked = prints[order]
    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64) for j in range(i)]
    for f in flips:
        if f.bit_count() > threshold:
            continue
        want = prints[mine] ^ np.uint64(f)
        at = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
        for i in np.flatnonzero(ranked[at] == want):
            if forest.join(mine[i], order[at[i]]):
                yield mine[i], order[at[i]]


def fingerprints(df: DataFrame, keep: list[str], text_col: str = "text", width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``keep`` and ``fp`` (a signed 64-bit number). Null text is empty."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            fps = np.fromiter((fingerprint(t, width, seed) for t in batch.column(batch.num_columns - 1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, text_or_empty(text_col).alias("_text_in")).mapInArrow(run, f"{schema}, fp bigint")


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``): within each anchor a spanning forest of the pairs
    that differ in at most ``threshold`` bits. All components are those of all such pairs."""
    spark = prints.sparkSession
    ship(spark)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            release()
            for lo in range(0, len(every), 2000):
                fps = every[lo:lo + 2000]
                who, anchor, own = anchors(fps, threshold)
                yield pa.RecordBatch.from_pydict({"anchor": anchor, "fp": fps[who].view(np.int64), "own": own})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not got:
            return
        anchor, fp, own = (np.concatenate(c) for c in zip(*got, strict=True))
        order = np.argsort(anchor, kind="stable")
        anchor, fp, own = anchor[order], fp[order].view(np.uint64), own[order]
        starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        stops = np.append(starts[1:], len(anchor))
        some = np.logical_or.reduceat(own, starts) & (stops - starts > 1)
        a, b = [], []
        for lo, hi in zip(starts[some], stops[some], strict=True):
            for i, j in group_links(fp[lo:hi], own[lo:hi], threshold):
                a.append(fp[lo + i])
                b.append(fp[lo + j])
        if a:
            pair = np.array([a, b], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pair[0], "b": pair[1]})

    spread = prints.select("fp").mapInArrow(copy, "anchor bigint, fp bigint, own boolean")
    return spread.repartition(parts(spark), "anchor").mapInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``id_col, fingerprint, component_id, n_same`` of every row; ``component_id`` is the smallest id that can be reached
    over links, ``n_same`` the number of rows with the same fingerprint.

    Null and wordless texts have fingerprint zero, linked like any other. Rows with a null id take part; a component in
    which no row has an id has none. Repeated rows come back as often as they came.
    """
    prints = settle(fingerprints(df, [id_col], text_col, width), "prints")
    by_print = prints.groupBy("fp").agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("n_same"))
    edges = settle(links(by_print, threshold), "links")
    member = components(edges)
    known = by_print.join(member, by_print["fp"] == member["node"], "left").withColumn("_root", F.coalesce("root", "fp")).select("fp", "_root", "_first", "n_same")
    known = settle(known, "members")
    first = known.groupBy("_root").agg(F.min("_first").alias("component_id"))
    classes = known.join(first, "_root").select("fp", "n_same", "component_id")
    return prints.join(classes, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same")


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """Hashes of the distinct shingles of ``width`` words, in order; a shorter text is one shingle, no words are none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    del words
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ends) - width + 1]
    ends = ends[width - 1:]
    made = []
    for lo in range(0, len(starts), STEP):
        places = zip(starts[lo:lo + STEP].tolist(), ends[lo:lo + STEP].tolist(), strict=True)
        made.append(np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in places), np.uint64, min(STEP, len(starts) - lo)))
    return np.unique(np.concatenate(made))


def sketch(hashes: np.ndarray, prints: int = PRINTS) -> np.ndarray:
    """``prints`` fingerprints of a set of shingles: a bit is 1 if it is set in over half of the shingles' hashes, which
    are mixed anew for every fingerprint."""
    votes = np.zeros(64 * prints, np.int64)
    add = (np.arange(1, prints + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    for lo in range(0, len(hashes), 255):  # as many as a byte can count
        x = hashes[lo:lo + 255, None] + add
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        votes += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits((2 * votes > len(hashes)).astype(np.uint8)).view(np.uint64)


def set_name(hashes: np.ndarray) -> int:
    """One signed 64-bit name of a set of shingles."""
    from xxhash import xxh64_intdigest

    n = xxh64_intdigest(hashes.tobytes(), SEED)
    return n - (1 << 64) if n >> 63 else n


def minhash_bits(hashes: np.ndarray, bits: int = MIN_BITS) -> np.ndarray:
    """One bit of the smallest value of the set under each of ``bits`` hashes: two sets differ in a bit with half the
    probability of their Jaccard distance, whatever their sizes."""
    rng = np.random.default_rng(SEED)
    a, b = (rng.integers(0, 1 << 32, bits, np.uint32) for _ in range(2))
    a |= np.uint32(1)
    low = np.full(bits, 0xFFFFFFFF, np.uint32)
    short = (hashes ^ hashes >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), 256):
        np.minimum(low, (short[lo:lo + 256, None] * a + b).min(axis=0), out=low)
    low = (low ^ low >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    return np.packbits((low >> np.uint32(31)).astype(np.uint8)).view(np.uint64)


def dealt_to_anchors(prints: DataFrame, stretches: int, bits: int, names: list[str]) -> DataFrame:
    """``anchor``, the numbers ``names``, ``own`` and the numbers ``w0``…: each node with its first ``bits`` minimum bits at
    every anchor within ``REACH`` bits of its fingerprints' stretches; ``own`` where it lies within the radius."""
    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, start, _ = near_errors()
        # The patterns of a remainder within REACH, as positions in ``flat``.
        near = np.flatnonzero(np.bitwise_count(flat) <= REACH)
        start, flat = np.searchsorted(near, start), flat[near]
        mask = np.uint64((1 << LENGTH) - 1)
        for batch in batches:
            release()
            *named, fps, payload = batch.columns
            named = {name: c.to_numpy() for name, c in zip(names, named, strict=True)}
            fps, payload = (np.array([np.frombuffer(x, np.uint64) for x in c.to_pylist()], np.uint64).reshape(batch.num_rows, -1) for c in (fps, payload))
            for k in range(stretches):
                points = (fps[:, k // 2] >> np.uint64(LENGTH * (k % 2)) & mask).astype(np.uint32)
                rem = remainder(points)
                n = start[rem + 1] - start[rem]
                who = np.repeat(np.arange(len(points)), n)
                e = flat[start[rem][who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)]
                anchor = (points[who] ^ e).astype(np.int64) * stretches + k
                yield pa.RecordBatch.from_pydict(
                    {"anchor": anchor} | {name: c[who] for name, c in named.items()} | {"own": np.bitwise_count(e) <= RADIUS}
                    | {f"w{i}": payload[who, i].view(np.int64) for i in range(payload.shape[1])})

    kind = ", ".join(["anchor bigint", *(f"{name} bigint" for name in names), "own boolean", *(f"w{i} bigint" for i in range(bits // 64))])
    whole = prints.select(*names, "fps", F.substring("mins", 1, bits // 8).alias("_w"))
    return whole.mapInArrow(copy, kind).repartition(parts(prints.sparkSession), "anchor").sortWithinPartitions("anchor")


def by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of one anchor after the other, from rows sorted by anchor."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cuts = np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1
        if held and held[-1][0][-1] != cols[0][0]:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held = []
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(cols[0])), strict=True):
            part = [c[lo:hi] for c in cols]
            if held and lo:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def near_in(words: list[np.ndarray], own: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``i`` (own) and ``j`` of one anchor whose words differ in at most ``limit`` bits, in blocks."""
    mine = np.flatnonzero(own)
    w = [x.view(np.uint64) for x in words]
    step = max(1, 500_000 // len(own))
    for m in range(0, len(mine), step):
        block = mine[m:m + step]
        far = np.zeros((len(block), len(own)), np.uint16)
        for x in w:
            far += np.bitwise_count(x[block, None] ^ x[None, :])
        i, j = np.nonzero(far <= limit)
        yield block[i], j


def two_columns(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": a, "b": b})


def neighbours(prints: DataFrame, stretches: int, bits: int, limit: int) -> DataFrame:
    """``a, b``: for every node that has others within ``limit`` of the first ``bits`` minimum bits at some anchor, the one
    with the smallest hash there, and no more: nodes of a dense group nearly all see the same one, so the rows are a few stars and not pairs."""
    ship(prints.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for _, node, own, *words in by_anchor(batches):
            if len(node) < 2:
                continue
            rank = np.argsort(np.argsort((node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable"))
            best = np.full(len(node), len(node))
            for i, j in near_in(words, own, limit):
                other = node[i] != node[j]
                i, j = i[other], j[other]
                np.minimum.at(best, i, rank[j])
                np.minimum.at(best, j, rank[i])
            has = np.flatnonzero(best < len(node))
            if len(has):
                by_rank = np.empty(len(node), np.int64)
                by_rank[rank] = node
                yield two_columns(node[has], by_rank[best[has]])

    mapped = dealt_to_anchors(prints, stretches, bits, ["node"]).mapInArrow(compare, "a bigint, b bigint")
    # Of the stars of several anchors a node keeps the one with the smallest hash.
    return mapped.groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("b"))


def meetings(prints: DataFrame, stretches: int, limit: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes that connect all nodes of different ``root`` that may be similar: whose minimum bits differ
    in at most ``limit`` places, and of which the one is within ``REACH`` bits of the other's code word on one of the
    stretches. An anchor gives back a spanning forest of its pairs, so never more of them than it holds nodes."""
    ship(prints.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for _, node, root, own, *words in by_anchor(batches):
            if len(node) < 2:
                continue
            trees = Trees(np.arange(len(node)))
            for i, j in near_in(words, own, limit):
                apart = root[i] != root[j]
                i, j = i[apart], j[apart]
                if len(joined := trees.join(i, j)):
                    yield two_columns(node[i[joined]], node[j[joined]])

    return dealt_to_anchors(prints, stretches, MIN_BITS, ["node", "root"]).mapInArrow(compare, "a bigint, b bigint").distinct()


def block_links(root: np.ndarray, mins: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Pairs of places ``(i, j)`` that connect the texts ``left`` with the texts ``right`` as all their similar pairs of
    different ``root`` would. Of the pairs whose minimum bits differ in at most ``limit`` places, those that are not yet
    connected are compared by their shingles."""
    few, whole = SIMILARITY
    trees = Trees(np.unique(root, return_inverse=True)[1])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    # Shingles are numbered within the blocks.
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marked = np.zeros(flat.max(initial=0) + 1, bool)
    mine = np.zeros(len(sets), bool)
    mine[left] = True
    for some, others in near_in([np.ascontiguousarray(w) for w in mins.T], mine, limit):
        # The larger set has no more than this share of its shingles in common with the smaller one.
        fit = np.minimum(sizes[some], sizes[others]) * whole >= np.maximum(sizes[some], sizes[others]) * few
        fit &= right[others] & (trees.label[some] != trees.label[others]) & (~(mine[others] & right[some]) | (some < others))
        some, others = some[fit], others[fit]
        firsts = np.flatnonzero(np.append(True, some[1:] != some[:-1])) if len(some) else []
        for i, candidates in zip(some[firsts], np.split(others, firsts[1:]), strict=True) if len(some) else ():
            own = flat[starts[i]:starts[i] + sizes[i]]
            marked[own] = True
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes[candidates]) // LOOKED_UP)) + 1
            for js in np.split(candidates, cuts):
                js = js[trees.label[js] != trees.label[i]]
                if not len(js):
                    continue
                ends = np.cumsum(sizes[js])
                at = np.arange(ends[-1]) + np.repeat(starts[js] - ends + sizes[js], sizes[js])
                both = np.add.reduceat(marked[flat[at]], ends - sizes[js], dtype=np.int64)
                js = js[both * whole >= (sizes[i] + sizes[js] - both) * few]
                for k in trees.join(np.full(len(js), i), js):
                    yield i, js[k]
            marked[own] = False


def group_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The distinct rows of one pair of blocks after the other, from rows sorted by group, blocks and node."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:3] != row[:3]:
                yield held
                held = []
            if not held or held[-1][3] != row[3]:
                held.append(row)
    if held:
        yield held


def links_in_groups(members: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int, limit: int) -> DataFrame:
    """Links ``(a, b)`` between the ``members`` (``node, root, mins, n, _first, group``) of each group that connect it as all
    similar pairs of its texts would; only pairs of different ``root`` are compared.

    Texts are read again for the members only, and the set of each goes to the tasks that compare its block with the others
    of its group. A group of up to ``BLOCK_TEXTS`` is one block, so its sets move once; a larger one of k blocks moves them
    k times, and no task holds more than two blocks.
    """
    spark = df.sparkSession
    ship(spark)
    kept = ["node", "root", "group", "mins", "blocks", "block"]
    kinds = "node bigint, root bigint, group bigint, mins binary, blocks int, block int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            sets = [shingle_hashes(t, width) for t in batch.column(len(kept)).to_pylist()]
            # Another text may have the same id.
            same = pa.array([set_name(h) == n for h, n in zip(sets, batch.column(0).to_pylist(), strict=True)], pa.bool_())
            whole = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([h.tobytes() for h in sets], pa.binary())], names=[*kept, "set"])
            yield whole.filter(same)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for rows in group_blocks(batches):
            _, low, high, node, root, block, mins, sets = (list(c) for c in zip(*rows, strict=True))
            block, root, node = (np.array(c, np.int64) for c in (block, root, node))
            mins = np.array([np.frombuffer(x, np.uint64) for x in mins], np.uint64)
            sets = [np.frombuffer(x, np.uint64) for x in sets]
            found = np.array(list(block_links(root, mins, sets, block == low[0], block == high[0], limit)), np.int64).reshape(-1, 2)
            if len(found):
                yield two_columns(node[found[:, 0]], node[found[:, 1]])

    size = members.groupBy("group").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("blocks"))
    wanted = members.join(size, "group").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    wanted = settle(wanted.select(*kept, F.col("_first").alias("_id")), "wanted")
    texts = df.select(F.col(f"`{id_col}`").alias("_key"), text_or_empty(f"`{text_col}`").alias("_t")).join(small(wanted), F.col("_key") == F.col("_id")).select(*kept, "_t")
    dealt = texts.mapInArrow(run, f"{kinds}, set binary").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("group", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "node", "root", "block", "mins", "set")
    key = ["group", "low", "high"]
    return dealt.repartition(parts(spark), *key).sortWithinPartitions(*key, "node").mapInArrow(compare, "a bigint, b bigint")


def similar_links(pairs: DataFrame, classes: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The ``pairs`` whose sets of distinct shingles are similar. Texts are read again for the nodes of the pairs only,
    one row with the class's ``_first`` id each."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            sets = [shingle_hashes(t, width) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(map(set_name, sets), pa.int64()), pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))], names=["node", "set"])

    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ids = settle(classes.join(nodes, "node").select(F.col("_first").alias("_id")).distinct(), "wanted")
    texts = df.join(small(ids), df[id_col] == ids["_id"], "left_semi").select(text_or_empty(text_col).alias("_t"))
    sets = settle(texts.mapInArrow(run, "node bigint, set array<bigint>").dropDuplicates(["node"]), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("_sa"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("_sb"))
    both = F.size(F.array_intersect("_sa", "_sb"))
    few, whole = SIMILARITY
    return pairs.join(one, "a").join(other, "b").filter(both * whole >= (F.size("_sa") + F.size("_sb") - both) * few).select("a", "b")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """The rows of ``df`` but for near copies: of each group of similar texts those with the smallest id stay.

    Two texts are similar if their sets of distinct ``width``-word shingles share at least ``SIMILARITY`` of their union,
    and groups are connected by similar pairs; a pair links only if its sets say so. Which pairs to compare is found by
    fingerprints (see the README for the recall), in two steps. First every text that has others near it is compared with
    one of them, the same for nearly all of a dense group, which so becomes a star. Then the texts that have others near
    them, and only these, are searched for those that the stars have left apart; these meet in groups, and within a group
    all pairs that may be similar are compared where its sets lie, so that texts and links move but no pairs.

    Null and wordless texts are alike. Rows with a null id are never dropped and drop none; of rows with the same id, all
    or none stay.
    """
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            names, fps, mins, sizes = [], [], [], []
            for t in batch.column(1).to_pylist():
                h = shingle_hashes(t, width)
                names.append(set_name(h))
                fps.append(sketch(h).tobytes())
                mins.append(minhash_bits(h).tobytes())
                sizes.append(len(h))
            made = [pa.array(names, pa.int64()), pa.array(fps, pa.binary()), pa.array(mins, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["id", "node", "fps", "mins", "n"])

    def rooted(of: DataFrame, edges: DataFrame) -> DataFrame:
        return settle(of.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node")), "members")

    rows = df.filter(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))
    prints = settle(rows.mapInArrow(run, f"id {kind}, node bigint, fps binary, mins binary, n bigint"), "prints")
    classes = settle(prints.groupBy("node").agg(F.min("id").alias("_first"), F.first("fps").alias("fps"), F.first("mins").alias("mins"), F.first("n").alias("n")), "classes")

    stars = settle(neighbours(classes, 2 * PRINTS, FIRST_BITS, FIRST_LIMIT), "stars")
    rays = settle(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rays")
    close = settle(similar_links(rays, classes, df, id_col, text_col, width), "links")
    near = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    searched = rooted(classes.join(near, "node"), close)
    group = components(meetings(searched, 2 * PRINTS, MIN_LIMIT)).withColumnRenamed("root", "group")
    members = settle(searched.drop("fps").join(group, "node"), "met")
    links = close.unionByName(settle(links_in_groups(members, df, id_col, text_col, width, MIN_LIMIT), "links"))
    known = rooted(searched.drop("root"), links).select("node", "root", "_first")
    first = known.groupBy("root").agg(F.min("_first").alias("_low"))
    low = known.select("node", "root").join(first, "root").select("node", "_low")
    # Texts without others near them are dropped only where a copy has a smaller id.
    alone = classes.join(near, "node", "left_anti").select("node", F.col("_first").alias("_low"))
    gone = prints.join(low.unionByName(alone), "node").filter(F.col("id") != F.col("_low")).select(F.col("id").alias("_gone")).distinct()
    gone = settle(gone, "gone")
    return df.join(small(gone), df[id_col] == gone["_gone"], "left_anti")
