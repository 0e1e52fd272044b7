"""Exact top-k search by inner product over a paged M-tree.

Vectors are dealt to routing objects (the nearest of a bounded sample), then to pages. A page holds its centre, its
covering radius, the distance of its centre to its routing object and the vectors. A query looks at pages best first: the
distance to the centre is bounded from the stored parent distance by the triangle inequality, and computed only if that
bound leaves the page in question; the vectors are compared only if the covering radius does. The search stops at the
first page whose best possible score cannot change the k results, so results are exact.

Distances bound the inner product through ``2 q.x = |q|^2 + |x|^2 - d(q, x)^2``. Queries go to the tasks in blocks of a
fixed size, and every block passes over all pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwork.llm.common import parts, settle, ship

SCALE = 256
# Routing objects are chosen from so many sampled vectors; a page takes so many vectors; queries go out so many at once.
SAMPLE, ROUTES = 4096, 64
PAGE, BUCKET = 128, 2048
BLOCK = 4096
DIMENSIONS = 1000  # so many dimensions, the most frequent ones, get routing objects of their own
SLACK = 1e-6  # share of a length by which rounding may shift a bound
EXACT = 2.0**53  # scores below it are whole numbers in a double


def codes(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their components as ``floor(scale * x)``). Null vectors, empty ones and those that hold null
    or non-finite components take none."""
    usable, out = [], []
    for i, v in enumerate(vectors.to_pylist()):
        if not v or any(x is None for x in v):
            continue
        x = np.asarray(v, np.float64)
        if np.isfinite(x).all():
            usable.append(i)
            out.append(np.floor(scale * x))
    return np.array(usable, np.int64), out


def coded(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``id, dim, code``: the usable vectors as packed doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = codes(batch.column(1), scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([len(v) for v in vectors], pa.int32()), pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary())], names=["id", "dim", "code"])

    return df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("_v")).mapInArrow(run, "id bigint, dim int, code binary")


def routing_objects(sample: np.ndarray, count: int = ROUTES) -> np.ndarray:
    """Farthest-first choice: each next one is the sampled vector farthest from those chosen."""
    if not len(sample):
        return sample
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        nxt = int(far.argmax())
        if far[nxt] == 0:
            break
        chosen.append(nxt)
    return sample[chosen]


def split(vectors: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Positions cut into pages: halves by the nearer of two far-apart vectors, in equal parts where all are alike."""
    todo = [np.arange(len(vectors))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            yield at
            continue
        x = vectors[at]
        a = x[((x - x[0]) ** 2).sum(axis=1).argmax()]
        b = x[((x - a) ** 2).sum(axis=1).argmax()]
        left = ((x - a) ** 2).sum(axis=1) < ((x - b) ** 2).sum(axis=1)
        n = int(left.sum())
        if min(n, len(at) - n) < max(1, len(at) // 20):
            left = np.arange(len(at)) < len(at) // 2
        todo += [at[left], at[~left]]


def roots_of(roots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return roots[dim] if dim in roots else np.zeros((1, dim))


def build(vectors: DataFrame, sample_size: int = SAMPLE, routes: int = ROUTES, page: int = PAGE) -> DataFrame:
    """Index over ``id, dim, code``, written to the shared folder: one row per page. Routing objects come from the
    ``sample_size`` vectors with the smallest hashes of their ids; every vector is indexed. Vectors of different
    dimensions get trees of their own; those of dimensions beyond the ``DIMENSIONS`` most frequent ones hang under the
    origin. Repeated vectors and ties share pages as they come."""
    spark = vectors.sparkSession
    often = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").limit(DIMENSIONS)
    roots = {}
    for d in [r["dim"] for r in often.collect()]:
        picked = vectors.filter(F.col("dim") == d).orderBy(F.xxhash64("id"), "code").select("code").limit(sample_size).collect()
        roots[d] = routing_objects(np.array([np.frombuffer(r["code"], "<f8") for r in picked]), routes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, np.int32)
            dim = batch.column(1).to_numpy()
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                x = np.array([np.frombuffer(batch.column(2)[int(i)].as_py(), "<f8") for i in at])
                r = roots_of(roots, int(d))
                near[at] = ((r ** 2).sum(axis=1) - 2 * x @ r.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=["id", "dim", "code", "route"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for i, d, c, r, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault((d, r, s), []).append((i, c))
        for (d, r, _), rows in held.items():
            ids = np.array([i for i, _ in rows], np.int64)
            x = np.frombuffer(b"".join(c for _, c in rows), "<f8").reshape(len(ids), d)
            parent = roots_of(roots, d)[r]
            out = []
            for at in split(x, page):
                at = at[np.argsort(ids[at], kind="stable")]
                centre = x[at].mean(axis=0)
                out.append((d, r, float(np.linalg.norm(centre - parent)), float(np.sqrt(((x[at] - centre) ** 2).sum(axis=1).max())), float((x[at] ** 2).sum(axis=1).max()), centre.tobytes(), ids[at].tobytes(), x[at].tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["dim", "route", "to_parent", "radius", "largest", "centre", "ids", "vectors"])

    routed = settle(vectors.mapInArrow(route, "id bigint, dim int, code binary, route int"), "routed")
    # A routing object of many vectors is dealt over as many tasks as it fills: its pages need not be made together.
    size = routed.groupBy("dim", "route").agg(F.count(F.lit(1)).alias("_n"))
    dealt = routed.join(F.broadcast(size), ["dim", "route"]).select("id", "dim", "code", "route", F.expr(f"cast(pmod(xxhash64(id), ceil(_n / {BUCKET})) as int)").alias("salt"))
    made = dealt.repartition(parts(spark), "dim", "route", "salt").mapInArrow(pages, "dim int, route int, to_parent double, radius double, largest double, centre binary, ids binary, vectors binary")
    return settle(made, "pages"), roots


def search_pages(pages: list[dict], roots: np.ndarray, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
    """Improve ``ids, scores``, the k best found so far for each query, by some pages; unused places have id -1 and score
    minus infinity. Ties go to smaller ids."""
    nq, k = ids.shape
    size = (q ** 2).sum(axis=1)
    route = np.array([p["route"] for p in pages])
    to_parent, radius, largest = (np.array([p[c] for p in pages]) for c in ("to_parent", "radius", "largest"))
    lowest = np.array([p["ids"][0] for p in pages])
    longest = float(max(size.max(), largest.max(), (roots ** 2).sum(axis=1).max()))
    if float(np.sqrt(size.max() * largest.max())) >= EXACT:
        raise ValueError("scores of 2^53 and more cannot be told exactly; use a smaller scale")
    shift = SLACK * (1 + np.sqrt(longest))  # of distances, whose squares lose digits where they are small
    loose = SLACK + 1e-11 * longest  # of scores
    to_root = np.sqrt(np.maximum(size[:, None] + (roots ** 2).sum(axis=1) - 2 * q @ roots.T, 0))

    def most(distance):  # the best score a vector at this distance or farther can have
        return (size[:, None] + largest - np.maximum(distance - shift, 0) ** 2) / 2 + loose

    # From stored distances alone: no centre is touched.
    bound = most(np.maximum(np.abs(to_root[:, route] - to_parent) - radius, 0))
    bound = np.minimum(bound, np.sqrt(size)[:, None] * np.sqrt(largest) + loose)
    measured = np.zeros(bound.shape, bool)
    centres = np.array([p["centre"] for p in pages])
    active = np.arange(nq)
    while len(active):
        nxt = bound[active].argmax(axis=1)
        best = bound[active, nxt]
        worst, worst_id = scores[active, -1], ids[active, -1]
        go = (best >= worst) & np.isfinite(best) & ~((np.floor(best) == worst) & (worst_id >= 0) & (lowest[nxt] > worst_id) & (best < worst + 1))
        # A page that only ties with larger ids is passed over; the query may still have others.
        tie = (best >= worst) & np.isfinite(best) & ~go
        bound[active[tie], nxt[tie]] = -np.inf
        stay = go | tie
        active, nxt, go = active[stay], nxt[stay], go[stay]
        at, page = active[go], nxt[go]
        for p in np.unique(page):
            mine = at[page == p]
            new = mine[~measured[mine, p]]
            if len(new):  # one distance to the centre tightens the bound; the page then waits for its turn
                d = np.sqrt(np.maximum(((q[new] - centres[p]) ** 2).sum(axis=1), 0))
                closest = np.maximum(d - radius[p] - shift, 0)
                tight = np.minimum((size[new] + largest[p] - closest ** 2) / 2, q[new] @ centres[p] + np.sqrt(size[new]) * radius[p]) + 1e-3 + loose
                bound[new, p] = np.minimum(bound[new, p], tight)
                measured[new, p] = True
            old = np.setdiff1d(mine, new, assume_unique=True)
            if len(old):
                s = np.rint(q[old] @ pages[p]["x"].T)
                who = np.broadcast_to(pages[p]["ids"], s.shape)
                s = np.where(who == q_ids[old, None], -np.inf, s)
                both = np.concatenate([scores[old], s], axis=1)
                names = np.concatenate([ids[old], who], axis=1)
                names = np.where(np.isneginf(both), np.iinfo(np.int64).max, names)
                order = np.lexsort((names, -both), axis=1)[:, :k]
                scores[old] = np.take_along_axis(both, order, axis=1)
                found = np.take_along_axis(names, order, axis=1)
                ids[old] = np.where(np.isneginf(scores[old]), -1, found)
                bound[old, p] = -np.inf


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` best other rows by inner product of the codes.

    Queries are the rows whose id is divisible by ``every``. Rows with a null id take no part, nor do unusable vectors
    (see ``codes``). A row never finds a row with its own id. Vectors of another dimension are no candidates. Rows that
    repeat an id are different candidates with the same id; a repeated query is answered once per distinct vector.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = settle(coded(df, id_col, vector_col, scale), "codes")
    index, roots = build(vectors)
    queries = settle(vectors.filter(F.col("id") % every == 0).distinct(), "queries")
    total = queries.count()
    pieces = max(1, -(-total // block))
    named = settle(queries.withColumn("_b", F.pmod(F.xxhash64("id", "code"), F.lit(pieces))), "blocks") if pieces > 1 else queries.withColumn("_b", F.lit(0))
    found = None
    for b in range(pieces):
        rows = named.filter(F.col("_b") == b).collect()  # about ``block`` queries, whatever the table's size
        part = search(index, roots, [(r["id"], r["dim"], bytes(r["code"])) for r in rows], k)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id", "_n").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(index: DataFrame, roots: dict[int, np.ndarray], queries: list[tuple[int, int, bytes]], k: int) -> DataFrame:
    """The k best of every task's pages for each of a block of queries; ``_n`` tells queries of one id apart. What a task
    has found bounds its search of later pages, and it gives out k rows a query at most."""
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast((roots, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots, queries = sent.value
        asked: dict[int, list[list]] = {}  # dimension -> parts of the queries, each with the best found so far in this task
        for n, (i, d, c) in enumerate(queries):
            groups = asked.setdefault(d, [])
            if not groups or len(groups[-1]) == 1024:
                groups.append([])
            groups[-1].append((n, i, np.frombuffer(c, "<f8")))
        state = {
            d: [(np.array([n for n, _, _ in g], np.int32), np.array([i for _, i, _ in g], np.int64), np.array([c for _, _, c in g]).reshape(len(g), d),
                 np.full((len(g), k), -1, np.int64), np.full((len(g), k), -np.inf)) for g in groups] for d, groups in asked.items()
        }
        for batch in batches:
            by_dim: dict[int, list[dict]] = {}
            for row in batch.to_pylist():
                d = row["dim"]
                if d in state:
                    ids = np.frombuffer(row["ids"], np.int64)
                    by_dim.setdefault(d, []).append(row | {"ids": ids, "x": np.frombuffer(row["vectors"], "<f8").reshape(len(ids), d), "centre": np.frombuffer(row["centre"], "<f8")})
            for d, pages in by_dim.items():
                for _, q_ids, q, ids, scores in state[d]:
                    search_pages(pages, roots_of(roots, d), q_ids, q, ids, scores)
        for groups in state.values():
            for n, q_ids, _, ids, scores in groups:
                r, c = np.nonzero(np.isfinite(scores))
                if len(r):
                    yield pa.RecordBatch.from_pydict({"query_id": q_ids[r], "_n": n[r], "vec_id": ids[r, c], "score": scores[r, c].astype(np.int64)})

    return index.mapInArrow(run, "query_id bigint, _n int, vec_id bigint, score bigint")
