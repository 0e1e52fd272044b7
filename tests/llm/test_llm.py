"""The training-data operators against plain versions, and their odd cases."""

import math
import os
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import brute  # noqa: E402
from oracle import compare, connect  # noqa: E402

from tarnwork.llm import common, decontam, gru, htmltext, langid, lm, mtree, packing, sharding, simhash, suffix, tokens  # noqa: E402
from tarnwork.llm.components import components  # noqa: E402
from tarnwork.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "wort und satz über dächer " * 3000
SAME = "one passage that stands in several documents and is longer than fifty bytes for sure. "
ODD = [
    (1, None), (2, ""), (3, "   \t\n "), (4, "a"), (5, "don't  stop<|endoftext|> now\n\n\nok "), (6, LONG), (7, SAME + "alpha beta gamma"), (8, "delta epsilon " + SAME),
    (9, SAME + "alpha beta gamma"), (9, SAME + "alpha beta gamma"), (10, "x" * 300), (11, "x" * 120), (12, "日本語 text with spaces\x1c\x1d and 🙂"), (13, "!!! 123 ..."),
]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((v is None, v) for v in r))


@pytest.fixture(scope="module")
def table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows


@pytest.fixture(params=["table", "odd", "empty"])
def docs(request, spark, table):
    rows = {"table": table, "odd": ODD, "empty": []}[request.param]
    return odd(spark, rows), rows


def test_queries_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_token_counts(docs):
    df, rows = docs
    assert got(tokens.token_counts(df), "doc_id", "n_bytes", "n_tokens", "over_limit") == brute.token_counts(rows)


def test_tokenizer_is_dropped_and_loaded_again():
    before = tokens.Vocabulary.of(None)
    counts = before.count([LONG, SAME])
    common.release()
    after = tokens.Vocabulary.of(None)
    assert after is not before and after.count([LONG, SAME]) == counts


def test_ids_of_runs_encoded_together():
    rng = np.random.default_rng(17)
    bits = ["a", "b c", " ", "  ", "\n", "\n\n", "\t", "\u3000", "\xa0", "don't", "<|endoftext|>", "é", "日本", "🙂", "1234", "...", "!", " '", "x\t", "\x1c"]
    texts = ["".join(rng.choice(bits, int(rng.integers(0, 14))).tolist()) for _ in range(8000)]
    v = tokens.Vocabulary(None)
    codes = [c.ids for c in v.tool.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in v.encode(texts)] == codes and v.count(texts) == [len(c) for c in codes]


def test_whole_tokens_are_single():
    v = tokens.Vocabulary(None)
    some = sorted(v.whole)[::997]
    assert len(v.whole) > 40_000 and all(len(v.tool.encode(t, add_special_tokens=False).ids) == 1 for t in some)


def test_packing(docs):
    df, rows = docs
    out = packing.pack_documents(df)
    assert got(out, "doc_id", "piece", "start", "length", "ids_crc32") == brute.pieces(rows)
    windows = defaultdict(list)
    for r in out.collect():
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    for cap in (10, 100, 1024):
        counts = Counter(rng.integers(1, cap + 1, 5000).tolist())
        plan = packing.plan_windows(counts, cap)
        fill = defaultdict(int)
        for s, _, n, w, _ in plan.segments:
            for k in range(n):
                fill[w + k] += s
        assert max(fill.values()) <= cap and len(fill) == plan.windows
        assert sum(fill.values()) == sum(s * n for s, n in counts.items())
        large = sum(n for s, n in counts.items() if 2 * s > cap)
        # Seen on these instances: at most 1.4 % above the area bound, which itself may be out of reach.
        assert plan.windows <= 1.02 * max(large, math.ceil(sum(fill.values()) / cap)) + 1


def test_dominance_is_optimal_on_small_instances():
    def best(items, cap):
        if not items:
            return 0
        first, rest, low = items[0], items[1:], 99
        for mask in range(1 << len(rest)):
            with_ = [x for k, x in enumerate(rest) if mask >> k & 1]
            if first + sum(with_) <= cap:
                low = min(low, 1 + best([x for k, x in enumerate(rest) if not mask >> k & 1], cap))
        return low

    rng = np.random.default_rng(5)
    for _ in range(25):
        items = sorted(rng.integers(1, 11, 7).tolist(), reverse=True)
        plan = packing.Plan(Counter(items), 10)
        plan.reduce()
        fixed, left = plan.windows, [s for s, n in plan.left.items() for _ in range(n)]
        assert fixed + best(sorted(left, reverse=True), 10) == best(items, 10)


@pytest.mark.parametrize("length", [50, 30])
def test_repeats(docs, length):
    df, rows = docs
    rows = [(d, t if len(t or "") < 5000 else t[:5000]) for d, t in rows]
    out = suffix.remove_repeats(odd(df.sparkSession, rows), length=length)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed(rows, length)


def test_repeats_with_small_batches_and_crowded_anchors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    words = ["ab", "cd", "ef", "gh"]
    line = "a very common line that many documents share in their middle, word for word"
    rows = [(int(i), " ".join(rng.choice(words, 20)) + line + " ".join(rng.choice(words, 25))) for i in rng.permutation(120)] + [(None, line), (None, None)]
    out = suffix.remove_repeats(odd(spark, rows).repartition(5))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed(rows)


def test_family_levels_merge_geometrically():
    family = suffix.Family()
    found = 0
    for k in range(13):
        batch = {c: np.arange(20) for c in ("g", "a", "at")} | {"doc": np.full(20, 13 - k)}
        found += sum(len(f["g"]) for f in family.add(batch))
    assert [x is not None for x in family.levels] == [True, False, True, True]
    found += sum(len(f["g"]) for f in family.close())
    assert found == 12 * 20 and set(family.whole["doc"]) == {1}


def test_rows_handed_over_do_not_grow_with_the_number_of_tasks(spark, monkeypatch):
    """Keys are rows, one for each anchor, and not one parcel for each pair of tasks."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 60))) for i in range(300)]
    rows += [(1000 + i, rows[i][1][:200] + " and more of it") for i in range(40)]
    wrote = []
    monkeypatch.setattr(suffix, "settle", lambda df, label: wrote.append((label, (kept := common.settle(df, label)).count())) or kept)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(got(suffix.remove_repeats(odd(spark, rows).repartition(n)), "doc_id", "n_removed", "kept_sha256"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    few, many = dict(wrote[:len(wrote) // 2]), dict(wrote[len(wrote) // 2:])
    assert results[0] == results[1] == [(r[0], r[2], r[4]) for r in brute.removed(rows)]
    # What is given out is bounded by the anchors in matches, however many tasks there are.
    matched = sum(r[2] for r in brute.removed(rows))
    assert few["suffixes"] <= many["suffixes"] < matched / 4 and few["windows"] <= many["windows"] < matched / 4


def test_texts_of_one_id_are_told_apart(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 2000, 40)) for _ in range(60)]
    rows = [(7, t) for t in texts] + [(3, texts[5]), (5, texts[9][:120]), (9, texts[30]), (None, texts[2])] + [(7, texts[1])] * 3
    assert got(suffix.remove_repeats(odd(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed(rows)


def test_clean_texts_keeps_columns(spark):
    df = odd(spark).withColumns({c: F.lit("x") for c in ("bucket", "_t", "_kept", "_without_text", "k0", "t", "tag", "doc", "spans", "c0", "_", "__")})
    out = suffix.clean_texts(df)
    assert out.columns == df.columns and out.count() == len(ODD)
    assert {r["text"] for r in out.filter("doc_id = 9").collect()} == {""}  # parts of one document: both repeat number 7


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/a>Home</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><article><h1>Head &amp; line</h1><p>First para, with <b>bold</b> text.<p>Second&nbsp;para:
over two lines. <script>var x = "</p>";</script></article><aside>Ad</aside><section class="comments"><p>Nice, very nice, I think so, too.</p></section>
<form><input><p>Log in</p></form><footer>&copy; us</footer>"""


def test_html():
    assert htmltext.main_text(PAGE) == "Head & line\nFirst para, with bold text.\nSecond para: over two lines."
    assert htmltext.main_text(PAGE.replace("article", "div")).startswith("Head & line\nFirst para, with bold text.\nSecond para")
    for empty in (None, "", "<html></html>", "<script>x</script>", "<nav>a</nav>"):
        assert htmltext.main_text(empty) == ""
    for broken in ("<p>a < b and c > d", "<a href='x>text", "<p>" * 3000 + "deep", "</p></div>plain", "<<<>>>&#xZZ;&amp"):
        htmltext.main_text(broken)


def test_html_query(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (1, "u", PAGE, "x")], "page_id bigint, url string, html string, text string")
    rows = got(htmltext.extract_pages(df, ["page_id", "url"]), "page_id", "url", "text", "n_chars")
    assert [(r[0], len(r[2]) == r[3]) for r in rows] == [(1, True), (1, True), (2, True)] and rows[2][2] == ""
    assert QUERIES["op5_html_text"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()


VECTOR = "vec_id bigint, embedding array<float>, label int"


def test_top_k(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(QUERIES["op6_top_k"](spark, SF), "query_id", "rank", "vec_id", "score") == brute.top(rows)


def test_top_k_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(300)] + [(i, [0.5] * 8, 0) for i in range(300, 700)]
    rows += [(1000, None, 0), (1050, [], 0), (1100, [1.0, None] * 4, 0), (1150, [float("nan")] * 8, 0), (1200, [float("inf")] * 8, 0), (None, [0.1] * 8, 0), (1250, [0.1] * 3, 0)]
    df = spark.createDataFrame(rows, VECTOR)
    want = brute.top([(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None) for i, v, _ in rows])
    assert got(mtree.top_k(df), "query_id", "rank", "vec_id", "score") == want
    assert got(mtree.top_k(df, block=3), "query_id", "rank", "vec_id", "score") == want
    assert mtree.top_k(df.filter("vec_id < 0")).count() == 0


VECTORS = "vec_id bigint, embedding array<double>"


@pytest.mark.parametrize("size", [1.0, 1e3, 1e4])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, (rng.normal(0, size, 24) if i % 3 else rng.normal(0, size / 50, 24) + size).tolist()) for i in range(700)]
    assert got(mtree.top_k(spark.createDataFrame(rows, VECTORS)), "query_id", "rank", "vec_id", "score") == brute.top(rows)


def test_top_k_refuses_scores_that_doubles_cannot_tell(spark):
    rows = [(i, [1e6 + i, 1e6]) for i in range(60)]
    with pytest.raises(Exception, match="2\\^53"):
        mtree.top_k(spark.createDataFrame(rows, VECTORS)).collect()


def test_top_k_with_more_dimensions_than_have_routes(spark, monkeypatch):
    monkeypatch.setattr(mtree, "DIMENSIONS", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 2 + i % 7).tolist()) for i in range(900)]
    found = got(mtree.top_k(spark.createDataFrame(rows, VECTORS)), "query_id", "rank", "vec_id", "score")
    want = [r for d in range(2, 9) for r in brute.top([v for v in rows if len(v[1]) == d])]
    assert found == sorted(want)


def test_search_keeps_what_a_task_has_found(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(3000)]
    vectors = mtree.settle(mtree.coded(spark.createDataFrame(rows, VECTORS).repartition(3), "vec_id", "embedding"), "codes")
    index, roots = mtree.build(vectors, page=16)
    asked = [(r["id"], r["dim"], bytes(r["code"])) for r in vectors.filter("id % 50 = 0").collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        out = mtree.search(index.coalesce(2), roots, asked, 5)
        assert out.count() <= 5 * len(asked) * out.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scores(docs):
    df, rows = docs
    if rows is ODD:
        rows = rows[:9] + rows[10:]
        df = odd(df.sparkSession, rows)
    out = lm.score_documents(df)
    a, b = got(out, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"), brute.base_scores(rows)
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert all(math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b, strict=True))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out.collect())


def test_scores_with_joined_counts(spark, table, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", 600)
    out = got(lm.score_documents(odd(spark, table)), "doc_id", "n_known", "base_score")
    want = [(r[0], r[3], r[5]) for r in brute.base_scores(table)]
    assert all(x[:2] == y[:2] and math.isclose(x[2], y[2], rel_tol=1e-9) for x, y in zip(out, want, strict=True))


def test_scores_do_not_depend_on_the_layout(spark, table, monkeypatch):
    """The same model whatever holds the rows; parts are small here, so that there are several."""
    monkeypatch.setattr(lm, "PART", 5_000)
    rows = table + [(d, t) for d, t in table[:3] for _ in range(40)]
    scores = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, shuffled in ((1, 8), (8, 3)):
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffled))
            scores.append(sorted((r["doc_id"], r["score"]) for r in lm.score_documents(odd(spark, rows).repartition(n)).select("doc_id", "score").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [d for d, _ in scores[0]] == [d for d, _ in scores[1]]
    assert max(abs(a - b) / max(1, abs(a)) for (_, a), (_, b) in zip(*scores, strict=True)) < 1e-6


def test_many_copies_of_one_row(spark):
    rows = [(1, "one and the same row")] * 3000 + [(i, f"row number {i}") for i in range(20, 60)]
    out = lm.score_documents(odd(spark, rows))
    got_ = [r["score"] for r in out.filter("doc_id = 1").collect()]
    # Sums of single precision differ in their last digits with what stands beside a text.
    assert out.count() == 3040 and len(got_) == 3000 and max(got_) - min(got_) < 1e-5 * abs(min(got_))


def test_model_beats_the_base_on_held_out(spark):
    r = QUERIES["op7_lm_score"](spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert r["s"] > r["b"]


def plain_score(p, doc, end, outs):
    """Natural log probability of one document, token by token, as the formulas of a gated recurrent unit say."""
    p = {k: v.astype(np.float64) for k, v in p.items()}
    h, read, total, n = np.zeros(gru.STATE), end, 0.0, gru.STATE
    for token in doc.tolist():
        gx, gh = p["emb"][read] @ p["wx"] + p["b"], h @ p["wh"]
        r, z = (1 / (1 + np.exp(-(gx[a:a + n] + gh[a:a + n]))) for a in (0, n))
        new = np.tanh(gx[2 * n:] + r * gh[2 * n:])
        h = (1 - z) * new + z * h
        c, k = outs[0][token], outs[1][token]
        logits = h @ p["wc"] + p["bc"]
        total += logits[c] - np.log(np.exp(logits).sum())
        if k >= 0:
            logits = h @ p["wo"][c] + p["bo"][c]
            total += logits[k] - np.log(np.exp(logits).sum())
        read = token
    return total


def test_scores_and_gradients_in_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    p = {k: v * 5 for k, v in gru.start(10, 5, 2, 3).items()}
    outs = (np.array([0, 0, 0, 1, 1, 1, 2, 3, 4, 4]), np.array([0, 1, 2, 0, 1, 2, -1, -1, -1, -1]))
    docs = [np.append(rng.integers(0, 10, n), 6).astype("<u2") for n in (3, 0, 70, 15, 16, 17, 3, 40)]
    table = p["emb"] @ p["wx"] + p["b"]

    def gradients():
        return gru.window_gradients(p, table, gru.Texts(docs, 6, outs), np.zeros((len(docs), gru.STATE), np.float32), 0)

    whole = gradients()
    monkeypatch.setattr(gru, "BLOCK", 7)
    blocks = gradients()
    assert whole[1] == blocks[1] == sum(min(len(d), gru.WINDOW) for d in docs) and math.isclose(whole[0], blocks[0], rel_tol=1e-5)
    assert all(np.allclose(whole[2][k], blocks[2][k], rtol=1e-4, atol=1e-4) for k in p)
    assert np.allclose(gru.score(p, gru.Texts(docs, 6, outs)), [plain_score(p, d, 6, outs) for d in docs], rtol=1e-5)


def test_rare_words_are_not_remembered():
    """What a worker holds does not grow with the words it meets; those that it has no counts of are given to the join."""
    known = {b"the": 9, b"of": 4}
    words = lm.Words(list(known), known, [1.0] * lm.TAILS, 3, 100, 50)
    before = len(words.number)
    for _ in range(2):
        every, base, constant, n_known, (who, word, often) = words.facts(["The new of NEW", "", "old new"])
        tails = {w: lm.HEAD + 1 + lm.tail_class(w) for w in (b"new", b"old")}
        assert [x.tolist() for x in every] == [[0, tails[b"new"], 1, tails[b"new"], lm.HEAD], [lm.HEAD], [tails[b"old"], tails[b"new"], lm.HEAD]]
        assert sorted(zip(who.tolist(), word, often.tolist(), strict=True)) == [(0, b"new", 2), (2, b"new", 1), (2, b"old", 1)]
        assert n_known.tolist() == [3, 1, 1]
        log_all, end = math.log10(100 + lm.ALPHA * 51), math.log10(3 + lm.ALPHA)
        assert np.allclose(base, [math.log10(9.1) + math.log10(4.1) + end - 5 * log_all, end - log_all, end - 3 * log_all])
        assert np.allclose(constant, [-2 * math.log10(1.1), 0, -2 * math.log10(1.1)])
    assert len(words.number) == before == len(known)


def test_texts_of_several_batches_are_scored_side_by_side(monkeypatch):
    known = {b"the": 9, b"of": 4}
    words = lm.Words(list(known), known, [1.0] * lm.TAILS, 3, 100, 50)
    p = gru.start(words.inputs, words.classes, words.groups, words.places)
    every = words.facts(["the of the " * n for n in (3, 0, 40, 1, 7)])[0]
    batches = [pa.RecordBatch.from_pydict({"row": [i], "constant": [float(i)], "inputs": pa.array([x.astype("<u2").tobytes()], pa.binary())}) for i, x in enumerate(every)]
    batches.insert(2, batches[0].slice(0, 0))
    calls, score = [], gru.score
    monkeypatch.setattr(gru, "score", lambda p, texts: calls.append(len(texts.sizes)) or score(p, texts))
    want = [score(p, gru.Texts([x], words.end_input, words.outs))[0] / math.log(10) + i for i, x in enumerate(every)]
    for tokens, sizes in ((lm.SCORED, [5]), (100, [3, 2]), (0, [1] * 5)):
        monkeypatch.setattr(lm, "SCORED", tokens)
        calls.clear()
        out = pa.Table.from_batches(lm.score_batches(iter(batches), words, p)).to_pydict()
        assert calls == sizes and list(out) == ["row", "n_tokens", "score"] and out["row"] == [0, 1, 2, 3, 4]
        assert out["n_tokens"] == [len(x) for x in every] and np.allclose(out["score"], want, rtol=1e-5)


def test_model_is_a_distribution_and_gradients_hold():
    p = gru.start(10, 5, 2, 3)
    h = np.random.default_rng(0).normal(0, 0.3, (1, gru.STATE)).astype(np.float32)
    total = sum(math.exp(gru.outputs(p, h, np.array([c]), np.array([k]), False)[0][0]) for c, k in [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, -1), (3, -1), (4, -1)])
    assert math.isclose(total, 1, rel_tol=1e-4)
    outs = (np.array([0, 0, 0, 1, 1, 1, 2, 3, 4, 4]), np.array([0, 1, 2, 0, 1, 2, -1, -1, -1, -1]))
    docs = [np.array([1, 3, 8, 6]), np.array([7, 0, 6])]
    q = {k: v.astype(np.float64) for k, v in p.items()}

    def loss(q):
        texts = gru.Texts(docs, 6, outs)
        return gru.window_gradients(q, q["emb"] @ q["wx"] + q["b"], texts, np.zeros((2, gru.STATE)), 0)

    ll, n, grads, _ = loss(q)
    assert n == 7 and math.isclose(ll, gru.score(q, gru.Texts(docs, 6, outs)).sum(), rel_tol=1e-5)
    for k in q:
        at = tuple(np.argwhere(np.abs(grads[k]) == np.abs(grads[k]).max())[0])
        q[k][at] += 1e-4
        up = loss(q)[0]
        q[k][at] -= 2e-4
        down = loss(q)[0]
        q[k][at] += 1e-4
        assert math.isclose(-(up - down) / 2e-4, grads[k][at], rel_tol=2e-2, abs_tol=1e-4), k


def test_simhash(docs):
    df, rows = docs
    assert got(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == brute.simhash(rows)


def test_anchors_cover():
    rng = np.random.default_rng(4)
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, int(rng.integers(0, 3)), replace=False):
            y ^= 1 << int(b)
        who, anchor, own = simhash.anchors(np.array([x, y], np.uint64))
        assert set(anchor[(who == 0) & own]) <= set(anchor[who == 1]) and own.sum() == 2


def test_group_links_by_flips_as_by_pairs():
    rng = np.random.default_rng(6)
    prints = np.unique(np.uint64(12345) ^ np.array([sum(1 << int(b) for b in rng.choice(64, 2)) for _ in range(300)], np.uint64))
    own = rng.random(len(prints)) < 0.6
    forests = []
    for most in (10**9, 0):
        f = simhash.Forest(len(prints))
        for i, j in simhash.group_links(prints, own, most=most):
            f.join(int(i), int(j))
        forests.append([f.root(i) for i in range(len(prints))])
    assert forests[0] == forests[1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (7, 8)]
    rows = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert rows == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_one_of_each(spark, table):
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "changed", *words[201:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words)), (4, "quite another text " + " ".join(f"v{i}" for i in range(300))), (None, " ".join(words)), (5, None)]
    out = simhash.one_of_each(odd(spark, rows))
    assert got(out, "doc_id") == [(1,), (4,), (5,), (None,)] and out.columns == odd(spark).columns


def test_language(spark):
    rows = got(QUERIES["op9_language"](spark, SF), "doc_id", "held_out", "lang_pred", "score")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [lang[d] == p for d, h, p, _ in rows if h]
    assert len(rows) == len(lang) and np.mean(held) > 0.97 and all(0 <= r[3] <= 1 for r in rows)
    profiles = langid.fit_profiles(spark.read.parquet(f"{SF}/documents.parquet"))
    out = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd(spark), profiles, ["doc_id"]).collect()}
    assert all(out[d] == "und" for d in (1, 2, 3, 13)) and out[4] != "und" and out[12] != "und"
    assert langid.fit_profiles(odd(spark)) == {} and langid.predict(odd(spark), {}, ["doc_id"]).filter("lang_pred <> 'und'").count() == 0


def test_shards(docs):
    df, rows = docs
    out = sharding.shard_documents(df).collect()
    size = Counter(r["shard"] for r in out)
    assert len(out) == len(rows) and (not rows or max(size.values()) - min(size.get(k, 0) for k in range(16)) <= 1)
    for k in size:
        assert sorted(r["slot"] for r in out if r["shard"] == k) == list(range(size[k]))
    text = defaultdict(set)
    for d, t in rows:
        text[d].add(len((t or "").encode()) + 1)
    assert all(r["size"] in text[r["doc_id"]] and r["grown_shard"] is None for r in out)


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_decontamination_matches_sql(spark):
    assert compare(QUERIES["op2_decontaminate"](spark, SF), connect(SF), ORACLES["op2_decontaminate"]) == []


def test_decontamination_tolerates_substitutions(spark):
    item = [f"q{i}" for i in range(30)]
    changed = ["zz" if i % 6 == 4 else w for i, w in enumerate(item)]
    half = ["zz" if i % 2 else w for i, w in enumerate(item)]
    rows = [(1, "before " + " ".join(item).upper()), (2, "a b, " + "; ".join(changed) + " c"), (3, " ".join(half)), (4, None), (5, ""), (None, " ".join(item)), (1, "before " + " ".join(item).upper())]
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (None, "x"), (9, "a b"), (7, " ".join(item))], "item_id bigint, text string")
    found = decontam.contaminated(odd(spark, rows), items)
    assert got(found, "doc_id", "item_id", "n_words", "n_matched", "start") == [(1, 7, 30, 30, 1), (2, 7, 30, 25, 2)]
    assert got(decontam.decontaminate(odd(spark, rows), items), "doc_id") == [(3,), (4,), (5,), (None,)]
    assert decontam.contaminated(odd(spark, rows), items.filter("item_id < 0")).count() == 0


def test_no_python_in_decontamination(spark, capsys):
    QUERIES["op2_decontaminate"](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "Arrow" not in plan and "Python" not in plan


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = odd(spark, [(90_001, None), (90_002, "123 !!!"), (90_003, " ".join(f"n{i}" for i in range(200)))])
    docs = docs.unionByName(extra)
    before, columns = docs.count(), docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = cp.settle(stage(spark, docs, SF), name)
        assert docs.columns == columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert 90_003 in ids and not ids & {90_001, 90_002}
        assert len(ids) <= before
        before = len(ids)
    out = cp.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == ids


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_take_empty_tables(spark, stage):
    import corpus_pipeline as cp

    assert cp.STAGES[stage][1](spark, odd(spark, []), SF).count() == 0


def test_ids_of_a_group_of_runs_are_fetched_once():
    """The library makes a new list of all ids each time they are asked for."""
    asked = []

    class Code:
        def __init__(self, code):
            self.code, self.offsets = code, code.offsets

        @property
        def ids(self):
            asked.append(1)
            return self.code.ids

    class Tool:
        def encode_batch(self, texts, add_special_tokens):
            return [Code(c) for c in tool.encode_batch(texts, add_special_tokens=add_special_tokens)]

    vocabulary = tokens.Vocabulary(None)
    tool, runs = vocabulary.tool, [" a", " word", "\nof", " many", " words"]
    want = vocabulary.id_runs(runs)
    vocabulary.tool = Tool()
    assert vocabulary.spaced_runs(runs) == want and len(asked) == 1
