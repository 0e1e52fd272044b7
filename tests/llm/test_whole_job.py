"""Cases in which the training-data operators did less than the whole job."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tarnwork.llm import common, htmltext, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def shingles(text, width=5):
    w = text.split()
    width = min(width, len(w))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b)


def changed(rng, words, low, high):
    """The words with some substituted, so that the shingle similarity is in the range."""
    of = shingles(" ".join(words))
    while True:
        out = list(words)
        for at in rng.choice(len(words), int(rng.integers(1, 1 + len(words) // 12)), replace=False):
            out[at] = f"x{rng.integers(1 << 40)}"
        if low <= jaccard(of, shingles(" ".join(out))) <= high:
            return out


def test_near_duplicates_as_by_brute_force(spark):
    rng = np.random.default_rng(8)
    rows, want = [], set()
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(60, 400)))]
        similar = k % 2 == 0
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed(rng, words, *((0.8, 0.95) if similar else (0.65, 0.79)))))]
        want |= {2 * k} | (set() if similar else {2 * k + 1})
    assert ids(simhash.one_of_each(docs_of(spark, rows))) == sorted(want)


def test_near_duplicates_take_the_limit_and_distinct_shingles(spark):
    line = " ".join(f"a{i}" for i in range(40)) + " "
    rows = [
        (1, "a b c d e f g h"), (2, "a b c d e f g h i"),  # 4 of 5 shingles
        (3, "p q r s t u v"), (4, "p q r s t u v w"),  # 3 of 4
        (5, line + "one two"), (6, line * 30 + "one two"),  # 42 words' 38 shingles of the 42 of the repeated line
        (7, "B c"), (8, "b  C"), (9, "b c d"), (10, None), (11, " "),
    ]
    assert ids(simhash.one_of_each(docs_of(spark, rows))) == [1, 3, 4, 5, 7, 9, 10]


def test_near_duplicates_of_a_dense_group_are_linked_by_a_forest(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join([*words[:-1], f"end{k}"])) for k in rng.permutation(500).tolist()]
    assert ids(simhash.one_of_each(docs_of(spark, rows))) == [0]


@pytest.mark.parametrize("texts", [2048, 40])
def test_near_duplicates_of_a_group_near_the_limit_move_no_pairs(spark, monkeypatch, texts):
    rng = np.random.default_rng(10)
    rows = []
    for k in range(300):  # most pairs lie between 0.6 and 0.8
        words = [f"w{i}" for i in range(120)]
        for at in rng.integers(0, 120, 2 + k % 2):
            words[at] = f"x{k}-{at}"
        rows.append((k, " ".join(words)))
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for j in range(300) for i in range(j) if jaccard(sets[i], sets[j]) >= 0.8]
    forest = simhash.Forest(300)
    for i, j in links:
        forest.join(i, j)
    counts = []

    def settle(df, label):
        out = common.settle(df, label)
        counts.append(out.count())
        return out

    monkeypatch.setattr(simhash, "settle", settle)
    monkeypatch.setattr(simhash, "BLOCK_TEXTS", texts, raising=False)
    assert ids(simhash.one_of_each(docs_of(spark, rows))) == [k for k in range(300) if forest.root(k) == k]
    assert max(counts) <= 40 * len(rows)


def test_language_stage_without_labels(spark):
    import corpus_pipeline as cp

    rows = [(1, "some clean words"), (2, "日本語"), (3, None), (4, ""), (5, "123 !!!")]
    assert ids(cp.language(spark, docs_of(spark, rows), SF)) == [1, 2]


def test_repeats_stage_cuts_fifty_one_short_words(spark):
    import corpus_pipeline as cp

    passage = " ".join("abcdefghijklmnopqrstuvwxyzyxwvutsrqponmlkjihgfedcba")
    rows = [(1, "first document: " + passage + " end of it"), (2, "second one, " + passage + "; other end")]
    out = {r["doc_id"]: r["text"] for r in cp.repeats(spark, docs_of(spark, rows), SF).collect()}
    assert len(passage) == 101 and out[1] == rows[0][1] and passage not in out[2] and "second one" in out[2]


def test_html_keeps_mathml_fallbacks_and_the_headline():
    page = """<body><nav><a>Menu</a></nav><article><div class="entry-header"><h1>Head</h1></div><p>The square <math><semantics><mrow><msup><mi>x</mi>
<mn>2</mn></msup></mrow><annotation encoding="tex">x^2</annotation></semantics></math> is positive, as a rule, everywhere.</p>
<p>See <object data=a.pdf>the fallback text</object>, which stands here, too.</p><div class="entry-header ad">Buy</div></article><div class="site-header">Site</div></body>"""
    assert htmltext.main_text(page) == "Head\nThe square x 2 is positive, as a rule, everywhere.\nSee the fallback text, which stands here, too."


CLASHING = "lang_pred score _kept bucket _t doc tag spans lo hi k0 c0 l s t id node root _gone _found _doc _w fps mins".split()


def test_stages_take_extra_columns_of_any_name(spark):
    import corpus_pipeline as cp

    rows = [(1, "some clean words, enough of them to stand alone here"), (2, "some clean words, enough of them to stand alone here"), (3, None), (4, "123"), (5, "other words, which nobody has said before in this table")]
    docs = docs_of(spark, rows).withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {r[c] for r in out.collect() for c in ("lang_pred", "_kept", "node")} == {"extra lang_pred", "extra _kept", "extra node"}, name
        docs = out
    assert ids(docs) == [1, 5] and ids(cp.packed(spark, docs, SF)) == [1, 5]


def test_the_pipeline_leaves_only_the_stages_rows(spark):
    import corpus_pipeline as cp

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    cp.run(spark, SF)
    left = sorted(p.rsplit("-", 1)[0] for p in set(os.listdir(shared)) - before)
    assert [p for p in left if p in dict(cp.STAGES)] == sorted(name for name, _ in cp.STAGES[:-1])
    assert not {"prints", "classes", "pairs", "suffixes", "windows", "stars"} & set(left)
