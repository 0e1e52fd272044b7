"""Main text of pages: what the ratios decide, odd pages, and the given pages against an independent reading."""

import html
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarnwork.llm import htmltext  # noqa: E402
from tarnwork.llm.queries import QUERIES  # noqa: E402

ONE = "The river rose in the night, and by the morning, as the older people had said, the lower fields stood under water."
TWO = "Nobody was hurt; the cattle had been moved on Friday, the bridge was closed, and the school, for once, stayed empty."
PLAIN = f"""<body><div><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div><div><h2>Flood</h2><p>{ONE}</p><p>{TWO}</p><p>So it was.</p></div>
<div>&copy; 2024 The Paper</div></body>"""


def test_a_page_without_marks_is_cut_by_the_ratios(monkeypatch):
    want = f"Flood\n{ONE}\n{TWO}\nSo it was."
    assert htmltext.main_text(PLAIN) == want
    # Without the ratios the menu and the copyright line stay.
    monkeypatch.setattr(htmltext, "content_nodes", lambda nodes, *a: [i for i, n in enumerate(nodes) if not n.noise and n.text.strip()])
    assert "News" in htmltext.main_text(PLAIN) and "2024" in htmltext.main_text(PLAIN)


@pytest.mark.parametrize("name", "notice tags related widget search-results alert share promo newsletter".split())
def test_inside_an_article_a_name_alone_drops_nothing(name):
    page = f'<article><h1>Flood</h1><p>{ONE}</p><div class="{name}">{TWO} <b>Really.</b></div><div class="{name} x">Tweet</div><p>So it was.</p></article>'
    assert htmltext.main_text(page) == f"Flood\n{ONE}\n{TWO} Really.\nSo it was."


def test_what_is_never_content_goes_however_dense():
    page = f"""<nav>{TWO}</nav><div class="cookie-notice">{TWO}</div><article><header><h1>Flood</h1></header><p>{ONE}</p><form><p>{TWO}</p></form><div hidden>{TWO}</div>
    <section id=comments><p>{TWO}</p></section><aside><p>{TWO}</p></aside><script>{TWO}</script></article><footer>{TWO}</footer>"""
    assert htmltext.main_text(page) == f"Flood\n{ONE}"


def test_odd_pages(spark):
    long = "".join(f"<p>Paragraph {i}, of many, with some words in it.</p>" for i in range(20_000))
    pages = [(1, None, None), (2, "u", ""), (3, None, "<p"), (4, "u", "only text, no tags at all"), (5, "u", "<nav>a</nav>"), (6, "u", f"<article>{long}</article>"),
             (6, "u", f"<article>{long}</article>"), (7, "u", "<div>" * 5000 + ONE), (8, "u", "<!-- " + ONE), (9, "u", f"<main><p>a&#8212;b&nbsp;&nbsp;c {ONE}</main>")]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id bigint, url string, html string, k0 string, h string")
    out = {r["page_id"]: r for r in htmltext.extract_pages(df, ["page_id", "url", "k0"]).collect()}
    assert [out[i]["text"] for i in (1, 2, 3, 5, 8)] == [""] * 5 and out[1]["url"] is None and out[1]["k0"] == "x"
    assert out[4]["text"] == "only text, no tags at all" and out[7]["text"] == ONE and out[9]["text"] == f"a—b c {ONE}"
    assert out[6]["text"].count("\n") == 19_999 and out[6]["n_chars"] == len(out[6]["text"])
    assert htmltext.extract_pages(df.limit(0), ["page_id"]).count() == 0
    with pytest.raises(ValueError, match="text"):
        htmltext.extract_pages(df.withColumnRenamed("k0", "text"), ["text"])


def slowly(page):
    """The marked article, its tags cut out: block tags end a line, line breaks are spaces, all others nothing."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    inner = re.sub(r"<!--.*?-->", "", inner, flags=re.S)
    inner = re.sub(r"</?(?:p|h1|div)>", "\0", inner)
    inner = re.sub(r"<br>", " ", inner)
    inner = html.unescape(re.sub(r"</?b>", "", inner))
    lines = (" ".join(x.split()) for x in inner.split("\0"))
    return "\n".join(x for x in lines if x)


def test_given_pages_as_by_an_independent_reading(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in QUERIES["op5_html_text"](spark, folder).collect()}
    assert len(got) == len(pages) > 200 and got == {k: slowly(v) for k, v in pages.items()}
