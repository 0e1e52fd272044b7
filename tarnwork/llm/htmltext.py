"""Main text of web pages by tag-path ratios.

Every text node of a page belongs to its root-to-leaf tag path. Text length and punctuation are added up per path and
divided by the path's number of nodes; the two ratios are smoothed along the page with a Gaussian, fused by
multiplication, and the paths above the threshold (their deviation from the mean) select content nodes.

The smallest element that holds most of the selected text is the article. Where the page marks it (``article``, ``main``),
all of it is given back but for what is never content (menus, forms, scripts, comments of readers) and for blocks whose
name sounds like a notice, a share bar and the like *and* whose path is below the threshold. Where the page does not mark
it, the ratios alone tell where it begins and ends: from the first selected block, with the headings right above it, to
the last. Outside an article names still tell notices and adverts from text, as these may be as dense.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import ship, text_or_empty

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>?)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-label)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
# Element names of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg select".split())
MATH = frozenset("math mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mspace mfenced menclose mphantom semantics annotation annotation-xml".split())
INLINE = MATH | frozenset("object a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
NOISE = frozenset("nav footer aside form script style noscript button select option textarea title head iframe template svg annotation annotation-xml dialog menu input fieldset".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPE = frozenset("table td th article section div main aside nav footer header form body ul ol dl blockquote".split())
ROOTS = frozenset("article main".split())
NOISE_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer|foot|header|masthead|cookies?|consent|notice\w*|alert|popup|modal|"
    r"comments?|commentlist|disqus|respon[ds]e?s?|replies|reply|share|sharing|social|related|recommend\w*|subscribe|newsletter|signup|login|search\w*|tags?|pagination|pager|toolbar|widget\w*|skip|disclaimer|copyright|legal)(?:$|[-_\s\d])", re.I)
COMMENT_NAME = re.compile(r"(?:^|[-_\s])(?:comments?|commentlist|disqus|replies)(?:$|[-_\s\d])", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of a name that mean nothing inside an article, as its own header holds the headline.
HEADER_NAME = re.compile(r"(?:^|(?<=[-_\s]))(?:header|masthead)(?=$|[-_\s\d])", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
SIGMA = 1.0
THRESHOLD = 0.8


class Node:
    """A run of text: its path (element numbers from the root), its block and its words, whether it is never content
    (``noise``), and whether an article's element around it has a name that sounds so (``suspect``)."""

    __slots__ = ("path", "names", "block", "text", "noise", "suspect")

    def __init__(self, path, names, block, text, noise, suspect):
        self.path, self.names, self.block, self.text, self.noise, self.suspect = path, names, block, text, noise, suspect


def read_nodes(page: str) -> list[Node]:
    """Text nodes in page order. Unclosed and stray tags are tolerated: a start tag closes what it cannot stand in, an
    end tag closes up to its start tag if there is one."""
    stack: list[tuple[str, int, bool, str, bool]] = []  # name, number, noise, name with class, suspect
    nodes: list[Node] = []
    number = block = at = 0

    def add(text: str) -> None:
        if text:
            nodes.append(Node(tuple(s[1] for s in stack), tuple(s[3] for s in stack), block, html.unescape(text), bool(stack and stack[-1][2]), bool(stack and stack[-1][4])))

    def pop_to(k: int) -> None:
        nonlocal block
        if any(s[0] not in INLINE for s in stack[k:]):
            block += 1
        del stack[k:]

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m.group(1):
            name = m.group(1).lower()
            if name == "br":
                add(" ")
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
                if name in INLINE and stack[k][0] in SCOPE:
                    break
        elif m.group(2):
            name, attrs = m.group(2).lower(), m.group(3) or ""
            if name == "br":
                add(" ")
            if name in VOID:
                block += name == "hr"
                continue
            if name in CLOSES_P or name in SIBLING:
                shut = SIBLING.get(name, set()) | ({"p"} if name in CLOSES_P else set())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in shut:
                        pop_to(k)
                        if name != "tr":
                            break
                    elif stack[k][0] in SCOPE and stack[k][0] not in shut:
                        break
            number += 1
            label = " ".join(v for a in ATTRIBUTE.finditer(attrs) if a.group(1).lower() in ("class", "id", "role") for v in (a.group(2) or a.group(3) or a.group(4) or "",))
            hidden = any(a.group(1).lower() == "hidden" for a in ATTRIBUTE.finditer(attrs)) or "display:none" in attrs.replace(" ", "").lower()
            inside, doubted = (bool(stack[-1][2]), bool(stack[-1][4])) if stack else (False, False)
            within = any(s[0] in ROOTS for s in stack)
            said = HEADER_NAME.sub("", label) if within else label
            sounds = bool(said and name not in ROOTS and name not in ("body", "html") and NOISE_NAME.search(said))
            own = name in NOISE or hidden or sounds and (not within or bool(COMMENT_NAME.search(said)))
            if name == "header":
                own = own or not within
            stack.append((name, number, inside or own, f"{name}.{label}" if label else name, doubted or sounds))
            if name not in INLINE:
                block += 1
            if name in RAW:
                end = re.compile(rf"</{name}\s*/?>", re.I).search(page, at)
                at = end.end() if end else size
                pop_to(len(stack) - 1)
    return nodes


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_nodes(nodes: list[Node], sigma: float = SIGMA, threshold: float = THRESHOLD) -> list[int]:
    """Positions of the nodes whose path's fused ratio is at least ``threshold`` times its deviation over the page."""
    length: dict[tuple, int] = defaultdict(int)
    marks: dict[tuple, int] = defaultdict(int)
    count: dict[tuple, int] = defaultdict(int)
    for n in nodes:
        length[n.names] += len(n.text.strip())
        marks[n.names] += len(PUNCTUATION.findall(n.text))
        count[n.names] += 1
    text = smooth(np.array([0.0 if n.noise else length[n.names] / count[n.names] for n in nodes]), sigma)
    mark = smooth(np.array([0.0 if n.noise else marks[n.names] / count[n.names] for n in nodes]), sigma)
    fused = text * (1 + mark)
    best: dict[tuple, float] = {}
    for n, f in zip(nodes, fused, strict=True):
        best[n.names] = max(best.get(n.names, 0.0), float(f))
    line = min(threshold * float(fused.std()), float(fused.max()))

    def dense(n: Node) -> bool:
        # What lies beside text is lifted by smoothing; a suspect's path has to be dense by itself.
        own = length[n.names] / count[n.names] * (1 + marks[n.names] / count[n.names])
        return (own if n.suspect else best[n.names]) >= line

    return [i for i, n in enumerate(nodes) if not n.noise and n.text.strip() and dense(n)]


def main_text(page: str | None) -> str:
    """Blocks of the article, one to a line, or empty if the page has none."""
    if not page:
        return ""
    nodes = [n for n in read_nodes(page) if n.text]
    chosen = content_nodes(nodes) if any(n.text.strip() and not n.noise for n in nodes) else []
    if not chosen:
        return ""
    # The element that holds most of the selected text: down from the root as long as one child has over half of it.
    weight: dict[int, int] = defaultdict(int)
    total = 0
    for i in chosen:
        size = len(nodes[i].text.strip())
        total += size
        for e in nodes[i].path:
            weight[e] += size
    semantic = {e for i in chosen for e, name in zip(nodes[i].path, nodes[i].names, strict=True) if name.partition(".")[0] in ROOTS}
    main = [e for e in semantic if 2 * weight[e] > total]
    if main:
        root = max(main)  # the innermost: numbers grow inwards
    else:
        root, block_like = None, {e: name.partition(".")[0] for i in chosen for e, name in zip(nodes[i].path, nodes[i].names, strict=True)}
        for e in sorted(weight):
            if 10 * weight[e] > 9 * total and block_like[e] in SCOPE:
                root = e
    first, last = 0, len(nodes) - 1
    if not main:
        first, last = chosen[0], chosen[-1]
        while first and (nodes[first - 1].block == nodes[first].block or not nodes[first - 1].text.strip() or is_heading(nodes[first - 1])):
            first -= 1
        while last + 1 < len(nodes) and nodes[last + 1].block == nodes[last].block:
            last += 1
    dense = {nodes[i].block for i in chosen}
    blocks: dict[int, list[str]] = {}
    for n in nodes[first:last + 1]:
        if not n.noise and (root is None or root in n.path) and not (n.suspect and n.block not in dense):
            blocks.setdefault(n.block, []).append(n.text)
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n".join(line for line in lines if line)


def is_heading(n: Node) -> bool:
    return any(name.partition(".")[0] in HEADINGS for name in n.names)


def extract_pages(df: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The columns ``keep``, ``text`` and ``n_chars`` (code points) of every row.

    Null or empty pages, and pages without text, give empty text; a null url stays null; repeated rows are read each; an
    empty table gives no rows. A kept column with a name of the results is an error.
    """
    if clash := set(keep) & {"text", "n_chars"}:
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*kept, "t", "n"])

    kept = [f"k{i}" for i in range(len(keep))]  # inner names by position, so that no column can clash
    schema = ", ".join(f"{k} {df.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept, strict=True))
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], text_or_empty(f"`{html_col}`").alias("h"))
    out = rows.mapInArrow(run, f"{schema}, t string, n bigint")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], F.col("t").alias("text"), F.col("n").alias("n_chars"))
