"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks: runs of text between block-level tags, with the open elements around them. Scripts,
styles, forms, the head, comments in the markup and hidden elements hold no blocks; a form around an article or main
element, or around every block of the page, is not read as a form. Each block gets a probability of being content
from a logistic model; its costs of either label are the negative logarithms, and they become the capacities to
the two terminals of a graph. Blocks next to each other in page order are tied, and blocks with the same
parent or grandparent element more strongly the closer they are in the tree: cutting a tie costs its weight.
The minimum cut (augmenting paths) is the labelling of least total cost, so a short line inside an article follows
its neighbours, and a long notice in a sidebar does too.

The model is trained here on blocks of a bounded sample of pages, labelled weakly by the markup where it is
explicit (inside ``article`` or ``main`` and in no boilerplate element, against inside a boilerplate
element). Its features are of the text and the tags near it, and of the names in the markup (HINTS), but not the
elements that made the labels; those enter the costs as a fixed evidence (ELEMENT_EVIDENCE), so that a page
without such elements is judged by the model and its ties.

White space inside a block becomes one blank; blocks are joined by two newlines. Defined cases: null or
empty html, and pages without content, give an empty text; broken or unclosed markup is read as far as it goes;
repeated rows are read alike; without a usable sample the model is the prior in PRIOR; an empty table gives an
empty table. Only id and html, and columns asked for, are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, sampled, share_of

# Fixed values of the markup language.
SILENT = frozenset("script style template noscript head title svg iframe select textarea button audio video".split())
#: Further forms of a formula beside the one that is shown; they do not end a block.
UNSHOWN = frozenset(("annotation", "annotation-xml"))
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split()
)
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
CONTENT = frozenset("article main".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: Words in class, id and role names that speak for boilerplate.
HINTS = frozenset(
    """ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
    breadcrumbs sidebar side widget footer header masthead cookie cookies consent gdpr notice alert popup modal overlay
    newsletter subscribe subscription signup login share sharing social related recommended recommendations more trending
    comment comments reply replies respond discussion disqus pagination pager tags tagcloud toolbar copyright legal
    disclaimer search complementary contentinfo""".split()
)

#: Hints that hold for an article inside the element too: each comment or teaser may be an article of its own.
LASTING = frozenset(
    """sidebar related recommended recommendations more trending comment comments reply replies respond discussion
    disqus""".split()
)
#: Names that speak for boilerplate on an article itself.
CARDS = HINTS | {"teaser", "teasers"}

SAMPLE = 2_000
#: Blocks of one page that the fit may use.
PAGE_BLOCKS = 200
EPOCHS = 300
RATE = 0.5
PENALTY = 0.01
NEXT_TIE = 0.6
PARENT_TIE = 1.2
GRANDPARENT_TIE = 0.4
ELEMENT_EVIDENCE = 5.0
HINT_EVIDENCE = 6.0
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_NAME = re.compile(r"[a-z]+")
_ABOUT = frozenset(("has", "with", "no", "without", "not"))
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    tag: str
    parent: Element | None
    silent: bool
    boilerplate: bool
    content: bool
    hints: int
    children: int = 0
    lasting: int = 0
    form: Element | None = None
    wraps: bool = False


@dataclass
class Block:
    text: str
    linked: int
    element: Element
    parts: list[str] = field(default_factory=list)
    form: Element | None = None


def _names(attributes: str, article: bool = False) -> tuple[list[str], bool]:
    """Words of class, id and role; whether the element is hidden. The topics an article is filed under do not count."""
    names, hidden = [], False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id", "role", "aria-label"):
            for one in value.split():
                words = _NAME.findall(one)
                if article and len(words) > 1 and words[0] in ("tag", "category"):
                    continue
                if not _ABOUT.intersection(words):  # "with-sidebar" is about another element
                    names += words
        elif key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
            hidden = True
        elif key == "aria-hidden" and value == "true":
            hidden = True
    return names, hidden


def _outside_forms(blocks: list[Block]) -> list[Block]:
    """The blocks in no form, but for forms that wrap the page's text."""

    def forms(block: Block) -> list[Element]:
        found, form = [], block.form
        while form is not None:
            found.append(form)
            form = form.parent.form
        return found

    around = [forms(b) for b in blocks]
    if blocks and all(around) and all(a[-1] is around[0][-1] for a in around):
        around[0][-1].wraps = True
    return [b for b, a in zip(blocks, around) if all(f.wraps for f in a)]


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order."""
    root = Element("", None, False, False, False, 0)
    stack, blocks = [root], []
    parts: list[str] = []
    linked = 0
    depth_a = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            home = next(e for e in reversed(stack) if e.tag in BLOCKS or e.parent is None)
            blocks.append(Block(text, min(linked, len(text)), home, form=stack[-1].form))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].silent:
            parts.append(text)
            if depth_a:
                linked += len(text.strip())

    def close(tag: str) -> None:
        nonlocal depth_a
        while len(stack) > 1:
            if stack[-1].tag == "form":
                flush()
            gone = stack.pop()
            if gone.tag == "a":
                depth_a -= 1
            if gone.tag == tag:
                break

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # end tag
            if tag in BLOCKS or tag in SILENT or tag == "form":
                flush()
            if any(e.tag == tag for e in stack):
                close(tag)
            continue
        if tag == "br":
            add("\n")
        if tag in BLOCKS or tag in SILENT or tag == "form":
            flush()
            if tag in CLOSES_P:  # an open paragraph ends here, with the inline tags in it
                for e in reversed(stack):
                    if e.tag == "p":
                        close("p")
                        break
                    if e.tag in BLOCKS:
                        break
            if tag in ("li", "td", "th", "tr", "dd", "dt", "option"):
                same = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                for e in reversed(stack):
                    if e.tag in same:
                        close(e.tag)
                        break
                    if e.tag in ("ul", "ol", "table", "dl", "menu", "tr") and e.tag != tag:
                        break
        if tag in VOID:
            continue
        names, hidden = _names(m[3], tag == "article") if m[3] else ([], False)
        top = stack[-1]
        top.children += 1
        element = Element(
            tag,
            top,
            top.silent or tag in SILENT or tag in UNSHOWN or hidden,
            top.boilerplate or tag in BOILERPLATE,
            top.content or tag in CONTENT,
            top.hints + any(n in HINTS for n in names),
            lasting=top.lasting + any(n in LASTING for n in names),
            form=top.form,
        )
        if tag == "article":
            element.hints = top.lasting + any(n in CARDS for n in names)
            element.lasting = top.lasting + any(n in CARDS for n in names)
        elif tag in ("main", "html", "body"):
            element.hints = element.lasting = 0
        if tag == "form":
            element.form = element
        elif tag in CONTENT and not (element.hints or element.boilerplate or element.silent):
            form = element.form
            while form is not None:
                form.wraps = True
                form = form.parent.form
        # A heading block of an article is content, not page furniture.
        if tag == "header" and top.content:
            element.boilerplate = top.boilerplate
        if (m[3] or "").endswith("/") and tag not in BLOCKS:
            continue
        stack.append(element)
        if tag == "a":
            depth_a += 1
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    flush()
    return _outside_forms(blocks)


FEATURES = ("bias", "log_words", "link_share", "ends_sentence", "comma_rate", "word_length", "heading", "list_item", "paragraph", "digits", "short")
#: Weights used when nothing can be learned: long running text is content, links and fragments are not.
PRIOR = (-0.5, 0.8, -4.0, 0.8, 0.3, 0.0, 0.8, -0.8, 1.0, -1.0, -0.5)


def features(block: Block) -> list[float]:
    words = block.text.split(" ")
    n, size, tag = len(words), len(block.text), block.element.tag
    return [
        1.0,
        math.log1p(n) - 2,
        block.linked / size,
        float(block.text[-1] in ".!?…:\"'»”)"),
        min(block.text.count(",") / n * 5, 2.0),
        min(size / n / 6 - 1, 2.0),
        float(tag in ("h1", "h2", "h3", "h4", "h5", "h6")),
        float(tag in ("li", "dd", "dt", "td", "th")),
        float(tag in ("p", "blockquote", "pre", "figcaption")),
        sum(c.isdigit() for c in block.text) / size,
        float(n < 4),
    ]


def train_weights(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by gradient steps, both classes weighted alike, drawn to the prior."""
    prior = np.array(PRIOR)
    if not len(labels) or labels.min() == labels.max():
        return prior
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    w, held = prior.copy(), np.full(len(prior), 1e-8)
    for _ in range(EPOCHS):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        g = rows.T @ ((p - labels) * share) + PENALTY * (w - prior)
        held += g * g
        w -= RATE * g / np.sqrt(held)
    return w


def evidence(block: Block) -> float:
    """Log-odds from explicit elements and names. Names count from the innermost article or main element on,
    the article's own included, and LASTING ones from outside an article as well."""
    e = block.element
    if e.boilerplate or e.hints:
        return -ELEMENT_EVIDENCE * e.boilerplate - HINT_EVIDENCE * min(e.hints, 2)
    return ELEMENT_EVIDENCE * e.content


class CutGraph:
    """Nodes between two terminals; capacities are real numbers."""

    def __init__(self, size: int):
        self.out: list[dict[int, float]] = [{} for _ in range(size + 2)]
        self.source, self.sink = size, size + 1

    def tie(self, a: int, b: int, forth: float, back: float) -> None:
        self.out[a][b] = self.out[a].get(b, 0.0) + forth
        self.out[b][a] = self.out[b].get(a, 0.0) + back

    def terminals(self, node: int, source: float, sink: float) -> None:
        self.tie(self.source, node, source, 0.0)
        self.tie(node, self.sink, sink, 0.0)

    def source_side(self) -> set[int]:
        """Maximum flow by shortest augmenting paths level by level; then what the source still reaches."""
        least = 1e-9
        while True:
            level = {self.source: 0}
            queue = deque([self.source])
            while queue:
                a = queue.popleft()
                for b, room in self.out[a].items():
                    if room > least and b not in level:
                        level[b] = level[a] + 1
                        queue.append(b)
            if self.sink not in level:
                return set(level) - {self.source}
            edges = {a: iter(list(self.out[a])) for a in level}
            path = [self.source]
            while path:
                a = path[-1]
                if a == self.sink:
                    steps = list(zip(path, path[1:]))
                    flow = min(self.out[x][y] for x, y in steps)
                    for x, y in steps:
                        self.out[x][y] -= flow
                        self.out[y][x] += flow
                    first = next(i for i, (x, y) in enumerate(steps) if self.out[x][y] <= least)
                    del path[first + 1 :]
                    continue
                for b in edges[a]:
                    if self.out[a][b] > least and level.get(b) == level[a] + 1:
                        path.append(b)
                        break
                else:
                    path.pop()


def content_blocks(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """The labelling of least cost."""
    if not blocks:
        return []
    odds = np.array([features(b) for b in blocks]) @ weights
    graph = CutGraph(len(blocks))
    last_child: dict[int, int] = {}
    last_grandchild: dict[int, int] = {}
    for i, block in enumerate(blocks):
        value = max(-12.0, min(12.0, float(odds[i]) + evidence(block)))
        # -log of either probability; the source side is content.
        graph.terminals(i, math.log1p(math.exp(value)), math.log1p(math.exp(-value)))
        if i:
            graph.tie(i - 1, i, NEXT_TIE, NEXT_TIE)
        parent = block.element.parent
        for known, anchor, tie in ((last_child, parent, PARENT_TIE), (last_grandchild, parent.parent if parent else None, GRANDPARENT_TIE)):
            if anchor is not None and anchor.parent is not None:
                other = known.get(id(anchor))
                if other is not None and other != i:
                    graph.tie(other, i, tie, tie)
                known[id(anchor)] = i
    content = graph.source_side()
    return [i in content for i in range(len(blocks))]


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(page) if page else []
    return "\n\n".join(b.text for b, keep in zip(blocks, content_blocks(blocks, weights)) if keep)


def train(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", sample: int = SAMPLE) -> np.ndarray:
    """Weights from the explicit blocks of about ``sample`` pages, dealt by a hash of id and html (equal rows count once).

    A page gives at most PAGE_BLOCKS blocks, evenly spaced.
    """
    rows = pages.select(F.col(id_column).alias("id"), F.col(html_column).alias("html"))
    picked = sampled(rows, share_of(sample, pages.count()), ["id", "html"]).select("html", "__deal")
    width = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels, deals = [], [], []
            for page, deal in zip(batch.column("html").to_pylist(), batch.column("__deal").to_pylist()):
                marked = [b for b in blocks_of(page) if b.element.boilerplate or b.element.hints or b.element.content] if page else []
                taken = range(len(marked)) if len(marked) <= PAGE_BLOCKS else np.linspace(0, len(marked) - 1, PAGE_BLOCKS).astype(int)
                for i in taken:
                    e = marked[i].element
                    rows.append(features(marked[i]))
                    labels.append(int(not (e.boilerplate or e.hints > 0)))
                    deals.append(deal)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32()), pa.array(deals, pa.int64())],
                names=["row", "label", "deal"],
            )

    table = map_arrow(picked, sums, "row array<double>, label int, deal bigint").toArrow().sort_by([("deal", "ascending")])
    rows = np.array(table.column("row").to_pylist(), float).reshape(-1, width)
    return train_weights(rows, table.column("label").to_numpy().astype(float))


def extract(pages: DataFrame, weights: np.ndarray, keep: list[str], html_column: str = "html") -> DataFrame:
    """Columns ``keep``, ``text`` and ``n_chars`` of every row."""
    base = pages.select(*keep, F.col(html_column).alias("__html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(p, weights) for p in batch.column("__html").to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    return map_arrow(base, read, f"{fields}, text string, n_chars bigint")
