"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.staging import chunks, texts_of

#: Elements that start and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of the page.
SILENT = frozenset("button canvas datalist embed head iframe math noscript object option script select style svg template textarea title".split())
#: Elements around the article, whatever they hold.
AROUND = frozenset("aside dialog footer menu nav search".split())
CONTAINERS = frozenset("article body div html main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
#: Words of class and id names that say what stands around an article, unless the element is a wrapper of it.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disclaimer disqus foot footer gdpr legal login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
#: Elements closed by the start of another of the group, within the given parents.
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
#: Share of the best path's score from which a path counts as content.
THRESHOLD = 0.1
#: Share of the page's text from which a named element or form is a wrapper of it, and of the text of all articles.
WRAPPER, WRAPPED = 2 / 3, 0.5
#: Share of the content from which articles mark it alone.
MARKED = 0.5
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_MARKS = re.compile(r"[.,;:!?。，！？、…]")


class _Element:
    __slots__ = ("around", "marked", "named", "out", "path", "parent", "silent", "tag")

    def __init__(self, tag: str, parent: _Element | None, around: bool, named: bool, silent: bool):
        self.tag, self.parent, self.around, self.named, self.silent = tag, parent, around, named, silent
        self.path = f"{parent.path}/{tag}" if parent else tag
        #: Whether it or an element around it is surroundings whatever it holds, or an article of the page.
        self.out = around or bool(parent and parent.out)
        self.marked = bool(parent and parent.marked) or (tag in ("article", "main") and not named)

    def up(self) -> Iterator[_Element]:
        node: _Element | None = self
        while node:
            yield node
            node = node.parent


class _Blocks(HTMLParser):
    """The page as blocks (element, text), with markup repaired as browsers do."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [_Element("", None, False, False, False)]
        self.blocks: list[tuple[_Element, str]] = []
        self.parts: list[str] = []
        self.holder: _Element | None = None

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and self.holder:
            self.blocks.append((self.holder, text))
        self.parts, self.holder = [], None

    def _around(self, tag: str, attrs: list, inside: _Element) -> tuple[bool, bool]:
        """Whether the element is surroundings whatever it holds, and whether it is named so or a form."""
        said = dict(attrs)
        role = (said.get("role") or "").lower()
        names = f"{said.get('class') or ''} {said.get('id') or ''}"
        named = tag == "form" or role == "form" or bool(names.strip()) and not NAMED.isdisjoint(word.lower() for word in _NAME.findall(names))
        if tag in AROUND:
            return True, named
        if tag in ("html", "body", "article", "main"):
            return False, named
        if role in ROLES or "hidden" in said or (said.get("aria-hidden") or "").lower() == "true":
            return True, named
        return tag == "header" and "/article" not in inside.path and "/main" not in inside.path, named

    def _pop_to(self, tags: tuple, stop: frozenset | tuple) -> None:
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag in tags:
                del self.open[place:]
                return
            if self.open[place].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.end_block()
            if tag != "br":
                self._pop_to(("p",), CONTAINERS | {"table", "li", "blockquote", "button"})
            if tag in SIBLINGS:
                self._pop_to(*SIBLINGS[tag])
            if tag == "body":
                self._pop_to(("head",), ())
        if tag in VOID:
            if tag not in BLOCK:
                self.parts.append(" " if tag in ("img", "wbr") and self.parts and tag == "img" else "")
            return
        inside = self.open[-1]
        self.open.append(_Element(tag, inside, *self._around(tag, attrs, inside), inside.silent or tag in SILENT))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "iframe", "script"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_block()
        if tag not in VOID:
            self._pop_to((tag,), () if tag in BLOCK or tag in SILENT else BLOCK)

    def handle_data(self, data: str) -> None:
        inside = self.open[-1]
        if inside.silent:
            return
        if self.holder is None and not data.isspace():
            while inside.tag and inside.tag not in BLOCK:
                if inside.around or inside.named:
                    break
                inside = inside.parent
            self.holder = inside
        self.parts.append(data)


def path_scores(blocks: list[tuple[_Element, str]]) -> dict[str, float]:
    """Smoothed and fused ratios of each tag path, paths in page order.

    Per path: characters a block and punctuation marks a block. Both are
    smoothed with the neighbouring paths, then fused as a product of
    the two relative to their maxima.
    """
    length: dict[str, int] = {}
    marks: dict[str, int] = {}
    nodes: dict[str, int] = {}
    for element, text in blocks:
        path = element.path
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(_MARKS.findall(text))
        nodes[path] = nodes.get(path, 0) + 1
    paths = list(length)

    def smooth(ratio: list[float]) -> list[float]:
        padded = [ratio[0], *ratio, ratio[-1]]
        return [(a + 2 * b + c) / 4 for a, b, c in zip(padded, padded[1:], padded[2:])]

    texts = smooth([length[p] / nodes[p] for p in paths])
    points = smooth([marks[p] / nodes[p] for p in paths])
    most_text, most_points = max(texts), max(points) or 1.0
    return {p: t / most_text * (0.5 + 0.5 * m / most_points) * length[p] ** 0.5 for p, t, m in zip(paths, texts, points)}


def _inner(blocks: list[tuple[_Element, str]]) -> list[tuple[_Element, str]]:
    """The blocks outside all surroundings.

    A named element or form is surroundings unless it wraps the page: it holds
    half of the text of all articles, or stands in an article or on a page
    without any and holds two thirds of the text. If that leaves nothing, the
    one with most text is a wrapper too.
    """
    blocks = [(element, text) for element, text in blocks if not element.out]
    size: dict[_Element, int] = {}
    article: dict[_Element, int] = {}
    for element, text in blocks:
        for node in element.up():
            size[node] = size.get(node, 0) + len(text)
            article[node] = article.get(node, 0) + (len(text) if element.marked else 0)
    if not blocks:
        return blocks
    root = next(node for node in blocks[0][0].up() if not node.parent)

    def wraps(node: _Element) -> bool:
        if article[root] and not node.marked:
            return article[node] >= WRAPPED * article[root]
        return size[node] >= WRAPPER * size[root]

    shut = {node for node in size if node.named and node.tag not in ("html", "body", "article", "main") and not wraps(node)}
    while shut:
        left: dict[_Element, bool] = {root: False}

        def closed(element: _Element) -> bool:
            chain = []
            while element not in left:
                chain.append(element)
                element = element.parent
            said = left[element]
            for node in reversed(chain):
                said = left[node] = said or node in shut
            return said

        inner = [(element, text) for element, text in blocks if not closed(element)]
        if inner:
            return inner
        shut.remove(max(shut, key=lambda node: (size[node], -node.path.count("/"))))
    return blocks


def main_text(html: str) -> str:
    """Main text of one page: blocks of the content container, in page order, joined by line feeds.

    Elements that name themselves as surroundings are out, unless they wrap
    the page. The other blocks give each tag path a score; blocks of paths above
    the threshold mark the content, only those in articles if they are half of it
    or more. The smallest container with all of them is the article, whose
    low-scoring blocks (headings, list items, short lines) stay as well.
    """
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    blocks = _inner(parser.blocks)
    if not blocks:
        return ""
    scores = path_scores(blocks)
    least = THRESHOLD * max(scores.values())
    content = [(element, text) for element, text in blocks if scores[element.path] >= least]
    marked = [(element, text) for element, text in content if element.marked]
    if sum(len(text) for _, text in marked) >= MARKED * sum(len(text) for _, text in content):
        content = marked
    weight: dict[_Element, int] = {}
    plain: dict[_Element, int] = {}
    for element, _ in content:
        for node in element.up():
            weight[node] = weight.get(node, 0) + 1
    for element, text in blocks:
        for node in element.up():
            plain[node] = plain.get(node, 0) + (0 if element.tag in HEADINGS else len(text))
    root = next(node for node in content[0][0].up() if (node.tag in CONTAINERS or not node.tag) and weight[node] == len(content))
    root = next((node for node in root.up() if node.tag in ("article", "main")), root)
    while root.parent and root.parent.tag in ("div", "section") and plain[root.parent] == plain[root]:
        root = root.parent
    return "\n".join(text for element, text in blocks if any(node is root for node in element.up()))


def extract_text(pages: DataFrame) -> DataFrame:
    """Main text of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Every page gives a row, repeated ones too; NULL or empty html gives the
    empty text. Pages are read whole. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "html"):
            texts = [main_text(html) if html else "" for html in texts_of(chunk, "html")]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    thin = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return thin.mapInArrow(run, "page_id long, url string, text string, n_chars long")
