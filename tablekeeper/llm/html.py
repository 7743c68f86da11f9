"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
"""Lines summed for a block; so many empty lines end a stretch of text."""
SURGE = 80
"""Characters a block must reach for its stretch to count as text on a page without an article or main element."""

_RAW = "script style noscript template svg math textarea select button iframe object title canvas audio video"
_RAW_NAMES = frozenset(_RAW.split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var img wbr br input picture source map area".split()
)
_CELL = frozenset(("td", "th"))
_ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())
"""Elements that need no closing tag; the next block closes them."""
_BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense adslot sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs masthead header footer foot "
    "copyright comment comments commentlist disqus reply replies respond discussion share sharing social related "
    "recommended recommendations widget widgets pagination pager toolbar search skip".split()
)
_COMMENT_WORDS = frozenset("comment comments reply replies respond related teaser".split())
_NEGATION = frozenset(("no", "with", "without", "has", "hide"))


def _is_boiler(name: str, rest: str, in_article: bool) -> bool:
    """Is the element a part of a page that is never its main text?"""
    if name in ("html", "body", "main"):
        return False
    if name in _BOILER_TAGS and not (name == "header" and in_article):
        return True
    if not rest or "=" not in rest and "hidden" not in rest:
        return False
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key == "role" and value.lower() in _BOILER_ROLES:
            return True
        if key in ("class", "id"):
            for part in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
                pieces = re.split(r"[^a-z]+", part)
                if pieces[0] not in _NEGATION:
                    words.update(pieces)
    if name == "article":
        return bool(words & _COMMENT_WORDS)
    if name == "header" or in_article and "header" in words:
        words.discard("header")
    return bool(words & _BOILER_WORDS)


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NO_LINE = ("", 0, 0, 0, False)


class Containers:
    """The containers of a page, numbered in the order in which they begin; 0 is the page."""

    def __init__(self):
        self.parent, self.last = [0], [0]

    def begin(self, parent: int) -> int:
        self.parent.append(parent)
        self.last.append(len(self.last))
        return len(self.last) - 1

    def end(self, node: int) -> None:
        self.last[node] = len(self.last) - 1

    def holds(self, node: int, other: int) -> bool:
        return node <= other <= self.last[node]

    def around(self, first: int, last: int) -> int:
        """The innermost container that holds all containers from ``first`` to ``last``."""
        node = first
        while not self.holds(node, last):
            node = self.parent[node]
        return node


def page_lines(html: str) -> tuple[list[tuple[str, int, int, int, bool]], Containers]:
    """Strip the markup: (text, link characters, article or 0, container, is a heading) of each line.

    A block is a line. Containers leave an empty line where they begin and end, boilerplate one in its place, and an
    article as many as end a stretch.
    """
    lines: list[tuple[str, int, int, int, bool]] = []
    containers, heading = Containers(), False
    parts: list[str] = []
    link_chars, in_link = 0, False
    stack: list[tuple[str, int, int]] = []  # open containers, the article and the container around them
    skip_at, articles, article, inside = 0, 0, 0, 0
    at = 0

    def end_block() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                lines.append((text, link_chars, article, inside, heading))
            parts.clear()
        link_chars = 0

    def enter(name: str) -> None:
        nonlocal inside
        stack.append((name, article, inside))
        if name not in _HEADINGS:
            inside = containers.begin(inside)

    def leave(depth: int) -> None:
        nonlocal skip_at, article, inside
        while len(stack) > depth:
            name, article, around = stack.pop()
            if inside != around:
                containers.end(inside)
                inside = around
            if skip_at and len(stack) < skip_at:
                skip_at = 0
            if name == "article":
                lines.extend([_NO_LINE] * WINDOW)

    n = len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else n
        if stop > at and not skip_at:
            parts.append(html[at:stop])
            if in_link:
                link_chars += stop - at
        if not m:
            break
        at = m.end()
        name = m.group("name") or m.group("name2")
        if not name:
            continue
        name = name.lower()
        closing = bool(m.group("close") or m.group("close2"))
        rest = m.group("rest") or m.group("rest2") or ""
        if not closing and name in _RAW_NAMES and not rest.endswith("/"):
            end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if name in _VOID:
            if name == "br" or name == "hr":
                if name == "hr":
                    end_block()
                elif not skip_at:
                    parts.append(" ")
            continue
        if name in _INLINE:
            if name == "a":
                in_link = not closing
        elif name in _CELL:
            if not skip_at:
                parts.append(" ")
        else:
            end_block()
            heading = name in _HEADINGS and not closing
        container = name not in _INLINE and name not in _ENDS_ITSELF
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(depth)
                    break
            if container and not skip_at:
                lines.append(_NO_LINE)
            continue
        if stack and stack[-1][0] in _ENDS_ITSELF and name not in _INLINE:
            leave(len(stack) - 1)  # a boilerplate paragraph ends where the next block begins
        if skip_at:
            if container or name == stack[skip_at - 1][0]:
                enter(name)
            continue
        if _is_boiler(name, rest, bool(article)):
            enter(name)
            skip_at = len(stack)
            lines.append(_NO_LINE)
        elif container:
            enter(name)
            if name == "head":
                skip_at = len(stack)
                continue
            lines.extend([_NO_LINE] * (WINDOW if name in ("article", "main") else 1))
            if name == "body":
                skip_at = 0
            if name == "article" or name == "main" and not article:
                articles += 1
                article = articles
    end_block()
    leave(0)
    return lines, containers


def _weak_too(lines, size, stretches: list[tuple[int, int]], strong: set[tuple[int, int]], containers: Containers) -> set[tuple[int, int]]:
    """The strong stretches and the weak ones that belong to them.

    These lie in the innermost container that holds all strong ones and any weak one, or are headings with nothing but
    more of them before the next stretch that is kept.
    """
    at = [lines[k][3] for i, j in strong for k in range(i, j) if size[k]]
    weak = sorted(lines[k][3] for i, j in stretches if (i, j) not in strong for k in range(i, j) if size[k])
    around = containers.around(min(at), max(at))
    while around and bisect_right(weak, containers.last[around]) == bisect_left(weak, around):
        around = containers.parent[around]
    kept, follows = set(), False
    for i, j in reversed(stretches):
        texts = [lines[k] for k in range(i, j) if size[k]]
        belongs = (i, j) in strong or all(containers.holds(around, line[3]) for line in texts)
        if belongs or follows and all(line[4] for line in texts):
            kept.add((i, j))
            follows = True
        else:
            follows = False
    return kept


def main_text(html: str | None) -> str:
    """Text of the page's main stretches of lines, joined by line breaks."""
    if not html:
        return ""
    lines, containers = page_lines(html)
    least = SURGE
    if any(line[2] for line in lines if line[0]):  # the page says itself where its articles are, so all text there counts
        lines = [(line[0], 0, *line[2:]) if line[2] else _NO_LINE for line in lines]
        least = 1
    size = np.array([0 if 2 * link > len(text) else len(text) for text, link, *_ in lines] + [0] * WINDOW)
    blocks = np.convolve(size, np.ones(WINDOW, int))[WINDOW - 1 : WINDOW - 1 + len(lines)]  # sum from each line on
    stretches, first = [], None
    for i, (line_size, block) in enumerate(zip(size, blocks, strict=False)):
        if first is None and line_size:
            first = i  # surge point
        if first is not None and not block:
            stretches.append((first, i))  # dive point
            first = None
    if first is not None:
        stretches.append((first, len(lines)))
    strong = {(i, j) for i, j in stretches if blocks[i:j].max() >= least}
    if not strong and stretches:
        strong = {max(stretches, key=lambda x: int(size[x[0] : x[1]].sum()))}
    if len(strong) < len(stretches):
        strong = _weak_too(lines, size, stretches, strong, containers)
    return "\n".join(lines[k][0] for i, j in stretches if (i, j) in strong for k in range(i, j) if lines[k][0])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and ``text`` of each page's main text.

    Markup, scripts, styles, comments in the source and parts that name themselves as menus, page headers, footers,
    sidebars, notices, adverts, forms or reader comments are stripped; then the sums of text lengths over WINDOW lines
    tell where text begins (surge) and ends (dive). On a page without an article or main element a stretch of SURGE
    characters is strong; a weaker one stays if it lies in the nearest container around the strong ones that has others, or is a heading before
    one, unless most of it is links. Inside a block each run of white space is one space.

    NULL and empty pages give an empty text, as do pages without text; repeated rows are pages of their own; an empty
    table gives an empty result. Other columns are not read. There is no shuffle.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = rows.select("page_id", "url").schema.add("text", "string")

    def run(batches):
        for batch in batches:
            html = batch.column(2)
            for a in range(0, batch.num_rows, 256):
                text = [main_text(x) for x in html.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, 256), batch.column(1).slice(a, 256), pa.array(text, pa.string())], ["page_id", "url", "text"]
                )

    return rows.mapInArrow(run, schema)
