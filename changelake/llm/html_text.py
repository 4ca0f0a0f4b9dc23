"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from
the root to it.  Text length and punctuation are summed per path and divided
by the path's blocks; both series are smoothed over the blocks in page order,
fused with the share of text outside links, and paths whose score reaches a
part of the heaviest path's score, or the score of a short paragraph, are
content wherever they stand.  Headings that open content, and short items
and paragraphs next to it, belong to it.

Only elements that HTML names for it are left out before the scores: menus,
page headers, footers, asides, buttons, hidden elements, their roles, and
forms that hold no more than half of the page's text.  Words of class or id
("sidebar", "share", "cookie", "comments") leave a path a tenth of its score.
They weigh nothing down where the element holds more than half of the page's
text (comments excepted).  Inside the content, which is an article or main
element or the innermost element with more than half of the text, they weigh
down no heading, paragraph, section, quote or table (a section of comments
excepted), and other elements only where a whole class or id is made of such
words ("share", "related-posts", not "social-structure").

The work grows with the page's length: elements and paths are kept as trees,
tags are found by their place among the open ones.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from math import exp, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, slices

OTHER_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S)
TAG_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
TAG_STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

# Fixed values of the HTML language.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
CLOSES = {  # an opening tag -> open elements that it ends, up to the nearest of the second set
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INSIDE = HEADINGS | {"li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption", "p"}
PARTS = INSIDE | {"ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "caption", "figure", "hgroup"}
SECTIONS = {"section", "article", "main", "header"}
ROOTS = {"html", "body"}

# What is not content: elements, roles, and words of class or id.
BOILER_TAGS = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "input", "option"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}
FORMS = {"form", "fieldset"}
BOILER_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "consent", "cookie",
    "cookies", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "notification", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENT_WORDS = {"comment", "comments", "disqus", "replies", "respond"}
NEUTRAL_WORDS = {
    "area", "bar", "block", "box", "button", "buttons", "container", "content", "form", "group", "icons", "inner", "item", "items", "links",
    "list", "main", "outer", "panel", "post", "posts", "section", "site", "top", "bottom", "left", "right", "widget", "wrap", "wrapper",
}
PLAIN_TAGS = {"html", "body", "main", "article"}
TEXT_TAGS = HEADINGS | {"p", "section", "blockquote", "pre", "figure", "figcaption", "table", "tbody", "thead", "tr", "td", "th", "dl", "dt", "dd"}

CONTENT_PART = 0.25
PROSE_SCORE = 10.0  # about a paragraph of 90 characters with one mark: no path needs more
LINK_PART = 0.5
SMOOTH_RADIUS = 1
WORD_WEIGHT = 0.1  # what class or id words leave of a path's score


class Path:
    """A path of block elements from the root, one object for each different one; ``jump`` leads far up."""

    __slots__ = ("parent", "label", "tag", "depth", "jump", "below")

    def __init__(self, parent: Path | None, label: str, tag: str):
        self.parent, self.label, self.tag, self.below = parent, label, tag, {}
        self.depth = parent.depth + 1 if parent else 0
        if parent is None:
            self.jump = self
        else:
            up = parent.jump
            self.jump = up.jump if parent.depth - up.depth == up.depth - up.jump.depth else parent

    def child(self, label: str, tag: str) -> Path:
        if label not in self.below:
            self.below[label] = Path(self, label, tag)
        return self.below[label]

    def up_to(self, depth: int) -> Path:
        """The path's first ``depth`` elements."""
        node = self
        while node.depth > depth:
            node = node.jump if node.jump.depth >= depth else node.parent
        return node

    def shared(self, other: Path) -> Path:
        """The longest common start of two paths."""
        depth = min(self.depth, other.depth)
        x, y = self.up_to(depth), other.up_to(depth)
        while x is not y:
            x, y = (x.jump, y.jump) if x.jump is not y.jump else (x.parent, y.parent)
        return x


class Block:
    """A block of text; ``element`` is the innermost open element, ``damped`` the weight that words leave it."""

    __slots__ = ("text", "path", "tag", "links", "boiler", "element", "damped")

    def __init__(self, text, path, tag, links, boiler, element):
        self.text, self.path, self.tag, self.links, self.boiler, self.element, self.damped = text, path, tag, links, boiler, element, False


class Element:
    """An open element; ``boiler`` rules it out with all it holds, ``flag`` weighs it down under conditions:
    by its mass (MASS), by mass and place (PLACE), by place alone (COMMENT), or always (COMMENTS)."""

    __slots__ = ("tag", "path", "number", "boiler", "flag", "form")

    def __init__(self, tag, path, number, boiler=False, flag=0, form=False):
        self.tag, self.path, self.number, self.boiler, self.flag, self.form = tag, path, number, boiler, flag, form


MASS, PLACE, COMMENT, COMMENTS = 1, 2, 3, 4


def _describe(tag: str, attrs: str, above: Path, in_content: bool, number: int, boiler: bool) -> Element:
    """An element with its path, whether its name or role rules it out, and what its words say."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attrs)} if attrs.strip(" /") else {}
    names = html.unescape(f"{found.get('class', '')} {found.get('id', '')}")
    words = {w.lower() for w in WORD.findall(names)}
    role = found.get("role", "").lower()
    boiler = (boiler or tag in BOILER_TAGS or role in BOILER_ROLES or "hidden" in found
              or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
              or (tag == "header" and not in_content))
    flag = 0
    if tag not in PLAIN_TAGS and words & (BOILER_WORDS | COMMENT_WORDS):
        free = _is_free(tag, names)
        if words & COMMENT_WORDS and not (free and in_content):
            flag = COMMENT if free else COMMENTS
        elif words & BOILER_WORDS and not (in_content and (free or words & BOILER_WORDS == {"header"})):
            flag = PLACE if free else MASS
    path = above if tag in INLINE else above.child(".".join([tag, *sorted(names.split())]), tag)
    return Element(tag, path, number, boiler, flag, tag in FORMS or role == "form")


def _is_free(tag: str, names: str) -> bool:
    """Whether words of its class and id say nothing about an element inside the content."""
    tokens = [{w.lower() for w in WORD.findall(t)} for t in names.split()]
    if tag in TEXT_TAGS:
        return tag != "section" or not any(t & COMMENT_WORDS and t <= COMMENT_WORDS | NEUTRAL_WORDS for t in tokens)
    named = BOILER_WORDS | COMMENT_WORDS
    return not any(t & named and t <= named | NEUTRAL_WORDS for t in tokens)


class _Open:
    """The open elements, and where each tag stands among them."""

    def __init__(self):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.solid: list[int] = []  # places of elements that are not inline

    def last(self, tags) -> int:
        """The innermost place of any of the tags (-1: none is open)."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.stack))
        if element.tag not in INLINE:
            self.solid.append(len(self.stack))
        self.stack.append(element)

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag not in INLINE:
                self.solid.pop()


class _Tags:
    """Markup from a place on; every character is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.plain = page, False

    def at(self, lt: int) -> tuple[int, bool, str, str] | None:
        """``(end, closing, tag, attributes)`` of the markup at ``lt``; the tag is empty for a comment or declaration."""
        page = self.page
        m = OTHER_MARKUP.match(page, lt)
        if m:
            return m.end(), False, "", ""
        m = TAG_START.match(page, lt)
        if not m:
            return None
        end = self._end(m.end())
        return min(end + 1, len(page)), bool(m[1]), m[2].lower(), page[m.end():end]

    def _end(self, at: int) -> int:
        """Where the tag's ``>`` stands outside quoted values, or the next one if quotes do not pair up."""
        place = at
        while not self.plain:
            m = TAG_STOP.search(self.page, place)
            if m is None:
                # a quote is open to the end of the page: from here on quotes mean nothing
                self.plain = True
                break
            if m[0] == ">":
                return m.start()
            close = self.page.find(m[0], m.end())
            if close < 0:
                self.plain = True
                break
            place = close + 1
        end = self.page.find(">", at)
        return len(self.page) if end < 0 else end


def blocks(page: str) -> tuple[list[Block], list[int], list[Element]]:
    """The blocks of text of a page, in order, and its elements: the number of each one's parent, and the elements."""
    out: list[Block] = []
    root = Element("", Path(None, "", ""), 0)
    parents, elements = [0], [root]
    opened, tags = _Open(), _Tags(page)
    pieces: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            inner = opened.stack[-1] if opened.stack else root
            out.append(Block(text, inner.path, inner.path.tag, min(linked, len(text)), inner.boiler, inner.number))
        pieces.clear()
        linked = 0

    while at < len(page):
        lt = page.find("<", at)
        m = tags.at(lt) if lt >= 0 else None
        stop = len(page) if lt < 0 else (lt + 1 if m is None else lt)
        if stop > at:
            pieces.append(page[at:stop])
            if opened.places.get("a"):
                linked += len(html.unescape(page[at:stop]).strip())
        at = stop
        if m is None or lt < 0:
            continue
        at, closing, tag, attrs = m
        if not tag:
            continue
        if closing:
            place = opened.last((tag,))
            if tag not in INLINE:
                flush()
            if place >= 0 and (tag not in INLINE or not opened.solid or opened.solid[-1] < place):
                opened.cut(place)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES:
                ended, scope = CLOSES[tag]
                place = opened.last(ended | {"p"})
                if place > opened.last(scope):
                    opened.cut(place)
            elif opened.solid and opened.stack[opened.solid[-1]].tag == "p":
                opened.cut(opened.solid[-1])
        if not attrs.rstrip().endswith("/") or tag not in INLINE:
            above = opened.stack[-1] if opened.stack else root
            in_content = bool(opened.places.get("article") or opened.places.get("main"))
            element = _describe(tag, attrs, above.path, in_content, len(elements), above.boiler)
            parents.append(above.number)
            elements.append(element)
            opened.push(element)
    flush()
    return out, parents, elements


def _smooth(values: list[float], radius: int = SMOOTH_RADIUS) -> list[float]:
    weights = [exp(-(d * d) / 2) for d in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        total = scale = 0.0
        for d, w in zip(range(-radius, radius + 1), weights):
            if 0 <= i + d < len(values):
                total += w * values[i + d]
                scale += w
        out.append(total / scale)
    return out


def path_scores(found: list[Block]) -> tuple[dict[Path, float], dict[Path, float]]:
    """Fused score of each path, smoothed and from its own blocks alone; words weigh a path down by their share of its text."""
    length, marks, links, count, damped = (defaultdict(int) for _ in range(5))
    for b in found:
        length[b.path] += len(b.text)
        marks[b.path] += len(PUNCTUATION.findall(b.text))
        links[b.path] += b.links
        count[b.path] += 1
        damped[b.path] += b.damped * len(b.text)
    weight = {p: (1 - links[p] / n) * (1 - (1 - WORD_WEIGHT) * damped[p] / n) for p, n in length.items()}
    by_length = _smooth([length[b.path] / count[b.path] for b in found])
    by_marks = _smooth([(marks[b.path] + 0.1) / count[b.path] for b in found])
    fused = defaultdict(float)
    for b, x, y in zip(found, by_length, by_marks):
        fused[b.path] += sqrt(x * y) / count[b.path] * weight[b.path]
    own = {p: sqrt(length[p] * (marks[p] + 0.1)) / count[p] * weight[p] for p in length}
    return fused, own


def _judge(found: list[Block], parents: list[int], elements: list[Element]) -> list[Block]:
    """The blocks outside forms (a form with more than half of the text is none), those that words weigh down marked."""
    comment, flagged = [False] * len(elements), False
    for n, e in enumerate(elements):
        comment[n] = comment[parents[n]] or e.flag >= COMMENT
        flagged |= bool(e.flag) or e.form
    if not flagged:
        return found
    mass = [0] * len(elements)
    for b in found:
        if not comment[b.element]:
            mass[b.element] += len(b.text)
    # an element's number is larger than its parent's
    for n in range(len(elements) - 1, 0, -1):
        mass[parents[n]] += mass[n]
    total = mass[0]
    # the innermost block element with more than half of the text (0: the page itself)
    core = max((n for n, e in enumerate(elements) if n and e.tag not in INLINE and e.tag not in ROOTS and 2 * mass[n] > total), default=0)
    inside = [not core] * len(elements)
    out, low = [False] * len(elements), [False] * len(elements)
    for n, e in enumerate(elements[1:], 1):
        up = parents[n]
        inside[n] = inside[up] or n == core
        large = 2 * mass[n] > total
        out[n] = out[up] or e.form and not large
        low[n] = low[up] or bool(e.flag) and not (e.flag < COMMENT and large or e.flag in (PLACE, COMMENT) and n > core and inside[n])
    for b in found:
        b.damped = low[b.element]
    return [b for b in found if not out[b.element]]


def main_text(page: str | None) -> str:
    """The article of a page: its content blocks, joined by newlines (none: empty)."""
    found, parents, elements = blocks(page or "")
    found = _judge([b for b in found if not b.boiler], parents, elements)
    if not found:
        return ""
    scores, own = path_scores(found)
    weight, order = defaultdict(float), {}
    for b in found:
        weight[b.path] += scores[b.path] * len(b.text)
        order.setdefault(b.path, len(order))
    main = max(weight, key=lambda p: (weight[p], -order[p]))
    limit = min(CONTENT_PART * scores[main], PROSE_SCORE)
    # the smoothing alone must not carry a short block, such as a credit line, that stands beside long ones
    paths = {p for p in weight if scores[p] >= limit and own[p] >= limit} | {main}
    chosen = [b.path in paths and (b.links <= LINK_PART * len(b.text) or b.path is main) and b.tag not in HEADINGS for b in found]
    if not any(chosen):
        chosen = [b.path is main for b in found]
    return "\n".join(b.text for b, keep in zip(found, _with_near(found, chosen)) if keep)


def _container(path: Path) -> Path:
    """The path without the paragraph, list, quote, table or heading that it ends in."""
    while path.parent and path.tag in PARTS:
        path = path.parent
    return path


def _rooted(path: Path) -> bool:
    return not path.parent or path.tag in ROOTS


def _belongs(block: Block, content: Block, beside: bool) -> bool:
    """Whether a block that does not score on its own goes with the nearest one that is kept."""
    own, other = _container(block.path), _container(content.path)
    heading = block.tag in HEADINGS
    if own is other or own is content.path.up_to(own.depth) and (heading or not _rooted(own)):
        return True
    shared = own.shared(other)
    if shared.depth < other.depth and _rooted(shared):
        return False
    return heading and beside or all(_sections(p, shared) for p in (own, other))


def _sections(path: Path, top: Path) -> bool:
    """Whether only sections stand between a path and its start ``top``."""
    while path is not top:
        if path.tag not in SECTIONS:
            return False
        path = path.parent
    return True


def _with_near(found: list[Block], chosen: list[bool]) -> list[bool]:
    """``chosen`` with the headings before kept blocks, and the short items and paragraphs next to them."""
    keep = list(chosen)
    near = [b.tag in INSIDE and b.links <= LINK_PART * len(b.text) and not b.damped for b in found]
    forward, back = range(len(found)), range(len(found) - 1, -1, -1)
    for order, headings in ((forward, False), (back, True), (forward, False)):
        last = None
        for i in order:
            if last is not None and not keep[i] and near[i] and (headings or found[i].tag not in HEADINGS):
                keep[i] = _belongs(found[i], found[last], abs(i - last) == 1)
            if keep[i]:
                last = i
    return keep


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> ``(page_id, url, text, n_chars)``, one row per input row.

    A NULL or empty page, or one without content, has an empty text; broken
    markup is read as far as it goes; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_arrow(narrow, run, "page_id long, url string, text string, n_chars long")
