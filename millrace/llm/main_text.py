"""Main text of web pages by tree scoring.

A page is read once into a tree of its block elements. Every paragraph passes points for its length and its commas to the elements
around it, less and less with the distance; an element's points are discounted by the share of its text that stands in links. The
best element and those of its siblings that hold running text are kept, without what is never the article: menus, headers,
footers, side bars, notices, adverts, forms, scripts, styles and comments. Tags, classes and ids tell of these only where the element
does not hold most of the page's running text: a wrapper may be named for what it stands beside, a form may hold the whole page, an
end tag may be missing, and what is shown without scripts may be the article. In an article, the id of a section, a heading or a
paragraph is an anchor and tells nothing (but `comments`), and a paragraph is no discussion of readers.

Defined results: null, empty and text-free pages give an empty text; broken markup is read as browsers do, roughly: end tags may be
missing, quotes may stay open, and a page may end anywhere; repeated rows are extracted on their own; a null id or url stays null;
an empty table gives an empty table; other columns are not read. A page may be of any length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, batch, mapped

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|title|textarea|template|iframe|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>?)""",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul head button select option".split()
)
PARAGRAPHS = frozenset("p pre li dd dt blockquote figcaption h1 h2 h3 h4 h5 h6 summary address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of these ends where one of the same kind begins in the same list, table or menu.
ENDS_BEFORE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_AT = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
NEVER = frozenset("button select option object svg canvas audio video map".split())
#: Left out like these, but for those that wrap the article; of the first ones it takes more to be a wrapper.
FRAMES = frozenset("nav header footer aside dialog menu".split())
WRAPPERS = FRAMES | frozenset("form fieldset label noscript".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments disqus reply replies discussion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login share sharing social related recommended widget pagination pager skip toolbar".split()
)
#: Names of what has running text of its own that is not the article.
TALK = frozenset("comment comments disqus reply replies discussion related recommended".split())
#: In an article these count in any attribute and for any tag.
READERS = frozenset("comment comments disqus".split())
ALWAYS = frozenset("html body article main".split())
#: Names that also begin names of other things: they count alone, at the end of a name, and before one of BOXES or of NEVER_NAMES.
ALSO_WORDS = frozenset("notice social related alert promo promotion discussion share sharing reply replies recommended menu modal banner skip ad".split())
BOXES = frozenset(
    "area bar block blocks board box boxes button buttons card cards container content dialog entry feed form frame group header icon icons inner item items label layer link links list message messages module panel popup post posts row section set slot strip text title tools top unit wrap wrapper zone".split()
)
SEPARATOR = re.compile(r"[\s_\-:]+")
#: Levels that a paragraph's points reach, and the least characters of a paragraph that gives points.
LEVELS, LEAST = 5, 25


class Open:
    """The open elements (tag, nearest block, whether it is left out, nearest of named), with the places of each tag and of the blocks,
    so that no step looks at more of them than it ends."""

    def __init__(self):
        self.stack: list[tuple[str, int, bool, int]] = [("html", 0, False, -1)]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.blocks = [0]

    @property
    def links(self) -> int:
        return len(self.places.get("a", ()))

    def push(self, element: tuple[str, int, bool, int]) -> None:
        k = len(self.stack)
        self.stack.append(element)
        self.places.setdefault(element[0], []).append(k)
        if element[0] in BLOCKS:
            self.blocks.append(k)

    def last(self, *tags: str) -> int:
        return max((held[-1] for t in tags if (held := self.places.get(t))), default=-1)

    def cut(self, k: int) -> None:
        """Ends the elements from the place k on."""
        for tag, *_ in self.stack[k:]:
            self.places[tag].pop()
        del self.stack[k:]
        while self.blocks[-1] >= k:
            self.blocks.pop()

    def make_room(self, name: str) -> None:
        """Ends what the start of a block element ends."""
        k = self.blocks[-1]
        tag = self.stack[k][0]
        if k and (tag == "p" or tag in HEADINGS and name in HEADINGS):
            self.cut(k)
        if name in ENDS_BEFORE:
            k = self.last(*ENDS_BEFORE[name])
            if k > max(0, self.last(*ENDS_AT[name])):
                self.cut(k)


class Tree:
    """Block elements of one page (parent, tag), and its blocks of text in page order, each in pieces.

    named has of each element that may be left out whether it is of TALK, whether it is of FRAMES, and the one around it (-1 for none);
    within of each block element the one around it. A piece knows the innermost one that it stands in, so that one reading of the page
    tells the texts with any of them left out.
    """

    def __init__(self, page: str):
        self.parent, self.tag, self.within, self.named = [-1], ["html"], [-1], []
        self._blocks: list[tuple[int, list[tuple[str, bool, int]]]] = []
        self._pieces: list[tuple[str, bool, int]] = []
        open_ = Open()
        at = 0
        for m in TOKEN.finditer(page):
            top = open_.stack[-1]
            if m.start() > at and not top[2]:
                self._pieces.append((page[at : m.start()], open_.links > 0, top[3]))
            at = m.end()
            name = m[3]
            if name is None:
                continue
            name = name.lower()
            if name == "br" or name == "hr" and m[2]:
                if self._pieces:
                    self._pieces.append((" ", False, self._pieces[-1][2]))
                continue
            if name in BLOCKS:
                self._end_block(top[1])
            if m[2]:
                k = open_.last(name)
                if k > 0 and (name in BLOCKS or k > open_.blocks[-1]) and (name not in PARAGRAPHS or k > open_.last("article", "main", "body", "table")):
                    open_.cut(k)
                continue
            if name in EMPTY:
                continue
            if name in ("html", "body", "head"):
                if name == "body":
                    open_.cut(1)
                continue
            if name in BLOCKS:
                open_.make_room(name)
                top = open_.stack[-1]
                self.parent.append(top[1])
                self.tag.append(name)
                self.within.append(top[3])
                node = len(self.tag) - 1
            else:
                node = top[1]
            attributes = m[4]
            out, inside = top[2] or name in NEVER, top[3]
            if not out and (name in WRAPPERS or len(attributes) > 4 and name not in ALWAYS):
                out, names = _left_out(attributes, name, open_.last("article", "main") > 0) if len(attributes) > 4 else (False, set())
                if not out and (names or name in WRAPPERS):
                    self.named.append((not TALK.isdisjoint(names), name in FRAMES, inside))
                    inside = len(self.named) - 1
            if not attributes.rstrip(">").endswith("/") or name in BLOCKS or name == "a":
                open_.push((name, node, out, inside))
        top = open_.stack[-1]
        if at < len(page) and not top[2]:
            self._pieces.append((page[at:], open_.links > 0, top[3]))
        self._end_block(top[1])

    def _end_block(self, node: int) -> None:
        if self._pieces:
            self._blocks.append((node, self._pieces))
            self._pieces = []

    def texts(self, out: list[bool] | None = None) -> list[tuple[int, str, int, int]]:
        """(element, text, characters in links, outermost of named in it) of each block with text, without the pieces in what is out."""
        found = []
        for node, pieces in self._blocks:
            if out is not None:
                pieces = [p for p in pieces if p[2] < 0 or not out[p[2]]]
            text = " ".join(html.unescape("".join([p[0] for p in pieces])).split())
            if text:
                found.append((node, text, min(sum(len(p[0]) for p in pieces if p[1]), len(text)), min(p[2] for p in pieces)))
        return found


def _left_out(attributes: str, tag: str, in_article: bool) -> tuple[bool, set[str]]:
    """Whether an element is hidden or has a role that is never the article's; and such names among its classes and id."""
    names = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in NEVER_ROLES:
            return True, names
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, names
        if name in ("class", "id"):
            anchor = in_article and name == "id" and (tag == "section" or tag in PARAGRAPHS)
            for whole in value.split():
                parts = SEPARATOR.split(whole)
                for part, then in zip(parts, [*parts[1:], ""], strict=True):
                    if part in NEVER_NAMES and (part not in ALSO_WORDS or not then or then in BOXES or then in NEVER_NAMES or then.isdigit()):
                        if part in READERS or not anchor and not (in_article and tag == "p" and part in TALK):
                            names.add(part)
    return False, names


def _gain(text: str, links: int, tag: str) -> float:
    """The points of a paragraph."""
    return 0.0 if len(text) < LEAST or tag in HEADINGS else (1 + text.count(",") + min(3, len(text) / 100)) * (1 - links / len(text))


def _read(page: str) -> tuple[Tree, list[tuple[int, str, int, int]]]:
    """The page and its texts without what is left out by name, but with named elements that wrap the article.

    Such an element has more than half of the page's running text (or, where there is none, an article element); nine tenths, if the
    main heading stands elsewhere. It holds an article element, or no text of such an element stands elsewhere. One of FRAMES holds an
    article element, or the main heading and nine tenths. What is named as talk has text of its own: it only counts as a wrapper if it
    holds the main heading, or if there is nothing else.
    """
    tree = Tree(page)
    every, n = tree.texts(), len(tree.named)
    if not n:
        return tree, every
    gain, headed, article = [0.0] * (n + 1), [False] * (n + 1), [False] * (n + 1)  # the last is for text outside of all
    body = [0] * (n + 1)  # blocks of text in article elements
    size = len(tree.tag)
    inside, filled = [False] * size, [False] * size  # whether an article element is around, and whether there is text
    for node in range(size):
        inside[node] = tree.tag[node] in ("article", "main") or tree.parent[node] >= 0 and inside[tree.parent[node]]
    for node, text, links, k in every:
        gain[k] += _gain(text, links, tree.tag[node])
        body[k] += inside[node]
        filled[node] = True
    for node in range(size - 1, -1, -1):
        if filled[node]:
            headed[tree.within[node]] |= tree.tag[node] in ("h1", "main")
            article[tree.within[node]] |= tree.tag[node] in ("article", "main")
            if tree.parent[node] >= 0:
                filled[tree.parent[node]] = True
    own, bodies = gain[:], body[:]
    for k in range(n - 1, -1, -1):
        up = tree.named[k][2]
        if up >= 0:
            gain[up] += gain[k]
            headed[up] |= headed[k]
            article[up] |= article[k]
    total, titled = sum(own), headed[-1] or article[-1]
    talk = [tree.named[k][0] and not headed[k] and (gain[k] < total - 1e-9 or titled or not total) for k in range(n)]
    for k in range(n):
        talk[k] |= tree.named[k][2] >= 0 and talk[tree.named[k][2]]
    rest, text = [0.0 if talk[k] else own[k] for k in range(n)], [0 if talk[k] else bodies[k] for k in range(n)]
    whole, all_text = sum(rest) + own[-1], sum(text) + bodies[-1]
    for k in range(n - 1, -1, -1):
        if tree.named[k][2] >= 0:
            rest[tree.named[k][2]] += rest[k]
            text[tree.named[k][2]] += text[k]

    def wraps(k: int) -> bool:
        if not whole or article[k]:
            return article[k] and rest[k] >= whole / 2
        if tree.named[k][1]:
            return headed[k] and text[k] == all_text and rest[k] > whole * 0.9
        return text[k] == all_text and rest[k] > whole * (0.9 if headed[-1] and not headed[k] else 0.5)

    out = []
    for k in range(n):
        up = tree.named[k][2]
        out.append(talk[k] or not wraps(k) or up >= 0 and out[up])
    return tree, tree.texts(out)


def main_text(page: str) -> str:
    """The blocks of the article, joined by line ends."""
    tree, blocks = _read(page)
    if not blocks:
        return ""
    n = len(tree.tag)
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    for node, text, links, _ in blocks:
        chars[node] += len(text)
        linked[node] += links
        gain = _gain(text, links, tree.tag[node])
        if not gain:
            continue
        up, level = (tree.parent[node] if tree.tag[node] in PARAGRAPHS else node), 1
        while up >= 0 and level <= LEVELS:
            points[up] += gain / level
            up, level = tree.parent[up], level + 1
    for k in range(n - 1, 0, -1):
        chars[tree.parent[k]] += chars[k]
        linked[tree.parent[k]] += linked[k]
    score = [p * (1 - linked[k] / chars[k]) * (1.5 if tree.tag[k] in ("article", "main") else 1) if chars[k] else 0.0 for k, p in enumerate(points)]
    best = max(range(n), key=lambda k: (score[k], k))
    if score[best] == 0:  # no running text: the article element if there is one, else the page
        best = max((k for k in range(n) if tree.tag[k] in ("article", "main") and chars[k]), key=lambda k: chars[k], default=0)
    up = best
    while up >= 0:  # an article holds its parts
        if tree.tag[up] == "article" and linked[up] < chars[up] / 2:
            best = up
            break
        up = tree.parent[up]
    keep = {best}
    least = max(10.0, 0.2 * score[best])
    for k in range(n):
        if k != best and tree.parent[k] == tree.parent[best] >= 0 and chars[k]:
            density = linked[k] / chars[k]
            if score[k] >= least or tree.tag[k] == "p" and chars[k] > 80 and density < 0.25 or tree.tag[k] in HEADINGS and k < best and density < 0.25:
                keep.add(k)
    inside = [False] * n
    for k in range(n):
        inside[k] = k in keep or tree.parent[k] >= 0 and inside[tree.parent[k]]
    return "\n".join(text for node, text, _, _ in blocks if inside[node])


def extract_main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""
    def extract(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(x or "") for x in b.column("html").to_pylist()]
            yield batch(page_id=b.column("page_id"), url=b.column("url"), text=pa.array(text, pa.string()), n_chars=np.array([len(x) for x in text], np.int64))

    picked = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    return picked.transform(mapped, extract, "page_id long, url string, text string, n_chars long", rows=500)
