"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into flat blocks at block-level tags. A block's features are its word count and
link density, those of its two neighbours, and element facts: heading, list item, within an article, within
navigation and the like by element or role, after the page's first heading, whether the page marks an
article at all, and whether a word of an enclosing element's class or id is one of ``NAMES``. Six more tell without
names what is set apart from running text: whether a box (``div``, ``section``) among paragraphs holds the block, the
box's share of the words there, whether it has a class or id of its own, whether it has a heading, how many boxes
without a heading are alike (element and class) around, beside or in it, as comments of readers are, and whether the block stands
in the box of the page's first heading. A decision
tree over all of them is trained on ``LABELLED``, a small table of page layouts with a label for every block, filled with
words of varying number, and decides which blocks are main text.

Script, style, form controls, comments and markup never become text. Character references
are decoded, white space inside a block becomes one space, blocks are joined by two newlines.

Defined cases: null or empty html gives an empty text; a page cut off inside a tag loses that tag
only; broken quotes end at the next ``>``; repeated rows are each returned; null ids and urls stay; a dropped
element without its end tag loses only that tag, but script, style, textarea, title and iframe run to the end of the page; an empty
table gives no rows; other columns are ignored. Each page is one row from start to end: nothing is
shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Elements that are dropped with all they hold; the first ones run to the end of the page where they are not closed.
_RAW = "script|style|textarea|title|iframe"
_SHORT, _LONG = "svg|select|datalist|button", "object|video|audio|canvas"
#: What the others can't hold: there, one that was never closed ends.
_BEYOND = "article|section|main|div|body|nav|footer|header|aside|form|ul|ol|table|h[1-6]"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?:{_SHORT}|{_LONG})\b[^>]*+(?<=/)>|<(?P<short>{_SHORT})\b[^>]*+>(?:(?!</?(?:{_BEYOND}|p)\b).)*?</(?P=short)\s*>"
    rf"|<(?P<long>{_LONG})\b[^>]*+>(?:(?!</?(?:{_BEYOND})\b).)*?</(?P=long)\s*>"
    r"|<(?:noscript|template)\b[^>]*+>(?:(?!<(?:noscript|template)\b).)*?</(?:noscript|template)\s*>"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/a-z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose nesting counts for where a block stands.
_AREAS = frozenset("html head body nav header footer aside form dialog menu article main section div ul ol table details address figure blockquote span".split())
#: Those of them that group blocks; within lists, quotations and the like blocks count as standing around these.
_BOXES = frozenset("html body header footer nav aside form dialog article main section div".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOILER_TAGS = frozenset("head nav footer aside form dialog menu".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id names of parts that no element tells, and words that make a name one of a state of the page.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner comment comments respond responses discussion disqus"
    " cookie cookies consent gdpr notice newsletter subscribe sidebar related recommended share sharing social breadcrumb breadcrumbs pagination popup".split()
)
STATES = frozenset("has with without no not is open closed enabled disabled js".split())
_NAME_WORD = re.compile(r"[a-z]+")
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


@dataclass
class Block:
    """A flat block: its text and the facts that the tree sees."""

    text: str = ""
    words: int = 0
    link_words: int = 0
    heading: bool = False
    item: bool = False
    outside: bool = False
    article: bool = False
    named: bool = False
    at: int = 0
    boxed: bool = False
    share: float = 1.0
    own_name: bool = False
    box_headed: bool = False
    alike: int = 0
    with_head: bool = False

    @property
    def link_density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


@dataclass
class _Area:
    name: str
    outside: bool = False
    article: bool = False
    named: bool = False
    said: str = ""
    at: int = 0


@dataclass
class _Box:
    """An element that groups blocks; ``direct`` paragraphs stand in it and in no box within."""

    parent: int
    name: str
    said: str
    words: int = 0
    direct: int = 0
    headed: bool = False


@dataclass
class _State:
    areas: list[_Area] = field(default_factory=lambda: [_Area("")])
    parts: list[tuple[str, bool]] = field(default_factory=list)
    links: int = 0
    heading: bool = False
    item: bool = False


def _entered(name: str, attrs: str, outer: _Area) -> _Area:
    said = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)} if attrs else {}
    article = outer.article or name in ("article", "main") or said.get("role") in ("main", "article")
    hidden = "hidden" in said or said.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", said.get("style", "")))
    outside = name in _BOILER_TAGS or said.get("role") in _BOILER_ROLES or hidden or (name == "header" and not outer.article)
    names = f"{said.get('class', '')} {said.get('id', '')}".strip()
    # The page's own frame may be named after what it holds.
    named = name not in ("html", "body", "main") and (name != "article" or outer.article) and any(_names_a_part(n) for n in names.split())
    return _Area(name, outer.outside or outside, article, outer.named or named, names)


def _names_a_part(name: str) -> bool:
    words = _NAME_WORD.findall(name)
    return not NAMES.isdisjoint(words) and STATES.isdisjoint(words)


def _set_apart(found: list[Block], boxes: list[_Box]) -> None:
    """Fills in what the boxes of a page tell about its blocks."""
    for b in found:
        box = boxes[b.at]
        box.words += b.words
        box.headed |= b.heading
        box.direct += not (b.heading or b.item) and b.link_density < 0.5
    alike: dict[tuple[int, str, str], int] = {}
    for k in range(len(boxes) - 1, 0, -1):
        box = boxes[k]
        outer = boxes[box.parent]
        outer.words += box.words
        outer.headed |= box.headed
        if box.words and not box.headed and box.name in ("div", "section"):
            key = box.parent, box.name, box.said
            alike[key] = alike.get(key, 0) + 1
    most = [0] * len(boxes)
    for (k, _, _), n in alike.items():
        most[k] = max(most[k], n)
    # The box that sets a block apart: the outermost one below the article that stands among paragraphs.
    apart, around = [-1] * len(boxes), [0] * len(boxes)
    head = next((b.at for b in found if b.heading and not b.outside), -1)
    head = boxes[head].parent if head > 0 and boxes[head].name == "header" else head
    under = [k == head for k in range(len(boxes))]
    for k, box in enumerate(boxes[1:], 1):
        outer = boxes[box.parent]
        under[k] |= under[box.parent]
        around[k] = max(around[box.parent], alike.get((box.parent, box.name, box.said), 0))
        if box.name in ("div", "section"):
            apart[k] = k if apart[box.parent] < 0 and outer.direct >= 2 else apart[box.parent]
    for b in found:
        k = apart[b.at]
        b.alike, b.with_head = max(around[b.at], most[b.at]), under[b.at]
        if k >= 0:
            box = boxes[k]
            b.boxed, b.own_name, b.box_headed = True, bool(box.said), box.headed
            b.share = box.words / max(1, boxes[box.parent].words)
            b.alike = max(b.alike, most[k])


def blocks(page: str) -> list[Block]:
    """The flat blocks of a page, in order, boilerplate included."""
    state, out, at = _State(), [], 0
    boxes = [_Box(0, "", "")]

    def close() -> None:
        if state.parts:
            text = " ".join("".join(t for t, _ in state.parts).split())
            if text:
                linked = " ".join("".join(t if link else " " for t, link in state.parts).split())
                area = state.areas[-1]
                out.append(Block(text, text.count(" ") + 1, linked.count(" ") + 1 if linked else 0, state.heading, state.item, area.outside, area.article, area.named, area.at))
            state.parts.clear()

    def said(raw: str) -> None:
        if raw:
            state.parts.append((html.unescape(raw), state.links > 0))

    for m in _TOKEN.finditer(page):
        said(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        end = bool(m["end"])
        if name == "a":
            state.links = 0 if end else 1
        elif name == "br":
            state.parts.append((" ", False))
        if name in _INLINE and name != "span":
            continue
        if name != "span" or (not end and m["attrs"]):
            if name != "span":
                close()
        if end:
            if name in _AREAS and any(x.name == name for x in state.areas[1:]):
                while state.areas.pop().name != name:
                    pass
        elif name in _AREAS and name not in _VOID and not m["attrs"].endswith("/"):
            outer = state.areas[-1]
            inner = _entered(name, m["attrs"], outer) if name != "span" else _Area(name, outer.outside, outer.article, outer.named)
            inner.at = outer.at
            if name in _BOXES:
                boxes.append(_Box(outer.at, name, inner.said))
                inner.at = len(boxes) - 1
            state.areas.append(inner)
        if name != "span":
            state.links = state.links if name in ("div", "section") else 0
            state.heading = name in _HEADINGS and not end
            state.item = name in ("li", "dt", "dd", "td", "th") and not end or (state.item and not end and name == "p")
    said(page[at:])
    close()
    _set_apart(out, boxes)
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "item", "outside", "article", "named", "headed", "marked", "boxed", "share", "own_name", "box_headed", "alike", "with_head")


def features(page: list[Block]) -> np.ndarray:
    """One row per block; a missing neighbour has no words and no links."""
    edge, headed, marked = Block(), False, any(b.article for b in page)
    rows = []
    for before, own, after in zip([edge, *page[:-1]], page, [*page[1:], edge]):
        headed |= own.heading and not own.outside
        rows.append([own.words, own.link_density, before.words, before.link_density, after.words, after.link_density, own.heading, own.item, own.outside, own.article, own.named, headed, marked, own.boxed, own.share, own.own_name, own.box_headed, own.alike, own.with_head])
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


#: Layouts of pages. A letter after ``+`` (main text) or ``-`` (not) stands for a block: p long and s short
#: paragraph, h heading, i list item, m paragraph with a link in it, k short link, l linked paragraph, t line in a box, b bare
#: text of any length. The classes x, y and z stand for any name that tells nothing.
LABELLED = (
    "<nav><ul>-k-k-k</ul></nav><div>-t</div><article>+h+p+s+p+m+p</article><footer>-t</footer>",
    "<nav><ul>-k-k-k-k</ul></nav><div>-p</div><article>+h+s+p+p+s</article><footer>-p</footer>",
    "<header>-t</header><main>+h+p+m<ul>+i+i+i</ul>+s</main><footer>-s</footer>",
    "<header>-h-t</header><article>+h</article><footer>-t</footer>",
    "<div>-t-k</div><article><header>+h+s</header>+p+l+p<blockquote>+s</blockquote>+p</article><aside>-h-p-p</aside>",
    "<article>+s+s+s+p</article><div>-h<ul>-k-k-k</ul></div><div>-p</div>",
    "<article>+h+p<form>-p-s</form>+p</article><aside>-p</aside><div>-k-k</div>",
    "<article>+h+p+p<section class=comments>-h-p-s-p</section></article><div class=sidebar>-p-k</div>",
    "<article>+h+p<div class=ad>-t</div>+p+s<div class=share>-k-k</div></article>",
    "<div><ul>-k-k-k</ul></div><div>+h+p+s+p+p</div><div>-k-k-k</div><div>-k</div>",
    "<div>-t</div><ul>-k-k-k-k</ul><div>+h+p+p+s+p</div><div>-k-k</div><footer>-p</footer>",
    "<div>-p</div><div>+h+p+m+s+p</div><div>-k-k-k-k</div>",
    "<div>-s</div><div>+h+p+p</div><ul>-k-k-k</ul>",
    "<ul>-k-k-k</ul>+p+p+s+p<div>-k-k</div>",
    "<ul>-k-k</ul>+p+s+s+p+m<ul>-k-k-k</ul><footer>-t</footer>",
    "<div>-k-k-k</div><div>+h+p<ul>+i+i+i+i</ul>+p</div><div>-h-k-k-k</div>",
    "<div>-k-k-k</div><div>+h+s+p+l+p</div><div>-h-k-k-k-k</div><div>-k</div>",
    "<div role=dialog>-p-s</div><div>+h+p+p</div><div id=comments>-h-p-s-p</div>",
    "<div class=cookie-notice>-p</div><ul>-k-k</ul><div>+h+p+s+p</div><div class=related>-h-l-l</div>",
    "<div>-k-k-k</div>+p+s+p<div>-k-s-k</div>",
    "<div>-k-s-k-k</div><div>+h+p+s+p</div><div>-k-s-k-k</div>",
    "<article>+h+p+s</article>", "<article>+p</article>", "<article>+s</article>", "<main>+h+m+s</main>", "<article>+l+p</article>", "<article>+h+p+l</article>",
    "<nav>-k-k-k</nav><article>+h+s</article>", "<div>-t</div><article>+p+s+p</article>", "<div class=cookie-notice>-p</div><main>+h+m</main>", "<div>-p</div><article>+h+s+p</article>",
    "<div>-t</div><article>+h+s+s</article><footer>-t</footer>", "<nav>-k</nav>", "<nav><ul>-k-k-k</ul></nav><footer>-p</footer>", "<aside>-p</aside><article>+s+p+i+i</article>",
    "<div>+h+p+s</div>", "<div>+h+p+p+s</div>", "<div>-k-k-k</div><div>+h+p+s</div>", "<div>-k-k-k</div><div>+p+p+s</div><footer>-p</footer>", "<p>-k-k-k</p>", "<article>+s+l+s</article><div>-k-k</div>",
    # Set apart within running text: adverts, notices, comments.
    "<article>+h+p<div class=x>-b</div>+p+s</article>", "<article>+h+p+s<div class=x>-s</div>+p+p+s</article>", "<article>+h+p+p+s<div class=x>-p</div></article>",
    "<article><div class=x>-p</div>+h+p+s+p</article>", "<article><div class=x>-b</div>+h+p+p+p</article>", "<nav>-k-k</nav><article><div class=x>-s-k</div>+h+p+p</article>",
    "<article>+h+p+p<section class=x>-h<div class=y>-s-p</div><div class=y>-s-p</div><div class=y>-s-s</div></section></article>",
    "<article>+h+p+s+p<div class=x><div class=y>-p</div><div class=y>-s</div><div class=y>-p</div></div></article>",
    "<article>+h+p+s+p<div class=x>-s-p</div><div class=x>-s-s</div><div class=x>-s-p</div><div class=x>-t-p</div></article>",
    "<div>+h+p+s+p<div class=x>-h<div class=y>-s-p</div><div class=y>-s-p</div></div></div>", "<div>+h+p+p<div class=x>-b</div>+p</div>", "<div>+h+p+p+s<div class=x><div class=y>-p</div><div class=y>-p</div><div class=y>-s</div></div></div>",
    "<div>-k-k</div><div>+h+p+p<div class=comments>-p-s</div></div>", "<div>+h+p+p</div><div class=comments>-h<div class=comment>-s-p</div><div class=comment>-s-p</div></div>",
    "<article>+h+p</article><div class=comments><div>-s-p</div><div>-p</div></div>", "<article>+h+p+p<div class=ad>-p</div></article>", "<article>+p<div class=ad>-b</div>+p<div class=comments>-s<div>-p</div></div></article>",
    "<div class=ad>-b</div><div>+h+p+p</div>", "<div>+h+p<div class=ad>-b</div>+p</div><div class=comments>-p</div>", "<div>+p+p</div><div class=ad>-p</div>",
    # Comments beside the text.
    "<nav>-k-k</nav><div>+h+p+s+p</div><section class=x>-h<div class=y>-p</div><div class=y>-p</div><div class=y>-s</div></section><footer>-t</footer>", "<nav>-k-k</nav><div>+h+p+s+p</div><div class=x><div class=y>-s-p</div><div class=y>-s-p</div></div><footer>-t</footer>",
    "<nav>-k-k</nav><div>+h+p+s+p</div><div class=x>-s-p</div><div class=x>-p-s</div><div class=x>-t-s</div><footer>-t</footer>", "<nav>-k</nav><div>+h+p+s+p</div><div class=x>-p</div><footer>-t</footer>", "<nav>-k</nav><div>+h+p+s+s</div><div class=x>-s-s</div><footer>-s</footer>",
    "<nav>-k-k</nav><article>+h+p+s+p</article><section class=x>-h<div class=y>-s-p</div><div class=y>-s-p</div></section><footer>-t</footer>", "<nav>-k-k</nav><article>+h+p+s+p</article><div class=x>-s-s</div><div class=x>-p-p</div><footer>-t</footer>", "<nav>-k</nav><article>+h+p+s+p</article><div class=x>-t-s</div><footer>-t</footer>",
    "<nav>-k</nav><div>+h</div><div>+p+p+s+p</div><footer>-t</footer>", "<div>+h</div><div>+p+s+p+p</div>", "<div>-k-k</div><div>+h+s</div><div>+p+p+s+p</div>",
    "<nav>-k-k</nav><div>+h+p+s+p</div><div class=x>-s-p</div><footer>-s</footer>", "<nav>-k-k</nav><div>+h+p+p+s</div><div class=x>-t-p</div><footer>-t</footer>",
    # Outside by element, in articles without a heading too.
    "<article>+s<form>-p-s</form>+s</article><aside>-p</aside>", "<article>+s<div hidden>-p</div></article>", "<article>+p<div hidden>-p-s</div>+s</article>", "<main>+p<aside>-p</aside>+p</main>", "<main>+s<form>-s</form>+p</main>", "<article>+s+p<aside>-s-p</aside>+s</article>",
    # Lists of links with a line to each.
    "<article>+h+p+p<ul>-k-s-k-s-k</ul>+p</article>", "<div>+h+p+s<ul>-k-s-k-s-k</ul></div>", "<article>+h+s+p<ul>-k-k-s</ul>+p+s</article>", "<article>+h+p+s<ul>-k-s-k-s</ul>+p+s</article>",
    "<article>+h+p<ul>+i+i+i</ul>+s+p+s</article>", "<article>+h+p+s+s+h+s+p</article>", "<main>+h+p+s<ul>+i+i</ul>+s<ul>+i+i+i</ul>+s</main>", "<article>+h+p<div class=x>-l</div>+s+p</article>", "<main>+h+p+i+i<div class=x>-l</div>+s+p</main>", "<div>+h+p+p<div class=x>-l</div>+s+s</div>", "<div>-p</div><div>+h+p+p+s</div>", "<div>-p</div><div>+h+p+s</div>",
    # Not set apart: bare text, sections, plain boxes of the article.
    "<article>+b+p+p</article>", "<article><div>+b</div>+p+p</article>", "<article>+h<div>+b+p+s+p</div></article>", "<div>+h+b+p+p</div>", "<div>+b+p+p+s</div>", "<div>-k-k-k</div><div>+b+p+p</div>", "<nav>-k</nav><div>+b+p+s+p</div><footer>-t</footer>",
    "<article>+h+p+p<section class=x>+h+p+p</section><section class=x>+h+p+s</section></article>", "<article>+h+p+s<section>+h+p+p</section><section>+h+s+p+p</section></article>",
    "<article>+h+p+s<div>+p</div>+p+s</article>", "<article>+s+p<div>+b</div>+p+s</article>", "<article>+h<div class=x>+p+p+s</div></article>", "<article>+h+s+s<div class=x>+p+p+s+p+p+p</div></article>", "<div class=x>+h<div class=y>+p+p+s+p</div></div>",
    "<article>+h<div class=y>+p</div><div class=y>+p</div><div class=y>+s</div></article>", "<article>+h+s<div>+p+p</div><div>+s+p</div></article>",
)
_FORMS = {
    "p": ("<p>{}</p>", 9, 60), "s": ("<p>{}</p>", 1, 8), "h": ("<h2>{}</h2>", 1, 12), "i": ("<li>{}</li>", 1, 12), "m": ("<p>{} <a href=x>{}</a> {}</p>", 3, 20),
    "k": ("<li><a href=x>{}</a></li>", 1, 4), "l": ("<p><a href=x>{}</a></p>", 5, 14), "t": ("<div>{}</div>", 3, 14), "b": ("{} ", 3, 40),
}
_BLOCK = re.compile(r"([+-])([pshimkltb])(?![a-z])")


def labelled_table(copies: int = 10, seed: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1: main text) of all blocks of ``LABELLED``, each layout filled ``copies`` times."""
    rng = np.random.default_rng(seed)

    def filled(m: re.Match) -> str:
        form, low, high = _FORMS[m[2]]
        texts = [" ".join(["word"] * int(rng.integers(low, high + 1))) for _ in range(form.count("{}"))]
        texts[0] = m[1] + texts[0]
        return form.format(*texts)

    xs, ys = [], []
    for layout in LABELLED:
        for _ in range(copies):
            found = blocks(re.sub(r"(?<=[>pshimkltb])" + _BLOCK.pattern + r"|^" + _BLOCK.pattern, lambda m: filled(_BLOCK.fullmatch(m[0])), layout))
            xs.append(features(found))
            ys += [b.text[0] == "+" for b in found]
    return np.concatenate(xs), np.array(ys, int)


class Tree:
    """A binary decision tree by Gini impurity: nodes are (feature, threshold, low, high) or a label."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 3):
        self.root = self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int):
        label = int(2 * y.sum() >= len(y))
        if depth == 0 or len(set(y.tolist())) < 2 or len(y) < 2 * least:
            return label
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                n = low.sum()
                if min(n, len(y) - n) < least:
                    continue
                p, q = y[low].mean(), y[~low].mean()
                impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, f, float(cut), low
        if best is None:
            return label
        _, f, cut, low = best
        below, above = self._grow(x[low], y[low], depth - 1, least), self._grow(x[~low], y[~low], depth - 1, least)
        return below if below == above and isinstance(below, int) else (f, cut, below, above)

    def predict(self, row: np.ndarray) -> int:
        node = self.root
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if tree.predict(row))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    tree = Tree(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(x.as_py(), tree) for x in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
