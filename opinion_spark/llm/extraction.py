"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_SHARE = 0.1    # of the best path's fused ratio that a content path has
LEAST_MARKED = 0.01  # the same inside elements that the page marks as its article
NEAR = 0.5           # weight of a path for each step that it is farther than a sibling

# Elements that are skipped as raw text, and those whose text is no text of the page.
RAW = {"script", "style", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
UNSEEN = {"noscript", "template", "object", "svg", "select", "canvas", "audio", "video", "datalist"}
# Elements and roles that a page uses for anything but its article.
ASIDE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert",
         "alertdialog"}
# Words of class and id that say the same of an element without a telling name.
LABELS = {"ad", "ads", "adbox", "adsense", "adslot", "adunit", "adv", "advert", "advertisement", "advertising", "adverts",
          "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments", "consent", "cookie", "cookies", "disclaimer",
          "disqus", "gdpr", "login", "modal", "newsletter", "notice", "notification", "pager", "pagination", "popup",
          "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing",
          "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# The same, unless an article or main element is within.
FRAME = {"banner", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "sidebar", "topbar"}
LAYOUT = {"has", "no", "with", "without", "is", "layout"}               # "has-sidebar" is no sidebar
OWN = {"article", "content", "entry", "post", "story", "title"}          # "entry-header" is the article's own
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements inside a block; all others begin and end one.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
SCOPES = ("table", "td", "th", "caption", "button", "object", "html", "body")
TABLE = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "html", "body"}
# A start tag ends an open one of the first, up to the nearest of the second.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}

_QUOTED = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_OPENS = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|href|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[^a-z0-9]+")


class Block(NamedTuple):
    path: int     # node of the tree of tag paths
    text: str
    linked: int   # characters inside links
    article: bool


class Element(NamedTuple):
    name: str
    path: int
    off: int      # 0: its text counts; 1: not, unless in an article or main element; 2: not
    article: bool
    link: bool


class Paths:
    """The tree of root-to-leaf tag paths of a page; a node comes after its parent."""

    def __init__(self) -> None:
        self.parent, self.outer = [0], [True]
        self._child: dict[tuple[int, str], int] = {}

    def child(self, of: int, label: str) -> int:
        at = self._child.setdefault((of, label), len(self.parent))
        if at == len(self.parent):
            self.parent.append(of)
            self.outer.append(self.outer[of] and label.split(".")[0] in ("html", "body"))
        return at


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of text, start and end tags; comments, declarations and raw elements are left out.

    The page is passed once: quotes count until one never ends, then no more; a tag,
    comment or raw element that never ends takes all behind it.
    """
    at, n, pattern = 0, len(html), _QUOTED
    while at < n:
        cut = html.find("<", at)
        if cut < 0:
            cut = n
        if cut > at:
            yield "text", "", html[at:cut]
        if cut == n:
            return
        if html[cut + 1:cut + 2] in ("!", "?"):
            comment = html.startswith("<!--", cut)
            end = html.find("-->" if comment else ">", cut + 2)
            at = n if end < 0 else end + (3 if comment else 1)
        elif not _OPENS.match(html, cut):
            yield "text", "", "<"
            at = cut + 1
        else:
            tag = pattern.match(html, cut)
            if not tag:
                pattern = _PLAIN
                tag = pattern.match(html, cut)
            if not tag:
                return
            at, name = tag.end(), tag[2].lower()
            if not tag[1] and name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(html, at)
                at = close.end() if close else n
            else:
                yield "end" if tag[1] else "start", name, tag[3]


def _described(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return found


def _marked(name: str, has: dict[str, str], in_article: bool) -> int:
    """What the page says of an element: see ``Element.off``."""
    if name in ASIDE or name in UNSEEN or has.get("role") in ROLES or "hidden" in has or has.get("aria-hidden") == "true":
        return 2
    if name == "header" and not in_article:
        return 1
    off = 0
    if name not in ("html", "body"):
        for token in (has.get("class", "") + " " + has.get("id", "")).split():
            words = set(_PARTS.split(token))
            if words & LAYOUT:
                continue
            if words & LABELS:
                return 2
            if words & FRAME and not words & OWN and not in_article:
                off = 1
    return off


def blocks(html: str) -> tuple[list[Block], Paths]:
    """The text of each block and its tag path; what the page itself marks as no article is left out.

    Tags may be missing, misnested or cut off: an end tag closes the nearest open
    element of its name and all within, a block inside ``p`` ends it, and
    unknown end tags are passed over.
    """
    found: list[Block] = []
    paths = Paths()
    stack = [Element("", 0, 0, False, False)]
    opened: dict[str, list[int]] = {}   # places in the stack, by name
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            pieces.clear()
            if text:
                found.append(Block(stack[-1].path, text, min(linked, len(text)), stack[-1].article))
        linked = 0

    def last(names) -> int:
        return max((opened[x][-1] for x in names if opened.get(x)), default=0)

    def close(to: int) -> None:
        if stack[-1].path != stack[to - 1].path:  # more than inline elements
            flush()
        while len(stack) > to:
            opened[stack.pop().name].pop()

    for kind, name, rest in tokens(html):
        if kind == "text":
            if not stack[-1].off:
                pieces.append(unescape(rest))
                linked += len(rest) * stack[-1].link
        elif name == "br":
            pieces.append(" ")
        elif kind == "end":
            at = last((name,))
            if at > (0 if name in TABLE else last(SCOPES)):
                close(at)
        else:
            inline = name in INLINE
            if not inline:
                flush()
                if (at := last(("p",))) > last(SCOPES):
                    close(at)
            if name in ENDS and (at := last(ENDS[name][0])) > last(ENDS[name][1]):
                close(at)
            if name == "a" and (at := last(("a",))) > last(SCOPES):
                close(at)
            if name in VOID:
                continue
            up = stack[-1]
            has = _described(rest) if rest else {}
            own = name in ("article", "main") or has.get("role") in ("main", "article") or has.get("itemprop") == "articlebody"
            off = _marked(name, has, up.article)
            if up.off == 2 or (up.off and not own):
                off = max(off, up.off)
            kind_of = _DIGITS.sub("", has.get("class", "")).strip()
            path = up.path if inline else paths.child(up.path, f"{name}.{kind_of}" if kind_of else name)
            opened.setdefault(name, []).append(len(stack))
            stack.append(Element(name, path, off, up.article or (own and not off), up.link or (name == "a" and "href" in has)))
    flush()
    return found, paths


def path_ratios(found: list[Block], paths: Paths) -> np.ndarray:
    """The fused ratio of each path.

    Text length (without that of links) and punctuation marks are added up over the
    blocks of a path and smoothed by those of near paths: siblings, parent and
    children count in full, others less by ``NEAR`` for each step; paths that have only
    html and body in common are near only as siblings. The sums over the number of
    blocks are the two ratios; they are fused to their product, each over its largest
    value, times the share of the path's own text that is in no link.
    """
    n = len(paths.parent)
    own, seen = np.zeros((n, 3)), np.zeros(n)
    for b in found:
        own[b.path] += (len(b.text) - b.linked, len(_PUNCTUATION.findall(b.text)) + 1, 1)
        seen[b.path] += len(b.text)
    below, direct, around = np.zeros((n, 3)), np.zeros((n, 3)), np.zeros((n, 3))
    for at in range(n - 1, 0, -1):
        below[paths.parent[at]] += own[at] + NEAR * below[at]
        direct[paths.parent[at]] += own[at]
    for at in range(1, n):
        up = paths.parent[at]
        if paths.outer[up]:
            around[at] = direct[up] - own[at] if not paths.outer[at] else 0
        else:
            around[at] = own[up] + below[up] - own[at] - NEAR * below[at] + NEAR * around[up]
    total = own + around + np.where(np.array(paths.outer)[:, None], 0, below)
    ratio = total[:, :2] / np.maximum(total[:, 2:], 1e-9)
    used = own[:, 2] > 0
    ratio = ratio / np.maximum(ratio[used].max(0, initial=0), 1e-9)
    return np.maximum(ratio, 0).prod(1) * own[:, 0] / np.maximum(seen, 1)


def main_blocks(html: str | None) -> list[str]:
    """The blocks of a page's content paths, in page order.

    If blocks lie in elements that the page marks as its article, only these can be
    content, and little is asked of them.
    """
    found, paths = blocks(html or "")
    share = LEAST_SHARE
    if any(b.article for b in found):
        found, share = [b for b in found if b.article], LEAST_MARKED
    ratio = path_ratios(found, paths)
    least = share * max((ratio[b.path] for b in found), default=0)
    return [b.text for b in found if ratio[b.path] >= least]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every whole page; one row per row of ``pages``.

    Each page is decided alone, in the task that reads it, in time and memory in
    proportion to its length; nothing is shuffled. Text length and punctuation are
    added up per root-to-leaf tag path, smoothed over near paths, fused, and the blocks
    of the paths above a share of the best are kept. References are decoded, white space inside a
    block is one space, blocks are joined by a line end. Pages with null or empty
    html, or without text, have an empty text. Other columns are not read; rows that
    repeat a page are each answered. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(main_blocks(html.as_py())) for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.selectExpr(f"`{id_col}` as page_id", f"cast(`{url_col}` as string) as url", f"cast(`{html_col}` as string) as html")
    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
