"""Main text of HTML pages by tag-path ratios.

A page becomes a list of text blocks, each with its root-to-leaf path of block tags. Text length a block and punctuation marks
a hundred characters are aggregated over all blocks of one path; a block's two ratios are smoothed with its neighbours of the same
container and fused by product, ``log(1 + length) * (1 + punctuation)``, and a path scores the best of its blocks. What is
known of a place weighs this score:

* within what is never article text (menus, headers of the page, footers, asides, forms, dialogs, by tag or role) by 0, within an
  element one of whose class or id names is such a cue (or a compound like ``cookie-notice``) by ``CUE``. Such a mark is not believed
  if it holds the page's dominant article or most of its text: a wrapper says nothing about what it wraps;
* link text (a list or path nearly all of whose characters are in links) by 0, unless the page has nothing else;
* article and main elements are a prior: with a share o of the page's text in them, their unmarked paths weigh 1 + 9 o, all paths outside (1 - o)^2.

Paths from ``LEAST`` times the mean score of the page's characters are content. A heading goes with the content of its container. If no
path scores, all text that is not in links is content, or else all text.

Null and empty pages give an empty text. Broken markup is read leniently: unclosed blocks end where a sibling or parent does, a
head at the first element of a body or text, an unclosed comment or tag runs to the end. Paths are numbered by parent and tag, and open
elements are found by tag, so time and memory are linear in the page whatever its nesting. Repeated rows give equal results; other columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Elements by role in a page.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section "
                   "select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe object svg math head title textarea select button".split())
IN_HEAD = frozenset("html head title base link meta script style noscript template".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CUES = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
                 "navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar side comment comments disqus "
                 "reply replies cookie cookies consent notice notices alert popup modal share sharing social subscribe "
                 "newsletter signup login related recommended pagination pager widget toolbar skip copyright".split())
#: Cues that say nothing as a part of a compound, and parts that turn a compound into a state of its element.
ALONE = frozenset("header side skip menu notice".split())
STATES = frozenset("has no with without is not entry post article content page single hide hidden open closed enabled disabled".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: What an opening tag closes, up to the element that bounds the search.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

#: The share of characters in links from which text is link text; of the page's text from which a mark is a wrapper.
LINKED, WRAPPER = 0.75, 0.8
CUE, LEAST, PRIOR = 0.002, 0.05, 9.0

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z", re.S | re.I)
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME = re.compile(r"[^\s]+")
_PART = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；！？…]")


def is_cue(name: str) -> bool:
    """Does a class or id name mark what is not article text: a cue, or a compound that begins or ends with one?"""
    parts = _PART.findall(name)
    if len(parts) < 2:
        return parts[:1] != [] and parts[0] in CUES
    return STATES.isdisjoint(parts) and any(x in CUES and x not in ALONE for x in (parts[0], parts[-1]))


def _mark(tag: str, attributes: str, inside: bool) -> float | None:
    """The weight that an element gives to all it holds, if it marks it. A header within the article holds its headline."""
    if tag in OUTSIDE and not (tag == "header" and inside):
        return 0.0
    cue = None
    if attributes and "=" in attributes:
        for m in _MARKS.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                if value.strip() in ROLES:
                    return 0.0
            elif any(is_cue(name) and not (inside and name == "header") for name in _NAME.findall(value)):
                cue = CUE
    return cue


class _Block:
    __slots__ = ("path", "tag", "article", "mark", "container", "parts", "text", "linked")

    def __init__(self, path: int, tag: str, article: int, mark: int, container: int):
        self.path, self.tag, self.article, self.mark, self.container, self.parts, self.text = path, tag, article, mark, container, [], ""
        self.linked = 0  # characters within links


class Page:
    """The non-empty text blocks of a page, in order, with the marks and articles they lie in. Number 0 of marks and articles is none."""

    def __init__(self, page: str):
        self.blocks: list[_Block] = []
        self.marks: list[tuple[int, float]] = [(0, 1.0)]  # (mark around it, weight)
        self.articles: list[tuple[int, int]] = [(0, 0)]  # (article around it, mark around it)
        self._read(page)

    def _read(self, page: str) -> None:
        paths: dict[tuple[int, str], int] = {}
        # (tag, path of block elements, article, mark, serial of the block element, of the one around it, hidden, within a link)
        stack: list[tuple[str, int, int, int, int, int, bool, bool]] = [("", 0, 0, 0, 0, 0, False, False)]
        open_at: dict[str, list[int]] = {}  # places in the stack by tag
        blocks_at: list[int] = [0]
        now: _Block | None = None
        serial, at = 0, 0

        def cut(depth: int) -> None:
            while len(stack) > depth:
                tag = stack.pop()[0]
                open_at[tag].pop()
                if tag in BLOCKS:
                    blocks_at.pop()

        def last(tags) -> int:
            return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

        def text(upto: int) -> None:
            nonlocal now
            piece = page[at:upto]
            if not piece:
                return
            if stack[-1][0] == "head" and not piece.isspace():
                cut(len(stack) - 1)
            if stack[-1][6]:
                return
            if now is None:
                if piece.isspace():
                    return
                tag, path, article, mark, own, around, _, _ = stack[-1]
                now = _Block(path, stack[blocks_at[-1]][0], article, mark, around)
                self.blocks.append(now)
            now.parts.append(piece)
            if stack[-1][7]:
                now.linked += len(" ".join(entities.unescape(piece).split()))

        for m in _TOKEN.finditer(page):
            text(m.start())
            at = m.end()
            tag = (m[3] or "").lower()
            if not tag:
                continue
            if m[2]:  # a closing tag; one that closes nothing is ignored
                depth = last((tag,))
                if depth and (tag in BLOCKS or depth > blocks_at[-1]):
                    cut(depth)
                if tag in BLOCKS:
                    now = None
                continue
            if tag not in IN_HEAD and open_at.get("head"):
                cut(open_at["head"][-1])
            if tag == "br":
                if now is not None:
                    now.parts.append(" ")
                continue
            if tag in BLOCKS:
                now = None
                if stack[blocks_at[-1]][0] == "p" and tag != "option":
                    cut(blocks_at[-1])
                if tag in CLOSES:
                    ends, bound = CLOSES[tag]
                    depth = last(ends)
                    if depth > last(bound):
                        cut(depth)
                elif tag in HEADINGS and stack[-1][0] in HEADINGS:
                    cut(len(stack) - 1)
            if tag in VOID or m[4].endswith("/"):
                continue
            _, path, article, mark, own, around, hidden, linked = stack[-1]
            if tag in BLOCKS:
                serial += 1
                path = paths.setdefault((path, tag), len(paths) + 1)
                own, around = serial, own
            weight = _mark(tag, m[4], article > 0)
            if weight is not None and tag not in ("body", "html"):
                self.marks.append((mark, weight))
                mark = len(self.marks) - 1
            if tag in ("article", "main"):
                self.articles.append((article, mark))
                article = len(self.articles) - 1
            # an unclosed link ends at a paragraph
            linked = (linked or tag == "a" and "href" in m[4].lower()) and tag != "p"
            open_at.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS:
                blocks_at.append(len(stack))
            stack.append((tag, path, article, mark, own, around, hidden or tag in HIDDEN, linked))
        text(len(page))
        for b in self.blocks:
            b.text = " ".join(entities.unescape("".join(b.parts)).split())
        self.blocks = [b for b in self.blocks if b.text]

    def weights(self) -> list[float]:
        """Of each mark, with those around it. A mark around the dominant article, or around most of the text, is not believed."""
        total = sum(len(b.text) for b in self.blocks)
        held, size = [0] * len(self.marks), [0] * len(self.articles)
        for b in self.blocks:
            held[b.mark] += len(b.text)
            size[b.article] += len(b.text)
        for i in range(len(self.marks) - 1, 0, -1):
            held[self.marks[i][0]] += held[i]
        for i in range(len(self.articles) - 1, 0, -1):
            size[self.articles[i][0]] += size[i]
        top = max(range(1, len(size)), key=lambda i: (size[i], -i), default=0)
        around: set[int] = set()
        if top and size[top] >= 0.3 * total:
            mark = self.articles[top][1]
            while mark:
                around.add(mark)
                mark = self.marks[mark][0]
        out = [1.0]
        for i, (outer, weight) in enumerate(self.marks[1:], 1):
            believed = i not in around and held[i] <= WRAPPER * total
            out.append(min(out[outer], weight if believed else 1.0))
        return out


def _link_text(found: list[_Block]) -> list[bool]:
    """Whether the list a block is an item of or else its path is nearly all links."""
    size: dict[tuple, list[int]] = {}
    keys = [(b.path, b.container if b.tag == "li" else 0) for b in found]
    for b, key in zip(found, keys):
        s = size.setdefault(key, [0, 0])
        s[0] += b.linked
        s[1] += len(b.text)
    return [size[key][0] > LINKED * size[key][1] and b.tag not in HEADINGS for b, key in zip(found, keys)]


def ratios(page: Page, weights: list[float]) -> list[float]:
    """The fused score of every block's path, not yet weighed. Paths are taken apart by the weight of their place."""
    found = page.blocks
    keys = [(b.path, weights[b.mark], b.article > 0) for b in found]
    sums: dict[tuple, list[int]] = {}
    for b, key in zip(found, keys):
        s = sums.setdefault(key, [0, 0, 0])
        s[0] += len(b.text)
        s[1] += len(_PUNCTUATION.findall(b.text))
        s[2] += 1
    length = [sums[k][0] / sums[k][2] for k in keys]
    marks = [100 * sums[k][1] / sums[k][0] for k in keys]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i, b in enumerate(found):
            near = [(j, w) for j, w in ((i - 1, 0.25), (i, 0.5), (i + 1, 0.25)) if 0 <= j < len(found) and found[j].container == b.container]
            out.append(sum(values[j] * w for j, w in near) / sum(w for _, w in near))
        return out
    best: dict[tuple, float] = {}
    for key, n, p in zip(keys, smooth(length), smooth(marks)):
        best[key] = max(best.get(key, 0.0), log1p(n) * (1 + p))
    return [best[key] for key in keys]


def content(page: Page) -> list[_Block]:
    """The blocks whose paths pass the threshold."""
    found, weights = page.blocks, page.weights()
    scores, links = ratios(page, weights), _link_text(page.blocks)
    weight = [0.0 if link else weights[b.mark] for b, link in zip(found, links)]
    size = [w * len(b.text) for b, w in zip(found, weight)]
    if not any(size):
        return [b for b, link in zip(found, links) if not link] or found
    share = sum(x for b, x in zip(found, size) if b.article) / sum(size)
    mean = sum(s * x for s, x in zip(scores, size)) / sum(size)
    each = [s * w * ((1 + PRIOR * share) ** (w == 1) if b.article else (1 - share) ** 2) for b, s, w in zip(found, scores, weight)]
    keep = [x > 0 and x >= LEAST * mean for x in each]
    kept = {b.container for b, on in zip(found, keep) if on}
    return [b for b, on, w in zip(found, keep, weight) if on or w == 1 and b.tag in HEADINGS and b.container in kept]


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in content(Page(page))) if page else ""


def with_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of its pages; an ``out`` that exists is replaced."""
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], type=pa.string())
    return df.withColumn(out, F.arrow_udf(extract, "string")(F.col(f"`{html}`")))


def report(pages: DataFrame) -> DataFrame:
    return with_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
