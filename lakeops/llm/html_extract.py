"""Main text of web pages by the ratios of their tag paths.

A page is read as a row of text blocks, each with the path of block elements from the root
to it. Text length and punctuation are summed by path and put in proportion to the path's
blocks; both sequences are smoothed along the page, fused, and the paths above a threshold
are content. Elements and names that never hold the article are left out before.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.common import slices, strings, without

# Names of HTML.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time "
    "tt u var br img wbr nobr picture source".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends open elements of these kinds, up to the nearest element named after the bar.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"tbody", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Elements that hold no article, wherever they are, and those that may be part of one.
NEVER = frozenset(
    "head nav footer aside form button select menu dialog object applet embed svg math canvas audio video map template datalist fieldset "
    "input label legend output progress meter".split()
)
#: Words in class, id or role of what surrounds an article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbox banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar comment comments disqus replies respond discussion reactions cookie "
    "cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations widget widgets pagination pager toolbar search searchbox skip copyright legal disclaimer "
    "contentinfo complementary dialog alert toc".split()
)
#: Of these, what a part of an article may be about: inside an article they leave nothing out.
TOPICS = frozenset(
    "discussion related legal notice notices reactions replies respond search disclaimer copyright alert consent cookie cookies "
    "recommended recommendations advertising promotion navigation social menu skip".split()
)
#: What leaves a section inside an article out; other names may be what the section is about.
SECTIONS = frozenset(
    "ad ads adv advert adverts advertisement adsbox sponsor sponsored promo comment comments disqus newsletter gdpr breadcrumb breadcrumbs "
    "sidebar sidebars navbar topbar masthead footer pagination pager subscribe share toc".split()
)
#: Elements that text flows through: they go with the element around them.
FLOW = frozenset("p ul ol li dl dt dd pre blockquote table caption thead tbody tfoot tr td th figcaption".split()) | HEADINGS
#: The same, but for those in front of an article only.
HEAD_NAMES = frozenset(["header"])
ARTICLE = frozenset("article main".split())
ARTICLE_NAMES = frozenset("article main articlebody entry post story".split())
#: Never left out for their names.
FRAMES = frozenset("html body article main".split())

TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|([a-zA-Z][^\s/>]*)([^>]*)>|/([a-zA-Z][^\s/>]*)[^>]*>|[!?/][^>]*>)""",
    re.S,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role|style|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|$)""", re.I)
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？؟।]")

#: Weights of a block and its neighbours, and the standard deviations that content is above.
SMOOTH = (0.25, 0.5, 0.25)
LAMBDA = 0.5
#: The factor of blocks outside an article element that holds most of the text.
OUTSIDE = 0.1


def _role(tag: str, attributes: str, in_article: bool) -> int:
    """-1 for what is left out, 1 for an article, 0 for the rest."""
    if tag in NEVER or tag == "header" and not in_article:
        return -1
    if not attributes:
        return 1 if tag in ARTICLE else 0
    found = {}
    for m in NAMED.finditer(attributes):
        found[m[1].lower()] = (m[2] or "").strip("\"'").lower()
    if tag in FRAMES:
        return 1 if tag in ARTICLE else 0
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""))
    if hidden:
        return -1
    names = " ".join(found.get(k, "") for k in ("class", "id", "role")).split()
    words = {w for n in names if not re.match(r"(no|has|with|without|is|not)[-_]", n) for w in WORD.findall(n)}
    plain = NAMES
    if tag in HEADINGS:
        plain = frozenset()
    elif in_article:
        plain = SECTIONS if tag == "section" else NAMES - TOPICS
        # "discussion" and "related-work" may be topics, "cookie-notice" is none.
        if any(len(ws) > 1 and NAMES.issuperset(ws) for ws in map(WORD.findall, names)):
            return -1
    if words & plain or "hidden" in names:
        return -1
    if words & HEAD_NAMES and not (in_article or tag in HEADINGS or words & ARTICLE_NAMES):
        return -1
    if "articlebody" in found.get("itemprop", "") or words & ARTICLE_NAMES and tag in ("div", "section", "td"):
        return 1
    return 0


class _Page:
    """The blocks of a page: text, path number, characters in links, in an article?"""

    def __init__(self, page: str):
        self.blocks: list[tuple[str, int, int, bool, bool]] = []
        self.paths: dict[tuple[int, str], int] = {}
        # By path number: the path of the nearest element that is not one of FLOW.
        self.around: list[int] = [0]
        # Open elements: tag, path number, article?, left out?
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        # Where elements of a tag are open, innermost last.
        self.depths: dict[str, list[int]] = {}
        self.text: list[str] = []
        self.links = self.linked = 0
        at, end = 0, len(page)
        while at < end:
            m = TAG.search(page, at)
            if m is None:
                self._add(page[at:])
                break
            if m.start() > at:
                self._add(page[at : m.start()])
            at = m.end()
            if tag := m[1] or m[3]:
                tag = tag.lower()
                self._start(tag, m[2] if m[1] else m[4])
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                    at = close.end() if close else end
            elif m[5]:
                self._end(m[5].lower())
        self._flush()

    def _add(self, raw: str) -> None:
        if not self.open[-1][3]:
            text = references.unescape(raw)
            self.text.append(text)
            if self.links:
                self.linked += len(text)

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                tag, path, article, _ = self.open[-1]
                self.blocks.append((text, path, self.linked, article, tag in HEADINGS))
            self.text = []
        self.linked = 0

    def _pop(self, depth: int) -> None:
        self._flush()
        for tag, *_ in self.open[depth:]:
            self.depths[tag].pop()
        del self.open[depth:]

    def _innermost(self, tags: set[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in RAW:
            self.text.append(" ")
            return
        if tag in INLINE:
            if tag == "a" and not attributes.rstrip().endswith("/"):
                self.links = 1
            elif tag in ("br", "img"):
                self.text.append(" ")
            return
        self._flush()
        if tag in VOID:
            return
        kinds, stops = ENDS.get(tag, ({"p"}, {"button", "table", "td", "th"}))
        depth = self._innermost(kinds)
        if depth > self._innermost(stops):
            self._pop(depth)
        _, path, article, out = self.open[-1]
        role = _role(tag, attributes, article)
        names = " ".join(sorted(re.findall(r"class\s*=\s*[\"']?([A-Za-z_-]+)", attributes))) if attributes else ""
        number = self.paths.setdefault((path, f"{tag} {names}"), len(self.paths) + 1)
        if number == len(self.around):
            self.around.append(self.around[path] if tag in FLOW else number)
        if not attributes.rstrip().endswith("/"):
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append((tag, number, article or role > 0, out or role < 0))
        self.links = 0

    def _end(self, tag: str) -> None:
        if tag in INLINE or tag in RAW:
            if tag == "a":
                self.links = 0
            return
        self._flush()
        if depth := self._innermost({tag}):
            self._pop(depth)
            self.links = 0


def _smoothed(x: np.ndarray) -> np.ndarray:
    return np.convolve(np.pad(x, 1, mode="edge"), SMOOTH, "valid")


def main_text(page: str) -> str:
    """The blocks on content paths, in page order, one to a line.

    By path: characters a block and punctuation marks a block, each as a logarithm, smoothed over
    neighbouring blocks and multiplied; links take their part of the characters away. A
    path is content if the mean over its blocks is above LAMBDA standard deviations of the
    page's blocks. If an article element holds half of these characters or more, membership
    is a factor of the score: blocks outside weigh OUTSIDE, and links inside take only half
    of their part away, so that lists of references may stay. The threshold is the same,
    inside too, but that an element of the article which holds content keeps its lists, code,
    quotations, tables and short paragraphs, unless links are half of their path. A heading
    goes with the block behind it.
    """
    read = _Page(page)
    blocks = read.blocks
    if not blocks:
        return ""
    path = np.array([b[1] for b in blocks])
    chars = np.array([len(b[0]) for b in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(b[0])) for b in blocks], float)
    linked = np.minimum(np.array([b[2] for b in blocks], float), chars)
    article = np.array([b[3] for b in blocks])
    heading = np.array([b[4] for b in blocks])
    _, at, n = np.unique(path, return_inverse=True, return_counts=True)
    link_share = (np.bincount(at, linked) / np.maximum(1, np.bincount(at, chars)))[at]

    def scores(taken: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length, points = (np.log1p(np.bincount(at, x) / n)[at] for x in (chars - taken * linked, marks))
        fused = _smoothed(length) * (0.5 + _smoothed(points)) * (1 - taken * link_share) * factor
        return fused, (np.bincount(at, fused) / n)[at]

    fused, mean = scores(np.ones(len(blocks)), np.ones(len(blocks)))
    limit = min(LAMBDA * fused.std(), fused.max())
    content = mean >= limit
    if chars[article].sum() >= 0.5 * chars[content].sum() and article.any():
        fused, mean = scores(np.where(article, 0.5, 1.0), np.where(article, 1.0, OUTSIDE))
        content = mean >= min(limit, fused.max())
        around = np.array(read.around)[path]
        content |= article & ~heading & (link_share < 0.5) & np.isin(around, around[content & article])
    for i in np.flatnonzero(heading[:-1])[::-1].tolist():
        content[i] = content[i] or content[i + 1] and link_share[i] < 0.8
    return "\n".join(b[0] for b, c in zip(blocks, content) if c)


def extracted(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The frame with the main text of each page.

    Character references are decoded, white space in a block becomes one blank, blocks are
    joined by newlines. Null and empty pages, and those without content, have the empty
    text. Pages are read whole, however long or broken. A column named as the result is
    replaced.
    """
    pages = without(pages, text)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in pages.schema]).add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [main_text(p) for p in strings(batch.column(html))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema)
