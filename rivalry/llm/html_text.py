"""Main text of web pages: text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams a page's events once.  Block borders
cut the page into *lines*; each has its characters and its tags.  The ratio
characters / tags per line is smoothed with a Gaussian kernel, and lines
above the threshold (the standard deviation of the smoothed ratios) form the
content cluster.  Where the page marks its article, the *region* is the
innermost ``article`` or ``main`` that holds the whole cluster, or what
encloses every ``article`` with cluster lines and a ``main`` with most of
them; all of its lines are text.  Everywhere else the cluster chooses:
a *container* (what holds paragraphs, headings and list items) is content if
at least half of its characters are cluster lines and links aren't most of its
text.  Short lines grow with their container; a container that isn't content
itself stays if, after the first content line, it lies within a content
container or before the last content line, and links aren't most of its text
either; headlines stay if they lead to content.  Names only veto: lines
in elements whose tag, role, class or id names them as menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or reader comments
belong to no region.

Null or empty html, and pages without text, give the empty string.  Markup
that isn't closed or is cut off ends with its parent or with the page.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rivalry.llm import memory

SIGMA = 1.0
_KERNEL = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-3, 4)]

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose text is never the article's.
SKIP = frozenset("script style noscript template nav footer aside form button select textarea iframe object svg "
                 "canvas head title dialog menu map audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                  "toolbar".split())
#: Names (whole words of a class or id) of blocks that aren't the article's.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|adbox|banner|sponsor(?:ed|s)?|promo(?:tion|s)?|sidebar|"
    r"menu|nav(?:bar|igation)?|breadcrumbs?|footer|masthead|cookies?|consent|gdpr|notices?|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|paywall|share|sharing|social|related|recommend(?:ed|ations)?|comments?|"
    r"commentlist|disqus|repl(?:y|ies)|login|signup|search|pagination|pager|toolbar|widgets?|copyright|disclaimer|"
    r"skip-link|hidden)(?=$|[\s_-])", re.I)
PAGE_HEAD = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-title)(?=$|[\s_-])", re.I)
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|respond)(?=$|[\s_-])", re.I)
HEADLINES = frozenset(("h1", "h2"))
#: Elements that belong to the container around them.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre address center caption summary".split())
#: A start tag that ends an open element of the given tags, if that is the innermost.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                   "ol p pre section table ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}


class _Lines(HTMLParser):
    """Collects the lines of a page: text, tags, element, headline or not, characters in links; and the elements' parents."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.parents, self.tags = [0], ["#page"]
        self.stack = [("#page", 0, False, False)]  # tag, element, skipped, inside an article
        self.parts: list[str] = []
        self.count = self.linked = 0
        self.link = False

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag, element, _, _ = self.stack[-1]
                self.lines.append((text, self.count, element, any(t[0] in HEADLINES for t in self.stack[-3:]), self.linked))
                self.count = 0
            self.parts, self.linked = [], 0

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][2]:
            self.parts.append(data)
            self.linked += len(data) * self.link

    def handle_starttag(self, tag: str, attrs) -> None:
        self.count += 1
        self.link = tag == "a" or self.link and tag in INLINE
        if tag in INLINE:
            if tag in VOID or not attrs:
                if tag not in VOID and self.stack[-1][2]:
                    self.stack.append((tag, *self.stack[-1][1:]))
                return
        else:
            self.cut()
            if tag in VOID:
                return
            if tag in ENDS_P:
                self._end_open(("p",))
            elif tag in SAME:
                self._end_open(SAME[tag])
        _, parent, skipped, inside = self.stack[-1]
        if not skipped:
            skipped = self._skips(tag, attrs, inside)
            if skipped and tag in INLINE:
                self.cut()
        inside = inside or tag in ("article", "main")
        element = parent
        if not skipped and tag not in INLINE:
            element = len(self.parents)
            self.parents.append(parent)
            self.tags.append(tag)
        if skipped or tag not in INLINE:
            self.stack.append((tag, element, skipped, inside))

    def _end_open(self, tags) -> None:
        while self.stack[-1][0] in tags:
            self.stack.pop()

    @staticmethod
    def _skips(tag: str, attrs, inside: bool) -> bool:
        if tag in SKIP or (tag == "header" and not inside):
            return True
        if not attrs:
            return False
        names = ""
        for k, v in attrs:
            if k in ("class", "id"):
                names += f" {v or ''}"
            elif (k == "role" and (v or "").lower() in ROLES) or k == "hidden" or (
                    k == "aria-hidden" and v == "true") or (
                    k == "style" and v and re.search(r"display\s*:\s*none", v)):
                return True
        if not names or tag in ("html", "body", "main"):
            return False
        if tag == "article":
            return bool(COMMENT.search(names))
        return bool(NAMES.search(names)) or (not inside and bool(PAGE_HEAD.search(names)))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.link = self.link and tag != "a"
        if tag not in INLINE:
            self.cut()
        elif not self.stack[-1][2]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian smoothing; the kernel is renormalised at the ends."""
    out, n = [], len(ratios)
    for i in range(n):
        lo, hi = max(0, i - 3), min(n, i + 4)
        weights = _KERNEL[lo - i + 3:hi - i + 3]
        out.append(sum(w * r for w, r in zip(weights, ratios[lo:hi])) / sum(weights))
    return out


def content_cluster(ratios: list[float]) -> list[bool]:
    """Lines whose smoothed ratio reaches the threshold (standard deviation, at most the mean); all if they are alike."""
    if not ratios:
        return []
    smooth = smoothed(ratios)
    mean = sum(smooth) / len(smooth)
    limit = min(mean, math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth)))
    return [x >= limit for x in smooth]


def main_text(html: str | None) -> str:
    page, html = _Lines(), html or ""
    last = html.rfind("<!--")
    if last >= 0 and not re.search(r"-->|</script", html[last:], re.I):
        html = html[:last]  # a comment that nothing ends
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match(r"</?[a-zA-Z]", html[last:]):
        html = html[:last]  # a tag that the page's end cuts off
    page.feed(html)
    page.close()
    page.cut()
    if not page.lines:
        return ""
    cluster = content_cluster([len(t) / max(1, n) for t, n, *_ in page.lines])
    chars = [0] * len(page.parents)  # of cluster lines in each element's subtree
    for (text, _, element, *_), inside in zip(page.lines, cluster):
        chars[element] += len(text) * inside
    for e in range(len(page.parents) - 1, 0, -1):
        chars[page.parents[e]] += chars[e]
    region = _marked(page, chars)
    if region is None:
        kept = grown(page, cluster)
    else:
        inside = [False] * len(page.parents)
        for e in range(len(page.parents)):
            inside[e] = e == region or (e > 0 and inside[page.parents[e]])
        kept = [inside[element] for _, _, element, *_ in page.lines]
    return " ".join(line[0] for line, keep in zip(page.lines, kept) if keep)


def _marked(page: _Lines, chars: list[int]) -> int | None:
    """The element of the region that the page's own marks give, if they do."""
    named = [e for e, t in enumerate(page.tags) if t in ("article", "main") and chars[e] == chars[0] > 0]
    if named:
        return max(named)  # the innermost that holds the whole cluster
    several = [e for e, t in enumerate(page.tags) if t == "article" and chars[e] or t == "main" and 2 * chars[e] > chars[0] > 0]
    if not several:
        return None
    region = several[0]  # what holds them all
    while not all(_under(page, e, region) for e in several):
        region = page.parents[region]
    return region


def grown(page: _Lines, cluster: list[bool]) -> list[bool]:
    """Which lines are kept where only the cluster tells: its containers, and what grows with them."""
    holder = [page.parents[e] if page.tags[e] in LEAVES else e for _, _, e, *_ in page.lines]
    n = len(page.parents)
    total, found, linked = [0] * n, [0] * n, [0] * n
    for (text, _, _, _, link), own, inside in zip(page.lines, holder, cluster):
        total[own] += len(text)
        found[own] += len(text) * inside
        linked[own] += link
    dense = [2 * f >= t for f, t in zip(found, total)]
    for e in range(n - 1, 0, -1):  # with all that lies in it
        for of in (total, linked):
            of[page.parents[e]] += of[e]
    text_like = [2 * k <= t for k, t in zip(linked, total)]
    content = {c for c in set(holder) if dense[c] and text_like[c]}
    within, leads = [False] * n, [False] * n
    for e in range(n):
        within[e] = e in content or (e > 0 and within[page.parents[e]])
        leads[e] = e in content
    for e in range(n - 1, 0, -1):
        leads[page.parents[e]] |= leads[e]
    at = [i for i, own in enumerate(holder) if own in content]
    first, last = (at[0], at[-1]) if at else (-1, len(holder))
    kept = []
    for i, ((_, _, _, head, _), own) in enumerate(zip(page.lines, holder)):
        kept.append(own in content or text_like[own] and i > first and (within[own] or i < last) or head and i < last and leads[own])
    return kept


def _under(page: _Lines, e: int, top: int) -> bool:
    while e > top:
        e = page.parents[e]
    return e == top


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``pages`` (key, url, html) with ``text``, the main text, instead of the html."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             [key, "url", "text"])

    return pages.select(key, "url", "html").mapInArrow(run, f"{key} {kind}, url string, text string")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.selectExpr("page_id", "url", "text", "CAST(length(text) AS BIGINT) AS n_chars")
