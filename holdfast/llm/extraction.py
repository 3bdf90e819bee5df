"""Main text of web pages from text-to-tag ratios.

Events of the standard library's parser cut a page into lines, one per block
element. A line's ratio is its characters per tag; lines in menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
count as 0. Ratios are smoothed by a Gaussian over neighbouring lines, and lines
at or above the standard deviation form the content cluster. A form, or a class or
id, marks no container that holds more than half of the characters of the cluster
that is found without such marks (nine tenths, if an ``article`` or ``main`` is
outside of all marked ones); names of comments mark it unless it holds all, and a
name beside an unusual word ("related-work") marks only what has no line of prose.
The content region is every ``article`` or ``main`` element that holds a line of
the cluster, if they hold half of its characters; else it is the smallest container
that holds most of them. All of a region's lines that are not boilerplate are its text, so
short paragraphs between long ones are kept.

Cases: null, empty and text-free pages give an empty text; unclosed, stray and
nested tags and broken markup are read as far as they go, an unclosed element
ends with its parent, a comment without an end at the next ``>``; work is linear in a
page, however deep; white space in a block becomes one space and blocks are
joined by one line break; repeated rows are extracted alike; an empty table
gives no rows; columns of the pages are untouched by :func:`extract`.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of
from holdfast.llm.text import slices

SIGMA = 1.0
RADIUS = 3
MOST = 0.8  # share of the cluster that a smaller container must hold
NEARLY = 0.9  # the same for marked containers beside a region
HALF = 0.5  # share of the cluster that regions hold, and marked containers do not

QUERIES, ORACLE, query = registry()

# fixed values: element names of HTML, and usual names of page parts
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
CONTAINERS = set(
    "article aside audio body button canvas center dialog div dl fieldset figure footer form head header html iframe main math "
    "menu nav noembed noframes noscript object ol optgroup script search section select style svg table template textarea title ul video".split()
)
BOILERPLATE = set(
    "aside audio button canvas dialog fieldset footer form head header iframe math menu nav noembed noframes noscript object "
    "script search select style svg template textarea title video".split()
)
NAMES = set(
    "ad ads adsense advert advertisement advertisements advertising adverts banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related replies reply "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
ROLES = set("banner navigation complementary contentinfo search form menu menubar dialog alert".split())
FORMS = {"form", "fieldset"}
COMMENT_NAMES = {"comment", "comments", "reply", "replies"}
REGIONS = {"article", "main"}
# words that go with a name of a page part; beside others ("related-work") the name may be a topic
GENERIC = set(
    "area articles bar block bottom box btn button card center col column container content footer global group header holder "
    "home inner item items js layout left links list main micro outer page panel placeholder posts primary region right row "
    "secondary section site slot stories top unit wrap wrapper zone".split()
)
_PLAIN, _NAMED, _COMMENTS, _TOPIC = range(4)  # marks of containers
PROSE, PROSE_RATIO = 80, 40.0  # characters of a line of prose, and those for each tag

_NAME = re.compile(r"[A-Za-z0-9]+")
_KERNEL = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


class _Lines(HTMLParser):
    """Lines of a page: text, tags, whether boilerplate, the region and the container around; and the tree of containers."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int, int]] = []
        # open containers: name, boilerplate by name of element, boilerplate by attributes, region, number
        self.open: list[tuple[str, bool, bool, int, int]] = [("", False, False, -1, 0)]
        self.named: list[dict[str, int]] = [{}]  # open containers by name, inside each open region
        self.wide = dict.fromkeys((*REGIONS, "html", "body"), 0)  # open ones that an end tag closes across regions
        # by number, the page being 0: the container around, the same but 0 for a region, and the kind of mark
        self.parent, self.marks_above, self.mark = [0], [0], [_PLAIN]
        self.parts: list[str] = []
        self.tags = 0
        self.closing = self.unclosed = False

    def close(self) -> None:
        self.closing = True
        super().close()

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment without an end hides what goes before the next ``>``; ends are looked for once."""
        end = -1 if self.unclosed else super().parse_comment(i, report)
        if end < 0:
            self.unclosed = True
            if self.closing:
                end = 1 + self.rawdata.find(">", i + 4) or len(self.rawdata)
        return end

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            if text:
                _, by_element, by_attribute, region, number = self.open[-1]
                self.lines.append((text, max(1, self.tags), by_element or by_attribute, region, number))
        self.tags = 0

    def handle_data(self, data: str) -> None:
        self.parts.append(data)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS or tag in CONTAINERS:
            self.flush()
        elif tag in ("br", "wbr"):
            self.parts.append(" " if tag == "br" else "")
        if tag in CONTAINERS:
            _, by_element, by_attribute, region, above = self.open[-1]
            number, mark, marks_above = len(self.parent), _PLAIN, above
            if tag in REGIONS:
                if region < 0:
                    by_attribute, marks_above = False, 0
                by_attribute = by_attribute or not COMMENT_NAMES.isdisjoint(self._names(attrs))
                region = number if region < 0 else region
            elif tag not in ("html", "body"):
                by_attribute = by_attribute or self._marked(attrs)
                mark = _NAMED if tag in FORMS else self._kind(attrs)
            by_element = by_element or (tag in BOILERPLATE and tag not in FORMS)
            self.parent.append(above), self.marks_above.append(marks_above), self.mark.append(mark)
            if tag in self.wide:
                self.wide[tag] += 1
            else:
                self.named[-1][tag] = self.named[-1].get(tag, 0) + 1
            if tag in REGIONS:
                self.named.append({})
            self.open.append((tag, by_element, by_attribute, region, number))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in ("script", "style") and tag in ("iframe", "svg", "math", "canvas", "object", "template"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS or tag in CONTAINERS:
            self.flush()
        if tag in CONTAINERS:
            # a stray end tag closes nothing, and not the region around it
            is_open = self.wide[tag] if tag in self.wide else self.named[-1].get(tag)
            while is_open:
                name = self.open.pop()[0]
                if name in REGIONS:
                    self.named.pop()
                if name in self.wide:
                    self.wide[name] -= 1
                else:
                    self.named[-1][name] -= 1
                is_open = name != tag

    @staticmethod
    def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
        return {n.lower() for key, value in attrs if key in ("class", "id") and value for n in _NAME.findall(value)}

    def _marked(self, attrs: list[tuple[str, str | None]]) -> bool:
        if not attrs:
            return False
        found = dict(attrs)
        style = (found.get("style") or "").replace(" ", "").lower()
        hidden = "hidden" in found or (found.get("aria-hidden") or "").lower() == "true" or "display:none" in style
        return hidden or (found.get("role") or "").lower() in ROLES - FORMS

    def _kind(self, attrs: list[tuple[str, str | None]]) -> int:
        """How a container is marked by its class, id or role."""
        if not attrs:
            return _PLAIN
        if not COMMENT_NAMES.isdisjoint(names := self._names(attrs)):
            return _COMMENTS
        if (dict(attrs).get("role") or "").lower() in FORMS:
            return _NAMED
        if NAMES.isdisjoint(names):
            return _PLAIN
        for key, value in attrs:
            for word in (value or "").lower().split() if key in ("class", "id") else ():
                parts = set(_NAME.findall(word))
                if not NAMES.isdisjoint(parts) and parts <= NAMES | GENERIC:
                    return _NAMED
        return _TOPIC


def _cluster(size: np.ndarray, tags: np.ndarray, boilerplate: np.ndarray) -> np.ndarray:
    """The lines of the content cluster."""
    ratio = np.where(boilerplate, 0.0, size / tags)
    smooth = np.convolve(np.pad(ratio, RADIUS, mode="edge"), _KERNEL, mode="valid")
    return ~boilerplate & (smooth >= smooth.std())


def _under(weight: np.ndarray, number: np.ndarray, parent: list[int]) -> np.ndarray:
    """The weight of the lines in each container and all below it; containers come after those around them."""
    held = np.bincount(number, weight, len(parent)).tolist()
    for k in range(len(parent) - 1, 0, -1):
        held[parent[k]] += held[k]
    return np.array(held)


def _below(chosen: np.ndarray, parent: list[int]) -> np.ndarray:
    """Whether each container is one of those chosen or inside one."""
    inside = chosen.tolist()
    for k in range(1, len(parent)):
        inside[k] = inside[k] or inside[parent[k]]
    return np.array(inside)


def _by_marks(page: _Lines, number: np.ndarray, weight: np.ndarray, prose: np.ndarray, most: float) -> np.ndarray:
    """The lines in marked containers that hold less than their mark needs to be wrong."""
    mark, total = np.array(page.mark), weight.sum()
    held = _under(weight, number, page.marks_above)
    right = (mark != _PLAIN) & (held <= most * total)
    right = np.where(mark == _COMMENTS, (held < total) | (total == 0), right)
    # a topic's name marks what has no prose
    right &= (mark != _TOPIC) | (_under(prose.astype(float), number, page.marks_above) == 0)
    return _below(right, page.marks_above)[number]


def main_text(html: str) -> str:
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    lines = page.lines
    if not lines:
        return ""
    boilerplate = np.array([x[2] for x in lines])
    size, tags = (np.array(x, float) for x in ([len(x[0]) for x in lines], [x[1] for x in lines]))
    region, number = (np.array([x[k] for x in lines]) for k in (3, 4))
    marked = _below(np.array(page.mark) != _PLAIN, page.marks_above)[number]
    if marked.any():
        beside = bool(((region >= 0) & ~marked & ~boilerplate).any())
        weight = np.where(_cluster(size, tags, boilerplate), size, 0.0)
        prose = ~boilerplate & (size >= PROSE) & (size >= PROSE_RATIO * tags)
        boilerplate |= _by_marks(page, number, weight, prose, NEARLY if beside else HALF)
    content = _cluster(size, tags, boilerplate)
    if not content.any():
        return ""
    weight = np.where(content, size, 0.0)
    if weight[region >= 0].sum() >= HALF * weight.sum():
        chosen = np.isin(region, np.unique(region[content & (region >= 0)]))
    else:
        # those with most of the weight lie one in another, the smallest last
        most = np.flatnonzero(_under(weight, number, page.parent) >= MOST * weight.sum())
        chosen = _below(np.arange(len(page.parent)) == most[-1], page.parent)[number]
    return "\n".join(x[0] for x, keep in zip(lines, chosen & ~boilerplate) if keep)


def _extracted(column: pa.Array) -> pa.Array:
    texts = []
    for batch in slices([pa.record_batch({"text": column})]):
        texts += [main_text(page) for page in batch.column("text").to_pylist()]
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["text", "n_chars"])


def extract(pages: DataFrame, html: str = "html") -> Column:
    """A struct ``text, n_chars`` of each page of ``pages``."""
    return F.arrow_udf(_extracted, "text string, n_chars long")(text_of(pages, html))


@query()
def op9_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", extract(pages).alias("found")).select("page_id", "url", "found.*")
