"""Main text of web pages from parser events and the text-to-tag ratio of lines.

A page is fed to the standard library's parser once. Its events build lines (blocks of
text) with the number of tags met since the line before and the containers around it. The
text-to-tag ratio of the lines is smoothed with a Gaussian kernel and split in two clusters;
lines of the upper cluster are content. The region that holds most of their text (an article
or main element where there is one) is the main text: every line in it counts, short ones
too, except what stands in a menu, header, footer, sidebar, notice, advert, form, script,
style or comment section. Elements and roles say so themselves; a class or an id is a hint only, which
the text overrules: where no article has text beside it, a container that holds half of the page's text is
never dropped for its name.
All steps take time in proportion to the page, however deep its elements are nested.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import map_slices

# Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "nav header footer aside form script style noscript template iframe object svg canvas select button "
    "textarea dialog menu head title audio video".split()
)
SECTIONING = ("article", "main")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar sidebars aside footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices "
    "comment comments disqus reply replies share sharing social newsletter subscribe popup modal related recommended "
    "pagination pager widget toolbar skip".split()
)
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SIGMA, ITERATIONS = 1.0, 20
#: Elements whose end tag may be missing: a block element starting inside a paragraph ends it.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
#: Parts of a class name that say that the other parts are not about the element itself.
MODIFIERS = frozenset("has no not with without free open closed enabled disabled layout page body wrapper".split())
WORD = re.compile(r"[A-Za-z]+")
#: Elements of running text: only a whole class name counts as a hint there, not a part of one.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figure figcaption article main".split()) | INLINE
#: Share of a page's text that an element must hold for its name not to count; of the heaviest article for another one to stand beside it.
OVERRULED, BESIDE = 0.5, 0.5
#: More articles alike than this are a list of teasers.
MOST_ARTICLES = 3


def hinted(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class or an id hints that an element is no content."""
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.split():
                parts = [w.lower() for w in WORD.findall(token)]
                if token.lower() in SKIPPED_WORDS:
                    return True
                if tag not in TEXTUAL and not MODIFIERS.intersection(parts) and SKIPPED_WORDS.intersection(parts):
                    return True
    return False


def marked(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the attributes say that an element is no content."""
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if not value:
            continue
        if name == "role" and value.strip().lower() in SKIPPED_ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


class Lines(HTMLParser):
    """Collects lines: text, tags since the last line, enclosing regions."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int]] = []  # element, skipped, region number
        self.places: dict[str, list[int]] = {}  # places of the open elements of a name in the stack
        self.blocks: list[int] = []  # places of the open elements that are not inline
        self.lines: list[tuple[str, int, int]] = []  # text, tags, region
        self.regions: list[tuple[int, str, bool]] = [(-1, "", False)]  # parent, kind of section, hinted to be no content
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, max(1, self.tags), self.region()))
            self.tags = 0

    def region(self) -> int:
        return self.stack[-1][2] if self.stack else 0

    def skipping(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    def last(self, names) -> int:
        """Place of the innermost open element of one of the names, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def close_to(self, depth: int) -> None:
        if depth < len(self.stack):
            self.flush()
            self.cut(depth)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close_open({"p"}, CLOSES_P - {"p"})
        elif tag in ITEMS:
            self.close_open({"td", "th"} if tag in ("td", "th") else {"dt", "dd"} if tag in ("dt", "dd") else {tag}, set(ITEMS[tag]))
        own = tag not in ("html", "body")
        skipped = self.skipping() or tag in SKIPPED or own and marked(attrs)
        if tag == "article":  # an article inside an article is a reader's comment on it
            skipped = skipped or bool(self.places.get("article"))
        region, hint = self.region(), own and not skipped and hinted(tag, attrs)
        if hint or tag not in INLINE and tag != "p":
            kind = tag if tag in SECTIONING else "main" if ("role", "main") in attrs else ""
            self.regions.append((region, kind, hint))
            region = len(self.regions) - 1
        if hint and tag in INLINE:
            self.flush_inline()
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, skipped, region))

    def flush_inline(self) -> None:
        """A hinted inline element is a line of its own."""
        tags, self.tags = self.tags, max(1, self.tags - 1)
        self.flush()
        self.tags = self.tags or tags

    def close_open(self, names: set[str], stops: frozenset | set) -> None:
        """End an element of ``names`` whose end tag was left out, unless a container stands between."""
        at = self.last(names)
        if at >= 0 and at > self.last(stops):
            self.close_to(at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        at = self.last((tag,))
        if at < 0:
            return
        if tag not in INLINE:
            self.close_to(at)
        elif not self.blocks or self.blocks[-1] < at:
            if self.stack[at][2] != (self.stack[at - 1][2] if at else 0):
                self.flush()
            self.cut(at)

    def handle_data(self, data: str) -> None:
        if not self.skipping():
            self.parts.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing, the kernel normalised at the edges."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel)[reach:-reach] / np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]


def threshold(values: np.ndarray) -> float:
    """Border of two clusters of the values (two means); the least value if all are equal."""
    low, high = float(values.min()), float(values.max())
    if low == high:
        return low
    for _ in range(ITERATIONS):
        border = (low + high) / 2
        upper = values >= border
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def weights(regions: list[tuple[int, str, bool]], lines: list[tuple[str, int, int]], counts: np.ndarray) -> np.ndarray:
    """Text of the counted lines in each region and all regions inside it; a region comes after its parent."""
    total = np.zeros(len(regions), dtype=np.int64)
    for (text, _, region), counted in zip(lines, counts.tolist(), strict=True):
        if counted:
            total[region] += len(text)
    for region in range(len(regions) - 1, 0, -1):
        total[regions[region][0]] += total[region]
    return total


def within(regions: list[tuple[int, str, bool]], chosen: set[int]) -> list[bool]:
    """Of each region, whether it is one of the chosen or inside one."""
    out: list[bool] = []
    for region, (parent, _, _) in enumerate(regions):
        out.append(region in chosen or parent >= 0 and out[parent])
    return out


def main_text(html: str | None) -> str:
    """Lines of the main region in page order, joined by one space; empty if there is none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines, regions = parser.lines, parser.regions
    if any(hint for _, _, hint in regions):
        dropped = within(regions, {r for r, (_, _, hint) in enumerate(regions) if hint})
        sections = within(regions, {r for r, (_, kind, _) in enumerate(regions) if kind})
        if not any(sections[region] and not dropped[region] for _, _, region in lines):
            # no article or main element has text without the hinted ones: the text overrules a hint on what holds most of it
            size = weights(regions, lines, np.ones(len(lines), dtype=bool))
            dropped = within(regions, {r for r, (_, _, hint) in enumerate(regions) if hint and size[r] < OVERRULED * size[0]})
        lines = [line for line in lines if not dropped[line[2]]]
    if not lines:
        return ""
    ratios = np.array([len(text) / tags for text, tags, _ in lines], dtype=float)
    smooth = smoothed(ratios)
    weight, size = weights(regions, lines, smooth >= threshold(smooth)), weights(regions, lines, np.ones(len(lines), dtype=bool))
    total = int(weight[0])
    for kind in SECTIONING:
        found = [r for r in range(len(regions)) if regions[r][1] == kind]
        heaviest = max(found, key=lambda r: (weight[r], -r), default=0)
        # articles count if they hold most of the content; a list of teasers does not
        alike = {r for r in found if size[r] >= BESIDE * size[heaviest]}
        alike = alike if len(alike) <= MOST_ARTICLES else {heaviest}
        if heaviest and 2 * sum(int(weight[r]) for r in alike) >= total > 0:
            inside = within(regions, alike)
            return " ".join(text for text, _, region in lines if inside[region])
    # no such element: the smallest container with nearly all of the content
    best = min((r for r in range(len(regions)) if weight[r] and weight[r] >= 0.9 * total), key=lambda r: (weight[r], -r), default=0)
    inside = within(regions, {best})
    return " ".join(text for text, _, region in lines if inside[region])


def page_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored. Null or empty
    html gives an empty text; null ids and urls stay null; repeated rows give repeated rows;
    broken markup is read as the parser reads it, an element left open ends with its container.
    Nothing is shuffled, and the memory of a task is one page's lines.
    """

    def make():
        def texts(ids, urls, htmls):
            found = [main_text(h) for h in htmls]
            return {"page_id": ids, "url": urls, "text": found, "n_chars": [len(t) for t in found]}

        return texts

    columns = [F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")]
    return map_slices(pages.select(*columns), make, "page_id long, url string, text string, n_chars long")
