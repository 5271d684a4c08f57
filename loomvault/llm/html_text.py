"""Main text of web pages by text-to-tag ratio.

Parser events of the standard library stream through one handler that cuts a page into lines, one per
block of text, and counts characters and tags of each. The text-to-tag ratio of the lines is smoothed
with a Gaussian and cut at a threshold in two clusters. The lines above it choose the content region:
the deepest element that holds nearly all of their text. Every line of the region is kept, short ones
too, except what stands in page furniture (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments), which is known by element name, role, class or id.

An element that holds the page's first ``article`` or ``main`` is no furniture for its class or id, but for reader comments; a name that begins
with has-, no-, with- or without- says what is beside the element, not what it is. Where no such element marks the region, the heading right before it belongs to it.

Defined cases: null, empty and text-free pages give the empty text; broken markup, unclosed elements,
unknown declarations and cut-off pages are read as far as they go; a page of any length and depth is handled as a whole in
memory and time of its own size; an empty table gives an empty table; repeated rows and extra columns pass through, a new column replaces one of its name.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns

SIGMA = 1.0
# Share of the text above the threshold that the content region must hold.
HELD = 0.9

# Element names and words of HTML (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr br""".split())
HIDDEN = frozenset("head script style noscript template iframe object embed svg canvas audio video math title textarea select option".split())
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CONTENT = frozenset("article main".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIER = frozenset("ul ol dl table article section div main body html aside nav header footer form blockquote".split())
WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|adbox|adslot|banner|sponsor|sponsored|promo|promotion|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|aside|rail|widget|footer|foot|masthead|topbar|"
    r"comment|comments|commentlist|disqus|respond|replies|reply|discussion|cookie|cookies|consent|gdpr|notice|notices|alert|"
    r"popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|recommendations|"
    r"pagination|pager|toolbar|skip|copyright|legal|disclaimer)(?:$|[\s_-])", re.IGNORECASE)
BESIDE = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)[_-]\S*", re.IGNORECASE)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment|comments|commentlist|disqus|respond|replies|reply|discussion)(?:$|[\s_-])", re.IGNORECASE)
HEADINGS = frozenset("h1 h2".split())


class Line:
    """A block of text: its tags, the element that holds it, and whether it is a heading."""

    __slots__ = ("text", "tags", "element", "heading")

    def __init__(self, text: str, tags: int, element: int, heading: bool):
        self.text, self.tags, self.element, self.heading = text, tags, element, heading


class Lines(HTMLParser):
    """Cuts a page into lines of visible text. Elements are numbers that know their parent, so depth costs nothing.

    Text in furniture by element name or role is left out at once; furniture by class or id is noted, to be judged when the page is known.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.names, self.parents = ["#page"], [0]
        self.called: dict[int, bool] = {}  # furniture by class or id, and whether for reader comments
        self.first = 0  # the first article or main
        self.open: list[tuple[int, bool]] = []  # number, whether its text is left out
        self.depths: dict[str, list[int]] = {}  # where elements of a name are open
        self.barriers: list[int] = []
        self.lines: list[Line] = []
        self.words: list[str] = []
        self.tags = self.skipped = 0

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            heading = any(self.depths.get(h) for h in HEADINGS)
            self.lines.append(Line(text, max(1, self.tags), self.open[-1][0] if self.open else 0, heading))
            self.tags = 0
        self.words.clear()

    def furniture(self, tag: str, attrs) -> bool:
        """Whether an element is left out whatever it holds."""
        if tag in HIDDEN or tag in FURNITURE:
            return True
        if tag in ("html", "body", *CONTENT):
            return False
        if tag == "header":  # the header of an article belongs to it
            return not any(self.depths.get(c) for c in CONTENT)
        for key, value in attrs:
            value = value or ""
            if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return True
            if key == "style" and "display:none" in value.replace(" ", "").lower():
                return True
            if key in ("class", "id") and WORDS.search(BESIDE.sub(" ", value)):
                number = len(self.names)
                self.called[number] = self.called.get(number, False) or bool(COMMENTS.search(value))
        return False

    def leave(self, depth: int) -> None:
        while len(self.open) > depth:
            number, out = self.open.pop()
            name = self.names[number]
            self.depths[name].pop()
            if name in BARRIER:
                self.barriers.pop()
            self.skipped -= out

    def innermost(self, name: str) -> int:
        found = self.depths.get(name)
        return found[-1] if found else -1

    def handle_starttag(self, tag, attrs) -> None:
        self.tags += 1
        if tag == "br":
            self.words.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            for closed in (*CLOSED_BY_BLOCK, *SAME_LEVEL.get(tag, ())):
                depth = self.innermost(closed)
                if depth >= 0 and not (self.barriers and self.barriers[-1] > depth):
                    self.leave(depth)
        if tag in VOID:
            return
        out = self.furniture(tag, attrs)
        number = len(self.names)
        if tag in CONTENT and not self.skipped and not self.first:
            self.first = number
        self.names.append(tag)
        self.parents.append(self.open[-1][0] if self.open else 0)
        self.depths.setdefault(tag, []).append(len(self.open))
        if tag in BARRIER:
            self.barriers.append(len(self.open))
        self.open.append((number, out))
        self.skipped += out

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        depth = self.innermost(tag)
        if depth >= 0 and not (tag in INLINE and self.barriers and self.barriers[-1] > depth):
            self.leave(depth)

    def handle_data(self, data) -> None:
        if not self.skipped:
            self.words.append(data)

    def unknown_decl(self, data) -> None:
        """A marked section that is not of HTML shows nothing."""

    def parse_marked_section(self, i, report=1):
        """The end of ``<![...]>``, whatever its name; the rest of the page where it never ends."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def close(self) -> None:
        super().close()
        self.flush()


def smoothed(ratio: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over the neighbouring lines, weights renewed at both ends."""
    reach = max(1, int(np.ceil(2 * SIGMA)))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * SIGMA**2))
    padded, ones = np.pad(ratio, reach), np.pad(np.ones(len(ratio)), reach)
    return np.convolve(padded, kernel, "valid") / np.convolve(ones, kernel, "valid")


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters on the line: means of both sides, until they stay."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = float(new)
    return min(cut, float(values.std()) if values.std() > 0 else cut)


def _sums(parser: Lines, amounts: dict[int, float]) -> list[float]:
    """For each element what it holds; children have larger numbers than their parents."""
    held = [0.0] * len(parser.names)
    for element, amount in amounts.items():
        held[element] += amount
    for number in range(len(held) - 1, 0, -1):
        held[parser.parents[number]] += held[number]
    return held


def _within(parser: Lines, roots) -> list[bool]:
    """For each element whether it is one of ``roots`` or lies in one."""
    inside = [number in roots for number in range(len(parser.names))]
    for number in range(1, len(inside)):
        inside[number] = inside[number] or inside[parser.parents[number]]
    return inside


def _furniture_by_name(parser: Lines) -> list[bool]:
    spared, number = set(), parser.first
    while number:
        number = parser.parents[number]
        if not parser.called.get(number, True):
            spared.add(number)
    return _within(parser, parser.called.keys() - spared)


def main_text(page: str | None) -> str:
    """The main text of one page, blocks joined by a line break."""
    if not page:
        return ""
    parser = Lines()
    try:
        parser.feed(page)
        parser.close()
    except AssertionError:  # how the standard parser gives up on a declaration: what was read so far counts
        parser.flush()
    names, parents = parser.names, parser.parents
    around = _furniture_by_name(parser)
    lines = [x for x in parser.lines if not around[x.element]]
    if not lines:
        return ""
    size = np.array([len(x.text) for x in lines], float)
    values = smoothed(size / np.array([x.tags for x in lines], float))
    chosen = values >= threshold(values)
    amounts: dict[int, float] = {}
    counts: dict[int, float] = {}
    for line, amount, keep in zip(lines, size, chosen):
        counts[line.element] = counts.get(line.element, 0) + 1
        if keep:
            amounts[line.element] = amounts.get(line.element, 0.0) + float(amount)
    mass, blocks = _sums(parser, amounts), _sums(parser, counts)
    total = float(size[chosen].sum())
    marked = [n for n in range(1, len(names)) if names[n] in CONTENT and mass[n]]
    region = max(marked, key=lambda n: (mass[n], n)) if sum(mass[n] for n in marked) * 2 >= total and marked else 0
    if not region:
        region = max((n for n in range(1, len(names)) if names[n] not in INLINE and mass[n] >= HELD * total and blocks[n] > 1), default=0)
    roots = {region}
    if names[region] == "article":
        # several articles on one page form one text: those beside it, and others that hold as much
        roots.update(n for n in range(1, len(names)) if names[n] in CONTENT and (
            mass[n] * 4 >= mass[region] if mass[n] else False) or names[n] == "article" and parents[n] == parents[region])
    inside = _within(parser, roots)
    keep = [inside[x.element] for x in lines]
    if names[region] not in CONTENT:
        for at in range(keep.index(True) - 1 if True in keep else -1, -1, -1):
            if not lines[at].heading:
                break
            keep[at] = True
    return "\n".join(x.text for x, k in zip(lines, keep) if k)


FIELDS = T.StructType([T.StructField("main_text", T.StringType())])


def extract_main_text(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` without its ``html`` column and with ``main_text``."""
    return add_columns(df, html, FIELDS, lambda pages: [pa.array([main_text(p) for p in pages], pa.string())], keep_text=False)
