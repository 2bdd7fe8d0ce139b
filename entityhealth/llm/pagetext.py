"""The main text of web pages by line-block distribution.

Markup is stripped and every block of a page becomes a line. Borders of
containers become blank lines, and what is no part of an article by its tag,
class or role is left out with its borders, unless it is around the article,
holds most of the page's text or, where the name is not sure, has a window that
surges although its letters count less. The lengths of the lines, link texts not counted, are summed over a
sliding window: where the sum surges a text begins, where it dives to nothing
the text ends, and the lines between are kept. On a page with an element that
holds most of the text by its tag or name, letters outside that element count
less; the sums decide inside it as on any page.
"""

from __future__ import annotations

import functools
import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A sum surges from so many characters on, or from this part of the window in which the median letter of the page lies.
SURGE = 80
SURGE_PART = 0.25
#: A legal line at the end of a page has no more letters.
LEGAL_LINE = 400
#: Blank lines between a text and a short run that belongs to it, at most, on pages without an element for the article.
NEARBY = 6

# Names of elements and attributes in HTML.
RAW = frozenset("script style title textarea noscript iframe noembed noframes template svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body div section article main aside nav header footer form ul ol dl table blockquote figure fieldset details dialog".split()
)
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre hr address figcaption caption summary center".split())
BORDERS = CONTAINERS - frozenset("html body ul ol dl table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
NO_TEXT = frozenset("nav footer aside".split())
CONTROLS = frozenset("dialog menu button select label".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar toolbar".split())
# Words in classes and ids that name parts of a page other than its article.
OTHER_PARTS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsored promo promotion sidebar sidebars masthead footer footnav
    cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus
    reply replies respond copyright login skyscraper outbrain taboola notice notices banner share sharing recommended
    recommendations breadcrumb breadcrumbs pagination pager""".split()
)
# Words that name parts of an article as well; a long text there is text.
MAYBE_PARTS = frozenset("sponsor rail nav navbar navigation menu menus related social widget widgets toolbar form forms".split())
# Words of the legal lines at the end of a page.
LEGAL = re.compile(
    r"©|\(c\) ?\d|\bcopyright\b|rights reserved|terms (?:of|and)|privacy|cookies|imprint|impressum|datenschutz|rechte vorbehalten"
    r"|nutzungsbedingungen|droits réservés|mentions légales|confidentialité|derechos reservados|aviso legal|privacidad",
    re.I,
)
HEADER_PARTS = frozenset("header topbar head".split())
ARTICLE_PARTS = frozenset("article post entry story content title".split())
# Those that an article element itself can be, and names of containers that hold an article.
OTHER_ARTICLES = frozenset("comment comments reply replies respond related recommended ad ads advert teaser promo".split())
ARTICLE_NAMES = frozenset("article articlebody post entry story content maincontent main".split())
# What a sentence ends with.
ENDS = (".", "!", "?", "…", ":", ";", "。", "！", "？", "।", "؟")
#: Elements that may hold the article are about as full if they hold this part of what the fullest holds.
ALIKE = 2 / 3
#: What a letter counts outside the element that holds the article, beside one inside it.
OUTSIDE = 0.125
#: What a letter counts in a part of another name, beside one outside such parts.
IN_PART = 0.25

# Kinds of parts: never seen as text, by element or role, by a surer or a less sure name, forms.
UNSEEN, ELEMENT, NAMED, MAYBE, FORM = 1, 2, 3, 4, 5

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_QUALIFIED = re.compile(r"\b(?:with|has|no|without|is)[-_][a-z0-9]+")
# References to characters by numbers: zeros before them, and numbers that no character has.
_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
_TOO_LARGE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_HALF_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")


def _part(name: str, attributes: str, in_article: bool) -> int:
    """What kind of part of the page other than its article an element is; 0 if none."""
    if name in CONTROLS:
        return UNSEEN
    if name == "form":
        kind = FORM
    else:
        kind = ELEMENT if name in NO_TEXT or (name == "header" and not in_article) else 0
    if not attributes or name in ("html", "body", "main"):
        return kind
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if (key == "aria-hidden" and value == "true") or (key == "hidden" and value != "until-found"):
            return UNSEEN
        if key == "style" and "display:none" in value.replace(" ", ""):
            return UNSEEN
        if key == "role" and value == "form":
            kind = kind or FORM
        elif key == "role" and value in NO_TEXT_ROLES:
            kind = ELEMENT
    if kind or _holds_article(name, attributes) == 2:
        return kind
    named = _named(attributes)
    if name == "article":
        return NAMED if named & OTHER_ARTICLES else 0
    if named & OTHER_PARTS or (named & HEADER_PARTS and not in_article and not named & ARTICLE_PARTS):
        return NAMED
    return MAYBE if named & MAYBE_PARTS else 0


def _named(attributes: str) -> set[str]:
    """The words in an element's class and id."""
    named: set[str] = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id"):
            named.update(_WORDS.findall(_QUALIFIED.sub(" ", value.lower())))
    return named


def _holds_article(name: str, attributes: str) -> int:
    """How surely an element is the one around the article; 0 if it is not."""
    if name == "article":
        return 3
    if name == "main" or re.search(r"role\s*=\s*[\"']?main\b", attributes, re.I):
        return 2
    return int(name in ("div", "section") and bool(attributes) and bool(_named(attributes) & ARTICLE_NAMES))


class Line(NamedTuple):
    """A line of a page: text, letters outside links, the innermost region and part around it."""

    said: str
    n: int
    region: int  # of the elements that may hold the article; NONE if none does
    part: int
    level: int  # of a heading; 0 of other lines


NONE = -1


@functools.cache
def _raw_end(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}\s*>", re.I)


class _Lines:
    """The lines of a page, its parts and its regions.

    Both are numbered in page order and know the number of the next one around
    them, so what holds for a whole nest is told in one pass over the numbers.
    """

    def __init__(self) -> None:
        self.rows: list[Line] = []
        self.kinds: list[int] = []
        self.outer_part: list[int] = []
        self.sure: list[int] = []
        self.outer_region: list[int] = []
        self.part_of_region: list[int] = []
        self.text: list[str] = []
        self.linked: list[str] = []
        self.region = self.part = NONE
        self.level = 0

    def end(self) -> None:
        said = " ".join("".join(self.text).split())
        if said:
            of_links = len(" ".join("".join(self.linked).split()))
            self.rows.append(Line(said, max(0, len(said) - of_links), self.region, self.part, self.level))
        self.text, self.linked = [], []

    def blank(self) -> None:
        self.end()
        self.rows.append(Line("", 0, self.region, self.part, 0))

    def open_part(self, kind: int) -> None:
        self.end()
        self.kinds.append(kind)
        self.outer_part.append(self.part)
        self.part = len(self.kinds) - 1

    def open_region(self, sure: int) -> None:
        self.sure.append(sure)
        self.outer_region.append(self.region)
        self.part_of_region.append(self.part)
        self.region = len(self.sure) - 1


def _within(outer: list[int], chosen: set[int]) -> list[bool]:
    """Whether each of nested numbers is one of the chosen or inside one; the last answer is that of NONE."""
    found: list[bool] = []
    for i, around in enumerate(outer):
        found.append(i in chosen or (around != NONE and found[around]))
    return [*found, False]


def _added_up(outer: list[int], own: list[float]) -> list[float]:
    """What nested numbers hold together with all inside them."""
    whole = list(own)
    for i in range(len(outer) - 1, -1, -1):
        if outer[i] != NONE:
            whole[outer[i]] += whole[i]
    return whole


def _unescape(text: str) -> str:
    """Character references decoded; numbers beyond all characters have none."""
    text = _ZEROS.sub(r"&#\1", text)
    return html.unescape(_TOO_LARGE.sub("\ufffd", text))


def _lines(page: str) -> _Lines:
    lines = _Lines()
    # Open containers: name, whether a reader sees only its headings, the region and the part around it.
    stack: list[tuple[str, bool, int, int]] = []
    opened: Counter[str] = Counter()
    only_headings = 0
    unseen: int | None = None  # where in the stack the element lies that is left out
    links = at = 0
    heading = False
    # No tag ends behind the last of these, so nothing is searched there.
    last = page.rfind(">") + 1

    def close(name: str) -> None:
        nonlocal unseen, only_headings
        if not opened[name]:
            return
        k = len(stack) - 1
        while stack[k][0] != name:
            k -= 1
        outer = unseen is None or unseen >= k
        breaks = outer and (unseen is None or name in BLOCKS or stack[unseen][0] in BLOCKS)
        _, _, region, part = stack[k]
        for inner, only, _, _ in stack[k:]:
            opened[inner] -= 1
            only_headings -= only
        del stack[k:]
        if breaks:
            lines.end()
        if outer:
            if lines.part != part:
                lines.end()
            lines.region, lines.part, unseen = region, part, None

    def add(raw: str) -> None:
        if unseen is None and raw and (heading or not only_headings):
            said = _unescape(raw) if "&" in raw else raw
            lines.text.append(said)
            if links:
                lines.linked.append(said)

    while m := _TOKEN.search(page, at, last):
        add(page[at : m.start()])
        open_comment = m[0].startswith("<!--") and not m[0].endswith("-->")
        at = len(page) if open_comment else m.end()
        name, closing, attributes = (m[2] or m[5] or "").lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if not name:
            continue
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                ended = _raw_end(name).search(page, at)
                at = ended.end() if ended else len(page)
            continue
        if name in BLOCKS:
            # A block ends the paragraph before it.
            if stack and stack[-1][0] == "p" and not closing:
                close("p")
            if unseen is None:
                lines.end()
                lines.level = int(name[1]) if name in HEADINGS and not closing else 0
                if name in BORDERS:
                    links = 0
                    if closing:
                        lines.blank()
        elif name in ("br", "td", "th"):
            add(" ")
        if name in HEADINGS:
            heading = not closing
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
        if closing:
            close(name)
        elif name not in VOID and not attributes.endswith("/"):
            kind = _part(name, attributes, lines.region != NONE) if unseen is None else 0
            if name in INLINE and kind:
                # A part of a line, not of the page.
                kind = 0 if kind == MAYBE else UNSEEN
            if kind or name in CONTAINERS:
                only = name == "header" and not kind
                stack.append((name, only, lines.region, lines.part))
                opened[name] += 1
                only_headings += only
                if kind == UNSEEN:
                    unseen = len(stack) - 1
                elif kind:
                    lines.open_part(kind)
                elif unseen is None and (sure := _holds_article(name, attributes)):
                    lines.open_region(sure)
                if name in BORDERS and unseen is None:
                    lines.blank()
    add(_HALF_TAG.sub("", page[at:]))
    lines.end()
    return lines


def _weights(lines: _Lines) -> list[float]:
    """What the letters outside links of every line count: less in parts that are named like no article."""
    share = []
    for kind, around in zip(lines.kinds, lines.outer_part):
        share.append((share[around] if around != NONE else 1.0) * (1.0 if kind == FORM else IN_PART))
    return [r.n * share[r.part] if r.part != NONE else float(r.n) for r in lines.rows]


def _region(lines: _Lines, weights: list[float]) -> int:
    """Where to look: the fullest element that may hold the article; of those about as full the surest, then the fullest.

    NONE if long lines outside it hold more than twice as much.
    """
    own = [0.0] * len(lines.sure)
    for r, weight in zip(lines.rows, weights):
        if r.region != NONE:
            own[r.region] += weight
    inside = _added_up(lines.outer_region, own)
    most = max(inside, default=0)
    alike = [i for i, held in enumerate(inside) if held and held >= ALIKE * most]
    if not alike:
        return NONE
    chosen = max(alike, key=lambda i: (lines.sure[i], inside[i], -i))
    within = _within(lines.outer_region, {chosen})
    beside = sum(weight for r, weight in zip(lines.rows, weights) if r.n >= SURGE and not within[r.region])
    return chosen if beside <= 2 * inside[chosen] else NONE


def _surge(rows: list[Line]) -> float:
    """The sum from which a window surges on this page; SURGE at most, less on pages of short lines."""
    windows = sorted(sum(r.n for r in rows[i : i + WINDOW]) for i in range(len(rows)))
    whole, seen = sum(windows), 0
    for size in windows:
        seen += size
        if 2 * seen >= whole:
            return min(SURGE, SURGE_PART * size)
    return SURGE


def _neighbours(lines: _Lines, rows: list[Line], chosen: int, surge: float) -> set[int]:
    """The chosen element and those beside it of the same kind whose windows surge too."""
    outer = lines.outer_region
    # Of every region the one around it, or itself, that lies beside the chosen one.
    beside: list[int] = []
    for i, around in enumerate(outer):
        beside.append(i if around == outer[chosen] else beside[around] if around != NONE else NONE)
    sizes: dict[int, list[int]] = {}
    for r in rows:
        at = beside[r.region] if r.region != NONE else NONE
        if at != NONE and lines.sure[at] == lines.sure[chosen]:
            sizes.setdefault(at, []).append(r.n)
    return {chosen} | {r for r, held in sizes.items() if any(sum(held[i : i + WINDOW]) >= surge for i in range(len(held)))}


def _spared(lines: _Lines, weights: list[float], chosen: int) -> list[bool]:
    """Of every part whether it is no other than the article with all around it; the last answer is that of no part.

    No other is what is around the article, has most of the page's text or, where
    the name is not sure, a window that surges among letters that count less.
    """
    n = len(lines.kinds)
    own, texts, links, fullest = ([0.0] * n for _ in range(4))
    for i, (r, weight) in enumerate(zip(lines.rows, weights)):
        if r.part != NONE:
            own[r.part] += weight
            texts[r.part] += r.n
            links[r.part] += len(r.said) - r.n
            window = sum(x.n for x in lines.rows[i : i + WINDOW] if x.part == r.part)
            fullest[r.part] = max(fullest[r.part], IN_PART * window)
    held, texts, links = (_added_up(lines.outer_part, x) for x in (own, texts, links))
    for p in range(n - 1, -1, -1):
        if lines.outer_part[p] != NONE:
            fullest[lines.outer_part[p]] = max(fullest[lines.outer_part[p]], fullest[p])
    spared, whole = set(), sum(weights)
    part = lines.part_of_region[chosen] if chosen != NONE else NONE
    while part != NONE:
        spared.add(part)
        part = lines.outer_part[part]
    for p, kind in enumerate(lines.kinds):
        if kind != ELEMENT and 2 * held[p] > whole:
            spared.add(p)
        elif kind == MAYBE and fullest[p] >= SURGE and texts[p] > links[p]:
            spared.add(p)

    def fine() -> list[bool]:
        found: list[bool] = []
        for p, around in enumerate(lines.outer_part):
            found.append(p in spared and (around == NONE or found[around]))
        return [*found, True]

    kept = fine()
    if not any(r.said and kept[r.part] for r in lines.rows):
        # Nothing has another name, so names tell nothing.
        spared.update(p for p, kind in enumerate(lines.kinds) if kind in (NAMED, MAYBE, FORM))
        kept = fine()
    return kept


#: First line, line after the last, fullest window.
Run = tuple[int, int, int]


def _runs(rows: list[Line]) -> list[Run]:
    """The runs of lines from where the window sums surge from nothing to where they dive to nothing."""
    windows = [sum(r.n for r in rows[i : i + WINDOW]) for i in range(len(rows))]
    runs: list[Run] = []
    start = None
    for i, size in enumerate([*windows, 0]):
        if start is None and size and rows[i].n:
            start = i
        elif start is not None and not size:
            runs.append((start, i, max(windows[start:i])))
            start = None
    return runs


def _edges(rows: list[Line], run: Run) -> tuple[int, int]:
    """A run with the lines of links at its edges, where they are too few for a dive."""
    first, end = run[:2]
    before, after = first, end
    while before and rows[before - 1].said and not rows[before - 1].n:
        before -= 1
    while after < len(rows) and rows[after].said and not rows[after].n:
        after += 1
    return (before if first - before < WINDOW else first), (after if after - end < WINDOW else end)


def _headings(rows: list[Line], first: int, lowest: int = 6, known: set[int] = frozenset()) -> list[int]:
    """The headings right before a line, up to one that is known."""
    found = []
    for i in range(first - 1, -1, -1):
        if i in known:
            break
        if rows[i].said:
            if not 0 < rows[i].level <= lowest:
                break
            found.append(i)
    return found


def _beside(rows: list[Line], runs: list[Run], texts: set[int], inside: bool) -> set[int]:
    """The runs with no line of links between them and a text: all inside an element, else the next one nearby."""
    found = set(texts)
    for order in (range(1, len(runs)), range(len(runs) - 2, -1, -1)):
        for k in order:
            other = k - 1 if order.step > 0 else k + 1
            if other in (found if inside else texts):
                lo, hi = (runs[other][1], runs[k][0]) if other < k else (runs[k][1], runs[other][0])
                if not any(r.said for r in rows[lo:hi]) and (inside or hi - lo <= NEARBY):
                    found.add(k)
    return found


def _kept(rows: list[Line], surge: float, inside: bool) -> tuple[set[int], int]:
    """The lines of the runs that are text, with the short ones beside them, and the fullest window."""
    runs = _runs(rows)
    fullest = max((r[2] for r in runs), default=0)
    texts = {k for k, run in enumerate(runs) if run[2] >= surge or run[2] == fullest}
    kept: set[int] = set()
    for k in sorted(_beside(rows, runs, texts, inside)):
        first, end = _edges(rows, runs[k])
        kept.update(_headings(rows, first, known=kept))
        kept.update(range(first, end))
    return kept, fullest


def _without_legal_end(rows: list[Line], kept: set[int]) -> set[int]:
    """The kept lines without the legal ones that end a page, where other lines remain."""
    order = sorted(i for i in kept if rows[i].said)
    while len(order) > 1 and len(rows[order[-1]].said) <= LEGAL_LINE and LEGAL.search(rows[order[-1]].said):
        # Its own paragraph in another container, not the end of the text itself.
        if not any(not rows[i].said for i in range(order[-2] + 1, order[-1])):
            break
        order.pop()
    return set(order)


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks in order, one per line; empty if there is none."""
    lines = _lines(page or "")
    weights = _weights(lines)
    chosen = _region(lines, weights)
    spared = _spared(lines, weights, chosen)
    rows = [r for r in lines.rows if spared[r.part]]
    surge = _surge(rows)
    named = chosen != NONE
    within = _within(lines.outer_region, _neighbours(lines, rows, chosen, surge) if named else set())
    inside = [i for i, r in enumerate(rows) if not named or within[r.region]]
    found, fullest = _kept([rows[i] for i in inside], surge, named)
    kept = {inside[i] for i in found}
    if named:
        kept.update(_headings(rows, min(kept, default=0), 1))
        # Elsewhere a letter counts less.
        for outside, some in itertools.groupby(range(len(rows)), lambda i: not within[rows[i].region]):
            at = list(some)
            for first, end, window in _runs([rows[i] for i in at]) if outside else ():
                if window * OUTSIDE >= fullest:
                    kept.update(at[first:end])
    else:
        kept = _without_legal_end(rows, kept)
    return "\n".join(rows[i].said for i in sorted(kept) if rows[i].said)


def text_column(page: Column) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return texts(page)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` for every row.

    Character references are decoded; white space inside a block becomes one
    space. NULL and empty pages, and pages without text, have an empty text.
    Markup that is cut off or not closed is read as far as it goes, in time that
    grows with the page's length only. Repeated rows
    and NULL ids come out as they went in. Other columns are not read.
    """
    rows = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), text_column(pages[html_col]).alias("text")
    )
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
