"""Main text of web pages by tag-path ratios.

A page becomes text blocks, each with the path of block elements from the root to it. Per path the text
length and the punctuation of all its blocks are added up and divided by their number. Both ratios are
smoothed over the blocks in page order, so that a short paragraph or a heading between long ones from them, averaged per path again and fused into one score between 0 and 1. Paths that reach ``SHARE``
are content.

Where the page has ``article`` or ``main`` elements, markup and ratios share the score: within them a
path is given a part by its last element (a heading enough, other text elements most of that, mere containers
little) and the ratios give the rest; beyond them the ratios count less than half. Links lower the ratios,
and beyond articles, in lists and in mere containers the whole score, by the path's share of text outside
links; a linked heading, paragraph or caption within an article stays, a list of nothing but links goes. All articles and mains count by their own text, but those with less than ``SHARE``
of the largest one's that are links for ``SHARE`` of their text or more, as teasers are.

What can be told by its markup never becomes a block: menus, page headers, footers, sidebars, forms,
scripts, styles, hidden and embedded elements. Elements whose class or id has a listed word (notices,
adverts, reader comments) go as well, unless they hold an article or main that counts, or hold most of
the page's text outside links while no article or main that counts stands apart from them. A paragraph,
heading or other text element within an article never goes for such a word.

Open elements know their path, innermost article and innermost listed element, so the time grows with the
page, however deep its elements are.

Blocks are decoded, their white space becomes single spaces, and two line ends join them in page order.

Defined results: a null, empty or markup-only page has an empty text. Unclosed elements end with their
parent, stray end tags are ignored, unfinished tags and comments run to the end of the page. Repeated
rows stay apart. Only the id, url and html columns are read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import record_batch, slices

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long"
SHARE = 0.25
# What standing within the article gives a path's score, by its last element; the ratios give the rest.
WITHIN_BARE, WITHIN_TEXT, WITHIN_HEADING = 0.1, 0.2, SHARE
BEYOND = 0.4  # the weight of the ratios beyond the article
KERNEL = np.array([1.0, 4.0, 6.0, 4.0, 1.0]) / 16
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡]")

TOKEN = re.compile(
    r"""<!--(?:.*?(?:-->|\Z)|>)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?>[^>"']+|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav"
    " ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements for running text; others merely contain it.
TEXTS = frozenset("p li dt dd td th pre blockquote figcaption caption".split())
ITEMS = frozenset("li dt dd".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea plaintext".split())
# Elements that never hold article text.
OUTSIDE = frozenset(
    "head nav aside footer form fieldset button select option datalist label input noscript template svg"
    " canvas object video audio menu dialog search map".split()
)
# Elements that hold none unless they stand within the article.
OUTSIDE_OF_PAGE = frozenset(["header", "hgroup"])
ROLES = frozenset(
    "navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar"
    " toolbar status".split()
)
# Words of class and id attributes.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall"
    " sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager"
    " footer masthead toolbar share sharing social related recommended recommendations teaser"
    " comment comments commentlist reply replies respond disqus newsletter subscribe subscription"
    " signup login widget hidden".split()
)
# First words of class names that tell what an element has or lacks, not what it is.
STATES = frozenset("no not has have with without".split())
CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
    "th": ("tr", "table"), "option": ("select",),
}
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html head td th tr tbody thead tfoot caption li dt dd".split())


class Path:
    """Element names from the root, shared by all that stand at the same path."""

    __slots__ = ("above", "last", "below")

    def __init__(self, above: Path | None, last: str):
        self.above, self.last = above, last
        self.below: dict[str, Path] = {}

    def __truediv__(self, name: str) -> Path:
        if name not in self.below:
            self.below[name] = Path(self, name)
        return self.below[name]

    def __str__(self) -> str:
        names, path = [], self
        while path.above is not None:
            names.append(path.last)
            path = path.above
        return "/".join(reversed(names))


@dataclass
class Block:
    path: Path
    text: str
    linked: int  # characters within links
    scope: int  # the innermost article or main it stands in, -1 if there is none


@dataclass
class _Scope:
    """An article or main. Elements with a listed class or id are called by their number."""

    named: int  # the innermost such element around it, itself included, or -1
    itself: bool  # has it such a class or id of its own?
    around: int  # the article or main it stands in, or -1


@dataclass
class _Listed:
    """An element with a listed class or id."""

    named: int  # the innermost other one around it, or -1
    around: int  # the article or main it stands in, or -1


@dataclass
class _Part:
    text: str
    linked: int
    named: int


@dataclass
class _Open:
    """An open element and what is around it, itself included."""

    name: str
    outside: bool
    path: Path
    scope: int
    named: int


@dataclass
class _Reader:
    """Open elements and the text of the block that is being read."""

    stack: list[_Open] = field(default_factory=lambda: [_Open("", False, Path(None, ""), -1, -1)])
    places: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))  # of open elements, by name
    block_places: list[int] = field(default_factory=list)
    parts: list[_Part] = field(default_factory=list)
    blocks: list[tuple[Path, int, list[_Part]]] = field(default_factory=list)
    in_link: int = 0
    scopes: list[_Scope] = field(default_factory=list)
    listed: list[_Listed] = field(default_factory=list)

    def outside(self) -> bool:
        return self.stack[-1].outside

    def read(self, text: str) -> None:
        linked = len(html.unescape(text).strip()) if self.in_link else 0
        self.parts.append(_Part(text, linked, self.stack[-1].named))

    def finish(self) -> None:
        """End the block: what was read belongs to the elements open now."""
        if self.parts:
            self.blocks.append((self.stack[-1].path, self.stack[-1].scope, self.parts))
            self.parts = []

    def drop(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().name].pop()
        while self.block_places and self.block_places[-1] >= place:
            self.block_places.pop()

    def close_to(self, place: int) -> None:
        self.finish()
        self.drop(place)

    def find(self, name: str, until: tuple[str, ...] = ()) -> int:
        """The place of the innermost open element of that name, or -1; none beyond those of ``until``."""
        place = self.places[name][-1] if self.places[name] else -1
        beyond = max((self.places[other][-1] for other in until if self.places[other]), default=-1)
        return place if place > beyond else -1

    def push(self, name: str, outside: bool, scope: int, named: int, block: bool) -> None:
        self.places[name].append(len(self.stack))
        if block:
            self.block_places.append(len(self.stack))
        self.stack.append(_Open(name, outside, self.stack[-1].path / name, scope, named))

    def open(self, name: str, attributes: str) -> None:
        if name in CLOSES_PARAGRAPH:
            place = self.find("p", ("table", "button", "td", "th"))
            if place >= 0:
                self.close_to(place)
        if name in CLOSED_BY_SAME:
            same = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            for other in same:
                place = self.find(other, CLOSED_BY_SAME[name])
                if place >= 0:
                    self.close_to(place)
        known = _known(attributes) if attributes.strip() else {}
        above = self.stack[-1]
        scope, named = above.scope, above.named
        outside = above.outside or _is_outside(name, known, scope >= 0)
        running = scope >= 0 and (name in TEXTS or name in HEADINGS)
        listed = not outside and not running and _is_listed(name, known, scope >= 0)
        if listed:
            self.listed.append(_Listed(named, scope))
            named = len(self.listed) - 1
        if name in BLOCKS:
            self.finish()
            if not outside and (name in ("article", "main") or known.get("role") in ("main", "article")):
                self.scopes.append(_Scope(named, listed, scope))
                scope = len(self.scopes) - 1
            self.push(name, outside, scope, named, True)
        elif listed or (outside and not above.outside):
            # An inline element that stands outside is kept on the stack, without ending its block.
            self.push(name, outside, scope, named, False)

    def close(self, name: str) -> None:
        place = self.find(name)
        if place < 0:
            if name == "p":
                self.finish()
            return
        if name in BLOCKS:
            self.close_to(place)
        elif not self.block_places or self.block_places[-1] < place:
            self.drop(place)


def _known(attributes: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)
    }


def _is_outside(name: str, known: dict[str, str], in_scope: bool) -> bool:
    if name in ("html", "body"):
        return False
    if name in OUTSIDE or (name in OUTSIDE_OF_PAGE and not in_scope):
        return True
    if not known:
        return False
    if "hidden" in known or known.get("aria-hidden") == "true" or known.get("role") in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", known.get("style", "")):
        return True
    return False


def _is_listed(name: str, known: dict[str, str], in_scope: bool) -> bool:
    """Whether a word of its class or id speaks against the element; "no-sidebar" says nothing of it."""
    if name in ("html", "body") or not known:
        return False
    for token in f"{known.get('class', '')} {known.get('id', '')}".split():
        words = re.findall(r"[a-z0-9]+", token)
        if words and words[0] not in STATES and (
            not NAMES.isdisjoint(words) or (not in_scope and "header" in words)
        ):
            return True
    return False


def _lengths(parts: list[_Part]) -> np.ndarray:
    """Characters outside links, and all."""
    lengths = [(len(part.text.strip()), part.linked) for part in parts]
    return np.array([sum(all_ - linked for all_, linked in lengths), sum(all_ for all_, _ in lengths)])


def _counting(sizes: dict[int, np.ndarray]) -> frozenset[int]:
    """The articles and mains that count: not those that are short and hold many links, as teasers do."""
    largest = max((int(size[0]) for size in sizes.values()), default=0)
    return frozenset(
        scope for scope, (unlinked, total) in sizes.items()
        if unlinked and (unlinked >= SHARE * largest or total - unlinked < SHARE * total)
    )


def _discarded(reader: _Reader) -> list[bool]:
    """Whether each listed element goes, by itself or with one around it.

    Those stay that hold an article or main that counts, and those that hold most of the page's text
    outside links if none that counts stands apart from them.
    """
    scopes, listed = reader.scopes, reader.listed
    if not listed:
        return []
    sizes: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(2, np.int64))
    held, total = [0] * len(listed), 0
    for _, scope, parts in reader.blocks:
        for part in parts:
            size = _lengths([part])
            total += int(size[0])
            if part.named >= 0:
                held[part.named] += int(size[0])
            if scope >= 0 and part.named == scopes[scope].named:
                sizes[scope] += size
    counting = _counting({scope: size for scope, size in sizes.items() if not scopes[scope].itself})
    holds = [False] * len(listed)
    for scope in counting:
        if scopes[scope].named >= 0:
            holds[scopes[scope].named] = True
    for element in range(len(listed) - 1, -1, -1):  # an element comes after the one around it
        around = listed[element].named
        if around >= 0:
            held[around] += held[element]
            holds[around] |= holds[element]
    counted: list[int] = []  # of each article and those around it, how many count
    for scope, known in enumerate(scopes):
        counted.append((counted[known.around] if known.around >= 0 else 0) + (scope in counting))
    gone: list[bool] = []
    for element, known in enumerate(listed):
        apart = (counted[known.around] if known.around >= 0 else 0) < len(counting)
        stays = holds[element] or (2 * held[element] > total and not apart)
        gone.append(not stays or (known.named >= 0 and gone[known.named]))
    return gone


def blocks_of(page: str) -> tuple[list[Block], frozenset[int]]:
    """The text blocks of a page in order, and the numbers of the articles and mains that count."""
    reader = _read(page)
    gone = _discarded(reader)
    blocks = []
    sizes: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(2, np.int64))
    for path, scope, parts in reader.blocks:
        kept = [part for part in parts if part.named < 0 or not gone[part.named]]
        text = " ".join(html.unescape("".join([part.text for part in kept])).split())
        if text:
            linked = min(sum(part.linked for part in kept), len(text))
            blocks.append(Block(path, text, linked, scope))
            if scope >= 0:
                sizes[scope] += (len(text) - linked, len(text))
    return blocks, _counting(sizes)


def _read(page: str) -> _Reader:
    reader = _Reader()
    at = 0
    while True:
        match = TOKEN.search(page, at)
        end = match.start() if match else len(page)
        if end > at and not reader.outside():
            reader.read(page[at:end])
        if not match:
            break
        at = match.end()
        if not match["name"]:
            continue
        name = match["name"].lower()
        if match["close"]:
            if name == "a":
                reader.in_link = 0
            elif name == "br" and not reader.outside():
                reader.read(" ")
            reader.close(name)
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = close.end() if close else len(page)
        elif name in VOID:
            if name == "hr":
                reader.open(name, "")
                reader.close(name)
            elif name == "br" and not reader.outside():
                reader.read(" ")
        else:
            if name == "a":
                reader.in_link = 1
            reader.open(name, match["attributes"])
    reader.finish()
    return reader


def _key(block: Block, articles: frozenset[int]) -> tuple[Path, bool]:
    return block.path, not articles or block.scope in articles


def _given(path: Path) -> float:
    return WITHIN_HEADING if path.last in HEADINGS else WITHIN_TEXT if path.last in TEXTS else WITHIN_BARE


def path_scores(blocks: list[Block], articles: frozenset[int] | None) -> dict[tuple[Path, bool], float]:
    """A score from 0 to 1 for each path, apart for blocks within and outside the articles."""
    articles = articles or frozenset()

    def key(block: Block) -> tuple[Path, bool]:
        return _key(block, articles)

    totals: dict[tuple[Path, bool], np.ndarray] = defaultdict(lambda: np.zeros(4))
    for block in blocks:
        marks = len(PUNCTUATION.findall(block.text))
        totals[key(block)] += (len(block.text) - block.linked, marks, 1, len(block.text))
    ratios = np.array([totals[key(b)][:2] / totals[key(b)][2] for b in blocks])
    padded = np.pad(ratios, ((2, 2), (0, 0)), mode="edge")
    smooth = sum(weight * padded[i : i + len(blocks)] for i, weight in enumerate(KERNEL))
    sums: dict[tuple[Path, bool], np.ndarray] = defaultdict(lambda: np.zeros(2))
    for block, value in zip(blocks, smooth):
        sums[key(block)] += value
    means = {path: value / totals[path][2] for path, value in sums.items()}
    fused = {path: float(np.sqrt(length * (1 + marks))) for path, (length, marks) in means.items()}
    best = max(fused.values()) or 1.0
    scores = {}
    for path, value in fused.items():
        unlinked = float(totals[path][0] / totals[path][3])
        if not articles:
            scores[path] = value / best
        elif path[1]:
            given = _given(path[0])
            scores[path] = given + (1 - given) * value / best
            if given == WITHIN_BARE or path[0].last in ITEMS:
                scores[path] *= unlinked
        else:
            scores[path] = unlinked * BEYOND * value / best
    return scores


def main_blocks(page: str) -> list[str]:
    """The content blocks of a page."""
    blocks, articles = blocks_of(page)
    if not blocks:
        return []
    scores = path_scores(blocks, articles)
    return [b.text for b in blocks if scores[_key(b, articles)] >= SHARE]


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page its main text and the number of its code points."""

    def run(batches):
        for batch in slices(batches, 2):
            kept = [main_blocks(page or "") for page in batch.column(2).to_pylist()]
            texts = ["\n\n".join(blocks) for blocks in kept]
            yield record_batch({
                "page_id": (pa.int64(), batch.column(0).to_pylist()),
                "url": (pa.string(), batch.column(1).to_pylist()),
                "text": (pa.string(), texts),
                "n_chars": (pa.int64(), [len(text) for text in texts]),
                "n_blocks": (pa.int64(), [len(blocks) for blocks in kept]),
            })

    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return source.mapInArrow(run, SCHEMA)
