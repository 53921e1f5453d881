"""Main text of web pages by tag-path ratios.

Every piece of text has a path of tags from the root. Per path, the length of its
text and its punctuation are summed and divided by its number of pieces. Both ratios
are smoothed over neighbouring pieces, multiplied, and averaged back to paths; paths
above a threshold are content.

Tags, roles and class names mark boilerplate, unless the scores speak against it: a
marked element that holds the main article, and one marked by its name (or a form) that
holds the first heading or all text there is, is none if it has more score than all text
outside marked elements. What article and main
tags hold is the article, with text beside them whose path is above the threshold or
that stands in paragraphs; on pages without these tags it is what the smallest container
of all content holds. Bare lists of links outside article and main go if their path is
below the threshold.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import by_batch

# Weights of a piece's neighbours when ratios are smoothed.
KERNEL = np.array([1, 2, 4, 2, 1]) / 10
# A path is content from this share of the page's mean score on (mean by characters).
SHARE_OF_MEAN = 0.25

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[a-zA-Z/!][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PUNCTUATION = re.compile(r"[.,;:!?…()\"'«»¿¡-]")
NAME_PARTS = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])|(?<=[a-z])(?=[0-9])")

# Kinds of tags of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn del em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog div dl dir fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd tr td th tbody thead tfoot".split()
)
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("html body article main section div td th ul ol dl table nav aside header footer form blockquote figure".split())
CONTAINERS = frozenset("html body article main section div td center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Tags, roles and names of boilerplate.
BOILERPLATE_TAGS = frozenset("head nav footer aside form button select option textarea input dialog svg annotation annotation-xml object canvas audio video menu".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored sponsors promo promos promotion "
    "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer foot "
    "comment comments disqus respond reply replies cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "pagination pager toolbar masthead topbar copyright skip tags widget widgets".split()
)
# Words that say nothing of a name's meaning: a name marks boilerplate if all its words
# are names of boilerplate or such.
NEUTRAL_NAMES = frozenset(
    "site page main left right top bottom first second primary secondary global local list lists box boxes block area bar container "
    "wrapper wrap inner outer section buttons button links link item items post posts article articles content body text message "
    "panel slot unit row col column grid holder group module view region js and the".split()
)
NEVER_MARKED = frozenset("html body".split())
PARAGRAPHS = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 dd figcaption".split())


class _Element:
    """An open tag: its place in the tree, what marks it, and what it stands in. Elements
    are numbered in page order, so those inside have the numbers up to ``end``."""

    __slots__ = ("end", "header", "heading", "hidden", "in_article", "item", "link", "marked", "name", "number", "paragraph", "parent", "path")

    def __init__(self, number: int, name: str, parent: _Element | None, attributes: str, path: int) -> None:
        self.number, self.end, self.name, self.parent, self.path = number, number, name, parent, path
        own = name in ("article", "main")
        self.in_article = own or bool(parent and parent.in_article)
        self.header = name == "header" or bool(parent and parent.header)
        self.heading = name in HEADINGS or bool(parent and parent.heading)
        self.link = name == "a" or bool(parent and parent.link)
        self.item = name == "li" or bool(parent and parent.item)
        self.paragraph = name in PARAGRAPHS or bool(name in INLINE and parent and parent.paragraph)
        self.hidden = False
        self.marked = self._marked(attributes)

    def _marked(self, attributes: str) -> bool:
        if self.name in BOILERPLATE_TAGS or (self.name == "header" and not self.in_article):
            return True
        if self.name in NEVER_MARKED or not attributes or attributes.isspace():
            return False
        given = {}
        for name, *values in ATTRIBUTE.findall(attributes):
            given.setdefault(name.lower(), next(filter(None, values), ""))
        self.hidden = "hidden" in given or given.get("aria-hidden") == "true"
        if self.hidden or given.get("role", "").lower() in BOILERPLATE_ROLES:
            return True
        names = f"{given.get('class', '')} {given.get('id', '')}".split()
        marks = BOILERPLATE_NAMES if self.in_article or self.name in HEADINGS else BOILERPLATE_NAMES | {"header"}
        return any(_says(name, marks) for name in names)


def _says(name: str, marks: frozenset) -> bool:
    """Whether a class or id consists of words of ``marks`` and neutral ones. A number is
    neutral; words of another meaning (``no-sidebar``, ``share-price``) keep it from marking."""
    words = [w.lower() for w in NAME_PARTS.split(name) if w]
    told = [w for w in words if w not in NEUTRAL_NAMES and not w.isdigit()]
    return bool(told) and all(w in marks for w in told)


@dataclass
class _Piece:
    text: str
    element: _Element
    block: int


def pieces(html: str) -> tuple[list[_Piece], list[_Element]]:
    """The texts of a page in order, with their element and the block they stand in, and
    the elements in order. Tags that are left open or closed without being open are borne
    with. Work and memory are in proportion to the page, however deep its tags nest."""
    root = _Element(0, "#", None, "", 0)
    at, block, found, stack, elements = 0, 0, [], [root], [root]
    paths: dict[tuple[int, str], int] = {}
    opened: dict[str, int] = defaultdict(int)

    def cut(place: int) -> None:
        for element in stack[place:]:
            element.end = len(elements) - 1
            opened[element.name] -= 1
        del stack[place:]

    def close(names: tuple[str, ...], scopes: frozenset) -> None:
        if not any(opened[name] for name in names):
            return
        for place in range(len(stack) - 1, 0, -1):
            if stack[place].name in names:
                cut(place)
                return
            if stack[place].name in scopes:
                return

    def add(text: str) -> None:
        if text:
            found.append(_Piece(unescape(text), stack[-1], block))

    while match := TOKEN.search(html, at):
        add(html[at : match.start()])
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            block += 1
        if match["close"]:
            close((name,), frozenset())
            continue
        if name in ENDS_PARAGRAPH:
            close(("p",), SCOPES)
        if name in HEADINGS:
            close(tuple(HEADINGS), SCOPES)
        if name in SAME_LEVEL:
            close(SAME_LEVEL[name], SCOPES - {"td", "th"})
        if name == "body":
            close(("head",), frozenset())
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not match["rest"].endswith("/"):
            path = paths.setdefault((stack[-1].path, name), len(paths) + 1)
            stack.append(_Element(len(elements), name, stack[-1], match["rest"], path))
            elements.append(stack[-1])
            opened[name] += 1
    add(html[at:])
    cut(0)
    return found, elements


def path_scores(found: list[_Piece]) -> dict[int, float]:
    """The fused and smoothed ratio of each path."""
    lengths = np.array([len(" ".join(p.text.split())) for p in found], float)
    marks = np.array([len(PUNCTUATION.findall(p.text)) for p in found], float)
    places: dict[int, int] = {}
    number = np.array([places.setdefault(p.element.path, len(places)) for p in found])
    count = np.bincount(number)
    side = len(KERNEL) // 2
    length, mark = (
        np.convolve((np.bincount(number, values) / count)[number], KERNEL, "full")[side:-side] for values in (lengths, marks)
    )
    averaged = np.bincount(number, length * (1 + mark)) / count
    return dict(zip(places, averaged.tolist(), strict=True))


def _boilerplate(found: list[_Piece], elements: list[_Element]) -> list[bool]:
    """For each element, whether it or one around it is boilerplate."""
    told = [p for p in found if not p.text.isspace()]
    scores = path_scores(told) if told else {}
    nearest = [0] * len(elements)  # the nearest marked element, 0 for none
    for element in elements[1:]:
        nearest[element.number] = element.number if element.marked else nearest[element.parent.number]
    # Score by the nearest marked element, and within every element.
    own, along = [0.0] * len(elements), [0.0] * (len(elements) + 1)
    for piece in told:
        if not piece.element.link:
            weight = scores[piece.element.path] * len(piece.text)
            own[nearest[piece.element.number]] += weight
            along[piece.element.number + 1] += weight
    for n in range(len(elements)):
        along[n + 1] += along[n]
    articles = [e for e in elements if e.name in ("article", "main") and not e.marked]
    article = max(articles, key=lambda e: along[e.end + 1] - along[e.number], default=None)
    heading = next((e for e in elements if e.name == "h1"), None)
    around_article, around_heading = [nearest[e.number] if e else 0 for e in (article, heading)]
    plain, silent = own[0], not any(p for p in told if not nearest[p.element.number])
    boiler = [False] * len(elements)
    for element in elements[1:]:
        above = boiler[element.parent.number]
        if element.marked and not above and not element.hidden:
            by_name = element.name not in BOILERPLATE_TAGS or element.name == "form"
            spared = element.number == around_article or (by_name and (element.number == around_heading or silent))
            spared = spared and own[element.number] > plain
            if spared:
                plain += own[element.number]
            boiler[element.number] = not spared
        else:
            boiler[element.number] = above or element.marked
    return boiler


def main_text(html: str | None) -> str:
    """The article of a page: references decoded, one space for any white space and
    between blocks. Empty if the page has no content."""
    return _article(*pieces(html or ""))


def _article(found: list[_Piece], elements: list[_Element]) -> str:
    boiler = _boilerplate(found, elements)
    open_pieces = [p for p in found if not boiler[p.element.number] and (not p.element.header or p.element.heading)]
    told = [p for p in open_pieces if not p.text.isspace()]
    if not told:
        return ""
    scores = path_scores(told)
    size = [len(p.text) for p in told]
    mean = sum(scores[p.element.path] * n for p, n in zip(told, size, strict=True)) / sum(size)
    high = {path for path, score in scores.items() if score >= SHARE_OF_MEAN * mean}
    plain = _text_blocks(told)
    if any(p.element.in_article for p in told):
        beside = {p.block for p in told if p.block in plain and (p.element.path in high or p.element.paragraph)}
        kept = [p for p in open_pieces if p.element.in_article or p.block in beside]
    else:
        inside = _container([p for p in told if p.element.path in high or p.block in plain or p.element.heading])
        kept = [p for p in open_pieces if inside is None or inside.number <= p.element.number <= inside.end]
    bare = _link_blocks(kept, high)
    return _joined([p for p in kept if p.block not in bare])


def _text_blocks(told: list[_Piece]) -> set[int]:
    """Blocks with letters or digits of which no more than half are in links."""
    letters: dict[int, int] = defaultdict(int)
    for piece in told:
        letters[piece.block] += sum(map(str.isalnum, piece.text)) * (-1 if piece.element.link else 1)
    written = {p.block for p in told if not p.element.link and any(map(str.isalnum, p.text))}
    return {block for block in written if letters[block] >= 0}


def _container(content: list[_Piece]) -> _Element | None:
    """The smallest container that holds all content; none holds texts beside the root."""
    if not content:
        return None
    first = min((p.element for p in content), key=lambda e: e.number)
    last = max(p.element.number for p in content)
    while first and not (first.name in CONTAINERS and first.end >= last):
        first = first.parent
    return first


def _link_blocks(kept: list[_Piece], high: set[int]) -> set[int]:
    """Blocks of lists in which every word is a link, where such blocks follow each other;
    none in article or main, none of paths above the threshold."""
    linked: dict[int, bool] = {}
    for piece in kept:
        if not piece.text.isspace():
            element = piece.element
            listed = element.link and element.item and not element.in_article and element.path not in high
            linked[piece.block] = linked.get(piece.block, True) and listed
    order = list(linked)
    bare = {b for b in order if linked[b]}
    return {b for n, b in enumerate(order) if b in bare and (order[n - 1 : n] and order[n - 1] in bare or order[n + 1 : n + 2] and order[n + 1] in bare)}


def _joined(kept: list[_Piece]) -> str:
    parts, block = [], None
    for piece in kept:
        if piece.block != block:
            parts.append(" ")
            block = piece.block
        parts.append(piece.text)
    return " ".join("".join(parts).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    Null and empty pages have an empty text. Pages are read whole, whatever their
    length and however deep their tags nest; ids and urls may be null or repeat, and each
    row is read by itself. An empty table gives an empty one. Other columns, also ones
    named like the result's, are not read.
    """

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

        return run

    source = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    return by_batch(source, make, f"page_id {id_type}, url string, text string, n_chars long")
