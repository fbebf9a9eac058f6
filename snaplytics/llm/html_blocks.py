"""Blocks of an HTML page: text under block-level elements, with its tag path."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

# Element classes of HTML.
BLOCK = frozenset("""
address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe label legend li main menu nav ol optgroup option p pre search
section select summary table tbody td textarea tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript title head svg math object canvas audio video iframe".split())
#: an element that a start tag of these ends, up to the nearest of the boundaries
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "optgroup")),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}

WHITE = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]   # tags and class, id and role words, outermost first
    text: str
    link_chars: int         # characters inside links


class Element:
    """An open element: its words, and the elements around it. Blocks point to their innermost
    element, so a page's paths take the space of its elements however deep they are."""

    __slots__ = ("tag", "words", "parent", "sum")

    def __init__(self, tag: str, words: tuple[str, ...], parent: Element | None) -> None:
        self.tag, self.words, self.parent = tag, words, parent
        self.sum = None  # of the path's learned rows, filled in when a page is labelled

    def path(self) -> tuple[str, ...]:
        parts, at = [], self
        while at is not None:
            parts.append(at.words)
            at = at.parent
        return tuple(w for words in reversed(parts) for w in words)


class Leaf(NamedTuple):
    element: Element | None
    text: str
    link_chars: int


class BlockParser(HTMLParser):
    """Collects the blocks of one page in order, in time proportional to the page: for each tag
    it knows where in the stack of open elements it stands."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}     # by tag, and of all block elements under ""
        self.leaves: list[Leaf] = []
        self.text: list[str] = []
        self.link_chars = 0
        self.unseen = 0
        self.links = 0

    def end_block(self) -> None:
        if self.text:
            text = WHITE.sub(" ", "".join(self.text)).strip()
            if text:
                self.leaves.append(Leaf(self.open[-1] if self.open else None, text, self.link_chars))
            self.text, self.link_chars = [], 0

    def open_element(self, tag: str, words: tuple[str, ...]) -> None:
        for name in (tag, "") if tag in BLOCK else (tag,):
            self.places.setdefault(name, []).append(len(self.open))
        self.open.append(Element(tag, words, self.open[-1] if self.open else None))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def close_from(self, at: int) -> None:
        while len(self.open) > at:
            tag = self.open.pop().tag
            for name in (tag, "") if tag in BLOCK else (tag,):
                self.places[name].pop()
            self.unseen -= tag in UNSEEN
            self.links -= tag == "a"

    def innermost(self, tags: tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def last_open(self, tags: tuple[str, ...], boundary: tuple[str, ...] = ()) -> int | None:
        """The place of the innermost of some tags, unless a boundary stands further in."""
        at = self.innermost(tags)
        return at if at >= 0 and at > self.innermost(boundary) else None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag == "body" and (at := self.last_open(("head",))) is not None:
            self.close_from(at)
        if tag in BLOCK:
            self.end_block()
            at = self.last_open(*CLOSES[tag]) if tag in CLOSES else None
            if at is None:
                at = self.last_open(("p",), ("button", "table", "td", "th", "object"))
            if at is not None:
                self.close_from(at)
        if tag in VOID:
            return
        words = [tag]
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                words += ["." + w for w in NAME.findall(value.lower())]
        self.open_element(tag, tuple(words))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        at = self.last_open((tag,), () if tag in BLOCK or tag in UNSEEN else ("",))
        if tag in BLOCK:
            self.end_block()
        if at is not None:
            self.close_from(at)

    def handle_data(self, data: str) -> None:
        if self.unseen:
            return
        self.text.append(data)
        if self.links:
            self.link_chars += len(data)


def page_leaves(html: str | None) -> list[Leaf]:
    """The blocks of a page with their innermost elements."""
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.leaves


def page_blocks(html: str | None, most: int | None = None) -> list[Block]:
    """The (first) blocks of a page with their paths spelled out."""
    return [Block(x.element.path() if x.element else (), x.text, x.link_chars) for x in page_leaves(html)[:most]]
