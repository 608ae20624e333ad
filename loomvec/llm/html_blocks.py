"""HTML pages as sequences of leaf blocks.

A block is the text between two tags that begin or end a block (paragraphs, items, cells, headings and so on).
Tags inside a line (links, emphasis) do not cut it. Each block knows the set of names on its tag path:
the tags, class words, ids and roles of all elements around it. Broken markup is read as browsers roughly do: paragraphs and
items end where the next one begins, stray end tags are ignored, and what is open at the end stays open.
The time taken is proportional to the page's length.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements inside a line, which never cut a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr nobr".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|audio|video|select|head"
# Elements that end where the next of their kind begins.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}

_MARKUP = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|(?=<body[\s>])|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tag: str
    path: frozenset[str]
    linked: int


@dataclass
class _Open:
    tag: str
    path: frozenset[str]


@dataclass
class _Reader:
    """State while reading one page."""

    stack: list[_Open] = field(default_factory=lambda: [_Open("", frozenset())])
    count: dict[str, int] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False
    blocks: list[Block] = field(default_factory=list)

    def text(self, raw: str) -> None:
        if raw:
            piece = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(piece)
            if self.in_link:
                self.linked += len(piece.strip())

    def flush(self) -> None:
        whole = " ".join("".join(self.pieces).split())
        if whole:
            top = self.stack[-1]
            self.blocks.append(Block(whole, top.tag, top.path, min(self.linked, len(whole))))
        self.pieces, self.linked = [], 0

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.count[tag] -= 1
        return tag

    def begin(self, tag: str, attributes: str) -> None:
        self.flush()
        if self.stack[-1].tag == "p":
            self.pop()
        while self.stack[-1].tag in SIBLINGS.get(tag, ()):
            self.pop()
        if tag in VOID:
            return
        names = {tag}
        if attributes:
            for found in _ATTRIBUTE.finditer(attributes):
                value = (found[2] or found[3] or found[4] or "").lower()
                names.update("." + word for word in _NAME.findall(value))
        around = self.stack[-1].path
        self.stack.append(_Open(tag, around if names <= around else around | names))
        self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        self.flush()
        if self.count.get(tag):
            while self.pop() != tag:
                pass


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    page = page or ""
    reader, at = _Reader(), 0
    for found in _MARKUP.finditer(page):
        reader.text(page[at : found.start()])
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            reader.text(" ")
        elif tag in INLINE:
            if tag == "a":
                reader.in_link = not found[2]
        elif found[2]:
            reader.end(tag)
        else:
            reader.begin(tag, found[4])
    reader.text(page[at:])
    reader.flush()
    return reader.blocks
