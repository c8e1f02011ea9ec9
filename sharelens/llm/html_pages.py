"""A page as its element paths and its pieces of text."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import xxhash

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSES_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
IN_HEAD = set("base basefont bgsound head html link meta noscript script style template title".split())
# Not shown, a control or a drawing: left out with all that is in it, if it is closed.
GONE = set("annotation button iframe noscript object select svg template textarea title".split())
SCOPES = set("table ul ol dl div section article main aside nav header footer form body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")
ROOT = 0


class Element(NamedTuple):
    path: int
    parent: int
    key: str
    repeated: bool


class Piece(NamedTuple):
    path: int
    block: int
    linked: bool
    text: str


def element_key(tag: str, attrs: str) -> str:
    """The tag with its classes, id and role, numbers left out."""
    marks = []
    for name, a, b, c in _NAMED.findall(attrs) if attrs else ():
        words = sorted(_DIGITS.sub("", a or b or c).lower().split())
        marks += [f"{name.lower()}={w}" for w in words if w]
    return " ".join([tag, *marks])


def child_path(parent: int, key: str) -> int:
    value = xxhash.xxh64_intdigest(f"{parent}/{key}")
    return value - (1 << 64) if value >> 63 else value


def closed(page: str, tag: str) -> dict[int, int]:
    """Where each of the page's elements of this name begins, if it is closed, and where it ends."""
    begun, ends = [], {}
    for mark in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", page, re.IGNORECASE):
        if not mark[1]:
            begun.append(mark.start())
        elif begun:
            ends[begun.pop()] = mark.end()
    return ends


def read_page(page: str) -> tuple[list[Element], list[Piece]]:
    """The page's elements, and its text outside scripts, styles and the like.

    A script or style without its end tag goes on to the page's end, as in a browser;
    any other element of ``GONE`` without one loses nothing but its tag.
    Equal children of one element are folded into one that is repeated.  Unclosed
    elements end where their parent or a sibling that cannot be inside them begins; a
    head ends where text or an element begins that cannot be in it.
    """
    elements: dict[int, list] = {}
    pieces: list[Piece] = []
    open_tags: list[tuple[str, int, int]] = []  # tag, path, instance
    linked, block, instance = 0, 0, 0
    seen: set[tuple[int, int]] = set()
    hidden = 0

    def pop_to(place: int) -> None:
        nonlocal linked, block, hidden
        for tag, _, _ in open_tags[place:]:
            linked -= tag == "a"
            hidden -= tag == "head"
            block += tag in BLOCKS
        del open_tags[place:]

    def end_head() -> None:
        pop_to(next(place for place, (tag, _, _) in enumerate(open_tags) if tag == "head"))

    ends: dict[str, dict[int, int]] = {}
    at = 0
    while token := _TOKEN.match(page, at):
        begin, at = at, token.end()
        text = token["text"]
        if hidden:
            begins = None if token["end"] else token["raw"] or token["tag"]
            if begins and begins.lower() not in IN_HEAD or text is not None and text.strip():
                end_head()
        if text is not None:
            if not hidden:
                path = open_tags[-1][1] if open_tags else ROOT
                pieces.append(Piece(path, block, linked > 0, html.unescape(text)))
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in GONE and not token["end"]:
            if tag not in ends:
                ends[tag] = closed(page, tag)
            if begin in ends[tag]:
                at = ends[tag][begin]
                continue
        if token["end"]:
            for place in range(len(open_tags) - 1, -1, -1):
                if open_tags[place][0] == tag:
                    pop_to(place)
                    break
            continue
        if tag == "br":
            path = open_tags[-1][1] if open_tags else ROOT
            pieces.append(Piece(path, block, linked > 0, " "))
            continue
        if tag in VOID:
            block += tag in BLOCKS
            continue
        if tag in BLOCKS:
            block += 1
            closing = CLOSES_ITSELF.get(tag, set()) | {"p"}
            for place in range(len(open_tags) - 1, -1, -1):
                if open_tags[place][0] in closing:
                    pop_to(place)
                    break
                if open_tags[place][0] in SCOPES:
                    break
        parent, above = (open_tags[-1][1], open_tags[-1][2]) if open_tags else (ROOT, 0)
        key = element_key(tag, token["attrs"])
        path = child_path(parent, key)
        instance += 1
        again = (above, path) in seen
        seen.add((above, path))
        if path in elements:
            elements[path][3] |= again
        else:
            elements[path] = [path, parent, key, again]
        open_tags.append((tag, path, instance))
        linked += tag == "a"
        hidden += tag == "head"
    return [Element(*e) for e in elements.values()], pieces


def blocks_of(pieces: list[Piece]) -> str:
    """Text by block: white space as one space, trimmed, blocks two lines apart."""
    out, last, words = [], None, []
    for piece in pieces:
        if piece.block != last:
            out.append(" ".join("".join(words).split()))
            words, last = [], piece.block
        words.append(piece.text)
    out.append(" ".join("".join(words).split()))
    return "\n\n".join(b for b in out if b)
