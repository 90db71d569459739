"""Blocks of a web page: a tree of block elements with their text, from possibly broken HTML."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAMES = re.compile(r"[a-z]+|\d+")

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An open element that the start of another one ends.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}


@dataclass
class Block:
    tag: str
    parent: int
    depth: int
    names: list[str]
    marked: bool = False  # carries the mark of training pages
    pieces: list[list[str]] = field(default_factory=list)  # text between inner blocks, in page order
    linked: int = 0  # characters inside links
    links: int = 0


def parse(page: str) -> tuple[list[Block], list[tuple[int, list[str]]]]:
    """Blocks, the root first and parents before children, and runs of text with their block, in page order.

    Inline elements belong to the block around them; scripts, styles, forms' texts
    and the head have no text.
    """
    blocks = [Block("#root", -1, 0, [])]
    open_tags: list[tuple[str, int]] = [("#root", 0)]  # tag and block
    runs: list[tuple[int, list[str]]] = []
    links, at, fresh = 0, 0, True

    def add(text: str) -> None:
        nonlocal fresh
        block = open_tags[-1][1]
        if fresh or not runs or runs[-1][0] != block:
            runs.append((block, []))
            fresh = False
        runs[-1][1].append(text)
        if links:
            blocks[block].linked += len(text.strip())

    def close(upto: int) -> None:
        nonlocal links, fresh
        while len(open_tags) > upto:
            tag, _ = open_tags.pop()
            links -= tag == "a"
            fresh |= tag not in INLINE

    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            add(html.unescape(text))
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_tags) - 1, 0, -1):
                if open_tags[k][0] == tag:
                    close(k)
                    break
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            fresh |= tag == "hr"
            continue
        if tag in ENDS_PARAGRAPH:
            _end(open_tags, {"p"}, close, {"table", "button"})
        elif tag in ENDED_BY:
            _end(open_tags, {t for t, by in ENDED_BY.items() if tag in by}, close, {"ul", "ol", "dl", "table", "select"})
        if tag in INLINE:
            open_tags.append((tag, open_tags[-1][1]))
            links += tag == "a"
            if tag == "a":
                blocks[open_tags[-1][1]].links += 1
        elif tag in RAW or tag == "head":
            end = re.compile(rf"</{re.escape(tag)}\s*>" if tag != "head" else r"</head\s*>|<body", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.start() if end[0].lower() == "<body" else end.end()
        else:
            attributes = {a.lower(): v or w or x for a, v, w, x in _ATTRIBUTE.findall(m[3])}
            names = _NAMES.findall(" ".join(attributes.get(a, "") for a in ("class", "id", "role", "itemprop", "aria-label")).lower())
            blocks.append(Block(tag, open_tags[-1][1], blocks[open_tags[-1][1]].depth + 1, names, "data-main" in attributes))
            open_tags.append((tag, len(blocks) - 1))
            fresh = True
    for block, pieces in runs:
        blocks[block].pieces.append(pieces)
    return blocks, runs


def _end(open_tags: list[tuple[str, int]], tags: set[str], close, limits: set[str]) -> None:
    for k in range(len(open_tags) - 1, 0, -1):
        if open_tags[k][0] in tags:
            close(k)
            return
        if open_tags[k][0] in limits:
            return


def words(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())
