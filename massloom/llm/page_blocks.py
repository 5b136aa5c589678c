"""HTML pages as leaf blocks: runs of text between block-level tags, with the elements around them."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Fixed values of HTML: elements without an end, whose content is no text of the page, that stay inside a line of text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style template title svg math iframe object canvas noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr br input".split()
)
# An element of the key ends open ones of the value, up to the nearest element that holds such lists.
ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: The element that a labeller puts around main text; it is no part of a path.
MARK = "x-main"
#: Elements that a paragraph does not end at.
HELD = frozenset("td th li div section article main aside header footer nav form body button object".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>",
    re.DOTALL,
)
NAMED = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
END = {name: re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE) for name in UNSEEN}


class Element(NamedTuple):
    tag: str
    words: tuple[str, ...]  # of class, id, role and the like, in lower case


class Block(NamedTuple):
    text: str
    path: tuple[Element, ...]  # block-level elements around it, outermost first
    linked: float  # share of its characters inside links
    main: bool  # inside an element that a labeller has put around main text


def _element(tag: str, attributes: str) -> Element:
    words: dict[str, None] = {}
    if attributes and not attributes.isspace():
        for name, *values in NAMED.findall(attributes):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("hidden", "aria-hidden"):
                if value.lower() != "false":
                    words["hidden"] = None
            elif name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                    words["hidden"] = None
            else:
                words.update((w.lower(), None) for w in PART.findall(html.unescape(value)))
    return Element(tag, tuple(words))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, those without text left out.

    Character references are decoded and white space, line ends by ``br``
    included, becomes one blank. Comments and what an element of ``UNSEEN``
    holds give nothing. Tags that are not closed, closed twice or cut off do not
    stop the reading; a ``<`` that starts no tag is text.
    """
    out: list[Block] = []
    open_: list[Element] = []  # block-level elements
    links = 0
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                path = tuple(e for e in open_ if e.tag != MARK)
                out.append(Block(whole, path, min(1.0, linked / len(whole)), len(path) < len(open_)))
            text.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                linked += len(raw.strip())

    at = 0
    while at < len(page):
        found = TAG.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            text.append(" ")
        elif tag in INLINE:
            continue
        elif closing:
            if tag in HEADINGS:  # ends whichever heading is open
                tag = next((e.tag for e in reversed(open_) if e.tag in HEADINGS), tag)
            if any(e.tag == tag for e in open_):
                flush()
                links = 0
                while open_.pop().tag != tag:
                    pass
            elif tag == "p":
                flush()
        else:
            flush()
            if tag in UNSEEN:
                if not attributes.rstrip().endswith("/"):
                    end = END[tag].search(page, at)
                    at = end.end() if end else len(page)
                continue
            if tag in VOID:
                continue
            ended, held = ENDS.get(tag, ({"p"}, HELD))
            cut = len(open_)
            for place in range(len(open_) - 1, -1, -1):
                if open_[place].tag in held:
                    break
                if open_[place].tag in ended:
                    cut = place
            del open_[cut:]
            open_.append(_element(tag, attributes))
    flush()
    return out
