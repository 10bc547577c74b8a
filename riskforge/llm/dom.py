"""A small tolerant HTML reader: block elements as a tree, each with its own
runs of text. Inline elements are part of the block they stand in."""

from __future__ import annotations

import html
import re

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_CUE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names by their role in HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
SILENT = frozenset("script style noscript iframe template textarea title head select option button svg math object canvas".split())
#: an opening element of the key closes an open element of the value
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
#: elements past which an implied end tag does not reach
WALLS = frozenset("table ul ol dl select body html article section div td th aside nav main header footer form".split())


class Block:
    """A block element: tag, cue words of its class, id and role, parent's
    number, and its text in runs (place in the page, text, text in links)."""

    __slots__ = ("tag", "cues", "parent", "runs")

    def __init__(self, tag: str, cues: frozenset[str], parent: int):
        self.tag, self.cues, self.parent = tag, cues, parent
        self.runs: list[tuple[int, str, int]] = []


def cue_words(attributes: str) -> frozenset[str]:
    found = _ATTRIBUTE.findall(attributes)
    return frozenset(w.lower() for _, a, b, c in found for w in _CUE.findall(html.unescape(a or b or c)))


def read(page: str) -> list[Block]:
    """The blocks of a page in page order; number 0 is the page itself."""
    blocks = [Block("#page", frozenset(), -1)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and the block they are in
    run: list[str] = []
    links = link_chars = run_at = 0

    def flush() -> None:
        nonlocal link_chars, run_at
        text = " ".join("".join(run).split())
        if text:
            blocks[stack[-1][1]].runs.append((run_at, text, link_chars))
            run_at += 1
        run.clear()
        link_chars = 0

    def close_to(depth: int) -> None:
        nonlocal links
        if any(name not in INLINE for name, _ in stack[depth:]):
            flush()
        links -= sum(name == "a" for name, _ in stack[depth:])
        del stack[depth:]

    def add(text: str) -> None:
        nonlocal link_chars
        if text and blocks[stack[-1][1]].tag not in SILENT:
            text = html.unescape(text)
            run.append(text)
            if links:
                link_chars += len(text.strip())

    at, lower = 0, None
    while True:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
                if stack[depth][0] in WALLS and (tag in INLINE or tag in CLOSES or tag == "p"):
                    break
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in INLINE and tag not in SILENT:
            if tag not in VOID and not m[3].endswith("/"):
                stack.append((tag, stack[-1][1]))
                links += tag == "a"
            continue
        shut = CLOSES.get(tag, frozenset())
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth][0]
            if name == "p" or name in shut:
                close_to(depth)
                break
            if name in WALLS:
                break
        flush()
        blocks.append(Block(tag, cue_words(m[3]), stack[-1][1]))
        if tag in RAW:  # its text ends at its end tag only
            if lower is None:
                lower = page.lower()
                if len(lower) != len(page):  # some capitals have two code points below
                    lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in page)
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            stack.append((tag, len(blocks) - 1))
        elif tag not in VOID:
            stack.append((tag, len(blocks) - 1))
    flush()
    return blocks
