"""Labelled pages to train the extraction model on: a seeded generator of page
layouts in which every block is known to be content (1) or not (0).

A page is a list of (tag, attributes, label, children or text). The layouts
cover article containers with and without a telling name, paragraphs of any
length, lists and tables inside the article, and around or inside it menus,
headers, footers, sidebars, notices, adverts, forms, sharing links and reader
comments.
"""

from __future__ import annotations

import random

Node = tuple[str, str, int, "list[Node] | str"]

# cue words of classes and ids by what they stand for
CONTENT_CUES = "article content main post entry story body text page prose single".split()
PLAIN_CUES = "wrapper container row col section inner block box group".split()
BOILERPLATE_CUES = (
    "nav menu navbar navigation breadcrumb breadcrumbs header masthead banner topbar footer copyright legal sidebar side widget related "
    "recommended ad ads advert advertisement sponsor sponsored promo cookie cookies notice consent alert popup modal overlay newsletter "
    "subscribe signup form search login register comment comments reply replies respond discussion disqus share sharing social tags "
    "pagination pager toolbar byline meta"
).split()
COMMENT_CUES = "comment comments reply replies respond discussion thread disqus reader".split()
SYLLABLES = "ba ne ti lo ru mi sa ke do pa le vi na to re".split()


def _words(rng: random.Random, low: int, high: int) -> str:
    n = rng.randint(low, high)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])


def _attrs(rng: random.Random, cues: list[str], chance: float) -> str:
    if rng.random() > chance:
        return ""
    name = rng.choice(cues)
    if rng.random() < 0.3:
        name += rng.choice(["-", "_", " "]) + rng.choice(PLAIN_CUES + cues)
    return f' {rng.choice(["class", "class", "id"])}="{name}"'


def _links(rng: random.Random, label: int) -> list[Node]:
    return [("li", "", label, f'<a href="/{k}">{_words(rng, 1, 3)}</a>') for k in range(rng.randint(2, 8))]


def _paragraph(rng: random.Random, label: int) -> Node:
    size = rng.choice([(1, 2), (2, 8), (8, 40), (40, 120)])
    text = _words(rng, *size)
    if rng.random() < 0.15:
        text = f"<b>{text}<br>"
    elif rng.random() < 0.15:
        text += f' <a href="#">{_words(rng, 1, 3)}</a> {_words(rng, 1, 10)}'
    return ("p", "", label, text)


def _boilerplate(rng: random.Random, inside: bool) -> Node:
    kind = rng.choice("links ad notice form comments share box".split() if inside else "nav header footer aside ad notice form comments links box".split())
    if kind in ("nav", "links"):
        tag = "nav" if kind == "nav" else rng.choice(["div", "ul", "nav", "section"])
        attrs = _attrs(rng, "nav menu navbar navigation breadcrumb related recommended pagination tags".split(), 0.4 if tag == "nav" else 0.9)
        return (tag, attrs, 0, _links(rng, 0) if tag == "ul" else [("ul", "", 0, _links(rng, 0))])
    if kind == "header":
        inner: list[Node] = [(rng.choice(["div", "p", "h1", "h2"]), "", 0, _words(rng, 1, 6))]
        return ("header", _attrs(rng, "header masthead banner topbar".split(), 0.4), 0, inner + ([("ul", "", 0, _links(rng, 0))] if rng.random() < 0.5 else []))
    if kind == "footer":
        return ("footer", _attrs(rng, "footer copyright legal".split(), 0.4), 0, "&copy; " + _words(rng, 1, 12) if rng.random() < 0.6 else [_paragraph(rng, 0)])
    if kind == "aside":
        return ("aside", _attrs(rng, "sidebar side widget related".split(), 0.5), 0, [("h3", "", 0, _words(rng, 1, 4)), _paragraph(rng, 0)])
    if kind == "form":
        return ("form", _attrs(rng, "search login newsletter subscribe signup".split(), 0.5), 0, [("p", "", 0, _words(rng, 1, 8)), ("div", "", 0, _words(rng, 1, 4))])
    if kind == "comments":
        each = [("div", _attrs(rng, COMMENT_CUES, 0.9), 0, [_paragraph(rng, 0)]) for _ in range(rng.randint(1, 5))]
        return (rng.choice(["div", "section", "ol"]), _attrs(rng, COMMENT_CUES, 1), 0, [("h3", "", 0, _words(rng, 1, 3)), *each])
    cues = {
        "ad": "ad ads advert advertisement sponsor sponsored promo".split(),
        "notice": "cookie cookies notice consent alert popup modal overlay newsletter".split(),
        "share": "share sharing social toolbar byline meta tags".split(),
    }.get(kind, BOILERPLATE_CUES)
    tag = rng.choice(["div", "div", "section", "p", "aside"])
    text = _words(rng, 1, 25)
    return (tag, _attrs(rng, cues, 1), 0, text if tag == "p" or rng.random() < 0.5 else [_paragraph(rng, 0)])


def _content(rng: random.Random) -> list[Node]:
    out: list[Node] = [("h1", "", 1, _words(rng, 1, 12))] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 14)):
        kind = rng.random()
        if kind < 0.75:
            out.append(_paragraph(rng, 1))
        elif kind < 0.82:
            out.append((rng.choice(["h2", "h3", "h4"]), "", 1, _words(rng, 1, 6)))
        elif kind < 0.87:
            out.append((rng.choice(["ul", "ol"]), "", 1, [("li", "", 1, _words(rng, 1, 20)) for _ in range(rng.randint(2, 5))]))
        elif kind < 0.9:
            out.append(("blockquote", "", 1, [_paragraph(rng, 1)]))
        elif kind < 0.92:
            cells = [("td", "", 1, _words(rng, 1, 3)) for _ in range(3)]
            out.append(("table", "", 1, [("tr", "", 1, cells)]))
        elif kind < 0.94:
            out.append((rng.choice(["pre", "figure", "figcaption"]), "", 1, _words(rng, 1, 20)))
        elif kind < 0.97:
            out.append((rng.choice(["div", "section"]), _attrs(rng, PLAIN_CUES + CONTENT_CUES, 0.4), 1, [_paragraph(rng, 1) for _ in range(rng.randint(1, 4))]))
        else:
            out.append(_boilerplate(rng, inside=True))
    return out


def page(rng: random.Random) -> Node:
    inner = _content(rng)
    shape = rng.random()
    if shape < 0.5:
        middle: list[Node] = [("article", _attrs(rng, CONTENT_CUES, 0.3), 1, inner)]
    elif shape < 0.75:
        middle = [(rng.choice(["div", "main", "section"]), _attrs(rng, CONTENT_CUES, 1), 1, inner)]
    elif shape < 0.9:
        middle = [("main", _attrs(rng, CONTENT_CUES, 0.4), 1, inner)]
    else:
        middle = inner
    if rng.random() < 0.3:  # a plain wrapper; it is content if paragraphs stand in it directly
        middle = [("div", _attrs(rng, PLAIN_CUES, 0.7), int(shape >= 0.9), [_boilerplate(rng, False) for _ in range(rng.randint(0, 2))] + middle)]
    around = lambda: [_boilerplate(rng, False) for _ in range(rng.randint(0, 3))]
    head: list[Node] = [("title", "", 0, _words(rng, 1, 8)), ("style", "", 0, "p{margin:0}")]
    return ("html", "", 0, [("head", "", 0, head), ("body", "", 0, around() + middle + around())])


def markup(node: Node) -> tuple[str, list[int]]:
    """HTML of a page, and the labels of its blocks in page order."""
    tag, attrs, label, inner = node
    if isinstance(inner, str):
        return f"<{tag}{attrs}>{inner}</{tag}>", [label]
    parts = [markup(x) for x in inner]
    return f"<{tag}{attrs}>{''.join(h for h, _ in parts)}</{tag}>", [label, *(v for _, labels in parts for v in labels)]


def pages(n: int, seed: int = 11) -> list[tuple[str, list[int]]]:
    rng = random.Random(seed)
    return [markup(page(rng)) for _ in range(n)]
