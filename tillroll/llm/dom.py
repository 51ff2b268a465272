"""A small HTML tree for main-text extraction.

One regular expression finds tags, comments and raw-text elements; a stack
with the closing rules that real pages need (void elements, paragraphs and
list items that close their like, end tags without a start) makes the tree.
Nodes are numbered in page order, so a parent always precedes its children.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# The HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object".split())
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption head br hr".split()
)
#: An element that starts closes an open one of these, inside the nearest of
#: the second set.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - {"html", "body", "head", "br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SCOPE = frozenset("body article section div main td th li blockquote figure aside nav header footer form table".split())

# A quote opens a value only directly after "=" (and white space) and if it is
# closed somewhere; any other quote is a plain character.
_NAME = r"[^\s/>][^\s/>=]*"
_ATTR = re.compile(rf"""({_NAME})(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|{_NAME}(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]*))?)*)(?:>|\Z)""",
    re.S,
)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in RAW}


@dataclass
class Node:
    tag: str
    parent: int
    attrs: dict[str, str]
    #: texts and child numbers, in page order
    items: list = field(default_factory=list)


def parse(page: str) -> list[Node]:
    """The page's tree; node 0 is the document. Nothing in a page is an
    error: unclosed elements end with their parent, stray end tags are
    skipped, cut tags and comments end with the page."""
    nodes = [Node("#document", -1, {})]
    stack = [0]
    # open elements by tag, so that an end tag without a start costs nothing
    open_tags: Counter[str] = Counter()

    def end(depth: int) -> None:
        open_tags.subtract([nodes[x].tag for x in stack[depth:]])
        del stack[depth:]

    def close(to: frozenset[str], stop: frozenset[str]) -> None:
        if not any(open_tags[t] for t in to):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[depth]].tag
            if tag in to:
                end(depth)
                return
            if tag in stop:
                return

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            nodes[stack[-1]].items.append(html.unescape(text))
        if not m:
            return nodes
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag = name.lower()
        if m.group(1):
            if not open_tags[tag]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    end(depth)
                    break
                if tag == "p" and nodes[stack[depth]].tag in SCOPE:
                    break
            continue
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ENDS_P:
            close(frozenset(["p"]), SCOPE)
        attrs = {k.lower(): html.unescape(a or b or c or "") for k, a, b, c in _ATTR.findall(m.group(3))} if m.group(3).strip("/ \t\n\r\f") else {}
        nodes.append(Node(tag, stack[-1], attrs))
        nodes[stack[-1]].items.append(len(nodes) - 1)
        if tag in VOID or m.group(3).endswith("/") and tag in ("svg", "math", "path", "rect", "circle"):
            continue
        if tag in RAW:
            past = _RAW_END[tag].search(page, at)
            if tag == "textarea" or tag == "title":
                nodes[-1].items.append(html.unescape(page[at : past.start() if past else len(page)]))
            at = past.end() if past else len(page)
            continue
        stack.append(len(nodes) - 1)
        open_tags[tag] += 1
