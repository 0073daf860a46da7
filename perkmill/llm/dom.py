"""A page's tree of block elements, from HTML as it's found: unclosed, misnested, cut off."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
HIDDEN = frozenset("script style template noscript head title svg annotation annotation-xml iframe canvas audio video textarea select datalist".split())
#: Elements whose content runs to their end tag, whatever is in it.
RAW = frozenset("script style textarea title noscript iframe".split())
#: Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup li listing main menu nav ol p pre search section summary table ul xmp".split()
)
#: Elements that are blocks of their own; all others, unknown ones too, are part of the text around them.
BLOCKS = ENDS_P | frozenset("html body caption colgroup legend optgroup option tbody td tfoot th thead tr".split())
#: What an element's start closes, if open, up to an element that holds it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
#: Elements that an end tag or an implied end doesn't reach through.
WALLS = frozenset("html body article section main nav aside header footer div table td th form ul ol blockquote figure".split())

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Node:
    tag: str
    attributes: str
    parent: int
    depth: int
    children: list[int] = field(default_factory=list)
    #: Pieces of text and numbers of child blocks, in page order.
    content: list[str | int] = field(default_factory=list)
    linked: int = 0
    inline: int = 0


def parse(page: str) -> list[Node]:
    """Blocks in page order; the first is the page itself. Hidden content isn't there; the text of formulas
    and of embedded objects stands in the block around them."""
    nodes = [Node("#page", "", -1, 0)]
    # Open elements: tag, block they belong to, whether the tag is hidden.
    stack: list[tuple[str, int]] = [("#page", 0)]
    hidden = links = at = 0

    def text(raw: str) -> None:
        if raw and not hidden:
            node = nodes[stack[-1][1]]
            decoded = html.unescape(raw) if "&" in raw else raw
            node.content.append(decoded)
            if links:
                node.linked += len(decoded.strip())

    def pop() -> None:
        nonlocal hidden, links
        tag, _ = stack.pop()
        hidden -= tag in HIDDEN
        links -= tag == "a"

    def close(tags: set[str], walls: frozenset | set) -> None:
        """Ends the innermost open element of these, and what is open in it; not through a wall."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in walls:
                return

    while True:
        m = MARKUP.search(page, at)
        if not m:
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                text(" ")
            else:
                close({tag}, WALLS if tag not in BLOCKS | HIDDEN or tag in ("p", "li") else frozenset())
            continue
        if tag in VOID:
            if tag == "hr" and not hidden:
                close({"p"}, WALLS)
            text(" " if tag == "br" else "")
            if tag not in ("br", "hr") and not hidden:
                nodes[stack[-1][1]].inline += 1
            continue
        # What is hidden ends nothing outside.
        if tag in ENDS_P and not hidden:
            close({"p"}, WALLS)
        if tag in CLOSES and not hidden:
            close(CLOSES[tag], HOLDS[tag])
        owner = stack[-1][1]
        if tag not in BLOCKS or hidden:
            nodes[owner].inline += not hidden
        else:
            words = " ".join(next(filter(None, a[1:]), "") for a in ATTRIBUTE.findall(m[3])) if m[3] else ""
            nodes.append(Node(tag, words, owner, nodes[owner].depth + 1))
            nodes[owner].children.append(len(nodes) - 1)
            nodes[owner].content.append(len(nodes) - 1)
            owner = len(nodes) - 1
        if m[3].endswith("/") and tag in HIDDEN:
            continue
        stack.append((tag, owner))
        hidden += tag in HIDDEN
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    # What follows the last markup; a cut-off tag at the end isn't text.
    rest = page[at:]
    cut = re.search(r"<[A-Za-z/!?][^>]*\Z", rest)
    text(rest[: cut.start()] if cut else rest)
    return nodes


def blocks(nodes: list[Node], kept: list[bool]) -> str:
    """The text of the kept nodes: what stands between two block tags is a block, its white space
    single spaces; blocks in page order, an empty line between."""
    out: list[str] = []
    run: list[str] = []

    def end_run() -> None:
        words = "".join(run).split()
        if words:
            out.append(" ".join(words))
        run.clear()

    todo: list[tuple[int, int]] = [(0, 0)]
    while todo:
        node, i = todo.pop()
        content = nodes[node].content
        while i < len(content) and isinstance(content[i], str):
            if kept[node]:
                run.append(content[i])
            i += 1
        end_run()
        if i < len(content):
            todo.append((node, i + 1))
            todo.append((content[i], 0))
    return "\n\n".join(out)
