"""A small, forgiving reader of HTML pages: the block tree, and the visible text in page order."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of the page: their whole content is passed over.
HIDDEN = frozenset("script style title template noscript iframe svg canvas select textarea button datalist "
                   "audio video noembed noframes annotation annotation-xml".split())
#: Of these the content is not markup.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset ul ol "
                  "li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address "
                  "details summary dialog menu search hgroup center legend".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH, PARAGRAPH_BORDER = frozenset({"p"}), frozenset("td th table caption".split())
#: A start tag on the left ends open elements of the first set, unless one of the second set is between.
ENDS = {name: (frozenset(ended.split()), frozenset(border.split())) for name, ended, border in (
    ("li", "li", "ul ol menu"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"),
    ("tr", "tr td th caption", "table"), ("td", "td th", "tr table"), ("th", "td th", "tr table"),
    ("thead", "tr td th caption", "table"), ("tbody", "thead tr td th caption", "table"),
    ("tfoot", "tbody tr td th", "table"))}
#: Tags, comments and declarations; an unclosed quote ends a tag at the next bracket.
MARKUP = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)"""
                    r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z)))""", re.S)
NAMING = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


@dataclass
class Page:
    """Blocks in page order (parent before child), and the text pieces: owner block and text, None at a block border.

    Inline elements belong to their block, except those with a class, id or role, which are blocks of their own kind
    without a border.
    """

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    naming: list[str] = field(default_factory=list)
    text: list[tuple[int, str] | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, naming: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.naming.append(naming)
        self.linked.append(0)
        return len(self.tag) - 1


class _Reader:
    """The open elements (name, owner of their text) and how many of each name are open."""

    def __init__(self, page: Page):
        self.page = page
        self.stack: list[tuple[str, int]] = [("html", page.add("html", -1, ""))]
        self.open: Counter[str] = Counter()

    def push(self, name: str, naming: str) -> None:
        owner = self.stack[-1][1]
        if name in BLOCK or naming:
            owner = self.page.add(name, owner, naming)
        if name in BLOCK:
            self.page.text.append(None)
        self.stack.append((name, owner))
        self.open[name] += 1

    def cut(self, size: int) -> None:
        """Ends all open elements from place ``size`` on."""
        while len(self.stack) > size:
            name, _ = self.stack.pop()
            self.open[name] -= 1
            if name in BLOCK:
                self.page.text.append(None)

    def end(self, name: str) -> None:
        if self.open[name]:
            self.cut(max(i for i in range(len(self.stack)) if self.stack[i][0] == name and i))

    def imply_ends(self, names: frozenset[str], border: frozenset[str]) -> None:
        """Ends the outermost open element of ``names`` that is not outside an element of the border."""
        if not any(self.open[n] for n in names):
            return
        last = 0
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in border:
                break
            if self.stack[i][0] in names:
                last = i
        if last:
            self.cut(last)

    def write(self, text: str) -> None:
        owner = self.stack[-1][1]
        self.page.text.append((owner, text))
        if self.open["a"]:
            self.page.linked[owner] += len(text)


def read_page(html: str) -> Page:
    """Broken markup is tolerated: unknown end tags are passed over, elements left open end with the page."""
    page = Page()
    reader = _Reader(page)
    at, size = 0, len(html)
    while at < size:
        found = MARKUP.search(html, at)
        start = found.start() if found else size
        if start > at:
            text = html[at:start]
            reader.write(unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            reader.end(name)
        elif name in HIDDEN:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            if end:
                at = html.find(">", end.end()) + 1 or size
            elif name in RAW:
                at = size
        elif name == "br":
            reader.write(" ")
        elif name == "hr":
            page.text.append(None)
        elif name not in VOID and name != "html":
            if name in BLOCK:
                reader.imply_ends(PARAGRAPH, PARAGRAPH_BORDER)
                if name in HEADING and reader.stack[-1][0] in HEADING:
                    reader.cut(len(reader.stack) - 1)
                if name in ENDS:
                    reader.imply_ends(*ENDS[name])
            attributes = found[3]
            naming = [a or b or c for a, b, c in NAMING.findall(attributes)] if "=" in attributes else ()
            reader.push(name, " ".join(naming).lower())
    return page
