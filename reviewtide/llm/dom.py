"""A page as a tree of block elements with their text, for the HTML extraction."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Elements as the HTML standard has them.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT = frozenset(
    "head script style template noscript svg math iframe object canvas select option button "
    "textarea title audio video".split()
)
BLOCKS = frozenset(
    "html body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody "
    "tfoot tr td th section article header footer nav aside main form fieldset figure figcaption "
    "address details summary hr dialog menu center".split()
)
# An element that the start of another one ends, if it is still open.
ENDED_BY = {
    "p": BLOCKS - {"html", "body"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
}
# What may stand in a head; the start of anything else ends it, as does text.
IN_HEAD = frozenset(
    "html base basefont bgsound link meta title noscript noframes style script template".split()
)
HEAD_SPACES = " \t\n\f\r"
SCOPES = frozenset(["ul", "ol", "dl", "table", "html", "body"])


@dataclass
class Node:
    """A block element. ``pieces``: runs of its own text, as they lie between its children."""

    tag: str
    names: str  # of class, id and role, in lower case
    parent: int  # -1 for the root
    order: list = field(default_factory=list)  # ("text", run) or ("node", index)
    own: int = 0  # characters of its own text
    own_links: int = 0  # those inside links
    label: str | None = None
    inputs: int = 0


def is_hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element says of itself that it is not shown."""
    for name, value in attrs:
        if name == "hidden" and (value or "").lower() != "until-found":
            return True
        if name == "style" and value and "display:none" in "".join(value.lower().split()):
            return True
    return False


class Builder(HTMLParser):
    """Builds the nodes. Unknown and inline elements belong to the block around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", "", -1)]
        self.open: list[tuple[str, int]] = [("html", 0)]  # open elements, with their block
        self.marks: list[int] = []  # places in ``open`` of all that is not inline
        self.hidden: list[int] = []
        self.silent = 0
        self.links = 0

    def handle_starttag(self, tag, attrs):
        if tag == "head" and self.in_head():
            return
        if tag not in IN_HEAD and self.open[-1][0] == "head" or tag == "body" and self.in_head():
            self.end_head()
        if tag in VOID:
            if tag == "input":
                self.nodes[self.open[-1][1]].inputs += 1
            elif not self.silent:
                self.text(" ", 0)
            return
        if tag in ("html", "body") and len(self.open) > 1 and tag == "html":
            return
        self.end_before(tag)
        at = self.open[-1][1]
        if is_hidden(attrs):
            self.hidden.append(len(self.open))
            self.silent += 1
        if tag in SILENT:
            self.silent += 1
        elif tag == "a":
            self.links += 1
        elif tag in BLOCKS and not self.silent:
            values = dict(attrs)
            names = " ".join(values.get(k) or "" for k in ("class", "id", "role", "aria-label"))
            self.nodes.append(Node(tag, names.lower(), at, label=values.get("data-y")))
            self.nodes[at].order.append(("node", len(self.nodes) - 1))
            at = len(self.nodes) - 1
        if tag in BLOCKS or tag in ENDED_BY or tag in SCOPES:
            self.marks.append(len(self.open))
        self.open.append((tag, at))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def in_head(self):
        return self.silent and any(tag == "head" for tag, _ in self.open)

    def end_head(self):
        self.close(next(i for i, (tag, _) in enumerate(self.open) if tag == "head"))

    def end_before(self, tag):
        """Ends an open paragraph, entry or cell that the start of ``tag`` ends."""
        for i in reversed(self.marks):
            at = self.open[i][0]
            if at in ENDED_BY and tag in ENDED_BY[at]:
                self.close(i)
                return
            if at in SCOPES or (at in BLOCKS and at != "p" and tag not in ("li", "dt", "dd", "tr", "td", "th")):
                return

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.close(i)
                return
            if tag not in BLOCKS and self.open[i][0] in BLOCKS and tag != "a":
                return

    def close(self, i):
        for tag, _ in self.open[i:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[i:]
        while self.marks and self.marks[-1] >= i:
            self.marks.pop()
        while self.hidden and self.hidden[-1] >= i:
            self.hidden.pop()
            self.silent -= 1

    def handle_data(self, data):
        if self.open[-1][0] == "head" and data.strip(HEAD_SPACES):
            self.end_head()
        if not self.silent:
            self.text(data, self.links)

    def text(self, data, links):
        node = self.nodes[self.open[-1][1]]
        if node.order and node.order[-1][0] == "text":
            node.order[-1][1].append(data)
        else:
            node.order.append(("text", [data]))
        n = len(data.strip())
        node.own += n
        node.own_links += n if links else 0


_SPACES = re.compile(r"\s+")


def normal(run: list[str]) -> str:
    return _SPACES.sub(" ", "".join(run)).strip()


def parse(html: str) -> list[Node]:
    """The nodes in page order; a parent lies before its children."""
    builder = Builder()
    builder.feed(html)
    HTMLParser.close(builder)
    return builder.nodes


def blocks(nodes: list[Node]) -> list[tuple[int, str]]:
    """The text blocks of a page in page order, each with its node."""
    found, stack = [], [iter(nodes[0].order)]
    at = [0]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            at.pop()
        elif item[0] == "text":
            if text := normal(item[1]):
                found.append((at[-1], text))
        else:
            stack.append(iter(nodes[item[1]].order))
            at.append(item[1])
    return found
