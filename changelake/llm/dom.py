"""Element trees of web pages, from tolerant reading of their markup."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

#: Elements without content, and elements that start a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre"
    " script search section select style summary svg table tbody td template textarea tfoot th thead title tr ul video".split()
)
#: Elements that an opening tag of the given names closes, up to the border elements.
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
    "body": ("head", ()),
}
#: Open elements that a paragraph doesn't reach out of.
_SCOPE = frozenset("td th table button caption html body".split())


@dataclass(slots=True)
class Node:
    """An element. It doesn't know its parent, so a tree is freed as soon as it isn't used."""

    tag: str
    attributes: dict[str, str]
    #: Elements, and texts as strings, in page order.
    children: list[Node | str] = field(default_factory=list)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def _close(self, names: tuple[str, ...] | list[str], border: frozenset[str] | tuple[str, ...]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in names:
                del self.open[depth:]
                return
            if tag in border:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._close(("p",), _SCOPE)
        if tag in CLOSES:
            names, border = CLOSES[tag]
            self._close(names.split(), border)
        node = Node(tag, {name: value or "" for name, value in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash in a tag means nothing in HTML, save for elements of other languages.
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and self.open[-1].tag == tag and any(n.tag in ("svg", "math") for n in self.open):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("p", "br") and all(node.tag != tag for node in self.open):
            # These two make an empty element where none is open.
            self.handle_starttag(tag, [])
        self._close((tag,), ())

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    """The page's tree below an unnamed root; character references are decoded."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader.root


def blocks(root: Node, keep=lambda node: True) -> list[tuple[Node, str]]:
    """Texts of blocks in page order, each with the block element it is in, of branches that `keep` accepts.

    White space inside a block, a line break too, becomes one space; empty blocks are left out.
    """
    out: list[tuple[Node, str]] = []
    parts: list[str] = []
    block = root

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((block, text))
        parts.clear()

    # Each entry is a node with the place of the next child, so depth costs no recursion.
    stack: list[list] = [[root, 0, root]]
    while stack:
        entry = stack[-1]
        node, place, outer = entry
        if place == len(node.children):
            stack.pop()
            if node.tag in BLOCK:
                flush()
                block = outer
            continue
        entry[1] += 1
        child = node.children[place]
        if isinstance(child, str):
            parts.append(child)
        elif child.tag == "br":
            parts.append("\n")
        elif child.tag not in VOID and keep(child):
            if child.tag in BLOCK:
                flush()
                stack.append([child, 0, block])
                block = child
            else:
                stack.append([child, 0, block])
        elif child.tag in BLOCK:
            flush()
    flush()
    return out
