"""Small page helper used inside tasks: a tree from the standard HTML parser.

It only finds elements and gives their text; numbers and dates are Spark expressions
over the rows that come out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
HIDDEN = {"script", "style", "template"}


class Element:
    __slots__ = ("tag", "attrs", "parent", "items")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """Elements below this one in document order."""
        stack = [iter(self.items)]
        while stack:
            for item in stack[-1]:
                if isinstance(item, Element):
                    yield item
                    stack.append(iter(item.items))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[tuple[Element, str]]:
        """Visible strings with the element that holds them."""
        stack = [(self, iter(self.items))]
        while stack:
            holder, rest = stack[-1]
            for item in rest:
                if isinstance(item, str):
                    yield holder, item
                elif item.tag not in HIDDEN:
                    stack.append((item, iter(item.items)))
                    break
            else:
                stack.pop()

    def text(self, separator: str = "", strip: bool = True) -> str:
        parts = (s for _, s in self.strings())
        return separator.join(filter(None, map(str.strip, parts)) if strip else parts)

    def up(self, tag: str) -> Element | None:
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node

    def matches(self, step: str) -> bool:
        tag, *classes = step.split(".")
        own = self.attrs.get("class", "").split()
        return self.tag == tag and all(c in own for c in classes)

    def find_all(self, path: str) -> Iterator[Element]:
        """Elements matching ``tag.class tag.class`` (descendant steps)."""
        *above, last = path.split()
        for node in self.walk():
            if not node.matches(last):
                continue
            place = node.parent
            for step in reversed(above):
                while place is not None and not place.matches(step):
                    place = place.parent
                if place is None:
                    break
                place = place.parent
            else:
                yield node

    def find(self, path: str) -> Element | None:
        return next(self.find_all(path), None)

    def links(self, test: Callable[[str], bool]) -> Iterator[Element]:
        return (n for n in self.walk() if n.tag == "a" and test(n.attrs.get("href", "")))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.place = Element("", {}, None)

    def _close(self, tag: str) -> None:
        node = self.place
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.place = node.parent

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close("a")
        if tag in CLOSES_P and self.place.tag == "p":
            self._close("p")
        node = Element(tag, {k: v or "" for k, v in attrs}, self.place)
        self.place.items.append(node)
        if tag not in VOID:
            self.place = node

    def handle_startendtag(self, tag, attrs):
        self.place.items.append(Element(tag, {k: v or "" for k, v in attrs}, self.place))

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data):
        self.place.items.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def text_of(node: Element | None, separator: str = "") -> str | None:
    return None if node is None else node.text(separator)
