"""A small forgiving HTML tree on the standard library's tokenizer.

Differences from a browser-grade parser: a start tag of the block set ends an
open ``p``; an ``li``, ``td``, ``th`` or ``tr`` ends its open sibling; an end
tag without a match is dropped; comments are not nodes; script text is kept as
text of its element.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": ("ul", "ol"), "td": ("tr",), "th": ("tr",), "tr": ("table", "tbody", "thead", "tfoot"), "dt": ("dl",), "dd": ("dl",)}


class Node:
    """An element: tag, attributes, and children that are texts or nodes."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """Itself and all elements below, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        """All text below."""
        parts: list[str] = []
        stack: list = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(parts)

    def lead(self) -> str:
        """Text before the first child element."""
        parts = []
        for child in self.children:
            if isinstance(child, Node):
                break
            parts.append(child)
        return "".join(parts)

    def get(self, name: str) -> str:
        return self.attrs.get(name, "")

    def html(self) -> str:
        """Markup of the element, however deep it is."""
        parts: list[str] = []
        stack: list = [(self, False)]
        while stack:
            item, plain = stack.pop()
            if plain:
                parts.append(item)
                continue
            parts.append(f"<{item.tag}{''.join(f' {k}="{v}"' for k, v in item.attrs.items())}>")
            if item.tag not in VOID:
                stack.append((f"</{item.tag}>", True))
                stack.extend((c, isinstance(c, str)) for c in reversed(item.children))
        return "".join(parts)

    def spans(self) -> tuple[list[str], list[tuple[Node, int, int]]]:
        """All texts below in order, and each element, in document order, with the first of its texts and the one behind its last."""
        texts: list[str] = []
        found: list[list] = []
        stack: list = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                texts.append(item)
            elif isinstance(item, Node):
                found.append([item, len(texts), 0])
                stack.append(len(found) - 1)  # met again behind the element's content
                stack.extend(reversed(item.children))
            else:
                found[item][2] = len(texts)
        return texts, [tuple(x) for x in found]


class _Builder(HTMLParser):
    def __init__(self, references: bool = True):
        super().__init__(convert_charrefs=True)
        self.references = references
        self.root = self.at = Node("#root", {}, None)
        self.open: Counter[str] = Counter()  # tags open at this place, so that one that is not open is not looked for

    def _leave(self, node: Node) -> None:
        """Go on behind ``node``, an element that is open."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[node.tag] -= 1
        self.at = node.parent

    def _close(self, tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        node = self.at if any(self.open[t] for t in tags) else self.root
        while node is not self.root and node.tag not in stops:
            if node.tag in tags:
                self._leave(node)
                return
            node = node.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ENDS_P:
            self._close(("p",), ("table", "td", "th", "li", "div", "body"))
        if tag in SIBLINGS:
            self._close(("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,), SIBLINGS[tag])
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while self.open[tag] and node is not self.root:
            if node.tag == tag:
                self._leave(node)
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        if not self.references and self.cdata_elem in self.CDATA_CONTENT_ELEMENTS:
            data = data.replace("&amp;", "&")  # no references are read here
        self.at.children.append(data)


def html_tree(data: bytes | str, references: bool = True) -> Node:
    """Tree of a page; without ``references`` its texts and attributes keep character references as they are written."""
    builder = _Builder(references)
    text = data if isinstance(data, str) else decode_bytes(data)
    builder.feed(text if references else text.replace("&", "&amp;"))
    builder.close()
    return builder.root


def decode_bytes(data: bytes) -> str:
    """Text of a document: byte-order mark, then the declared encoding, then UTF-8 with Latin-1 behind it."""
    if data.startswith(b"\xef\xbb\xbf"):
        return data[3:].decode("utf-8", "replace")
    declared = re.search(rb"""encoding=["']([\w-]+)["']""", data[:200])
    name = declared.group(1).decode("ascii").lower() if declared else "utf-8"
    if name in ("utf-8", "utf8"):
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return data.decode("latin-1")
    try:
        return data.decode(name, "replace")
    except LookupError:
        return data.decode("latin-1")


def canonical(text: str | None) -> str:
    """Driver-free twin of ``functions.text.canonical_text`` for use inside parsers."""
    import unicodedata

    kept = (c for c in unicodedata.normalize("NFC", text or "") if c not in "​‌‍﻿")
    spaced = "".join(" " if c == " " else c for c in kept if c in "\n\t" or unicodedata.category(c) != "Cc")
    return " ".join(spaced.split())
