"""A small, tolerant HTML tree.

The tree follows the rules of a plain event parser without any repair of
nesting: an end tag closes the nearest open element of that name and is
ignored when there is none, void elements never stay open, nothing is closed
implicitly, comments split text but are not text. One regular expression finds
the markup, so a page costs a few microseconds per tag.
"""

from __future__ import annotations

import re
from html import unescape

VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen"
    " link menuitem meta nextid param source spacer track wbr".split()
)
#: Text inside these belongs to the element but does not count as page text.
SPECIAL_TEXT_TAGS = frozenset({"script", "style", "template", "rt", "rp"})
RAW_TAGS = frozenset({"script", "style"})

_MARKUP = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|!--.*?--\s*>|!\[CDATA\[(.*?)\]\]>|[!?][^>]*>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TAGS}


class Node:
    """An element. Children are elements and strings; attributes may be None.

    `said`, `place` and `memo` keep what was found out about the element until
    `forget` is called on it: its text, its number in a list, and notes of features.
    """

    __slots__ = ("name", "attrs", "parent", "children", "has_text", "has_img", "has_input", "ctx", "lines", "said", "place", "memo")

    def __init__(self, name: str, attrs: dict | None, parent: "Node | None"):
        self.name = name
        self.attrs = attrs
        self.parent = parent
        self.children: list = []
        self.has_text = self.has_img = self.has_input = False
        self.ctx = self.said = self.memo = None
        self.lines = self.place = 0

    def forget(self) -> None:
        """To be called after the children changed: the text up to the root and the numbers of the children are found out anew."""
        node: Node | None = self
        while node is not None:
            node.said = node.memo = None
            node = node.parent
        for child in self.children:
            if type(child) is Node:
                child.place = 0

    def get(self, key: str, default: str = "") -> str:
        return self.attrs.get(key, default) if self.attrs else default

    def classes(self) -> list[str]:
        return self.attrs["class"].split() if self.attrs and "class" in self.attrs else []

    def elements(self):
        """All elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if type(c) is Node]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if type(c) is Node)


def parse_attributes(raw: str) -> dict | None:
    """Attributes with decoded values; of repeated ones the last counts."""
    if "=" not in raw and not raw.strip(" \t\r\n\f/"):
        return None
    out = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        value = a or b or c
        out[name.lower()] = unescape(value) if "&" in value else value
    return out or None


def _mark(node: Node | None, flag: str) -> None:
    while node is not None and not getattr(node, flag):
        setattr(node, flag, True)
        node = node.parent


def parse(html: str, resolve=None) -> Node:
    """The document node of `html`; never fails, whatever the text is.

    `resolve`, if given, is applied to the targets of links and buttons.
    """
    root = Node("[document]", None, None)
    here, path = root, [root]
    opened: dict[str, int] = {}
    closed: dict[str, int] = {}  # void elements whose explicit end tag is still to be skipped
    special = 0
    at, end = 0, len(html)

    def add_text(text: str) -> None:
        if "&" in text:
            text = unescape(text)
        here.children.append(text)
        if not special and not here.has_text and not text.isspace():
            node = here
            while node is not None and not node.has_text:
                node.has_text = True
                node = node.parent

    def close(name: str) -> None:
        nonlocal here, special
        if closed.get(name):
            closed[name] -= 1
            return
        if not opened.get(name):
            return
        while True:
            node = path.pop()
            opened[node.name] -= 1
            if node.name in SPECIAL_TEXT_TAGS:
                special -= 1
            if node.name == name:
                break
        here = path[-1]

    for m in _MARKUP.finditer(html):
        start = m.start()
        if start < at:  # inside a script or style
            continue
        if start > at:
            add_text(html[at:start])
        at = m.end()
        slash, tag, raw, data = m.groups()
        if tag is None:
            if data:
                add_text(data)
            continue
        name = tag.lower()
        if slash:
            close(name)
            continue
        empty = raw.endswith("/")
        attrs = parse_attributes(raw[:-1] if empty else raw) if raw else None
        node = Node(name, attrs, here)
        here.children.append(node)
        if attrs and resolve is not None and (name == "a" or name == "button"):
            for key in ("href", "data-href"):
                if target := attrs.get(key):
                    attrs[key] = resolve(target)
        if name == "img":
            _mark(node, "has_img")
        elif name == "input" or name == "select" or name == "textarea":
            _mark(node, "has_input")
        if name in VOID_TAGS:
            if not empty:
                closed[name] = closed.get(name, 0) + 1
        elif not empty:
            path.append(node)
            opened[name] = opened.get(name, 0) + 1
            here = node
            if name in SPECIAL_TEXT_TAGS:
                special += 1
                if name in RAW_TAGS:
                    stop = _RAW_END[name].search(html, at)
                    upto = stop.start() if stop else end
                    if upto > at:
                        here.children.append(html[at:upto])
                    at = stop.end() if stop else end
                    close(name)
    if at < end:
        add_text(html[at:])
    return root


def refresh_text(node: Node | None) -> None:
    """Recompute has_text from `node` up, after its children changed."""
    while node is not None:
        node.has_text = node.name not in SPECIAL_TEXT_TAGS and any(
            (c.has_text if type(c) is Node else not c.isspace()) for c in node.children
        )
        node = node.parent
