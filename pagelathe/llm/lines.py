"""Lines of a page as words and tags: what the page models read."""

from __future__ import annotations

import re
from functools import lru_cache

from ..operators.html_tree import Node
from ..operators.html_walk import TEXT, is_link_only, span_of

_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]")
_TARGET = re.compile(r"\]\([^)]*\)")
_NUMBER = re.compile(r"\d+")
#: Lines of this length class and longer (2 ** 10 letters) are alike.
LONGEST = 11
#: Remembered lines of a Python worker; the memory is emptied when full.
MEMORY = 20_000
_seen: dict[str, tuple] = {}
_named: dict[tuple[str, str], tuple[str, ...]] = {}


def words_of(text: str) -> tuple[tuple[str, ...], int, str, bool]:
    """(different lower-case words and marks with numbers as 0, length class, kind of links, ends a sentence)."""
    known = _seen.get(text)
    if known is not None:
        return known
    links = "](" in text
    plain = _TARGET.sub("]", text) if links else text
    words = tuple(set(_WORD.findall(_NUMBER.sub("0", plain.lower()))))
    kind = ("k" if is_link_only(text) else "l") if links else ""
    if len(_seen) >= MEMORY:
        _seen.clear()
    known = _seen[text] = (words, min(len(plain).bit_length(), LONGEST), kind, plain[-1:] in ".!?…。”\"")
    return known


def _names(node: Node, mark: str) -> tuple[str, ...]:
    """Tokens of the id, classes and role; names that hold digits are taken for generated ones."""
    out: tuple[str, ...] = ()
    for key in ("id", "class", "role"):
        if key in node.attrs:
            raw = node.attrs[key]
            known = _named.get((mark, raw))
            if known is None:
                if len(_named) >= MEMORY:
                    _named.clear()
                known = _named[mark, raw] = tuple(
                    [mark + ("opaque" if any(map(str.isdigit, v)) else v.lower()) for v in raw.split()]
                )
            out += known
    return out


@lru_cache(10_000)
def _form(kind: str, size: int, name: str) -> str:
    """Token for the kind, size and element of a line."""
    return f"f:{kind}{size} {name}"


_COMMON = frozenset("id class role href src".split())


def _around(node: Node) -> tuple[str, ...]:
    """Tokens of an element and everything it stands in, below the body."""
    if node.ctx is not None:
        return node.ctx
    up = node.parent
    base = _around(up) if up is not None else ()
    if up is not None and node.name not in ("body", "html"):
        own = ["a:" + node.name]
        if node.attrs:
            own += _names(node, "a:")
            own += ["a:@" + k for k in node.attrs if k not in _COMMON]
            if "style" in node.attrs:
                own.append("a:style=" + "".join(node.attrs["style"].lower().split()))
        base = tuple(dict.fromkeys((*base, *own)))
    node.ctx = base
    return base


def lines_of(items: list[tuple]) -> list[tuple]:
    """(line number, item, words, tags) of every line of text of a walked page.

    Tags name the element and what it stands in, its kind and size, its place
    against the title, and the words of the heading above. The neighbours are
    left to the scan for regions.
    """
    lines, number = [], 1
    for item in items:
        if item[1] == TEXT:
            lines.append((number, item, words_of(item[2])))
        number += span_of(item)
    title = next((i for i, x in enumerate(lines) if x[1][3] == "# "), None)
    forms = [
        _form(("#" if x[3][:1] == "#" else "-" if x[3] else "") + kind, size, x[4].name) for _, x, (_, size, kind, _) in lines
    ]
    out, heading, titles, n = [], (), 0, len(lines)
    for i, (number, item, (words, _, kind, ends)) in enumerate(lines):
        mark, node = item[3], item[4]
        form = forms[i]
        head = mark[:1] == "#"
        tags = [
            form,
            "t:" + node.name,
            "p:" + node.parent.name,
            f"k:{mark}{kind}" if head else "k:" + form[2:4],
            _TENTHS[10 * i // n],
        ]
        if node.attrs:
            tags += _names(node, "o:")
        if ends:
            tags.append("ends")
        if title is None:
            tags.append("untitled")
        else:
            tags.append(_AWAY[(i - title).bit_length() if i >= title else -(title - i).bit_length()])
        if head:
            titles += mark == "# "
            heading = (f"xl:{len(mark)}", *["x:" + w for w in words]) if len(words) < 12 else (f"xl:{len(mark)}",)
        tags.append(_TITLES[titles if titles < 3 else 3])
        tags += heading
        tags += _around(node)
        out.append((number, item, words, tags))
    return out


_TENTHS = [f"r:{i}" for i in range(10)]
_TITLES = [f"hs:{i}" for i in range(4)]
_AWAY = {i: f"h:{i}" for i in range(-64, 65)}
