"""Problem 3: clean text of pages, and the lines that still carry markup.

Composite text density: every element's characters per tag, adjusted for
links, is computed, and the densities of an element's children are summed. The
least density on the way from the subtree with the largest sum to the body is
the threshold: in every element that reaches it, the subtree with the largest
sum belongs to the clean text. The density tells what a page's text is, not
which lines carry markup; these are sought by their signs on the whole page.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.html_tree import Node
from ..operators.html_walk import INLINE, SKIPPED, TEXT, is_text_unit, span_of
from .markup import SIGNS, is_formula, kinds_in, plain
from .page_model import PageModel
from .pages import page_results


_TYPED_HEADING = re.compile(r"#{1,6}(?=\s)")
CODE = frozenset("pre code samp kbd textarea".split())


def visible_text(node: Node, inline_only: bool = False, code: bool = True) -> str:
    """The text of a line as it shows, without the marks that the walk adds; `code` tells whether code in it counts."""
    parts: list[str] = []
    stack = [(node, inline_only)]
    while stack:
        at, only = stack.pop()
        if type(at) is str:
            parts.append(at)
            continue
        for child in reversed(at.children):
            if type(child) is str:
                stack.append((child, False))
            elif child.name not in SKIPPED and not (only and child.name not in INLINE) and (code or child.name not in CODE):
                stack.append((child, False))
    return " ".join("".join(parts).split())


def line_text(item: tuple, code: bool = True) -> str:
    """Visible text of a walked line of text."""
    node = item[4]
    return visible_text(node, node.name not in INLINE and not is_text_unit(node), code)


def in_code(node: Node | None) -> bool:
    while node is not None:
        if node.name in CODE:
            return True
        node = node.parent
    return False


def residue_kinds(item: tuple) -> list[str]:
    """Kinds of markup left in a line; none for code and formulas, code within a line included."""
    if SIGNS.search(item[2]) is None:
        return []
    text = line_text(item, code=False)
    found = kinds_in(text)
    return found if found and not in_code(item[4]) and not is_formula(text) else []


# -------------------------------------------------------- composite density


class _Density:
    __slots__ = ("chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self):
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def densities(body: Node) -> dict[int, _Density]:
    """Density and sum of child densities of every element below `body`, by id()."""
    out: dict[int, _Density] = {}
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if type(c) is Node and c.name not in SKIPPED]
    for node in reversed(order):
        d = out[id(node)] = _Density()
        for child in node.children:
            if type(child) is str:
                d.chars += len("".join(child.split()))
            elif id(child) in out:
                c = out[id(child)]
                d.chars += c.chars
                d.tags += c.tags + 1
                d.link_chars += c.link_chars
                d.link_tags += c.link_tags
        if node.name == "a" or node.name == "button":
            d.link_chars, d.link_tags = d.chars, d.link_tags + 1
    whole = out[id(body)]
    share = whole.link_chars / max(whole.chars, 1)
    for node in order:
        d = out[id(node)]
        tags = max(d.tags, 1)
        if d.chars:
            # Links weigh by how much of the text is linked, against the whole page.
            base = log(d.chars / max(d.chars - d.link_chars, 1) * d.link_chars + share * d.chars + e)
            value = d.chars / max(d.link_chars, 1) * tags / max(d.link_tags, 1)
            d.density = d.chars / tags * log(max(value, 1.0)) / max(log(base), 0.1) if base > 1 else 0.0
    for node in order:
        out[id(node)].total = sum(out[id(c)].density for c in node.children if type(c) is Node and id(c) in out)
    return out


def dense_elements(body: Node) -> set[int]:
    """Ids of the elements that belong to the text: the subtrees of the largest sums in all elements that reach the threshold.

    Of equal sums the first element in the document counts. An element that
    stays below the threshold is not entered, except the body itself.
    """
    d = densities(body)
    inner = lambda node: [c for c in node.children if type(c) is Node and id(c) in d]
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += reversed(inner(node))
    best: dict[int, Node] = {}
    for node in reversed(order):
        most = node
        for child in inner(node):
            if d[id(best[id(child)])].total > d[id(most)].total:
                most = best[id(child)]
        best[id(node)] = most
    threshold, up = d[id(best[id(body)])].density, best[id(body)]
    while up is not None and id(up) in d:
        threshold = min(threshold, d[id(up)].density)
        up = up.parent
    kept: set[int] = set()
    stack = [body]
    while stack:
        node = stack.pop()
        if node is not body and d[id(node)].density < threshold or id(node) in kept:
            continue
        inside = [best[id(node)]]
        while inside:
            at = inside.pop()
            if id(at) not in kept:
                kept.add(id(at))
                inside += inner(at)
        stack += inner(node)
    return kept


def marked_lines(items: list[tuple]) -> list[int]:
    """Numbers of the lines of a walked page, in the body or outside, whose visible text carries markup."""
    out, number = [], 1
    for item in items:
        if item[1] == TEXT and residue_kinds(item):
            out.append(number)
        number += span_of(item)
    return out


def text_lines(items: list[tuple]) -> list[tuple[int, tuple]]:
    """(line number, item) of the lines of a walked page that stand in dense elements."""
    out: list[tuple[int, tuple]] = []
    number, kept = 1, None
    for item in items:
        if item[1] == TEXT:
            node = item[4]
            if kept is None:
                body = node
                while body.parent is not None and body.name != "body":
                    body = body.parent
                kept = dense_elements(body)
            if id(node) in kept:
                out.append((number, item))
        number += span_of(item)
    return out


def clean(items: list[tuple]) -> list[tuple[str, str]]:
    """(kind, text) of the lines in the text: heading, item, code, formula or text, free of markup.

    Lines without letters or digits after cleaning are left out; a page without
    text gives no lines.
    """
    out = []
    for _, item in text_lines(items):
        node, mark, text, kinds = item[4], item[3], line_text(item), residue_kinds(item)
        if in_code(node):
            # Code keeps its lines, unlike the numbered view.
            out.append(("code", _code(node)))
        elif is_formula(text):
            out.append(("formula", text))
        else:
            typed = _TYPED_HEADING.match(text)
            level = len(mark) - 1 if mark[:1] == "#" else len(typed[0]) if typed else 0
            text = plain(text) if kinds or level else text
            if any(map(str.isalnum, text)):
                out.append((f"heading{level}", text) if 0 < level < 7 else ("item", text) if mark else ("text", text))
    return out


def _code(node: Node) -> str:
    parts, stack = [], [node]
    while stack:
        at = stack.pop()
        if type(at) is str:
            parts.append(at)
        elif at.name not in SKIPPED:
            stack += reversed(at.children)
    return "".join(parts).strip("\n")


def as_markdown(lines: list[tuple[str, str]]) -> str:
    """Clean text with headings, lists, fenced code and formulas."""
    out = []
    for kind, text in lines:
        if kind.startswith("heading"):
            out.append("#" * int(kind[7:]) + " " + text)
        elif kind == "item":
            out.append("- " + text)
        elif kind == "code":
            out.append("```\n" + text + "\n```")
        else:
            out.append(text)
    return "\n".join(out)


_FOUND = pa.schema([pa.field("lines", pa.list_(pa.int32()))])
_CLEAN = pa.schema([pa.field("text", pa.string()), pa.field("lines", pa.list_(pa.int32()))])


def _found(_: PageModel) -> Callable:
    return lambda html, items, lines, scores: {"lines": marked_lines(items)}


def _cleaned(_: PageModel) -> Callable:
    return lambda html, items, lines, scores: {"lines": marked_lines(items), "text": as_markdown(clean(items))}


def found(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, line_num) of every line of a current successful page whose visible text carries markup.

    Pages that are cases of problem 4, or have null html, give no rows.
    """
    done = page_results(pages, annotations, model, _FOUND, _found)
    return done.where("status = 'success' and not residue").select("page_id", F.explode("lines").alias("line_num"))


def cleaned(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, text, lines): the clean text of every current successful page, and its lines that carried markup.

    Pages that are cases of problem 4 are left out. A page without text has an empty text.
    """
    done = page_results(pages, annotations, model, _CLEAN, _cleaned)
    return done.where("status = 'success' and not residue and text is not null").select("page_id", "text", "lines")
