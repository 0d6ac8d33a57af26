"""Lines of pages as rows: the walk in Arrow batches, and rendered views.

Pages are (page_id, url, html); rows with null html give nothing. The html
goes into Python once and leaves it as lines; it is never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cookie_rules import removals
from .current import latest
from .html_tree import Node, parse
from .html_walk import (
    CONTENT,
    COOKIES,
    END,
    LABEL,
    LINKS,
    SKIPPED,
    STRUCTURAL,
    collapse_link_runs,
    compressed,
    render,
    shorten_urls,
    span_of,
    walk,
)

# Signs of hidden, boilerplate, content and byline elements.
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden|opacity\s*:\s*0(?![.\d])", re.I)
_ROLES = frozenset("menu menubar complementary navigation alert dialog contentinfo banner".split())
_PROPERTIES = frozenset("articlebody description reviewbody mainentity text".split())
_BYLINE = re.compile(r"byline|author|dateline|writtenby|p-author", re.I)

META = (
    "has_image has_input is_button has_aria_hidden in_table in_details is_hidden role_is_boilerplate has_schema_content"
    " is_byline in_figure is_last_child sibling_count".split()
)


def _inherited(node: Node) -> tuple:
    """(button, aria-hidden, table, details, hidden, role, property, figure, class chain) of an element with its ancestors."""
    if node.ctx is not None:
        return node.ctx
    up = _inherited(node.parent) if node.parent is not None else (False,) * 8 + ((),)
    get, name = node.get, node.name
    style = get("style") or ""
    classes = node.classes()
    node.ctx = own = (
        up[0] or name == "button",
        up[1] or get("aria-hidden") == "true",
        up[2] or name == "table",
        up[3] or name == "details",
        up[4] or bool(style and _HIDDEN.search(style)),
        up[5] or (get("role") or "").lower() in _ROLES,
        up[6] or (get("itemprop") or "").lower() in _PROPERTIES,
        up[7] or name == "figure",
        ((" ".join(sorted(classes)),) + up[8]) if classes else up[8],
    )
    return own


def _kin(parent: Node) -> tuple:
    """(last child element, number of children that show, share of the commonest name among these); found out once a parent."""
    if parent.memo is None:
        own = [c for c in parent.children if type(c) is Node]
        names = Counter(c.name for c in own if c.name not in SKIPPED)
        n = names.total()
        parent.memo = (own[-1] if own else None, n, round(names.most_common(1)[0][1] / n, 4) if n else 0.0)
    return parent.memo


def element_meta(node: Node | None) -> tuple[dict, list[str]]:
    """Flags of the element of a line, and its chain of classes from itself to the root."""
    if node is None:
        return {**dict.fromkeys(META, 0), "sibling_tag_uniformity": 0.0}, []
    own = _inherited(node)
    block = node.parent
    while block is not None and block.name not in STRUCTURAL and block.name not in CONTENT:
        block = block.parent
    _, siblings, uniformity = _kin(block) if block is not None else (None, 0, 0.0)
    name = node.name
    return {
        "has_image": int(node.has_img),
        "has_input": int(node.has_input),
        "is_button": int(own[0]),
        "has_aria_hidden": int(own[1]),
        "in_table": int(own[2] or name in ("td", "th", "tr")),
        "in_details": int(own[3] or name == "summary"),
        "is_hidden": int(own[4]),
        "role_is_boilerplate": int(own[5]),
        "has_schema_content": int(own[6]),
        "is_byline": int(bool(_BYLINE.search(" ".join(node.classes())) or _BYLINE.search(node.get("id") or ""))),
        "in_figure": int(own[7]),
        "is_last_child": int(node.parent is None or _kin(node.parent)[0] is node),
        "sibling_count": siblings,
        "sibling_tag_uniformity": uniformity,
    }, list(own[8])


_TEXT, _INT, _LIST = pa.string(), pa.int32(), pa.list_(pa.string())
_LINE = [
    ("url", _TEXT),
    ("seq", _INT),
    ("line_num", _INT),
    ("span_lines", _INT),
    ("depth", _INT),
    ("item_type", _TEXT),
    ("text", _TEXT),
    ("md_prefix", _TEXT),
    ("link_lines", _INT),
    ("ancestors", _LIST),
    ("class_chain", _LIST),
    *[(m, _INT) for m in META],
    ("sibling_tag_uniformity", pa.float64()),
]
_SQL = {_TEXT: "string", _INT: "int", _LIST: "array<string>", pa.float64(): "double"}


def per_page(pages: DataFrame, fields: list[tuple[str, pa.DataType]], rows_of: Callable[[str, str | None], list[tuple]], carry: tuple[str, ...] = (), status: str | None = "success") -> DataFrame:
    """(page_id, *carry, rows): what `rows_of(html, url)` finds on every page with html, as an array of structs of `fields`.

    `pages` has page_id, url and html. If it has scraped_at and status too, its
    rows are scrapes: the current one of each page is chosen among the results,
    so the html is neither shuffled nor read again, and only pages whose
    current scrape has html and the wanted status stay. Carried columns have
    to be strings.
    """
    scrapes = "scraped_at" in pages.columns
    own = ["page_id", *(["scraped_at", "status"] if scrapes else []), *carry]
    struct = pa.struct([pa.field(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat: list[tuple] = []
            ends: list[int | None] = [0]
            there = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                if html is not None:
                    flat += rows_of(html, url)
                there.append(html is not None)
                ends.append(len(flat))
            columns = list(zip(*flat)) or [()] * len(fields)
            values = pa.StructArray.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], fields=list(struct))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([not x for x in there], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], lists], names=[*own, "rows"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.select(own).schema.fields)
    ddl += ", rows array<struct<" + ", ".join(f"{n}: {_SQL[t]}" for n, t in fields) + ">>"
    done = pages.select(*dict.fromkeys([*own, "url", "html"])).mapInArrow(run, ddl)
    if scrapes:
        done = latest(done, "page_id", "scraped_at")
        done = done.where(F.col("status") == status) if status is not None else done
    return done.where("rows is not null").select("page_id", *carry, "rows")


def unrolled(walked: DataFrame) -> DataFrame:
    """(page_id, fields of the rows) of a `per_page` table."""
    return walked.select("page_id", F.inline("rows"))


def _line_rows(collapse_links: bool) -> Callable[[str, str | None], list[tuple]]:
    def rows_of(html: str, url: str | None) -> list[tuple]:
        items = walk(html, url or "")
        if collapse_links:
            items = collapse_link_runs(items)
        open_labels: list[tuple[int, str]] = []
        out, number = [], 1
        for seq, item in enumerate(items):
            depth, kind, text, prefix, node = item
            if kind == LABEL or kind == END:
                while open_labels and open_labels[-1][0] >= depth:
                    open_labels.pop()
                if kind == LABEL:
                    open_labels.append((depth, text))
                continue
            plain = kind not in (COOKIES, LINKS)
            meta, chain = element_meta(node)
            span = span_of(item)
            shown = (text, prefix) if plain else ("", "")
            out.append(
                (url, seq, number, span, depth, kind, *shown, int(prefix) if kind == LINKS else 0, [x for _, x in open_labels], chain, *meta.values())
            )
            number += span
        return out

    return rows_of


def walked_lines(pages: DataFrame, collapse_links: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, *carry, rows): the lines of each page as `page_lines` gives them, still one row a page."""
    return per_page(pages, _LINE, _line_rows(collapse_links), carry)


def page_lines(pages: DataFrame, collapse_links: bool = False) -> DataFrame:
    """One row per line of text, consent container or (with `collapse_links`) run of links.

    `line_num` is the first number that the row takes and `span_lines` how many;
    `ancestors` are the open structural elements from the outermost. Containers
    and runs have an empty text, no classes and no flags. Of scrapes the
    current ones count, see `per_page`.
    """
    return unrolled(walked_lines(pages, collapse_links))


def rendered(pages: DataFrame) -> DataFrame:
    """(page_id, markdown, light): both numbered views of every page with html; line numbers agree between them."""

    def rows_of(html: str, url: str | None) -> list[tuple]:
        items = walk(html, url or "")
        light = render(collapse_link_runs(items))
        return [(render(items), f"[url: {url}]\n{shorten_urls(light, url)}" if url else light)]

    return unrolled(per_page(pages, [("markdown", _TEXT), ("light", _TEXT)], rows_of))


def outline(pages: DataFrame) -> DataFrame:
    """(page_id, seq, level, item_type, label): structural labels and summaries with their depth in the view."""

    def rows_of(html: str, url: str | None) -> list[tuple]:
        placed = enumerate(compressed(walk(html, url or "")))
        return [(seq, level, item[1], item[2]) for seq, (level, item) in placed if item[1] in (LABEL, COOKIES)]

    return unrolled(per_page(pages, [("seq", _INT), ("level", _INT), ("item_type", _TEXT), ("label", _TEXT)], rows_of))


def consent_audit(pages: DataFrame) -> DataFrame:
    """(page_id, provider, selector, tag, id, classes) of every element that cleaning takes out for consent."""
    names = ("provider", "selector", "tag", "id", "classes")

    def rows_of(html: str, url: str | None) -> list[tuple]:
        return [tuple(r[n] for n in names) for r in removals(parse(html))]

    return unrolled(per_page(pages, [(n, _LIST if n == "classes" else _TEXT) for n in names], rows_of))


def numbered_lines(pages: DataFrame) -> DataFrame:
    """(page_id, line_num, level, label, md_prefix, text) read back from rendered markdown.

    `level` is the indentation and `label` the nearest label above that is
    indented less; summaries of consent containers count as lines without
    prefix. Rows with null markdown give nothing.
    """
    raw = pages.select("page_id", F.posexplode(F.split("markdown", "\n")).alias("pos", "raw"))
    number = F.regexp_extract("raw", r"^ *([0-9]+) \|", 1)
    rest = F.regexp_replace("raw", r"^ *[0-9]+ \| ?", "")
    body = F.ltrim(rest)
    prefix = F.regexp_extract(body, r"^(#{1,6} |- |[0-9]+\. )", 1)
    return raw.where(number != "").select(
        "page_id",
        number.cast("int").alias("line_num"),
        F.floor((F.length(rest) - F.length(body)) / 2).cast("int").alias("level"),
        prefix.alias("md_prefix"),
        F.substr(body, F.length(prefix) + 1, F.length(body)).alias("text"),
    )
