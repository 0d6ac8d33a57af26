"""The registered queries against their SQL, on the smallest tables."""

import glob
import os
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from pagelathe import plans
from pagelathe.operators import html_walk as W
from pagelathe.operators.cookie_rules import removals
from pagelathe.operators.html_tree import Node, parse


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (bool, str)):
        return v
    return float(v) if hasattr(v, "__float__") else str(v)


def bag(frame):
    return Counter(tuple(map(same, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_its_sql(spark, data, duck, name):
    ours, theirs = plans.QUERIES[name](spark, data).toPandas(), duck.execute(plans.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert bag(ours) == bag(theirs)


def scraped(data):
    """(html, url) of the current successful pages with html, by page_id."""
    rows = pq.read_table(f"{data}/pages.parquet").to_pylist()
    best = {}
    for r in rows:
        at = r["scraped_at"].timestamp() if r["scraped_at"] else float("-inf")
        if r["page_id"] is not None and (r["page_id"] not in best or at > best[r["page_id"]][0]):
            best[r["page_id"]] = (at, r)
    return {k: (r["html"], r["url"]) for k, (_, r) in best.items() if r["status"] == "success" and r["html"] is not None}


def test_every_query_without_sql_is_compared():
    compared = {"html_render_light", "html_outline", "consent_audit", "collapsed_lines", "shuffled_feature", "page_features_85"}
    assert set(plans.QUERIES) - set(plans.SQL) == compared


def test_light_views(spark, data):
    want = {k: W.to_markdown_light(h, u or "") for k, (h, u) in scraped(data).items()}
    assert {r.page_id: r.light for r in plans.QUERIES["html_render_light"](spark, data).collect()} == want


def test_outlines(spark, data):
    want = {(k, i, level, x[1], x[2]) for k, (h, u) in scraped(data).items() for i, (level, x) in enumerate(W.compressed(W.walk(h, u or ""))) if x[1] in (W.LABEL, W.COOKIES)}
    got = [tuple(r) for r in plans.QUERIES["html_outline"](spark, data).collect()]
    assert len(got) == len(want) and set(got) == want


def test_consent_audit(spark, data):
    want = Counter((k, x["provider"], x["selector"], x["tag"], x["id"]) for k, (h, _) in scraped(data).items() for x in removals(parse(h)))
    assert Counter((r.page_id, r.provider, r.selector, r.tag, r.id) for r in plans.QUERIES["consent_audit"](spark, data).collect()) == want


def test_collapsed_lines(spark, data):
    want = set()
    for k, (h, u) in scraped(data).items():
        number = 1
        for x in W.collapse_link_runs(W.walk(h, u or "")):
            if x[1] in (W.COOKIES, W.LINKS):
                links = int(x[3]) if x[1] == W.LINKS else 0
                want.add((k, number, W.span_of(x), x[1], links, int(links > 0)))
            number += W.span_of(x)
    got = [tuple(r) for r in plans.QUERIES["collapsed_lines"](spark, data).collect()]
    assert len(got) == len(want) and set(got) == want and any(x[3] == W.LINKS for x in want)


def test_shuffled_feature(spark, data):
    rows = plans.QUERIES["line_text_stats"](spark, data).select("page_id", "line_num", "text_length").toPandas()
    got = plans.QUERIES["shuffled_feature"](spark, data).toPandas()
    values = lambda f: Counter(map(tuple, f[["page_id", "text_length"]].itertuples(index=False)))
    lines = lambda f: Counter(map(tuple, f[["page_id", "line_num"]].itertuples(index=False)))
    assert values(got) == values(rows) and lines(got) == lines(rows)
    assert (got.sort_values(["page_id", "line_num"])["text_length"].to_numpy() != rows.sort_values(["page_id", "line_num"])["text_length"].to_numpy()).mean() > 0.3


def walked_flags(html, url):
    """By line: depth, label above, labels open, last among its siblings, siblings, share of the commonest; found out the long way."""
    out, number, stack = {}, 1, []
    for x in W.walk(html, url or ""):
        depth, kind, _, _, node = x
        if kind in (W.LABEL, W.END):
            stack = [s for s in stack if s[0] < depth]
            if kind == W.LABEL:
                stack.append((depth, x[2]))
            continue
        if kind == W.TEXT:
            around = [c for c in node.parent.children if isinstance(c, Node)]
            block = node.parent
            while block is not None and block.name not in W.STRUCTURAL and block.name not in W.CONTENT:
                block = block.parent
            names = [c.name for c in block.children if isinstance(c, Node) and c.name not in W.SKIPPED] if block is not None else []
            most = max((names.count(n) for n in names), default=0)
            labels = [s[1] for s in stack]
            out[number] = (depth, labels[-1] if labels else "body", int("nav" in labels), int("article" in labels), int(around[-1] is node), len(names), round(most / len(names), 4) if names else 0.0)
        number += W.span_of(x)
    return out


def test_feature_table_of_the_walk(spark, data):
    """The columns that the html alone tells, and those of blocks, recomputed line by line."""
    pages = scraped(data)
    table = plans.QUERIES["page_features_85"](spark, data).toPandas().sort_values(["page_id", "line_num"])
    named = pq.read_table(f"{data}/pages.parquet", columns=["page_id", "dataset"]).to_pylist()
    assert set(table["dataset"]) <= {r["dataset"] or "original" for r in named} and len(table) > 100
    for page_id, rows in table.groupby("page_id"):
        want = walked_flags(*pages[page_id])
        text = rows[rows["is_cookie_summary"] == 0]
        columns = "depth parent_tag in_nav in_article is_last_child sibling_count sibling_tag_uniformity".split()
        assert {r.line_num: tuple(getattr(r, c) for c in columns) for r in text.itertuples()} == want
        block, blocks, last = 0, [], None
        for r in rows.itertuples():
            block += last != (r.parent_tag, r.depth)
            last = (r.parent_tag, r.depth)
            blocks.append(block)
        grouped = rows.assign(block=blocks).groupby("block")
        assert list(grouped["block_size"].transform("first")) == list(grouped["block_size"].transform("size"))
        assert np.allclose(grouped["text_length"].transform("mean"), rows["block_text_density"], atol=0.06)
        assert np.allclose(grouped["is_list_item"].transform("sum") / np.maximum(((rows["is_heading"] == 0) & (rows["is_list_item"] == 0) & (rows["is_cookie_summary"] == 0)).groupby(blocks).transform("sum"), 1), rows["block_li_p_ratio"], atol=6e-5)
        total = grouped["text_length"].sum()
        best = total.idxmax() if total.max() > 0.5 * total.sum() else None
        assert list(rows["content_region_ratio"]) == [int(b == best) for b in blocks]
        assert list(rows["total_lines"]) == [rows["span_lines"].sum()] * len(rows)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 100 and "label" in rows.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    code = "import sys; sys.modules['pagelathe.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 70 and not any(m.startswith('pagelathe.llm.') for m in sys.modules)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env={**os.environ, "PYTHONPATH": root})
