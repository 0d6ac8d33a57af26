"""What the query modules share: a registry, current tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.current import latest
from ..operators.items import numbered_lines
from ..sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query by its function's name, with SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def current_pages(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return latest(read_table(spark, folder, "pages"), "page_id", "scraped_at", ["status", *columns])


def current_annotations(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["ranges", "source", "validated", "skipped", "has_cookies", "created_at"]
    return latest(read_table(spark, folder, "annotations"), "page_id", "updated_at", kept)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered lines of current successful pages."""
    return numbered_lines(current_pages(spark, folder, "markdown").where("status = 'success'"))


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered lines with the text statistics and the flags that block features read."""
    rows = lines(spark, folder)
    stats = T.line_stats(F.col("text"), F.col("md_prefix"))
    zero = [F.lit(0).alias(n) for n in ("is_link_summary", "is_cookie_summary", "has_image", "has_input")]
    return rows.select("*", *[c.alias(n) for n, c in stats.items()], *zero, F.lit(1).alias("span_lines"), F.col("level").cast("string").alias("parent_tag"), F.col("level").alias("depth"))


CP = (
    "cp AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST) AS rn"
    " FROM (SELECT DISTINCT * FROM pages)) WHERE rn = 1)"
)
CA = (
    "ca AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY updated_at DESC NULLS LAST) AS rn"
    " FROM (SELECT DISTINCT * FROM annotations)) WHERE rn = 1)"
)
_PREFIX = r"regexp_extract(body, '^(#{1,6} |- |[0-9]+\. )', 1)"
LINES = rf"""{CP},
raw AS (SELECT page_id, unnest(string_split(markdown, chr(10))) AS raw FROM cp WHERE status = 'success'),
cut AS (SELECT page_id, CAST(regexp_extract(raw, '^ *([0-9]+) \|', 1) AS INTEGER) AS line_num, regexp_replace(raw, '^ *[0-9]+ \| ?', '') AS rest
        FROM raw WHERE regexp_matches(raw, '^ *[0-9]+ \|')),
bod AS (SELECT page_id, line_num, rest, ltrim(rest, ' ') AS body FROM cut),
tl AS (SELECT page_id, line_num, CAST((length(rest) - length(body)) // 2 AS INTEGER) AS level, {_PREFIX} AS md_prefix,
       substr(body, length({_PREFIX}) + 1) AS text FROM bod)"""
LINK = r"\[.*?\]\([^)]*\)"
WORDS = "list_filter(string_split(trim(text, ' '), ' '), lambda w: w <> '')"
MEASURED = rf"""{LINES},
mt AS (SELECT *, length(text) AS text_length, {WORDS} AS words, regexp_replace(text, '{LINK}', '', 'g') AS bare,
       regexp_extract_all(text, '{LINK}') AS links, regexp_extract_all(text, '\[([^\]]*)\]\(([^)]*)\)', 1) AS labels FROM tl),
st AS (SELECT *, len(words) AS word_count, CASE WHEN text_length > 0 THEN (text_length - length(bare)) / text_length ELSE 0 END AS link_ratio,
       len(links) AS link_count, CASE WHEN len(links) > 0 AND trim(bare, ' ') = '' THEN 1 ELSE 0 END AS is_link_only,
       CASE WHEN md_prefix LIKE '#%' THEN 1 ELSE 0 END AS is_heading, CASE WHEN md_prefix LIKE '#%' THEN length(rtrim(md_prefix, ' ')) ELSE 0 END AS heading_level,
       CASE WHEN md_prefix = '- ' OR regexp_matches(md_prefix, '^[0-9]+\. $') THEN 1 ELSE 0 END AS is_list_item,
       length(text) - length(replace(replace(text, ',', ''), '，', '')) AS comma_count FROM mt)"""
TOKENS = rf"""{LINES},
tk AS (SELECT page_id, line_num, list_transform(list_filter(string_split(trim(regexp_replace(text, '\[(.*?)\]\([^)]*\)', '\1', 'g'), ' '), ' '), lambda w: length(w) > 1),
       lambda w: trim(lower(w), '.,;:!?()[]{{}}"''-')) AS tokens FROM tl),
fl AS (SELECT page_id, line_num, unnest(tokens) AS word, unnest(range(1, len(tokens) + 1)) AS pos FROM tk)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


BLOCKS = """nb AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND level = lag(level) OVER w THEN 0 ELSE 1 END AS isnew FROM st WINDOW w AS (PARTITION BY page_id ORDER BY line_num)),
bl AS (SELECT *, CAST(sum(isnew) OVER (PARTITION BY page_id ORDER BY line_num ROWS UNBOUNDED PRECEDING) AS INTEGER) AS block FROM nb)"""
