"""The review queue: tabs, search, order, pages, counts and the next page to look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_PAGE = 25
#: Columns that the list may be ordered by; any other name orders by page_id.
SORTS = {"id": "page_id", "url": "url", "source": "source", "validated": "validated", "scraped_at": "scraped_at"}


def with_annotations(pages: DataFrame, annotations: DataFrame) -> DataFrame:
    """Current pages with status success and their annotation, if any; html and markdown are left behind."""
    kept = pages.where("status = 'success'").select("page_id", "url", "dataset", "urgent", "scraped_at")
    own = annotations.select("page_id", "ranges", "source", "validated", "skipped", "has_cookies")
    return kept.join(own, "page_id", "left")


def tab(name: str) -> Column:
    """unvalidated: neither validated nor skipped; validated; any other name: all."""
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    if name == "unvalidated":
        return no("validated") & no("skipped")
    return F.coalesce(F.col("validated"), F.lit(False)) if name == "validated" else F.lit(True)


def search(text: str | None) -> Column:
    """A number finds its page; anything else is sought in urls, letter case ignored, % and _ meaning themselves."""
    wanted = (text or "").strip()
    if not wanted:
        return F.lit(True)
    if wanted.isascii() and wanted.isdigit():
        return F.col("page_id") == int(wanted)
    return F.contains(F.lower("url"), F.lower(F.lit(wanted)))


def listed(queue: DataFrame, tab_name: str = "all", text: str | None = None, sort: str = "id", direction: str = "asc", page: int = 1, per_page: int = PER_PAGE) -> DataFrame:
    """One page of the list: urgent rows first, then by a column, nulls last, then by page_id. A page is the feature's own limit."""
    by = F.col(SORTS.get(sort, "page_id"))
    by = by.desc_nulls_last() if direction == "desc" else by.asc_nulls_last()
    chosen = queue.where(tab(tab_name)).where(search(text))
    ordered = chosen.orderBy(F.coalesce("urgent", F.lit(False)).desc(), by, "page_id")
    return ordered.offset((max(page, 1) - 1) * per_page).limit(per_page)


def counted(queue: DataFrame, tab_name: str = "all", text: str | None = None, per_page: int = PER_PAGE) -> DataFrame:
    """One row (total, pages): rows of the list, and how many pages of the list they fill, at least one."""
    total = queue.where(tab(tab_name)).where(search(text)).agg(F.count("*").alias("total"))
    return total.withColumn("pages", F.greatest(F.ceil(F.col("total") / per_page), F.lit(1)).cast("bigint"))


def tab_counts(queue: DataFrame) -> DataFrame:
    return queue.agg(F.count("*").alias("all"), F.count_if(tab("unvalidated")).alias("unvalidated"), F.count_if(tab("validated")).alias("validated"))


def following(queue: DataFrame, after: int) -> DataFrame:
    """The next page that is neither validated nor skipped: urgent ones first, then the smallest page_id above `after`."""
    rows = queue.where(tab("unvalidated")).where(F.col("page_id") > after)
    return rows.orderBy(F.coalesce("urgent", F.lit(False)).desc(), "page_id").limit(1).select("page_id", "url")


def pending(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(page_id, url) of pages without a status, by page_id."""
    rows = pages.where("status is null").select("page_id", "url").orderBy("page_id")
    return rows.limit(limit) if limit is not None else rows


def unannotated(pages: DataFrame, annotations: DataFrame, urgent_only: bool = False) -> DataFrame:
    """(page_id, url) of successful pages without any annotation."""
    rows = pages.where("status = 'success'").where("urgent" if urgent_only else "true")
    return rows.select("page_id", "url").join(annotations.select("page_id"), "page_id", "left_anti")


def looked_up(pages: DataFrame, annotations: DataFrame, wanted: Column) -> DataFrame:
    """The successful pages that `wanted` (a condition on page_id) names, with their annotation and its defaults.

    Without an annotation ranges, source and flags are null, but has_cookies is
    false; a page that is missing or no success gives no row. `acceptable`
    tells whether there are ranges to accept.
    """
    own = annotations.where(wanted).select("page_id", "ranges", "source", "validated", "skipped", "has_cookies")
    rows = pages.where(wanted & (F.col("status") == "success")).join(own, "page_id", "left")
    return rows.withColumn("has_cookies", F.coalesce("has_cookies", F.lit(False))).withColumn("acceptable", F.col("ranges").isNotNull())


def scan(rows: DataFrame, limit: int | None = None, after: int | None = None) -> DataFrame:
    """Rows by page_id, from behind `after` on, all or the first `limit`."""
    ordered = (rows.where(F.col("page_id") > after) if after is not None else rows).orderBy("page_id")
    return ordered.limit(limit) if limit is not None else ordered


def annotated(pages: DataFrame, annotations: DataFrame, source: str | None = None, dataset: str | None = None) -> DataFrame:
    """(page_id, url, dataset, ranges) of successful pages with a validated annotation; a null dataset is 'original'.

    `source` and `dataset` keep only pages of that source or dataset.
    """
    own = annotations.where("validated")
    if source is not None:
        own = own.where(F.col("source") == source)
    rows = pages.where("status = 'success'").select("page_id", "url", F.coalesce("dataset", F.lit("original")).alias("dataset"))
    if dataset is not None:
        rows = rows.where(F.col("dataset") == dataset)
    return rows.join(own.select("page_id", "ranges"), "page_id")
