"""Changes to annotations and pages as new tables: (table, changes) -> table.

A change table has at most one row per page_id that counts: of several the
one with the latest `at`. Nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .current import latest

FIELDS = ("ranges", "source", "validated", "skipped", "has_cookies", "created_at", "updated_at")
_DEFAULTS = {"ranges": "cast(array() as array<struct<start:int,end:int>>)", "source": "'manual'", "validated": "false", "skipped": "false", "has_cookies": "false"}


def _upsert(annotations: DataFrame, changes: DataFrame, values: dict[str, str]) -> DataFrame:
    """Rows of `changes` (page_id, at, ...) overwrite or insert; `values` gives the new columns as SQL over both sides."""
    new = changes.select("page_id", *[F.col(c).alias(f"new_{c}") for c in changes.columns if c != "page_id"])
    both = annotations.select("page_id", F.lit(True).alias("there"), *FIELDS).join(new, "page_id", "full_outer")
    out = []
    for c in FIELDS:
        default = _DEFAULTS.get(c, "new_at")
        changed = values.get(c, "new_at" if c == "updated_at" else f"case when there then {c} else {default} end")
        out.append(F.expr(f"case when new_at is null then {c} else {changed} end").alias(c))
    return both.select("page_id", *out)


def save(annotations: DataFrame, changes: DataFrame) -> DataFrame:
    """Set ranges and source, mark as validated and not skipped; `changes` has page_id, ranges, source and at."""
    rows = latest(changes, "page_id", "at")
    return _upsert(annotations, rows, {"ranges": "new_ranges", "source": "new_source", "validated": "true", "skipped": "false"})


def save_answers(annotations: DataFrame, changes: DataFrame) -> DataFrame:
    """Like `save` for answers of models: source llm, validated as `changes` (page_id, ranges, validated, at) says."""
    rows = latest(changes, "page_id", "at")
    return _upsert(annotations, rows, {"ranges": "new_ranges", "source": "'llm'", "validated": "new_validated", "skipped": "false"})


def skip(annotations: DataFrame, changes: DataFrame) -> DataFrame:
    """Mark as skipped and not validated; `changes` has page_id and at."""
    return _upsert(annotations, latest(changes, "page_id", "at"), {"validated": "false", "skipped": "true"})


def toggle_cookies(annotations: DataFrame, changes: DataFrame) -> DataFrame:
    """Turn has_cookies over, from none to true; `changes` has page_id and at."""
    return _upsert(annotations, latest(changes, "page_id", "at"), {"has_cookies": "not coalesce(has_cookies, false)"})


def accept(annotations: DataFrame, changes: DataFrame) -> DataFrame:
    """Mark existing annotations as validated and not skipped; pages without one are not inserted."""
    hit = latest(changes, "page_id", "at").select("page_id", F.col("at").alias("new_at"))
    joined = annotations.join(hit, "page_id", "left")
    on = F.col("new_at").isNotNull()
    return joined.select(
        "page_id",
        "ranges",
        "source",
        F.when(on, True).otherwise(F.col("validated")).alias("validated"),
        F.when(on, False).otherwise(F.col("skipped")).alias("skipped"),
        "has_cookies",
        "created_at",
        F.coalesce("new_at", "updated_at").alias("updated_at"),
    )


def record_scrapes(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Set status, error, html, markdown and scraped_at from `outcomes` (page_id, status, error, html, markdown, at).

    A success writes html and markdown and leaves the error as it was; a
    failure or skip writes the error and leaves html and markdown.
    """
    new = latest(outcomes, "page_id", "at").select("page_id", *[F.col(c).alias(f"new_{c}") for c in ("status", "error", "html", "markdown", "at")])
    joined = pages.join(new, "page_id", "left")
    on, good = F.col("new_at").isNotNull(), F.col("new_status") == "success"
    take = {
        "status": F.when(on, F.col("new_status")),
        "error": F.when(on & ~good, F.col("new_error")),
        "html": F.when(on & good, F.col("new_html")),
        "markdown": F.when(on & good, F.col("new_markdown")),
        "scraped_at": F.when(on, F.col("new_at")),
    }
    change = {"status": on, "error": on & ~good, "html": on & good, "markdown": on & good, "scraped_at": on}
    return joined.select(*[F.when(change[c], take[c]).otherwise(F.col(c)).alias(c) if c in take else F.col(c) for c in pages.columns])


def regeneration_counts(pages: DataFrame, annotations: DataFrame, keep_annotations: bool = False) -> DataFrame:
    """One row (pages, annotations): what a run of `regenerate` would render anew, and which annotations it would delete."""
    todo = pages.where("status = 'success' and html is not null").agg(F.count("*").alias("pages"))
    gone = F.lit(0).cast("bigint") if keep_annotations else F.lit(annotations.count()).cast("bigint")
    return todo.select("pages", gone.alias("annotations"))


def regenerate(pages: DataFrame, rendered: DataFrame) -> DataFrame:
    """Pages with the markdown of `rendered` (page_id, markdown) where they are a success with html."""
    new = rendered.select("page_id", F.col("markdown").alias("new_markdown"))
    on = (F.col("status") == "success") & F.col("html").isNotNull() & F.col("new_markdown").isNotNull()
    return pages.join(new, "page_id", "left").select(
        *[F.when(on, F.col("new_markdown")).otherwise(F.col(c)).alias(c) if c == "markdown" else F.col(c) for c in pages.columns]
    )
