"""Problem 1: the main body of pages without good annotations.

Maximum-scoring subsequence: the words and tags of a line score with weights
learned from labelled pages, and one linear scan finds the contiguous regions
with the largest total. The body of a page has dates, advertisements or share
prompts inside, so it is several regions, and a region costs something; the
regions alone decide.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .page_model import PageModel, body_lines
from .pages import page_results, validated_annotations

_LINES = pa.schema([pa.field("lines", pa.list_(pa.int32()))])
_TEXT = pa.schema([pa.field("lines", pa.list_(pa.int32())), pa.field("text", pa.string())])


def _lines(model: PageModel) -> Callable:
    return lambda html, items, lines, scores: {"lines": body_lines(lines, scores, model.cost)}


def _texts(model: PageModel) -> Callable:
    def result(html, items, lines, scores) -> dict:
        kept = body_lines(lines, scores, model.cost)
        own = set(kept)
        return {"lines": kept, "text": "\n".join([i[3] + i[2] for n, i, _, _ in lines if n in own])}

    return result


def main_bodies(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, residue, lines) of every page whose current row is a success.

    `lines` are the ascending line numbers of the main body, whether or not the
    page holds only residue; null without html, empty for pages without a
    region (an empty html among them). The html is read once, beside the
    labelled sample, and never shuffled.
    """
    done = page_results(pages, annotations, model, _LINES, _lines)
    return done.where("status = 'success'").select("page_id", "residue", "lines")


def found(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, line_num) of the main body of every page without a validated current annotation.

    Repeated rows count once; pages with null html, of another status, or with
    residue in place of content give no rows. An empty pages table gives none.
    """
    known = validated_annotations(annotations).select("page_id")
    return (
        main_bodies(pages, annotations, model)
        .where(~F.col("residue"))
        .join(known, "page_id", "left_anti")
        .select("page_id", F.explode("lines").alias("line_num"))
    )


def texts(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, lines, text): the main body of every current successful page, annotated or not, without site chrome.

    Pages that hold only residue or have null html are left out; a page without a body has an empty text.
    """
    done = page_results(pages, annotations, model, _TEXT, _texts)
    return done.where("status = 'success' and not residue and text is not null").select("page_id", "lines", "text")
