"""Problem 4: pages that hold an error, placeholders or filler in place of content.

Positive-unlabelled naive Bayes: records with unfilled placeholders or a failed
status and little body are the trusted positives, all others unlabelled, and
expectation-maximization over all records finds the weights of the words of
passages and of the amount of body. Passages are scored one by one; the sum of
a record's log odds decides.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .page_model import PageModel
from .pages import page_results

_NOTHING = pa.schema([])
_KEPT = pa.schema([pa.field("has_html", pa.bool_())])


def found(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id) of every page whose current row, whatever its status, holds nothing but residue.

    Null html is no case, and neither is html without any text. Repeated rows
    count once. Where no record is trusted there is no case.
    """
    return page_results(pages, annotations, model, _NOTHING, lambda _: lambda *_: {}).where("residue").select("page_id")


def kept(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, url) of the current successful pages with html that are no case, for the stages that follow."""
    done = page_results(pages, annotations, model, _KEPT, lambda _: lambda *_: {"has_html": True}, carry=("url",))
    return done.where("status = 'success' and has_html and not residue").select("page_id", "url")
