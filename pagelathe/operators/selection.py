"""From a selected piece of text back to line numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import selection_words

#: Words at either end of a selection that are looked for.
ENDS = 5


def _last(text: Column, part: Column) -> Column:
    """Place from 1 of the last occurrence, 0 without one."""
    back = F.instr(F.reverse(text), F.reverse(part))
    return F.when(back > 0, F.length(text) - back - F.length(part) + 2).otherwise(0)


def selected_lines(lines: DataFrame, selections: DataFrame) -> DataFrame:
    """(page_id, selection, first_line, last_line) of selections (page_id, selection, selected) in lines (page_id, line_num, text).

    Both are reduced to words without marks and links. The first words of the
    selection are sought from the front of the page's words and the last ones
    from its end; the last line that begins at or before a hit holds it.
    Selections that are not found, or have no words, give no row.
    """
    order = Window.partitionBy("page_id").orderBy("line_num")
    words = F.array_join(selection_words(F.col("text")), " ")
    spoken = lines.select("page_id", "line_num", words.alias("words"))
    # A line without words begins where the next one does; others are joined by one blank.
    size = F.when(F.col("words") != "", F.length("words") + 1).otherwise(0)
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = spoken.withColumn("begin", F.greatest(before - 1, F.lit(0)))
    # A page's lines are one row; what they say is joined once a page, however many selections it has.
    pages = placed.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("line_num", "begin", "words"))).alias("rows"))
    all_words = F.array_join(F.transform(F.filter("rows", lambda r: r["words"] != ""), lambda r: r["words"]), " ")
    pages = pages.select("page_id", F.transform("rows", lambda r: F.struct(r["line_num"].alias("line_num"), r["begin"].alias("begin"))).alias("rows"), all_words.alias("all_words"))
    said = selection_words(F.col("selected"))
    head = F.array_join(F.slice(said, 1, ENDS), " ")
    tail = F.array_join(F.slice(said, F.greatest(F.size(said) - (ENDS - 1), F.lit(1)), ENDS), " ")
    joined = (
        selections.where(F.size(said) > 0)
        .select("page_id", "selection", head.alias("head"), tail.alias("tail"))
        .join(pages, "page_id")
        .withColumn("start", F.instr("all_words", F.col("head")))
        .withColumn("finish", F.when(F.col("head") == F.col("tail"), F.col("start")).otherwise(_last(F.col("all_words"), F.col("tail"))))
        .where("start > 0 and finish > 0")
    )
    line_at = lambda place: F.element_at(F.filter("rows", lambda r: r["begin"] <= place), -1)["line_num"]
    a, b = line_at(F.col("start") - 1), line_at(F.col("finish") - 1 + F.length("tail"))
    return joined.select("page_id", "selection", F.least(a, b).alias("first_line"), F.greatest(a, b).alias("last_line"))
