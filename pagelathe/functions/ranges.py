"""Line ranges (start, end), both inclusive, and sets of line numbers.

Arrays of ranges are array<struct<start int, end int>>. A null array stands for
a failed answer and stays null; an empty array stands for no lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "struct<start:int,end:int>"
MOST_RANGES = 500


def range_lines(ranges: Column) -> Column:
    """The different lines of all ranges, ascending; reversed ranges and null ends give none."""
    good = F.filter(ranges, lambda r: r["start"] <= r["end"])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(good, lambda r: F.sequence(r["start"], r["end"])))))


def lines_ranges(lines: Column) -> Column:
    """The maximal contiguous ranges of an array of line numbers, ascending; repeats count once, nulls are ignored."""
    ordered = F.array_sort(F.array_distinct(F.filter(lines, lambda x: x.isNotNull())))
    empty = F.array().cast(f"array<{RANGE}>")

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), x.cast("int").alias("end")))
        )
        fresh = F.concat(done, F.array(F.struct(x.cast("int").alias("start"), x.cast("int").alias("end"))))
        return F.when((F.size(done) > 0) & (last["end"] == x - 1), longer).otherwise(fresh)

    return F.when(lines.isNotNull(), F.aggregate(ordered, empty, step))


def islands(lines: DataFrame, keys: list[str], line: str = "line_num") -> DataFrame:
    """Ranges (keys, start, end) of the rows' line numbers: the relational form of `lines_ranges`."""
    order = Window.partitionBy(*keys).orderBy(line)
    marked = lines.select(*keys, line).where(F.col(line).isNotNull()).distinct().withColumn("__run", F.col(line) - F.row_number().over(order))
    return marked.groupBy(*keys, "__run").agg(F.min(line).alias("start"), F.max(line).alias("end")).drop("__run")


def same_ranges(a: Column, b: Column) -> Column:
    """Whether two arrays hold the same ranges, in any order."""
    return F.array_sort(a) == F.array_sort(b)


def overlaps(ranges: Column, first: Column, last: Column) -> Column:
    """1 if the lines from first to last touch a range; missing ends count as 0, a null array has no ranges."""
    hit = F.exists(ranges, lambda r: (last >= F.coalesce(r["start"], F.lit(0))) & (first <= F.coalesce(r["end"], F.lit(0))))
    return F.when(hit, 1).otherwise(0)


def conflicts(ranges: Column, start: Column, end: Column) -> Column:
    """The ranges that a new one from start to end would touch."""
    return F.filter(ranges, lambda r: (start <= r["end"]) & (end >= r["start"]))


def boundary(ranges: Column, line: Column) -> Column:
    """The first range that starts or ends at a line; null without one."""
    return F.try_element_at(F.filter(ranges, lambda r: (r["start"] == line) | (r["end"] == line)), F.lit(1))


def valid_strict(ranges: Column, last: Column) -> Column:
    """Ranges clamped to the last line; null for all if one is malformed or there are too many.

    Ranges that begin behind the last line are dropped.
    """
    bad = F.exists(ranges, lambda r: r["start"].isNull() | r["end"].isNull() | (r["start"] < 1) | (r["start"] > r["end"]))
    kept = F.transform(
        F.filter(ranges, lambda r: r["start"] <= last), lambda r: F.struct(r["start"].alias("start"), F.least(r["end"], last).alias("end"))
    )
    return F.when(ranges.isNotNull() & ~bad & (F.size(ranges) <= MOST_RANGES), kept)


def valid_lenient(ranges: Column, last: Column) -> Column:
    """The ranges that are well formed and lie within the page."""
    return F.filter(ranges, lambda r: (r["start"] >= 1) & (r["start"] <= r["end"]) & (r["end"] <= last))


def acceptable(ranges: Column, source: Column) -> Column:
    """Whether an annotation may be saved: well-formed ranges, not too many, and a known source."""
    return (
        ranges.isNotNull()
        & (F.size(ranges) <= MOST_RANGES)
        & F.forall(ranges, lambda r: (r["start"] >= 1) & (r["end"] >= 1) & (r["start"] <= r["end"]))
        & source.isin("manual", "llm")
    )


def compact(ranges: Column, empty: str | None = "1:1") -> Column:
    """start:end,start:end; an empty array is written as `empty` (None: as an empty text)."""
    text = F.array_join(F.transform(ranges, lambda r: F.concat_ws(":", r["start"], r["end"])), ",")
    return F.when(F.size(ranges) > 0, text).otherwise(F.when(ranges.isNotNull(), F.lit(empty or "")))


def parse_compact(text: Column, last: Column) -> Column:
    """Ranges of a compact text that lie within the page; an empty text has none, a malformed one is null."""
    parts = F.split(F.trim(text), ",")
    pairs = F.transform(
        parts,
        lambda p: F.struct(F.split_part(p, F.lit(":"), F.lit(1)).try_cast("int").alias("start"), F.split_part(p, F.lit(":"), F.lit(2)).try_cast("int").alias("end")),
    )
    good = F.forall(parts, lambda p: F.trim(p).rlike(r"^[0-9]+:[0-9]+$"))
    return F.when(F.trim(text) == "", F.array().cast(f"array<{RANGE}>")).when(good, valid_lenient(pairs, last))


def shown(ranges: Column) -> Column:
    """Ranges for a table cell: start-end, at most 15 characters; N/A for null."""
    text = F.concat(F.lit("["), F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["start"], r["end"])), ", "), F.lit("]"))
    text = F.when(F.size(ranges) == 0, F.lit("[]")).otherwise(F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["start"], r["end"])), ", "))
    return F.when(ranges.isNull(), "N/A").when(F.length(text) > 15, F.concat(F.substring(text, 1, 12), F.lit("..."))).otherwise(text)


def moved(ranges: DataFrame, last_line: str) -> DataFrame:
    """Bounds for dragging: per range (page_id, start, end) the lowest start and highest end its neighbours allow.

    Ranges of a page must not overlap. A start may move up to its own end and a
    range may not go behind the page's last line.
    """
    order = Window.partitionBy("page_id").orderBy("start", "end")
    return ranges.withColumn("lowest_start", F.coalesce(F.lag("end").over(order), F.lit(0)) + 1).withColumn(
        "highest_end", F.coalesce(F.lead("start").over(order) - 1, F.col(last_line))
    )


def ranges_json(ranges: Column) -> Column:
    """Ranges as JSON text with a blank behind colons and commas; null for null."""
    one = lambda r: F.format_string('{"start": %s, "end": %s}', F.coalesce(r["start"].cast("string"), F.lit("null")), F.coalesce(r["end"].cast("string"), F.lit("null")))
    return F.when(ranges.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(ranges, one), ", "), F.lit("]")))
