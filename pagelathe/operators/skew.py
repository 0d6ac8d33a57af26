"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt out over.
PARTS = 8


def spread_join(rows: DataFrame, lookup: DataFrame, on: list[str], by: list[str], how: str = "inner", parts: int = PARTS) -> DataFrame:
    """`rows` joined with `lookup` on `on`, the rows of a key dealt out over `parts` tasks by a hash of `by`.

    `lookup` is repeated `parts` times, so it should be the far smaller side:
    one row a key, or only the keys that matter. `by` should tell the rows of a
    key apart. `how` is inner, left, left_semi or left_anti. Nothing is
    gathered, and the result is that of a plain join.
    """
    part = F.pmod(F.xxhash64(*by, F.lit(71)), F.lit(parts)).cast("int")
    copies = lookup.withColumn("__part", F.explode(F.array(*map(F.lit, range(parts)))))
    return rows.withColumn("__part", part).join(copies, [*on, "__part"], how).drop("__part")


#: Keys that are broadcast at most: 16 MB of numbers.
MOST_KEYS = 1_000_000


def sifted(rows: DataFrame, keys: DataFrame, on: str, most: int = MOST_KEYS) -> DataFrame:
    """`rows` without those whose key is none of `keys`, if these are at most `most`; else `rows` as they are.

    For wide rows that should not be shuffled: the keys are counted and then
    broadcast. Beyond the bound the narrower results are to be joined instead,
    which the caller does in any case.
    """
    known = keys.select(on).distinct()
    return rows.join(F.broadcast(known), on, "left_semi") if known.limit(most + 1).count() <= most else rows
