"""Current rows: of several rows with one key, the latest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, at: str, columns: list[str] | None = None) -> DataFrame:
    """One row per `key`: the one with the largest `at`; a null `at` is the earliest.

    Equal rows count once. Of rows that differ and share the latest time, the
    one whose remaining columns are largest in their order counts, so the
    result does not depend on how the rows are stored. Rows without a key are
    left out. One shuffle, with partial aggregation before it.
    """
    rest = [c for c in (columns or df.columns) if c not in (key, at)]
    best: Column = F.max(F.struct(at, *rest))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(best.alias("__best"))
        .select(key, *[F.col("__best")[c].alias(c) for c in (at, *rest)])
    )
