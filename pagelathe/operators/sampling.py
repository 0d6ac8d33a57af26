"""Bounded samples that depend on keys only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_hashes(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The `n` rows with the smallest hashes of `key`, all if there are fewer; of equal keys the smallest rows.

    Rows are counted first, and only those whose hash lies below half as much
    again as `n` rows need are sorted at all: what a task keeps and sends does
    not grow with the number of tasks. (Should hashes be so uneven that fewer
    than `n` lie there, those are the sample.) Rows without a key are left out.
    """
    rows = df.where(F.col(key).isNotNull())
    total = rows.count()
    part = min(1.0, (1.5 * n + 200) / max(total, 1))
    most = int(part * 2**64) - 2**63 - 1
    rank = F.xxhash64(key, F.lit(seed))
    return rows.where(rank <= F.lit(min(most, 2**63 - 1))).orderBy(rank, *df.columns).limit(n)
