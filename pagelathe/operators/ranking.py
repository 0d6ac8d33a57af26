"""Ranks and running sums over groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_rank(df: DataFrame, keys: list[str], order: Column, bucket: Column, weight: Column | None = None) -> DataFrame:
    """`df` with the column rank: its place from 1 by `order` within `keys`; with `weight`, also the running sum `upto`.

    `bucket` is a whole number that never falls along `order`. Buckets are
    counted first and only rows of one bucket meet in a task, so a group may be
    as large as it likes. A null weight counts as 0.
    """
    amount = F.coalesce(weight if weight is not None else F.lit(0), F.lit(0))
    tagged = df.withColumn("__bucket", bucket).withColumn("__amount", amount)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, "__bucket")
        .agg(F.count("*").alias("__n"), F.sum("__amount").alias("__sum"))
        .select(
            *keys,
            "__bucket",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
            F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__below"),
        )
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order)
    ranked = tagged.withColumn("__row", F.row_number().over(inside)).withColumn(
        "__run", F.sum("__amount").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    out = ranked.join(offsets, [*keys, "__bucket"]).withColumn("rank", F.col("__before") + F.col("__row"))
    if weight is not None:
        out = out.withColumn("upto", F.col("__below") + F.col("__run"))
    return out.drop("__bucket", "__amount", "__row", "__run", "__before", "__below")
