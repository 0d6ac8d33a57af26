"""Pairs of sets that may be similar enough, exactly: joined on the rarer of the elements that they share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Runs that stand in more pairs of sets are common; the commonest of them, at most MOST_COMMON (8 MB), are put first
#: in the order of runs. Which ones these are changes what has to be compared, never the result.
COMMON, MOST_COMMON = 1, 1_000_000


def common_runs(left: DataFrame, right: DataFrame, column: str = "runs") -> np.ndarray:
    """The commonest elements of both sides, the commonest first; counted with partial sums, and bounded before they reach the driver."""
    flat = lambda df, side: df.select(F.lit(side).alias("side"), F.explode(column).alias("run"))
    counts = flat(left, 0).union(flat(right, 1)).groupBy("run").agg(F.sum(1 - F.col("side")).alias("in_left"), F.sum("side").alias("in_right"))
    many = counts.select("run", (F.col("in_left") * F.col("in_right")).alias("n")).where(F.col("n") > COMMON)
    return np.asarray(many.orderBy(F.desc("n"), "run").limit(MOST_COMMON).select("run").toArrow()["run"], np.int64)


_TAIL = pa.schema([pa.field("key", pa.int64()), pa.field("run", pa.int64()), pa.field("size", pa.int64()), pa.field("place", pa.int64())])


def tails(sets: DataFrame, common: np.ndarray, least: float, column: str = "runs", weigh: Callable[[np.ndarray], np.ndarray] = np.ones_like) -> DataFrame:
    """(key, run, size, place) of the elements of each set (key, `column`) that stand at the part `least` of it or behind.

    The elements of all sets are in one order: common ones first, the others by
    their numbers. `place` is the weight up to and with an element, `size` that
    of the whole set.
    """
    shared = sets.sparkSession.sparkContext.broadcast((np.sort(common), np.argsort(common)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            keys = np.asarray(batch.column("key"), np.int64)
            flat = np.asarray(batch.column(column).flatten(), np.int64)
            counts = np.asarray(batch.column(column).value_lengths().fill_null(0), np.int64)
            own = np.repeat(np.arange(len(counts)), counts)
            first = np.full(len(flat), len(known), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                first = np.where(known[at] == flat, rank[at], first)
            flat = flat[np.lexsort((flat, first, own))]
            upto = np.concatenate(([0], np.cumsum(weigh(flat))))
            end = np.cumsum(counts)
            before, size = np.repeat(upto[end - counts], counts), np.repeat(upto[end] - upto[end - counts], counts)
            place = upto[1:] - before
            kept = place >= least * size
            yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (keys[own], flat, size, place)], schema=_TAIL)

    return sets.select("key", column).mapInArrow(run, "key bigint, run bigint, size bigint, place bigint")


def joined_tails(left: DataFrame, right: DataFrame, least: float, column: str = "runs", weigh: Callable[[np.ndarray], np.ndarray] = np.ones_like) -> DataFrame:
    """(run, a, b, size_a, size_b, place_a, place_b): the sets of both sides whose tails share an element, a row for each of these."""
    common = common_runs(left, right, column)
    side = lambda df, x: tails(df, common, least, column, weigh).select("run", F.col("key").alias(x), F.col("size").alias(f"size_{x}"), F.col("place").alias(f"place_{x}"))
    return side(left, "a").join(side(right, "b"), "run")


def candidates(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of a left and a right set, by key, among which are all of a similarity of at least `least`.

    Both sides have key and runs, an array of different numbers. Of such a pair
    each set has at least the part `least` of its runs in common with the
    other. With the runs of all sets in one order, the last run that a pair
    shares stands no earlier than the others it shares, so at that part of
    either set or behind. Only runs that stand there are joined on: phrases
    that everything shares come first and pair nothing, and no pair is lost.
    Nor does a run pair sets that cannot be similar enough if it is the last
    they share, for then they share no more runs than stand up to it in either.
    Sets that are equal should be one on each side before this is called.
    """
    most = F.least("place_a", "place_b")
    return joined_tails(left, right, least).where(most / (F.col("size_a") + F.col("size_b") - most) >= least).select("a", "b").distinct()
