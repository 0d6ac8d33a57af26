"""Named ways to predict the lines of a page's content, and resuming where a run stopped.

A predictor takes lines (page_id, line_num, ...) and gives (page_id, found):
an array of line numbers, or null where it failed on a page.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import json_ranges
from ..functions.scores import iou, precision, recall

Predictor = Callable[[DataFrame], DataFrame]
PREDICTORS: dict[str, Predictor] = {}


def predictor(name: str) -> Callable[[Predictor], Predictor]:
    """Register a predictor under a name."""

    def register(f: Predictor) -> Predictor:
        PREDICTORS[name] = f
        return f

    return register


@predictor("long_lines")
def long_lines(lines: DataFrame, least: int = 40, most_links: float = 0.5) -> DataFrame:
    """Lines of some length that are not mostly links; needs text_length and link_ratio."""
    good = F.when((F.col("text_length") >= least) & (F.col("link_ratio") < most_links), F.col("line_num"))
    return lines.groupBy("page_id").agg(F.array_sort(F.collect_list(good)).alias("found"))


@predictor("largest_block")
def largest_block(lines: DataFrame) -> DataFrame:
    """The block with more than half of the page's text, if there is one; needs content_region_ratio."""
    return lines.groupBy("page_id").agg(F.array_sort(F.collect_list(F.when(F.col("content_region_ratio") == 1, F.col("line_num")))).alias("found"))


def compare(lines: DataFrame, truth: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(method, page_id, iou, precision, recall) of the named predictors, by default all, against truth (page_id, truth)."""
    parts = [PREDICTORS[n](lines).select(F.lit(n).alias("method"), "page_id", "found") for n in (names or sorted(PREDICTORS))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    f, t = F.col("found"), F.col("truth")
    return rows.join(truth.select("page_id", "truth"), "page_id").select(
        "method", "page_id", iou(f, t).alias("iou"), precision(f, t).alias("precision"), recall(f, t).alias("recall")
    )


def answers(pages: DataFrame, ask: Callable[[str, int], str | None], models: int = 3) -> DataFrame:
    """(page_id, model_idx, response, ranges): what `ask(markdown, model_idx)` says of pages (page_id, markdown), asked on the executors.

    An answer that fails or cannot be read has null ranges; whatever `ask`
    raises fails that answer only. Pages with null markdown are not asked about.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, markdown in zip(frame["page_id"], frame["markdown"]):
                for model in range(models):
                    try:
                        rows.append((page, model, ask(markdown, model)))
                    except Exception:
                        rows.append((page, model, None))
            yield pd.DataFrame(rows, columns=["page_id", "model_idx", "response"])

    asked = pages.where("markdown is not null").select("page_id", "markdown").mapInPandas(run, "page_id bigint, model_idx int, response string")
    return asked.withColumn("ranges", json_ranges(F.col("response")))


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a run that was stopped has still to do: rows whose key has no result yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def random_subsets(spark: SparkSession, features: int, trials: int = 400, sizes: tuple[int, int] = (15, 45), seed: int = 2026) -> DataFrame:
    """(trial, mask): `trials` seeded random subsets of features, their sizes drawn from a range; small by its arguments."""
    r = random.Random(seed)
    rows = []
    for trial in range(trials):
        chosen = set(r.sample(range(features), min(features, r.randint(*sizes))))
        rows.append((trial, [int(i in chosen) for i in range(features)]))
    return spark.createDataFrame(rows, "trial int, mask array<int>")
