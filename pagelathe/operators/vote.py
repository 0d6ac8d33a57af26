"""Votes of several models on the ranges of a page.

Predictions are (page_id, model_idx, ranges); null ranges mean that the answer
could not be used, empty ones that nothing was found. The few models of a page
travel as one array, so a vote is one aggregation and a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import lines_ranges, range_lines, same_ranges
from ..functions.scores import iou


def answers(predictions: DataFrame, models: int = 3) -> DataFrame:
    """(page_id, a0, a1, ...): the ranges of each model by its index, null where it failed or is missing.

    Of repeated answers of one model the one that orders last counts.
    """
    picks = [F.max(F.when(F.col("model_idx") == i, F.array_sort("ranges"))).alias(f"a{i}") for i in range(models)]
    return predictions.where("page_id is not null").groupBy("page_id").agg(*picks)


def pairs(models: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(models) for j in range(i + 1, models)]


def _label(i: int) -> str:
    return chr(ord("A") + i)


def majority(table: DataFrame, models: int = 3) -> tuple[Column, Column]:
    """(ranges, label) of the first pair of models with the same ranges; null without one."""
    ranges = label = F.lit(None)
    for i, j in reversed(pairs(models)):
        agree = table[f"a{i}"].isNotNull() & table[f"a{j}"].isNotNull() & same_ranges(table[f"a{i}"], table[f"a{j}"])
        ranges = F.when(agree, table[f"a{i}"]).otherwise(ranges)
        label = F.when(agree, f"{_label(i)}+{_label(j)}").otherwise(label)
    return ranges, label


def closest_pair(table: DataFrame, models: int = 3) -> tuple[Column, Column, Column]:
    """(ranges, label, iou) of the pair with the largest agreement, of equal ones the first; the ranges are those of the union."""
    options = F.array(
        *[
            F.struct(
                iou(range_lines(table[f"a{i}"]), range_lines(table[f"a{j}"])).alias("iou"),
                F.lit(-n).alias("order"),
                F.lit(f"{_label(i)}|{_label(j)}").alias("label"),
                lines_ranges(F.array_union(range_lines(table[f"a{i}"]), range_lines(table[f"a{j}"]))).alias("ranges"),
            )
            for n, (i, j) in enumerate(pairs(models))
        ]
    )
    best = F.array_max(F.filter(options, lambda o: o["iou"].isNotNull()))
    return best["ranges"], best["label"], best["iou"]


def outcomes(predictions: DataFrame, models: int = 3) -> DataFrame:
    """(page_id, answered, outcome, label, ranges, validated): what a vote saves.

    Fewer than two usable answers: failed, nothing is saved. A majority is
    saved as validated; else the union of the closest pair, not validated.
    """
    table = answers(predictions, models)
    answered = sum((F.when(table[f"a{i}"].isNotNull(), 1).otherwise(0) for i in range(models)), F.lit(0))
    most, most_label = majority(table, models)
    near, near_label, _ = closest_pair(table, models)
    outcome = F.when(answered < 2, "failed").when(most.isNotNull(), "agreed").otherwise("merged")
    return table.select(
        "page_id",
        answered.alias("answered"),
        outcome.alias("outcome"),
        F.when(outcome == "agreed", most_label).when(outcome == "merged", near_label).alias("label"),
        F.when(outcome == "agreed", most).when(outcome == "merged", near).alias("ranges"),
        F.when(outcome != "failed", outcome == "agreed").alias("validated"),
    )


def agreement(predictions: DataFrame, truth: DataFrame, models: int = 3) -> DataFrame:
    """One row: pages agreed, merged and failed, mean agreement of each model and of the majority with the truth.

    `truth` has page_id and ranges; pages without truth are left out. Means skip failed answers.
    """
    table = answers(predictions, models).join(truth.select("page_id", F.col("ranges").alias("truth")), "page_id")
    most, _ = majority(table, models)
    count = sum((F.when(table[f"a{i}"].isNotNull(), 1).otherwise(0) for i in range(models)), F.lit(0))
    lines = range_lines(F.col("truth"))
    scored = table.select(
        (count < 2).alias("failed"), most.isNotNull().alias("agreed"), iou(range_lines(most), lines).alias("majority"), *[iou(range_lines(table[f"a{i}"]), lines).alias(f"m{i}") for i in range(models)]
    )
    return scored.agg(
        F.count("*").alias("pages"),
        F.count_if(F.expr("agreed and not failed")).alias("agreed"),
        F.count_if(F.expr("not agreed and not failed")).alias("merged"),
        F.count_if(F.col("failed")).alias("failed"),
        F.avg("majority").alias("majority_iou"),
        *[F.avg(f"m{i}").alias(f"iou_{_label(i).lower()}") for i in range(models)],
    )
