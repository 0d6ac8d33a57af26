"""Numbers about features, metrics and feature subsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import iou


def normalisation(features: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std): population statistics; a deviation of 0 becomes 1 so that dividing by it is safe."""
    stats = features.agg(*[x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in columns])
    return stats.select(F.inline(rows)).withColumn("std", F.when(F.col("std") == 0, 1.0).otherwise(F.col("std")))


def normalised(features: DataFrame, columns: list[str], keys: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """`keys` and z-scores of `columns`, with the statistics of `fit_on`, by default of the table itself."""
    source = fit_on if fit_on is not None else features
    stats = source.agg(*[x for c in columns for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    z = lambda c: (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)
    return features.select(*keys, *[z(c).alias(c) for c in columns])


def class_weight(labels: DataFrame) -> DataFrame:
    """One row (rows, positives, weight): negatives per positive; null without positives."""
    return labels.agg(F.count("*").alias("rows"), F.sum("label").alias("positives")).withColumn(
        "weight", F.when(F.col("positives") > 0, (F.col("rows") - F.col("positives")) / F.col("positives"))
    )


def metric_summary(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Means and deviation of iou, precision and recall over pages that have them, and how many are bad, good and perfect."""
    aggs = [
        F.count("*").alias("pages"),
        F.count("iou").alias("scored"),
        F.avg("iou").alias("mean_iou"),
        F.stddev_pop("iou").alias("std_iou"),
        F.avg("precision").alias("mean_precision"),
        F.avg("recall").alias("mean_recall"),
        F.count_if(F.col("iou") < 0.5).alias("bad"),
        F.count_if(F.col("iou") > 0.9).alias("good"),
        F.count_if(F.col("iou") == 1.0).alias("perfect"),
    ]
    return metrics.groupBy(*by).agg(*aggs) if by else metrics.agg(*aggs)


def worst(metrics: DataFrame, k: int = 10) -> DataFrame:
    """The `k` pages with the lowest iou; ties by page_id, pages without iou are left out."""
    return metrics.where("iou is not null").orderBy("iou", "page_id").limit(k)


def span_agreement(rows: DataFrame) -> DataFrame:
    """(page_id, iou) of predicted and true rows weighted by the lines they span; `rows` has page_id, span_lines, predicted, truth.

    Spans of a page do not overlap, so they are summed without being unrolled. A page with neither has 1.
    """
    both = F.sum(F.when((F.col("predicted") == 1) & (F.col("truth") == 1), F.col("span_lines")).otherwise(0))
    either = F.sum(F.when((F.col("predicted") == 1) | (F.col("truth") == 1), F.col("span_lines")).otherwise(0))
    return rows.groupBy("page_id").agg(F.when(either > 0, both / either).otherwise(1.0).alias("iou"))


def thresholded(rows: DataFrame, probability: str = "probability", cut: float = 0.5) -> DataFrame:
    return rows.withColumn("predicted", F.when(F.col(probability) >= cut, 1).otherwise(0))


def marginal(trials: DataFrame) -> DataFrame:
    """(feature, with_n, gain): mean score of trials that use a feature less that of the others; `trials` has mask and score.

    A feature that all or no trials use has a null gain.
    """
    flat = trials.select("score", F.posexplode("mask").alias("feature", "used"))
    mean = lambda u: F.avg(F.when(F.col("used") == u, F.col("score")))
    return flat.groupBy("feature").agg(F.sum("used").alias("with_n"), (mean(1) - mean(0)).alias("gain"))


def synergy(trials: DataFrame, least: int = 10) -> DataFrame:
    """(f, g, synergy) for f < g: score of both less each alone plus neither, with at least `least` trials in all four.

    `trials` has trial, mask and score. The pairs are formed within a trial's
    mask, whose length is fixed, and summed before the shuffle.
    """
    used = lambda i: F.element_at("mask", i + 1)
    n = F.size("mask")
    places = F.flatten(
        F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: F.struct(i.alias("f"), j.alias("g"))))
    )
    flat = trials.where(n >= 2).select("mask", "score", F.explode(places).alias("p")).select(
        F.col("p.f").alias("f"), F.col("p.g").alias("g"), "score", (used(F.col("p.f")) * 2 + used(F.col("p.g"))).alias("quadrant")
    )
    part = lambda q: F.avg(F.when(F.col("quadrant") == q, F.col("score")))
    size = lambda q: F.count_if(F.col("quadrant") == q)
    summed = flat.groupBy("f", "g").agg((part(3) - part(2) - part(1) + part(0)).alias("synergy"), F.least(*[size(q) for q in range(4)]).alias("__least"))
    return summed.where(F.col("__least") >= least).drop("__least")


def feature_frequency(trials: DataFrame) -> DataFrame:
    """(feature, n, share) over trials with different masks; of repeated masks the first trial counts."""
    first = Window.partitionBy("mask").orderBy("trial")
    once = trials.withColumn("__row", F.row_number().over(first)).where("__row = 1")
    total = once.agg(F.count("*")).first()[0]
    flat = once.select(F.posexplode("mask").alias("feature", "used"))
    return flat.groupBy("feature").agg(F.sum("used").alias("n")).withColumn("share", F.col("n") / F.lit(float(max(total, 1))))


def shuffled_within_pages(rows: DataFrame, column: str, seed: int = 0) -> DataFrame:
    """`rows` (page_id, line_num, ...) with the values of one column dealt out anew within each page, for permutation importance."""
    by_line = Window.partitionBy("page_id").orderBy("line_num")
    by_hash = Window.partitionBy("page_id").orderBy(F.xxhash64("page_id", "line_num", F.lit(seed)), "line_num")
    values = rows.select("page_id", F.col(column).alias("__value"), F.row_number().over(by_hash).alias("__row"))
    return rows.withColumn("__row", F.row_number().over(by_line)).drop(column).join(values, ["page_id", "__row"]).drop("__row").withColumnRenamed("__value", column)


def link_runs(lines: DataFrame, least: int = 3) -> DataFrame:
    """(page_id, first_line, lines, links) of contiguous runs of at least `least` lines that hold only links.

    `lines` has page_id, line_num, label_group, link_only and links; a change of label_group ends a run.
    """
    order = Window.partitionBy("page_id").orderBy("line_num")
    broken = F.when(
        (F.col("link_only") == 1) & (F.lag("link_only").over(order) == 1) & F.col("label_group").eqNullSafe(F.lag("label_group").over(order)), 0
    ).otherwise(1)
    runs = lines.withColumn("__new", broken).withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        runs.where("link_only = 1")
        .groupBy("page_id", "__run")
        .agg(F.min("line_num").alias("first_line"), F.count("*").alias("lines"), F.sum("links").alias("links"))
        .where(F.col("lines") >= least)
        .drop("__run")
    )


def permutation_importance(rows: DataFrame, columns: list[str], found: Callable[[DataFrame], DataFrame], truth: DataFrame, seed: int = 0) -> DataFrame:
    """(feature, score, drop): mean agreement of a predictor with each column shuffled within pages, and how far it falls.

    `found(rows)` gives (page_id, found), arrays of line numbers; `truth` has
    page_id and truth. The row of a null feature holds the score of the rows as
    they are. One pass for each column, all summed up by page before anything
    is compared.
    """

    def mean(kind: DataFrame, name: str | None) -> DataFrame:
        met = found(kind).join(truth, "page_id")
        return met.agg(F.avg(iou(F.col("found"), F.col("truth"))).alias("score")).select(F.lit(name).cast("string").alias("feature"), "score")

    base = mean(rows, None)
    out = base
    for i, c in enumerate(columns):
        out = out.union(mean(shuffled_within_pages(rows, c, seed + i), c))
    plain = base.first()["score"]
    return out.withColumn("drop", F.lit(plain) - F.col("score"))


def extreme_pairs(pairs: DataFrame, k: int = 15) -> DataFrame:
    """(end, f, g, synergy): the `k` pairs of `synergy` that gain most and the `k` that lose most; ties by f and g."""
    top = pairs.orderBy(F.desc("synergy"), "f", "g").limit(k).select(F.lit("top").alias("end"), "f", "g", "synergy")
    return top.union(pairs.orderBy("synergy", "f", "g").limit(k).select(F.lit("bottom").alias("end"), "f", "g", "synergy"))


def linear_scores(rows: DataFrame, weights: dict[str, float], bias: float = 0.0) -> DataFrame:
    """`rows` with logit and probability of a linear model over feature columns; null features count as 0."""
    logit = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()), F.lit(float(bias)))
    return rows.withColumn("logit", logit).withColumn("probability", 1 / (1 + F.exp(-F.col("logit"))))


def soft_loss(rows: DataFrame, weight: float = 1.0) -> DataFrame:
    """One row (bce, iou_loss, loss) of rows with page_id, logit and truth (0 or 1).

    Cross-entropy, content lines weighing `weight` times as much, averaged over
    rows, and 1 less the pages' mean of the smoothed overlap of probabilities
    with the truth.
    """
    x, y = F.col("logit"), F.col("truth").cast("double")
    p = 1 / (1 + F.exp(-x))
    each = (F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))) * F.when(y == 1, weight).otherwise(1.0)
    pages = rows.groupBy("page_id").agg(F.sum(each).alias("bce"), F.count("*").alias("n"), F.sum(p * y).alias("both"), F.sum(p + y - p * y).alias("either"))
    out = pages.agg((F.sum("bce") / F.sum("n")).alias("bce"), (1 - F.avg((F.col("both") + 1) / (F.col("either") + 1))).alias("iou_loss"))
    return out.withColumn("loss", F.col("bce") + F.col("iou_loss"))


def keyword_lines(lines: DataFrame, documents: DataFrame, least: float = 0.5) -> DataFrame:
    """(page_id, line_num, share): lines of which at least a part of the keywords stands in the page's document.

    `lines` has page_id, line_num and kw, `documents` page_id and kw (arrays of
    different words); lines without keywords are never found.
    """
    doc = documents.select("page_id", F.col("kw").alias("doc_kw"))
    share = F.size(F.array_intersect("kw", "doc_kw")) / F.size("kw")
    return lines.where(F.size("kw") > 0).join(doc, "page_id").select("page_id", "line_num", share.alias("share")).where(F.col("share") >= least)


def keyword_confusion(lines: DataFrame) -> DataFrame:
    """(page_id, tp, fp, fn): keywords on lines found rightly, found wrongly and missed; `lines` has keywords, predicted, truth."""
    total = lambda p, t: F.sum(F.when((F.col("predicted") == p) & (F.col("truth") == t), F.col("keywords")).otherwise(0))
    return lines.groupBy("page_id").agg(total(1, 1).alias("tp"), total(1, 0).alias("fp"), total(0, 1).alias("fn"))
