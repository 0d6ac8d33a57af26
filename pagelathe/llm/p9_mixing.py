"""Problem 9: mixing sources to target shares of the total size.

The total is the largest at which every source can hold its share exactly
within its repeats, so no source falls short unless a total is asked for. A
source's documents get the whole copies that are certain; of the fraction that
remains, Pareto order sampling draws documents with odds of inclusion that grow
with their size: ranked by random odds divided by the odds of inclusion, the
first ones that fill the source's size are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import bucketed_rank
from ..sources.tables import use_checkpoints
from .p8_encoding import RANK_FILE, token_counts

#: Parts that the documents of a source are ranked in.
BUCKETS = 1024
#: Up to so many sources the plan is broadcast; beyond it is joined by shuffle.
MOST_SOURCES = 10_000
#: A document of twice the size has 2 ** POWER times the odds of inclusion; 0 gives all of a source the same.
POWER = 0.5


def _uniform(seed: int) -> Column:
    """A number in (0, 1) that depends only on the document and the seed."""
    return (F.shiftrightunsigned(F.xxhash64("doc_id", "copy", F.lit(seed)), 11) + 0.5) / float(1 << 53)


def source_plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """Per source of `targets`: its tokens, target share, size to reach, and copies per document (a real number).

    `sizes` has doc_id, source and tokens. Sources without documents cannot be
    filled; the others then share the total in proportion to their targets. A
    null source, or one without target, gets nothing. Repeated targets of one
    source count once, the largest first; negative shares and repeats count as 0.
    """
    have = sizes.groupBy("source").agg(F.sum("tokens").cast("double").alias("tokens"), F.count("*").alias("documents"))
    wish = (
        targets.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.max(F.struct(F.greatest(F.col("target_share"), F.lit(0.0)).alias("share"), F.greatest(F.col("max_repeats"), F.lit(0)).alias("most"))).alias("t"))
        .select("source", F.coalesce("t.share", F.lit(0.0)).alias("target_share"), F.coalesce("t.most", F.lit(0)).alias("max_repeats"))
    )
    plan = wish.join(have, "source", "left").fillna({"tokens": 0.0, "documents": 0})
    usable = F.when((F.col("tokens") > 0) & (F.col("max_repeats") > 0), F.col("target_share")).otherwise(0.0)
    plan = plan.withColumn("usable", usable)
    all_shares, limit = plan.agg(
        F.sum("usable"), F.min(F.when(F.col("usable") > 0, F.col("tokens") * F.col("max_repeats") / F.col("usable")))
    ).first()
    if not all_shares:
        all_shares, reach = 1.0, 0.0
    else:
        reach = float(total) if total is not None else limit * all_shares
    goal = F.least(F.col("usable") * (reach / all_shares), F.col("tokens") * F.col("max_repeats"))
    return plan.withColumn("goal", goal).select(
        "source", "target_share", "max_repeats", "documents", "tokens", "goal", F.when(F.col("tokens") > 0, F.col("goal") / F.col("tokens")).otherwise(0.0).alias("copies")
    )


def _size_class(tokens: Column) -> Column:
    """Number of binary digits: documents of one class have the same odds of inclusion."""
    return F.length(F.bin(tokens)).cast("int")


def _weight(size_class: Column, power: float) -> Column:
    return F.pow(F.lit(2.0 ** power), size_class)


def mix(sizes: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 0, power: float = POWER) -> DataFrame:
    """(doc_id, source, tokens, copies) of the documents that are used at least once.

    `sizes` has doc_id, source and tokens and may repeat rows; each row is a
    document of its own only once per doc_id. Documents without tokens are not
    used. The boundary document of a source is taken if that brings the source
    nearer to its size. Ties of the random odds are settled by doc_id.
    """
    docs = sizes.where("source is not null and tokens > 0 and doc_id is not null").select("doc_id", "source", "tokens").dropDuplicates(["doc_id"])
    plan = source_plan(docs, targets, total).select("source", "max_repeats", "tokens", "goal", "copies")
    whole = F.floor(F.col("copies") + 1e-12).cast("int")
    plan = plan.withColumn("whole", whole).withColumn("chance", F.greatest(F.col("copies") - F.col("whole"), F.lit(0.0)))
    plan = plan.select("source", "whole", "chance", (F.col("goal") - F.col("whole") * F.col("tokens")).alias("rest"))
    weight = _weight(_size_class(F.col("tokens")), power)
    plan = plan.join(docs.groupBy("source").agg(F.avg(weight).alias("middle")), "source", "left")
    if plan.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES:
        plan = F.broadcast(plan)
    each = docs.join(plan, "source").withColumn("copy", F.col("whole"))
    u = _uniform(seed)
    # Random odds over odds of inclusion. These are a document's weight times a factor of the source, which does not
    # change the order; scaled by the mean weight instead, the keys are spread like the random numbers and fall into
    # even buckets as shares of 1.
    odds = (u / (1 - u)) / (weight / F.col("middle"))
    drawn = each.where("chance > 0 and rest > 0").withColumn("key", odds / (1 + odds))
    ranked = bucketed_rank(
        drawn, ["source"], F.struct("key", "doc_id"), F.floor(F.col("key") * BUCKETS), F.col("tokens")
    )
    extra = ranked.where(F.abs(F.col("upto") - F.col("rest")) <= F.abs(F.col("upto") - F.col("tokens") - F.col("rest"))).select("doc_id", F.lit(1).alias("one"))
    return (
        each.join(extra, "doc_id", "left")
        .select("doc_id", "source", "tokens", (F.col("whole") + F.coalesce("one", F.lit(0))).alias("copies"))
        .where("copies > 0")
    )


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: documents used, tokens with repeats, the most repeats, target and actual share.

    A source of which nothing was used has 0; shares are null if nothing was used at all.
    """
    used = selection.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies")
    )
    wish = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    # One row a source by now, at most MOST_SOURCES of them in a plan that is broadcast; one window sums them.
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    return wish.join(used, "source", "left").fillna(0, ["documents", "tokens", "most_copies"]).select(
        "source", "target_share", "max_repeats", "documents", "tokens", "most_copies", (F.col("tokens") / total).alias("actual_share")
    )


def sizes_of(documents: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """(doc_id, source, tokens), counted once and kept in the checkpoint folder, since mixing reads it several times."""
    use_checkpoints(documents.sparkSession)
    return token_counts(documents, rank_file).checkpoint()
