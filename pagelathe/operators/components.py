"""Connected components of an edge list, without bringing it to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import use_checkpoints
from .skew import spread_join

#: Tasks that the edges of one node are dealt out over.
PARTS = 4


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b); component is the smallest node reachable.

    Large-star and small-star steps alternate until no edge changes: the number
    of rounds grows with the logarithm of the number of nodes, and the number
    of edges never grows. Each round ends in a checkpoint, so lineage stays
    short and a lost executor costs one round. The edges of a hub, which every
    round leaves, are dealt out over several tasks. Null ends and self-loops are
    ignored, except that a self-loop makes its node known. Raises RuntimeError
    if `most_rounds` rounds do not suffice.
    """
    spark = edges.sparkSession
    use_checkpoints(spark)
    known = edges.where("a is not null and b is not null").select("a", "b").distinct().checkpoint()
    links = known.where("a <> b")
    before = None
    for _ in range(most_rounds):
        # Large star: every larger neighbour is tied to the smallest node around.
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = spread_join(both.where("b > a"), least, ["a"], ["b"], parts=PARTS).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours are tied to the smallest of them.
        down = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            spread_join(down, low, ["a"], ["b"], parts=PARTS)
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = small.checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"the components are not stable after {most_rounds} rounds")
    nodes = known.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("component")
    )
