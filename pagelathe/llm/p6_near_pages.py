"""Problem 6: pages whose main bodies differ only by small edits.

MinHash LSH forest: every body has a signature that is cut into trees. A tree
sorts the bodies by its part of the signature, so bodies that share a prefix
lie together, and how long a prefix two bodies share in some tree says how
early they meet. Pairs with the longest prefixes are verified first, on their
whole sets of word runs; prefixes are then shortened until the pairs found so
far tell that the target recall is reached. Where a short prefix is shared by
very many bodies, those are paired exactly by their rare runs instead.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.skew import spread_join
from ..sources.tables import use_checkpoints
from . import shingles
from .page_model import PageModel, body_lines
from .pages import walked
from .rare_runs import candidates
from .residue_model import with_residue

#: Words of a run, and the share of runs that a pair must have in common.
RUN, LEAST_SIMILARITY = 3, 0.6
#: Trees of the forest, the longest prefix in minima, and the recall that shortening must reach.
TREES, LONGEST, RECALL = 40, 4, 0.9999
#: A prefix that more bodies share is too common to pair them; they are paired by their rare runs.
MOST_IN_BUCKET = 100
#: A candidate is set aside without its sets being read if so few minima agree
#: that a pair of the least similarity would do so once in a hundred million.
DOUBT = 1e-8


def chance(similarity: float, length: int, trees: int = TREES) -> float:
    """Probability that a pair of this similarity shares a prefix of this length in some tree."""
    return 1 - (1 - similarity**length) ** trees


def shortest_prefix(similarity: float, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix at which even a pair of just this similarity meets with the wanted probability."""
    length = longest
    while length > 1 and chance(similarity, length, trees) < recall:
        length -= 1
    return length


def least_agreement(similarity: float, count: int, doubt: float = DOUBT) -> int:
    """How many of `count` minima agree at least in a pair of this similarity, but for a chance of `doubt`."""
    total = 0.0
    for k in range(count + 1):
        total += comb(count, k) * similarity**k * (1 - similarity) ** (count - k)
        if total > doubt:
            return k
    return count


_FIELDS = pa.schema([pa.field("body", pa.int64()), pa.field("runs", pa.list_(pa.int64())), pa.field("signature", pa.binary())])


def _body_sets(model: PageModel) -> Callable:
    none = {"body": None, "runs": None, "signature": None}

    def result(html, items, lines, scores) -> dict:
        kept = set(body_lines(lines, scores, model.cost))
        text = "\n".join([item[3] + item[2] for number, item, _, _ in lines if number in kept])
        runs = np.unique(shingles.run_hashes(shingles.word_hashes(shingles.words_of(text)), RUN))
        if not len(runs):
            return none
        minima = shingles.signature(runs, TREES * LONGEST).astype("<u4").view("<u2")[::2]
        return {"body": shingles.set_hash(runs), "runs": runs.astype(np.int64), "signature": minima.tobytes()}

    return result


def body_sets(pages: DataFrame, annotations: DataFrame, model: PageModel | None) -> tuple[DataFrame, DataFrame]:
    """(bodies, sets): bodies (page_id, body, mark, signature) of the current successful pages with a main body that is no residue, and runs (page_id, runs).

    `body` and `mark` are two hashes of the whole set of runs. The signature
    has LONGEST minima for each tree, of which the lower 16 bits are kept.
    Bodies of fewer than RUN words have no runs and are left out: they are
    similar to nothing. The second table has all pages, so it is to be joined.
    """
    model = model if model is not None else PageModel()
    done = walked(pages, annotations, model, _FIELDS, _body_sets, keep=True)
    own = done.where("status = 'success' and runs is not null").withColumn("mark", F.xxhash64("runs")).drop("runs", "scraped_at", "status")
    bodies = with_residue(own, model.residue).where("not residue").select("page_id", "body", "mark", "signature")
    return bodies, done.select("page_id", "runs")


_ENTRY = pa.schema([pa.field("key", pa.int64()), pa.field("node", pa.int64()), pa.field("rest", pa.int64())])


def forest(sets: DataFrame, shortest: int) -> DataFrame:
    """(key, node, rest): for every body and tree the node at depth `shortest`, and the minima below it, the first one highest.

    `sets` has key and signature.
    """
    power = shingles.mix(np.arange(1, shortest + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            labels = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(n, TREES, LONGEST).astype(np.uint64)
            top = shingles.mix(labels[:, :, :shortest] + np.uint64(1)) * power
            node = shingles.mix(top.sum(axis=2, dtype=np.uint64) + np.arange(TREES, dtype=np.uint64))
            rest = np.zeros((n, TREES), np.uint64)
            for i in range(shortest, LONGEST):
                rest = (rest << np.uint64(16)) | labels[:, :, i]
            keys = np.repeat(np.asarray(batch.column("key"), np.int64), TREES)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(node.ravel().astype(np.int64)), pa.array(rest.ravel().astype(np.int64))], schema=_ENTRY)

    return sets.select("key", "signature").mapInArrow(run, "key bigint, node bigint, rest bigint")


def meetings(sets: DataFrame, shortest: int, most: int = MOST_IN_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(pairs, busy): pairs (a, b, depth), a < b, that share a node of at most `most` bodies, and the keys in larger nodes.

    `depth` is the longest prefix that a pair shares in some tree.
    """
    entries = shared = forest(sets, shortest)
    large = entries.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > most).select("node").checkpoint()
    busy = sets.sparkSession.createDataFrame([], "key bigint")
    if large.take(1):
        busy = spread_join(entries, large, ["node"], ["key"], "left_semi").select("key").distinct()
        shared = spread_join(entries, large, ["node"], ["key"], "left_anti")
    depth = F.lit(shortest)
    for i in range(shortest, LONGEST):
        # The minima from the node down to this one are equal: nothing is left of their difference.
        depth = F.when(F.shiftrightunsigned(F.col("ra").bitwiseXOR(F.col("rb")), 16 * (LONGEST - 1 - i)) == 0, i + 1).otherwise(depth)
    pairs = (
        shared.select(F.col("key").alias("a"), "node", F.col("rest").alias("ra"))
        .join(shared.select(F.col("key").alias("b"), "node", F.col("rest").alias("rb")), "node")
        .where("a < b")
        .groupBy("a", "b")
        .agg(F.max(depth).alias("depth"))
    )
    return pairs, busy


def likely(pairs: DataFrame, signatures: DataFrame, agree: int) -> DataFrame:
    """The pairs (a, b, depth) of whose minima at least `agree` are equal."""
    signed = lambda name: signatures.select(F.col("key").alias(name), F.col("signature").alias(f"s{name}"))
    return pairs.join(signed("a"), "a").join(signed("b"), "b").mapInArrow(_agreeing(agree), "a bigint, b bigint, depth int")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) whose whole sets are at least so similar."""
    own = lambda name: sets.select(F.col("key").alias(name), F.col("runs").alias(f"r{name}"))
    common = F.size(F.array_intersect("ra", "rb"))
    return (
        pairs.select("a", "b")
        .join(own("a"), "a")
        .join(own("b"), "b")
        .select("a", "b", (common / (F.size("ra") + F.size("rb") - common)).alias("similarity"))
        .where(F.col("similarity") >= least)
    )


def _agreeing(agree: int):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                a = np.frombuffer(b"".join(batch.column("sa").to_pylist()), "<u2").reshape(n, -1)
                b = np.frombuffer(b"".join(batch.column("sb").to_pylist()), "<u2").reshape(n, -1)
                keep = pa.array((a == b).sum(axis=1) >= agree)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "depth")], names=["a", "b", "depth"])

    return run


def near_pairs(signatures: DataFrame, sets: DataFrame, least: float, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(a, b, similarity), a < b, of the keys of `signatures` (key, signature) and `sets` (key, runs) that are at least so similar.

    Prefixes are shortened one minimum at a time. After each step every pair
    found counts as one over its chance to have met by then, which estimates
    how many there are; once the pairs found are the part RECALL of that, the
    shorter prefixes are left. No group of bodies is ever gathered: nodes of
    more than `most` bodies pair nothing, their bodies are joined exactly among
    themselves. Bodies that are equal must be one row. Only the sets of bodies
    that some candidate needs are read.
    """
    shortest, agree = shortest_prefix(least), least_agreement(least, TREES * LONGEST)
    pairs, busy = meetings(signatures, shortest, most)
    pairs, busy = likely(pairs, signatures, agree).checkpoint(), busy.checkpoint()
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).union(busy).distinct()
    sets = sets.join(needed, "key", "left_semi").checkpoint()
    parts, found, there = [], 0, 0.0
    for length in range(LONGEST, shortest - 1, -1):
        parts.append(verified(pairs.where(F.col("depth") == length), sets, least).checkpoint())
        met = 1 - F.pow(1 - F.pow("similarity", F.lit(length)), F.lit(TREES))
        sums = [p.agg(F.count("*"), F.sum(1 / F.greatest(met, F.lit(1e-9)))).first() for p in parts]
        found, there = sum(s[0] for s in sums), sum(s[1] or 0.0 for s in sums)
        if there and found >= RECALL * there:
            break
    if busy.take(1):
        hot = sets.join(busy, "key", "left_semi").select("key", "runs")
        parts.append(verified(candidates(hot, hot, least).where("a < b"), sets, least))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("a", "b").agg(F.first("similarity").alias("similarity"))


def similar_bodies(pages: DataFrame, annotations: DataFrame, model: PageModel | None, least: float = LEAST_SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): classes (page_id, key) of equal bodies, named by their smallest page, and pairs of classes (a, b, similarity).

    Bodies count as equal if two 64-bit hashes of their whole sets agree, which
    are computed in different ways: among 10^11 bodies the chance of a single
    wrong match is below 10^-15.
    """
    use_checkpoints(pages.sparkSession)
    bodies, sets = body_sets(pages, annotations, model)
    small = bodies.checkpoint()
    named = small.groupBy("body", "mark").agg(F.min("page_id").alias("key"))
    classes = spread_join(small.select("page_id", "body", "mark"), named, ["body", "mark"], ["page_id"]).select("page_id", "key").checkpoint()
    heads = classes.where("page_id = key").select("key")
    signatures = small.select(F.col("page_id").alias("key"), "signature").join(heads, "key", "left_semi").checkpoint()
    return classes, near_pairs(signatures, sets.withColumnRenamed("page_id", "key"), least)


def found(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id_1, page_id_2), the smaller first, of every pair of different pages that are similar.

    The result names every pair, so pages of equal bodies are expanded from
    their classes at the very end; all work before that is per class, and the
    rows of a large class are dealt out over several tasks.
    """
    classes, pairs = similar_bodies(pages, annotations, model)
    pairs = pairs.select("a", "b").checkpoint()
    left = classes.select(F.col("key").alias("a"), F.col("page_id").alias("x"))
    right = classes.select(F.col("key").alias("b"), F.col("page_id").alias("y"))
    meet = pairs.select("a", "b").union(left.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a", F.col("a").alias("b")))
    both = spread_join(left.join(meet, "a"), right, ["b"], ["x"]).where("a <> b or x < y")
    return both.select(F.least("x", "y").alias("page_id_1"), F.greatest("x", "y").alias("page_id_2"))


def groups(pages: DataFrame, annotations: DataFrame, model: PageModel | None = None) -> DataFrame:
    """(page_id, group_id, links): pages connected by similar bodies share a group, named by its smallest page.

    `links` counts the other classes that the page's class is similar to. Pages
    without a similar page are groups of their own.
    """
    classes, pairs = similar_bodies(pages, annotations, model)
    pairs = pairs.select("a", "b").checkpoint()
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    links = ends.groupBy("key").agg(F.count("*").alias("links"))
    roots = connected_components(pairs).withColumnRenamed("node", "key").join(links, "key", "left")
    return spread_join(classes, roots, ["key"], ["page_id"], "left").select(
        "page_id", F.coalesce("component", "key").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links")
    )
