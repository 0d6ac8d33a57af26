"""Problem 7: splits that keep related records together.

Pages are related by site or by the author handle in their url, and through
chains of such links. `found` lists the test pages that are related to a
training page; `assign` makes new splits of given proportions.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import site_of
from ..operators.components import connected_components
from ..operators.ranking import bucketed_rank
from ..operators.current import latest
from ..operators.skew import spread_join
from ..sources.tables import use_checkpoints


def handle_of(url: Column | str) -> Column:
    """The author handle that a url carries, in lower case; null without one.

    The forms are /author/x/, /users/x/, /@x/, /~x/ and ?author=x, also with
    the signs written as %40 and %7E.
    """
    text = F.regexp_replace(F.regexp_replace(F.col(url) if isinstance(url, str) else url, "%40", "@"), "(?i)%7E", "~")
    text = F.regexp_replace(text, r"(?i)^\s*[a-z][a-z0-9+.-]*://[^/?#]*", "")
    path = F.regexp_extract(text, r"^[^?#]*?/(?:(?i:author|authors|user|users)/|[@~])([^/?#]+)", 1)
    query = F.regexp_extract(text, r"[?&](?i:author)=([^&#]+)", 1)
    found = F.when(path != "", path).when(query != "", query)
    return F.lower(found)


def page_keys(pages: DataFrame) -> DataFrame:
    """(page_id, site, handle) of current successful pages."""
    rows = latest(pages, "page_id", "scraped_at", ["status", "url"]).where("status = 'success'")
    return rows.select("page_id", site_of("url").alias("site"), handle_of("url").alias("handle"))


def _node(kind: str, key: str) -> Column:
    """A number for a site or handle; null for null."""
    return F.when(F.col(key).isNotNull(), F.xxhash64(F.lit(kind), F.col("grp"), F.col(key)))


def related_groups(members: DataFrame) -> DataFrame:
    """(grp, page_id, component): pages of one `grp` with the same component are related.

    `members` has grp, page_id, site and handle. The graph has a node for each
    site and handle of a group and an edge for each pair that occurs, so it is
    far smaller than the pages, and a site with a third of all pages is one
    node, whose pages are dealt out over several tasks. A page without site and handle is its own component.
    """
    keyed = members.select("grp", "page_id", _node("site", "site").alias("s"), _node("handle", "handle").alias("h"))
    edges = keyed.select(F.coalesce("s", "h").alias("a"), F.coalesce("h", "s").alias("b")).where("a is not null").distinct()
    roots = connected_components(edges)
    own = F.coalesce("s", "h", F.xxhash64(F.lit("page"), "grp", "page_id"))
    return (
        spread_join(keyed.select("grp", "page_id", own.alias("node")), roots, ["node"], ["page_id"], "left")
        .select("grp", "page_id", F.coalesce("component", "node").alias("component"))
    )


def manifest_members(manifest: DataFrame) -> DataFrame:
    """(grp, seed, page_id, side) of every entry; rows of the manifest stay apart even if they share a seed."""
    rows = manifest.select(F.xxhash64("seed", "total", "train_page_ids", "test_page_ids").alias("grp"), "seed", "train_page_ids", "test_page_ids").distinct()
    side = lambda name: rows.select("grp", "seed", F.explode(f"{name}_page_ids").alias("page_id"), F.lit(name).alias("side"))
    return side("train").union(side("test")).where("page_id is not null").distinct()


def found(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """(seed, page_id) of every test page to which a training page of its manifest row is related.

    Pages that are not current and successful are left out on both sides; null
    and empty arrays have no pages.
    """
    members = manifest_members(manifest)
    keyed = members.join(page_keys(pages), "page_id")
    groups = related_groups(keyed.select("grp", "page_id", "site", "handle").distinct())
    sides = groups.join(members, ["grp", "page_id"])
    # The components with a training page: one row each, however large they are.
    mixed = sides.where("side = 'train'").select("grp", "component").distinct()
    test = spread_join(sides.where("side = 'test'"), mixed, ["grp", "component"], ["page_id"], "left_semi")
    return test.select("seed", "page_id").distinct()


# ---------------------------------------------------------------- new splits

SPLITS = ("train", "validation", "test")
PROPORTIONS = (0.8, 0.1, 0.1)
#: Bundles that the driver holds at a time; more of them are solved one portion after the other.
PORTION = 20_000


def component_profiles(members: DataFrame) -> DataFrame:
    """(component, size, profile) per component; `members` has component, page_id and label.

    The profile is the sorted array of (label, n): how many pages of each label
    a component has. Null labels count as a label of their own.
    """
    counts = members.groupBy("component", F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    return counts.groupBy("component").agg(F.sum("n").alias("size"), F.array_sort(F.collect_list(F.struct("label", "n"))).alias("profile"))


def min_cost_flow(nodes: int, arcs: Sequence[tuple[int, int, int, float]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of a cheapest largest flow, by shortest augmenting paths."""
    to, room, cost, out = [], [], [], [[] for _ in range(nodes)]
    for a, b, capacity, price in arcs:
        for x, y, r, c in ((a, b, capacity, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
    while True:
        far, via = [float("inf")] * nodes, [-1] * nodes
        far[source] = 0.0
        queue = deque([source])
        waiting = [False] * nodes
        while queue:
            x = queue.popleft()
            waiting[x] = False
            for e in out[x]:
                if room[e] > 0 and far[x] + cost[e] < far[to[e]] - 1e-12:
                    far[to[e]], via[to[e]] = far[x] + cost[e], e
                    if not waiting[to[e]]:
                        waiting[to[e]] = True
                        queue.append(to[e])
        if via[sink] < 0:
            return [room[2 * i + 1] for i in range(len(arcs))]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


class Quotas:
    """What the splits, and the labels in them, have left of their shares, while bundles are placed from the largest on."""

    def __init__(self, sizes: dict[str, int], proportions: Sequence[float]):
        self.proportions = list(proportions)
        self.whole = [p * sum(sizes.values()) for p in proportions]
        self.cells = {(x, k): p * n for x, n in sizes.items() for k, p in enumerate(proportions)}

    def place(self, profile: Sequence[tuple[str, int]], n: int) -> list[int]:
        """How many of `n` components of one profile go to each split, by a min-cost flow in whole components.

        The bundle feeds the splits. A split takes what it and the labels'
        cells have left for nothing; one component more costs what it exceeds,
        each further one its size: twice the deviation of the split, relative
        to the proportion, and once that of every cell. So what is placed is
        integral at once, and smaller bundles even out what larger ones left.
        """
        size, splits = sum(c for _, c in profile), len(self.whole)
        arcs: list[tuple[int, int, int, float]] = []
        for k, p in enumerate(self.proportions):
            weight = 1 / p if p > 0 else 1e9
            steps = [(self.whole[k], size, 2 * weight)] + [(self.cells[x, k], c, weight) for x, c in profile]
            fits = sorted({min(n, max(0, int(left / part + 1e-9))) for left, part, _ in steps})
            marks = sorted({0, *fits, *[min(n, f + 1) for f in fits], n})
            for at, to in zip(marks, marks[1:]):
                # Between two marks each further component costs the same.
                price = sum(w * (max(0.0, (at + 1) * part - max(left, 0.0)) - max(0.0, at * part - max(left, 0.0))) for left, part, w in steps)
                arcs.append((0, 2 + k, to - at, price))
            arcs.append((2 + k, 1, n, 0.0))
        arcs.append((2 + splits, 0, n, 0.0))
        flow = min_cost_flow(3 + splits, arcs, 2 + splits, 1)
        out = [0] * splits
        for (a, b, _, _), f in zip(arcs, flow):
            if a == 0:
                out[b - 2] += f
        for k, f in enumerate(out):
            self.whole[k] -= f * size
            for x, c in profile:
                self.cells[x, k] -= f * c
        return out


def solve_quotas(bundles: Sequence[tuple[Sequence[tuple[str, int]], int]], proportions: Sequence[float]) -> list[list[int]]:
    """How many components of each bundle (profile, n) go to each split; larger sizes are placed first, then by profile."""
    sizes: dict[str, int] = {}
    for profile, n in bundles:
        for x, c in profile:
            sizes[x] = sizes.get(x, 0) + c * n
    quotas = Quotas(sizes, proportions)
    result: list[list[int]] = [[]] * len(bundles)
    for i in sorted(range(len(bundles)), key=lambda i: (-sum(c for _, c in bundles[i][0]), tuple(bundles[i][0]))):
        result[i] = quotas.place(*bundles[i])
    return result


def assign(
    members: DataFrame,
    proportions: Sequence[float] = PROPORTIONS,
    names: Sequence[str] = SPLITS,
    seed: int = 0,
    portion: int = PORTION,
) -> DataFrame:
    """(page_id, component, split) for `members` (page_id, component, label): components stay together.

    Components of one size and one profile of labels are a bundle. The driver
    places all bundles, the largest first, by min-cost flows; it reads at most
    `portion` of them at a time and keeps only what splits and labels have
    left, so the result depends on the components alone. The members of a
    bundle are dealt out by the order of their hashes, ranked in buckets, so a
    bundle with a third of all components is no single task. Every page gets a
    split; an empty table gives none. A component larger than a quota goes to
    the split that lacks most.
    """
    spark = members.sparkSession
    use_checkpoints(spark)
    profiles = component_profiles(members).checkpoint()
    labels = members.groupBy(F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("n")).collect()
    quotas = Quotas({r.label: r.n for r in labels}, proportions)
    bundles = profiles.groupBy("size", "profile").agg(F.count("*").alias("n")).orderBy(F.desc("size"), "profile")
    schema = T.StructType([T.StructField("size", T.LongType()), bundles.schema["profile"], T.StructField("upto", T.ArrayType(T.LongType()))])
    solved, parts = [], []

    def keep() -> None:
        table = spark.createDataFrame(solved, schema)
        parts.append(table.checkpoint())
        solved.clear()

    for r in bundles.toLocalIterator():
        profile = [(x.label, x.n) for x in r.profile]
        solved.append((r.size, profile, [int(x) for x in np.cumsum(quotas.place(profile, r.n))]))
        if len(solved) >= portion:
            keep()
    keep()
    upto = parts[0]
    for p in parts[1:]:
        upto = upto.union(p)
    ranked = bucketed_rank(
        profiles.withColumn("u", F.xxhash64("component", F.lit(seed))), ["size", "profile"], F.struct("u", "component"), F.shiftright("u", 54)
    )
    names_col = F.array(*map(F.lit, names))
    place = F.size(F.filter("upto", lambda x: x < F.col("rank"))) + 1
    # The commonest bundles hold most components, so their ranks are dealt out over several tasks.
    placed = spread_join(ranked, upto, ["size", "profile"], ["component"])
    split = placed.select("component", F.element_at(names_col, place).alias("split"))
    return spread_join(members.select("page_id", "component"), split, ["component"], ["page_id"])


def new_splits(pages: DataFrame, proportions: Sequence[float] = PROPORTIONS, seed: int = 0) -> DataFrame:
    """(page_id, split) for all current successful pages; the label is the dataset, null standing for 'original'."""
    use_checkpoints(pages.sparkSession)
    rows = latest(pages, "page_id", "scraped_at", ["status", "url", "dataset"]).where("status = 'success'")
    keyed = rows.select(
        F.lit(0).cast("bigint").alias("grp"), "page_id", site_of("url").alias("site"), handle_of("url").alias("handle"), F.coalesce("dataset", F.lit("original")).alias("label")
    )
    members = related_groups(keyed).join(keyed.select("page_id", "label"), "page_id").select("page_id", "component", "label").checkpoint()
    return assign(members, proportions, seed=seed).select("page_id", "split")
