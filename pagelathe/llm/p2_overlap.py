"""Problem 2: records of the training split that recur in the test split.

Content-defined chunks: a rolling hash over the words of a body cuts it where
the hash says so, so equal passages give equal chunks whatever surrounds them.
Chunk digests are joined across the splits, and the lengths of the shared ones
are summed into the overlap of a pair; pairs that overlap enough are verified by
all their runs of words. Edits can be spread so evenly that few chunks stay
whole; what the chunks leave out is joined exactly, through the rarer of the
runs of words that both splits have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import site_of
from ..operators.skew import spread_join
from ..sources.tables import use_checkpoints
from . import shingles
from .rare_runs import candidates, joined_tails

#: Words of a run, and the share of runs that a pair must have in common.
RUN, LEAST_SIMILARITY = 3, 0.6
#: Shared part of the longer record's chunks, by length, from which a pair is verified at once.
LEAST_OVERLAP = 0.2
#: The rolling hash looks at so many words, and one of CUT hashes ends a chunk; chunks have at least LEAST_CHUNK words.
WINDOW, CUT, LEAST_CHUNK = 2, 4, 2

_NUMBERED = re.compile(r"^\s*(\d+) \| ?(.*)$")
_RANGES = re.compile(r"\d+:\d+(?:,\d+:\d+)*")


def body_of(content: str, answer: str) -> str | None:
    """The lines of a user content that an answer names, labels left out; None if the answer names no lines."""
    if content is None or answer is None or not _RANGES.fullmatch(answer.strip()):
        return None
    inside = [tuple(map(int, part.split(":"))) for part in answer.strip().split(",")]
    out = []
    for line in content.split("\n"):
        m = _NUMBERED.match(line)
        if m and any(a <= int(m[1]) <= b for a, b in inside):
            out.append(m[2])
    return "\n".join(out)


def chunks_of(hashes: np.ndarray) -> np.ndarray:
    """Digests of the content-defined chunks of a sequence of word hashes, each once.

    The lowest byte of a digest is the chunk's length in words, at most 255; a
    chunk that would be longer is cut there.
    """
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    cut = np.zeros(n, bool)
    if n >= WINDOW:
        cut[WINDOW - 1 :] = shingles.run_hashes(hashes, WINDOW) % np.uint64(CUT) == 1
    starts, last = [0], 0
    for end in (np.flatnonzero(cut) + 1).tolist():
        if end - last >= LEAST_CHUNK and end < n:
            while end - last > 255:
                last += 255
                starts.append(last)
            starts.append(end)
            last = end
    while n - last > 255:
        last += 255
        starts.append(last)
    first = np.array(starts)
    length = np.diff(np.append(first, n))
    # A word counts with its place in the chunk, so order matters and any chunk is one sum.
    place = (np.arange(n) - np.repeat(first, length)).astype(np.uint64)
    digest = shingles.mix(np.add.reduceat(shingles.mix(hashes + place * shingles.STEP), first))
    return np.unique((digest & ~np.uint64(255)) | length.astype(np.uint64)).astype(np.int64)


_FIELDS = "page_id bigint, url string, body bigint, runs array<bigint>, chunks array<bigint>"


def records(split: DataFrame) -> DataFrame:
    """(page_id, url, body, runs, chunks) of the records of a split that name lines of their own.

    Records with null messages, without user content or without an answer that
    names lines are left out. The last message of a role counts. Repeated rows
    stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, url, messages in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "messages"))):
                said = {m["role"]: m["content"] for m in messages or [] if m}
                body = body_of(said.get("user"), said.get("assistant"))
                if page is None or body is None:
                    continue
                hashes = shingles.word_hashes(shingles.words_of(body))
                runs = np.unique(shingles.run_hashes(hashes, RUN)).astype(np.int64)
                rows.append((page, url, shingles.set_hash(runs), runs, chunks_of(hashes)))
            cols = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            names = ("page_id", "url", "body", "runs", "chunks")
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=list(names))

    return split.select(F.col("page_id").cast("bigint"), "url", "messages").mapInArrow(run, _FIELDS)


def _length(digest: Column) -> Column:
    return digest.bitwiseAND(F.lit(255)).cast("int")


def _total(chunks: Column) -> Column:
    return F.aggregate(chunks, F.lit(0), lambda s, c: s + _length(c))


def _overlap() -> Column:
    """Lengths of the shared chunks over those of all different chunks of the record that has more."""
    return _total(F.array_intersect("chunks_a", "chunks_b")) / F.greatest(_total(F.col("chunks_a")), _total(F.col("chunks_b")))


def overlaps(train: DataFrame, test: DataFrame, least: float = LEAST_OVERLAP) -> DataFrame:
    """(a, b): pairs of a training and a test record, by key, whose overlap is at least `least`.

    Both sides have key and chunks. Digests are joined but for the commonest of
    a record that together are shorter than the part `least` of it: a pair that
    overlaps enough still shares another. So phrases that everything shares are
    counted, but pair nothing. The lengths of all shared chunks are then summed.
    """
    near = joined_tails(train, test, least, "chunks", lambda digests: digests & 255)
    near = near.where(F.least("size_a", "size_b") >= least * F.greatest("size_a", "size_b")).select("a", "b").distinct()
    own = lambda df, x: df.select(F.col("key").alias(x), F.col("chunks").alias(f"chunks_{x}"))
    return near.join(own(train, "a"), "a").join(own(test, "b"), "b").where(_overlap() >= least).select("a", "b")


def class_pairs(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(close, a, b): pairs of bodies (a, b, overlap, similarity) of at least LEAST_SIMILARITY, and the records of both splits.

    Pairs come from their shared chunks, and those that share too few of them
    from an exact join. Records of equal bodies are one class on each side while pairs are sought.
    """
    use_checkpoints(train.sparkSession)
    a, b = records(train).checkpoint(), records(test).checkpoint()
    one = lambda df: df.where(F.size("runs") > 0).groupBy(F.col("body").alias("key")).agg(*[F.first(c).alias(c) for c in ("runs", "chunks")])
    left, right = one(a).checkpoint(), one(b).checkpoint()
    side = lambda df, x: df.select(F.col("key").alias(x), F.col("runs").alias(f"runs_{x}"), F.col("chunks").alias(f"chunks_{x}"))
    once = lambda df: df.groupBy("page_id", "body").agg(F.min("url").alias("url"))
    common = F.size(F.array_intersect("runs_a", "runs_b"))
    near = overlaps(left, right).checkpoint()
    rest = candidates(left, right, LEAST_SIMILARITY).join(near, ["a", "b"], "left_anti")
    close = (
        near.union(rest)
        .join(side(left, "a"), "a")
        .join(side(right, "b"), "b")
        .withColumn("similarity", common / (F.size("runs_a") + F.size("runs_b") - common))
        .where(F.col("similarity") >= LEAST_SIMILARITY)
        .select("a", "b", _overlap().alias("overlap"), "similarity")
    )
    return close.checkpoint(), once(a), once(b)


def pairs(train: DataFrame, test: DataFrame) -> DataFrame:
    """(train_page, test_page, train_url, test_url, overlap, similarity) of all pairs of at least LEAST_SIMILARITY.

    The records of equal bodies are put back at the end, those of a large class
    dealt out over several tasks.
    """
    close, a, b = class_pairs(train, test)
    own = lambda df, x, name: df.select(F.col("body").alias(x), F.col("page_id").alias(f"{name}_page"), F.col("url").alias(f"{name}_url"))
    half = spread_join(own(a, "a", "train"), close, ["a"], ["train_page"])
    there = own(b, "b", "test").join(close.select("b").distinct(), "b", "left_semi")
    return spread_join(half, there, ["b"], ["train_page"]).select("train_page", "test_page", "train_url", "test_url", "overlap", "similarity")


def found(train: DataFrame, test: DataFrame) -> DataFrame:
    """(page_id_1, page_id_2), the smaller first, of all pairs; each pair once."""
    return (
        pairs(train, test)
        .select(F.least("train_page", "test_page").alias("page_id_1"), F.greatest("train_page", "test_page").alias("page_id_2"))
        .distinct()
    )


def report(train: DataFrame, test: DataFrame) -> DataFrame:
    """(split, site, pairs, records): how many pairs and how many records of a split and site take part; a null url has a null site.

    Pairs are counted from the sizes of the classes of equal bodies and never listed.
    """
    close, a, b = class_pairs(train, test)

    def side(name: str, mine: DataFrame, own: str, others: DataFrame, other: str) -> DataFrame:
        sizes = others.groupBy(F.col("body").alias(other)).agg(F.count("*").alias("n"))
        partners = close.join(sizes, other).groupBy(F.col(own).alias("body")).agg(F.sum("n").alias("n"))
        met = spread_join(mine.select("body", "page_id", site_of("url").alias("site")), partners, ["body"], ["page_id"])
        # A page may have several bodies; it is one record of the split.
        once = met.groupBy("site", "page_id").agg(F.sum("n").alias("n"))
        return once.groupBy("site").agg(F.sum("n").alias("pairs"), F.count("*").alias("records")).select(F.lit(name).alias("split"), "site", "pairs", "records")

    return side("train", a, "a", b, "b").union(side("test", b, "b", a, "a"))
