"""Datasets for training: splits, chat rows and files."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranges import compact

SYSTEM = "Return content line ranges as start:end pairs."


def hash_split(rows: DataFrame, key: str = "page_id", train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """`rows` with split: train or test by a hash of the key, so a row's side never depends on the others."""
    place = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000))
    return rows.withColumn("split", F.when(place < int(round(train_share * 10_000)), "train").otherwise("test"))


def shuffled_split(ids: Sequence[int], seed: int = 42, train_share: float = 0.8) -> tuple[list[int], list[int]]:
    """The split that a seeded shuffle of a list gives, for sets small enough to be listed."""
    order = list(ids)
    random.Random(seed).shuffle(order)
    cut = int(len(order) * train_share)
    return order[:cut], order[cut:]


def split_by_manifest(rows: DataFrame, manifest: DataFrame, side: str, key: str = "page_id") -> DataFrame:
    """The rows whose key stands in train_page_ids or test_page_ids of the manifest; repeats there count once."""
    ids = manifest.select(F.explode(f"{side}_page_ids").alias(key)).distinct()
    return rows.join(ids, key, "left_semi")


def not_in_manifest(rows: DataFrame, manifest: DataFrame, key: str = "page_id") -> DataFrame:
    ids = manifest.select(F.explode(F.concat("train_page_ids", "test_page_ids")).alias(key)).distinct()
    return rows.join(ids, key, "left_anti")


def next_manifest(ids: DataFrame, earlier: DataFrame | None, seed: int = 42, train_share: float = 0.8) -> DataFrame:
    """One row (seed, total, train_page_ids, test_page_ids) for the pages `ids` (page_id), the ids in ascending order.

    Pages that are test pages of an earlier manifest stay there and all others
    are for training; without an earlier one a hash of the id decides.
    """
    known = ids.select("page_id").distinct()
    if earlier is not None:
        test = earlier.select(F.explode("test_page_ids").alias("page_id")).distinct().withColumn("test", F.lit(True))
        sided = known.join(test, "page_id", "left").withColumn("test", F.coalesce("test", F.lit(False)))
    else:
        sided = hash_split(known, "page_id", train_share, seed).withColumn("test", F.col("split") == "test")
    side = lambda on: F.array_sort(F.collect_list(F.when(on, F.col("page_id"))))
    return sided.agg(
        F.lit(seed).cast("bigint").alias("seed"), F.count("*").alias("total"), side(~F.col("test")).alias("train_page_ids"), side(F.col("test")).alias("test_page_ids")
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The manifest as JSON; `read_manifest` gives it back."""
    write_jsonl(manifest.select("seed", "total", "train_page_ids", "test_page_ids"), path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, "seed bigint, total bigint, train_page_ids array<bigint>, test_page_ids array<bigint>")


def write_idf(idf: DataFrame, path: str) -> None:
    """(word, idf) as JSON lines in the order of the words; `read_idf` gives them back."""
    write_jsonl(idf.select("word", "idf").orderBy("word"), path)


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, "word string, idf double")


def chat_rows(pages: DataFrame, system: str = SYSTEM, empty: str | None = "1:1") -> DataFrame:
    """(messages, page_id, url) from page_id, url, light markdown and ranges; no ranges are written as `empty`."""
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    answer: Column = compact(F.coalesce("ranges", F.array().cast("array<struct<start:int,end:int>>")), empty)
    return pages.select(F.array(said("system", F.lit(system)), said("user", F.col("light")), said("assistant", answer)).alias("messages"), "page_id", "url")


def prompt(template: str, markdown: Column, slot: str = "{structured_markdown}") -> Column:
    """A template with the page's markdown in its slot; only the first slot is filled."""
    before, _, after = template.partition(slot)
    return F.concat(F.lit(before), markdown, F.lit(after))


def fits(text: Column, most_tokens: int, count: Callable[[Column], Column] | None = None) -> Column:
    """Whether a text has at most `most_tokens` tokens by `count`, an expression or vectorized function of the text.

    Without one, words separated by white space stand in for a tokenizer's tokens. A null text does not fit.
    """
    words = lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda w: w != ""))
    return F.coalesce((count or words)(text) <= most_tokens, F.lit(False))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One JSON object a line; null fields are written."""
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside values are doubled. Nulls and empty texts both come back as nulls."""
    rows.write.mode("overwrite").csv(path, header=True, escape='"')


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """What `write_csv` wrote, line breaks inside values included."""
    return spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=True)


def debug_html(html: Column, base: Column, script: str = "") -> Column:
    """Html with a base element, and a script if one is given, put behind the first head tag; unchanged without one."""
    tag = F.regexp_extract(html, r"(?i)<head[^>]*>", 0)
    place = F.instr(html, tag)
    added = F.concat(F.lit('<base href="'), base, F.lit('">'), F.lit(script))
    end = place + F.length(tag)
    return F.when(tag != "", F.concat(F.substr(html, F.lit(1), end - 1), added, F.substr(html, end, F.length(html)))).otherwise(html)
