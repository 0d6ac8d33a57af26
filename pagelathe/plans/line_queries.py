"""Queries over lines of pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import analysis, features
from .base import BLOCKS, LINES, MEASURED, TOKENS, current_pages, lines, measured, query, with_


def r(name: str, digits: int = 6):
    return F.round(name, digits).alias(name)


@query(
    with_(MEASURED)
    + r"""
SELECT page_id, line_num, text_length, word_count, round(link_ratio, 6) AS link_ratio, link_count, is_link_only, is_heading, heading_level,
  CASE WHEN contains(text, '**') THEN 1 ELSE 0 END AS has_bold, is_list_item, text_length - length(translate(text, '.,;:!?()[]{}"''-', '')) AS punctuation_count,
  len(regexp_extract_all(text, '[.!?](?:\s|$)')) AS sentence_count,
  CASE WHEN word_count > 0 THEN round(CAST(list_sum(list_transform(words, lambda w: length(w))) AS DOUBLE) / word_count, 9) ELSE 0 END AS avg_word_length,
  length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS uppercase_count, length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS number_count,
  len(list_distinct(list_transform(words, lambda w: lower(w)))) AS unique_word_count, comma_count FROM st"""
)
def line_text_stats(spark, folder):
    flags = "is_link_only is_heading has_bold is_list_item".split()
    counts = (
        "text_length word_count link_count heading_level punctuation_count sentence_count uppercase_count number_count"
        " unique_word_count comma_count"
    ).split()
    counted = [F.col(c).cast("bigint").alias(c) for c in counts]
    return measured(spark, folder).select("page_id", "line_num", r("link_ratio"), r("avg_word_length", 9), *flags, *counted)


@query(with_(TOKENS) + "\nSELECT page_id, line_num, array_to_string(tokens, '|') AS tokens, len(tokens) AS n FROM tk")
def line_tokens_clean(spark, folder):
    t = T.clean_tokens(F.col("text"))
    return lines(spark, folder).select("page_id", "line_num", F.array_join(t, "|").alias("tokens"), F.size(t).cast("bigint").alias("n"))


@query(
    with_(MEASURED)
    + """
SELECT page_id, line_num, link_count, is_link_only, len(list_filter(labels, lambda x: length(x) < 10)) AS short_link_count,
  round(len(list_filter(labels, lambda x: length(x) < 10)) / greatest(link_count, 1), 6) AS short_link_ratio FROM st WHERE link_count > 0"""
)
def line_links(spark, folder):
    return measured(spark, folder).where("link_count > 0").select("page_id", "line_num", F.col("link_count").cast("bigint"), "is_link_only", F.col("short_link_count").cast("bigint"), r("short_link_ratio"))


@query(
    with_(LINES)
    + r""",
d AS (SELECT tl.page_id, line_num, regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^[w.]+', '') AS own,
  list_transform(regexp_extract_all(text, '\[([^\]]*)\]\(([^)]*)\)', 2), lambda u: regexp_replace(lower(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^[w.]+', '')) AS hosts
  FROM tl JOIN cp USING (page_id))
SELECT page_id, line_num, len(list_filter(hosts, lambda h: h <> '' AND h <> own)) AS external_link_count FROM d WHERE len(hosts) > 0"""
)
def external_links(spark, folder):
    pages = current_pages(spark, folder, "url").select("page_id", "url")
    rows = lines(spark, folder).where(F.size(F.regexp_extract_all("text", F.lit(T.LINK_PARTS), F.lit(2))) > 0).join(pages, "page_id")
    return rows.select("page_id", "line_num", T.external_links(F.col("text"), F.col("url")).cast("bigint").alias("external_link_count"))


@query(
    with_(LINES)
    + """
SELECT page_id, line_num, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z0-9À-ɏ]{3,}'), lambda w: lower(w)))), ' ') AS keywords FROM tl"""
)
def keywords(spark, folder):
    return lines(spark, folder).select("page_id", "line_num", F.array_join(F.array_sort(T.keywords(F.col("text"))), " ").alias("keywords"))


@query(
    with_(MEASURED)
    + """
SELECT page_id, line_num, round(avg(text_length) OVER w, 4) AS mean_text_length_w5, round(avg(link_ratio) OVER w, 6) AS mean_link_ratio_w5 FROM st
WINDOW w AS (PARTITION BY page_id ORDER BY line_num ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"""
)
def rolling_mean_w5(spark, folder):
    return features.with_rolling(measured(spark, folder)).select("page_id", "line_num", r("mean_text_length_w5", 4), r("mean_link_ratio_w5"))


@query(with_(MEASURED, BLOCKS) + "\nSELECT page_id, line_num, level, block FROM bl")
def block_ids(spark, folder):
    return features.with_blocks(measured(spark, folder), ("level",)).select("page_id", "line_num", "level", "block")


@query(
    with_(MEASURED)
    + """
SELECT page_id, line_num, round(CASE WHEN sum(text_length) OVER p > 0 THEN sum(text_length) OVER w / sum(text_length) OVER p ELSE 0 END, 6) AS cumulative_text_pct FROM st
WINDOW p AS (PARTITION BY page_id), w AS (PARTITION BY page_id ORDER BY line_num ROWS UNBOUNDED PRECEDING)"""
)
def cumulative_share(spark, folder):
    return features.with_position(measured(spark, folder)).select("page_id", "line_num", r("cumulative_text_pct"))


@query(
    with_(MEASURED)
    + """
SELECT page_id, line_num, CAST(row_number() OVER w AS INTEGER) AS running, count(*) OVER p AS total_lines, round(line_num / count(*) OVER p, 6) AS position_pct FROM st
WINDOW p AS (PARTITION BY page_id), w AS (PARTITION BY page_id ORDER BY line_num)"""
)
def line_position(spark, folder):
    rows = features.with_position(measured(spark, folder).withColumn("given", F.col("line_num")))
    numbered = features.running_numbers(rows.withColumnRenamed("line_num", "seq"))
    return numbered.select("page_id", F.col("given").alias("line_num"), F.col("line_num").alias("running"), "total_lines", r("position_pct"))


@query(
    with_(MEASURED, BLOCKS)
    + """
SELECT page_id, line_num, block, round(CASE WHEN count(*) OVER b > 1 THEN (row_number() OVER o - 1) / (count(*) OVER b - 1) ELSE 0 END, 6) AS relative_position_in_block FROM bl
WINDOW b AS (PARTITION BY page_id, block), o AS (PARTITION BY page_id, block ORDER BY line_num)"""
)
def pos_in_block(spark, folder):
    rows = features.with_block_features(features.with_blocks(measured(spark, folder), ("level",)))
    return rows.select("page_id", "line_num", "block", r("relative_position_in_block"))


@query(
    with_(MEASURED)
    + """,
hp AS (SELECT *, row_number() OVER w - 1 AS place, CASE WHEN row_number() OVER w > 1 AND level <> lag(level) OVER w THEN 1 ELSE 0 END AS tag_transition FROM st WINDOW w AS (PARTITION BY page_id ORDER BY line_num))
SELECT page_id, line_num, tag_transition, place - coalesce(max(CASE WHEN is_heading = 1 THEN place END) OVER (PARTITION BY page_id ORDER BY line_num ROWS UNBOUNDED PRECEDING), 0) AS dist_to_heading FROM hp"""
)
def dist_to_heading(spark, folder):
    return features.with_heading_distance(measured(spark, folder)).select("page_id", "line_num", "tag_transition", F.col("dist_to_heading").cast("bigint"))


@query(
    with_(MEASURED)
    + """,
lr AS (SELECT *, CASE WHEN is_link_only = 1 AND lag(is_link_only) OVER w = 1 AND level = lag(level) OVER w THEN 0 ELSE 1 END AS isnew FROM st WINDOW w AS (PARTITION BY page_id ORDER BY line_num)),
rn AS (SELECT *, sum(isnew) OVER (PARTITION BY page_id ORDER BY line_num ROWS UNBOUNDED PRECEDING) AS run FROM lr)
SELECT page_id, min(line_num) AS first_line, count(*) AS lines, CAST(sum(link_count) AS BIGINT) AS links FROM rn WHERE is_link_only = 1 GROUP BY page_id, run HAVING count(*) >= 3"""
)
def link_run_collapse(spark, folder):
    rows = measured(spark, folder).select("page_id", "line_num", F.col("level").alias("label_group"), F.col("is_link_only").alias("link_only"), F.col("link_count").alias("links"))
    return analysis.link_runs(rows)


@query(
    with_(TOKENS)
    + """,
np AS (SELECT count(DISTINCT page_id) AS pages FROM tl)
SELECT word, count(DISTINCT page_id) AS df, round(ln(CAST((SELECT pages FROM np) AS DOUBLE) / count(DISTINCT page_id)), 6) AS idf FROM fl GROUP BY word"""
)
def corpus_idf(spark, folder):
    return features.corpus_idf(lines(spark, folder)).select("word", "df", r("idf"))


@query(
    with_(LINES)
    + """,
np AS (SELECT count(DISTINCT page_id) AS pages FROM tl),
fr AS (SELECT trim(text, ' ') AS k, count(DISTINCT page_id) AS n FROM tl WHERE trim(text, ' ') <> '' GROUP BY 1)
SELECT page_id, line_num, round(coalesce(n, 0) / (SELECT pages FROM np), 6) AS line_frequency FROM tl LEFT JOIN fr ON trim(text, ' ') = k"""
)
def line_frequency(spark, folder):
    return features.line_frequency(lines(spark, folder)).select("page_id", "line_num", r("line_frequency"))


_WORDS = """,
pn AS (SELECT page_id, count(*) AS lines FROM tl GROUP BY page_id),
wc AS (SELECT page_id, word, count(*) AS n, count(DISTINCT line_num) AS df FROM fl GROUP BY page_id, word)"""


@query(
    with_(TOKENS)
    + _WORDS
    + """,
sc AS (SELECT page_id, line_num, avg(ln(lines / df)) AS mean_idf, max(ln(lines / df)) AS max_idf FROM fl JOIN wc USING (page_id, word) JOIN pn USING (page_id) GROUP BY page_id, line_num)
SELECT page_id, line_num, round(coalesce(mean_idf, 0), 6) AS mean_idf, round(coalesce(max_idf, 0), 6) AS max_idf FROM tl LEFT JOIN sc USING (page_id, line_num)"""
)
def page_idf(spark, folder):
    return features.word_scores(lines(spark, folder)).select("page_id", "line_num", r("mean_idf"), r("max_idf"))


@query(
    with_(TOKENS)
    + _WORDS
    + """,
sc AS (SELECT page_id, line_num, avg(1 / n) AS a, sum(1 / n) AS s FROM fl JOIN wc USING (page_id, word) GROUP BY page_id, line_num)
SELECT page_id, line_num, round(coalesce(a, 0), 9) AS word_novelty, round(coalesce(s, 0), 9) AS word_novelty_sum FROM tl LEFT JOIN sc USING (page_id, line_num)"""
)
def word_novelty(spark, folder):
    return features.word_scores(lines(spark, folder)).select("page_id", "line_num", r("word_novelty", 9), r("word_novelty_sum", 9))


@query(
    with_(TOKENS)
    + """,
bg AS (SELECT page_id, line_num, word, lead(word) OVER (PARTITION BY page_id, line_num ORDER BY pos) AS next FROM fl),
bc AS (SELECT page_id, word, next, count(*) AS n FROM bg WHERE next IS NOT NULL GROUP BY page_id, word, next),
sc AS (SELECT page_id, line_num, avg(1 / n) AS a FROM bg JOIN bc USING (page_id, word, next) GROUP BY page_id, line_num)
SELECT page_id, line_num, round(coalesce(a, 0), 9) AS bigram_novelty FROM tl LEFT JOIN sc USING (page_id, line_num)"""
)
def bigram_novelty(spark, folder):
    return features.word_scores(lines(spark, folder)).select("page_id", "line_num", r("bigram_novelty", 9))


@query(
    with_(MEASURED, BLOCKS)
    + """,
pl AS (SELECT *, CASE WHEN is_heading = 0 AND is_list_item = 0 THEN 1 ELSE 0 END AS is_p FROM bl)
SELECT page_id, block, CAST(count(*) AS INTEGER) AS block_size, round(avg(text_length), 4) AS block_text_density,
  round(CASE WHEN sum(text_length) > 0 THEN sum(text_length * link_ratio) / sum(text_length) ELSE 0 END, 6) AS block_link_density,
  round(CASE WHEN count(*) > 1 AND avg(text_length) > 0 THEN stddev_pop(text_length) / avg(text_length) ELSE 0 END, 6) AS sibling_text_variance,
  round(sum(is_heading) / count(*), 6) AS block_heading_density, round(sum(is_list_item) / greatest(sum(is_p), 1), 6) AS block_li_p_ratio, round(sum(is_p) / count(*), 6) AS container_p_ratio
FROM pl GROUP BY page_id, block"""
)
def block_features(spark, folder):
    rows = features.with_block_features(features.with_blocks(measured(spark, folder), ("level",)))
    names = ("block_link_density", "sibling_text_variance", "block_heading_density", "block_li_p_ratio", "container_p_ratio")
    return rows.where("relative_position_in_block = 0").select("page_id", "block", "block_size", r("block_text_density", 4), *[r(n) for n in names])


@query(
    with_(MEASURED, BLOCKS)
    + """
SELECT page_id, block, round(sum(1 + comma_count + least(3.0, text_length / 100)), 4) AS container_content_score FROM bl GROUP BY page_id, block"""
)
def container_score(spark, folder):
    rows = features.with_block_features(features.with_blocks(measured(spark, folder), ("level",)))
    return rows.where("relative_position_in_block = 0").select("page_id", "block", r("container_content_score", 4))


@query(
    with_(MEASURED, BLOCKS)
    + """,
bt AS (SELECT page_id, block, sum(text_length) AS t FROM bl GROUP BY page_id, block),
bb AS (SELECT page_id, block, t, row_number() OVER (PARTITION BY page_id ORDER BY t DESC, block) AS rn, sum(t) OVER (PARTITION BY page_id) AS total FROM bt)
SELECT bl.page_id, bl.line_num, CASE WHEN bb.block IS NOT NULL THEN 1 ELSE 0 END AS content_region_ratio
FROM bl LEFT JOIN bb ON bl.page_id = bb.page_id AND bl.block = bb.block AND bb.rn = 1 AND bb.t > 0.5 * bb.total"""
)
def content_region(spark, folder):
    rows = features.with_content_region(features.with_blocks(measured(spark, folder), ("level",)))
    return rows.select("page_id", "line_num", "content_region_ratio")


_CHAIN = "CASE WHEN is_heading = 1 THEN ['h' || heading_level, 'h', 'page'] WHEN is_list_item = 1 THEN ['l' || level, 'l', 'page'] WHEN link_count > 0 THEN ['a', 'page'] ELSE [] END"


def _style_rounds() -> str:
    out = f"\n,g0 AS (SELECT page_id, line_num, link_ratio, word_count, chain, coalesce(chain[1], '_no_class') AS g FROM (SELECT *, {_CHAIN} AS chain FROM st))"
    for i in range(8):
        out += (
            f",\ng{i + 1} AS (SELECT * EXCLUDE (g, n), CASE WHEN n < 3 THEN coalesce(CASE WHEN list_contains(chain, g) THEN chain[list_position(chain, g) + 1] END, g) ELSE g END AS g"
            f" FROM (SELECT *, count(*) OVER (PARTITION BY page_id, g) AS n FROM g{i}))"
        )
    return out


@query(
    with_(MEASURED)
    + _style_rounds()
    + """
SELECT page_id, line_num, g AS style_group, CAST(count(*) OVER w AS INTEGER) AS style_group_size, round(avg(link_ratio) OVER w, 6) AS style_group_link_density,
  round(avg(word_count) OVER w, 4) AS style_group_mean_words FROM g8 WINDOW w AS (PARTITION BY page_id, g)"""
)
def style_groups(spark, folder):
    """Markdown has no classes; chains of kinds of lines stand for them, so that groups merge over several rounds."""
    join = lambda a, b: F.concat(F.lit(a), F.col(b).cast("string"))
    chain = (
        F.when(F.col("is_heading") == 1, F.array(join("h", "heading_level"), F.lit("h"), F.lit("page")))
        .when(F.col("is_list_item") == 1, F.array(join("l", "level"), F.lit("l"), F.lit("page")))
        .when(F.col("link_count") > 0, F.array(F.lit("a"), F.lit("page")))
        .otherwise(F.array().cast("array<string>"))
    )
    rows = features.with_style_groups(measured(spark, folder).withColumn("class_chain", chain))
    return rows.select("page_id", "line_num", "style_group", "style_group_size", r("style_group_link_density"), r("style_group_mean_words", 4))


@query(
    with_(LINES)
    + r"""
SELECT page_id, line_num, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(regexp_replace(text, '!?\[([^\]]*)\]\([^)]*\)', '\1', 'g')), '[^0-9A-Za-z_\s]', '', 'g'), ' +', ' ', 'g'), ' '), ' '), lambda w: w <> ''), ' ') AS words FROM tl"""
)
def selection_words(spark, folder):
    return lines(spark, folder).select("page_id", "line_num", F.array_join(T.selection_words(F.col("text")), " ").alias("words"))


@query(
    with_(LINES)
    + """,
mx AS (SELECT page_id, max(line_num) AS last_line FROM tl GROUP BY page_id)
SELECT cp.page_id, coalesce(last_line, 0) AS last_line FROM cp LEFT JOIN mx USING (page_id) WHERE status = 'success' AND markdown IS NOT NULL"""
)
def max_line(spark, folder):
    pages = current_pages(spark, folder, "markdown").where("status = 'success' and markdown is not null")
    numbers = F.transform(F.regexp_extract_all("markdown", F.lit(r"(?m)^ *([0-9]+) \|"), F.lit(1)), lambda x: x.cast("int"))
    return pages.select("page_id", F.coalesce(F.array_max(numbers), F.lit(0)).alias("last_line"))


@query(
    with_(LINES)
    + """
SELECT a.page_id, a.line_num, min(b.line_num) AS next_same FROM tl a JOIN tl b ON a.page_id = b.page_id AND a.text = b.text AND b.line_num > a.line_num WHERE a.text <> '' GROUP BY a.page_id, a.line_num"""
)
def repeated_in_page(spark, folder):
    w = Window.partitionBy("page_id", "text").orderBy("line_num")
    rows = lines(spark, folder).where("text <> ''").withColumn("next_same", F.lead("line_num").over(w))
    return rows.where("next_same is not null").select("page_id", "line_num", "next_same")
