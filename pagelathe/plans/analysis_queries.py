"""Queries over features, labels and trials, and over the html itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ranges as R
from ..functions import text as T
from ..functions import training
from ..operators import analysis, features, items
from ..operators.skew import sifted
from ..sources.tables import read_table, use_checkpoints
from .base import CA, CP, MEASURED, current_annotations, lines, measured, query, with_

Z = ("text_length", "word_count", "link_ratio", "is_heading")


@query(with_(MEASURED) + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS std FROM st" for c in Z))
def normalisation(spark, folder):
    return analysis.normalisation(measured(spark, folder), list(Z)).select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(with_(MEASURED) + ", s AS (SELECT avg(text_length) AS m, stddev_pop(text_length) AS d, avg(link_ratio) AS lm, stddev_pop(link_ratio) AS ld FROM st) SELECT page_id, line_num, round((text_length - m) / d, 5) AS text_length, round((link_ratio - lm) / ld, 5) AS link_ratio FROM st, s")
def zscore(spark, folder):
    rows = analysis.normalised(measured(spark, folder), ["text_length", "link_ratio"], ["page_id", "line_num"])
    return rows.select("page_id", "line_num", F.round("text_length", 5).alias("text_length"), F.round("link_ratio", 5).alias("link_ratio"))


_LABELLED = ', lb AS (SELECT st.page_id, line_num, text, CASE WHEN list_bool_or(list_transform(ranges, lambda r: line_num >= coalesce(r."start", 0) AND line_num <= coalesce(r."end", 0))) THEN 1 ELSE 0 END AS label, CASE WHEN text_length >= 40 AND link_ratio < 0.5 THEN 1 ELSE 0 END AS predicted FROM st JOIN ca USING (page_id) WHERE validated)'


def _labelled(spark, folder):
    rows = measured(spark, folder).join(current_annotations(spark, folder).where("validated").select("page_id", "ranges"), "page_id")
    predicted = F.when((F.col("text_length") >= 40) & (F.col("link_ratio") < 0.5), 1).otherwise(0)
    return rows.select("page_id", "line_num", "span_lines", "text", R.overlaps(F.col("ranges"), F.col("line_num"), F.col("line_num")).alias("label"), predicted.alias("predicted"))


@query(with_(MEASURED, CA) + _LABELLED + " SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, round((count(*) - sum(label)) / sum(label), 6) AS weight FROM lb")
def class_balance(spark, folder):
    return analysis.class_weight(_labelled(spark, folder)).select("rows", "positives", F.round("weight", 6).alias("weight"))


@query(with_(MEASURED, CA) + _LABELLED + " SELECT page_id, round(CASE WHEN sum(greatest(predicted, label)) > 0 THEN sum(predicted * label) / sum(greatest(predicted, label)) ELSE 1 END, 6) AS iou FROM lb GROUP BY page_id")
def span_iou(spark, folder):
    return analysis.span_agreement(_labelled(spark, folder).withColumnRenamed("label", "truth")).select("page_id", F.round("iou", 6).alias("iou"))


@query(with_(MEASURED, CA) + _LABELLED + ", k AS (SELECT page_id, predicted, label, len(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z0-9À-ɏ]{3,}'), lambda w: lower(w)))) AS n FROM lb) SELECT page_id, CAST(sum(CASE WHEN predicted = 1 AND label = 1 THEN n ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN predicted = 1 AND label = 0 THEN n ELSE 0 END) AS BIGINT) AS fp, CAST(sum(CASE WHEN predicted = 0 AND label = 1 THEN n ELSE 0 END) AS BIGINT) AS fn FROM k GROUP BY page_id")
def keyword_confusion(spark, folder):
    rows = _labelled(spark, folder).withColumnRenamed("label", "truth").withColumn("keywords", F.size(T.keywords(F.col("text"))))
    return analysis.keyword_confusion(rows)


# Trials of feature subsets are made of documents: twelve bits of a product of the id, and a score of the length.
_TRIALS = "tr AS (SELECT doc_id AS trial, list_transform(range(0, 12), lambda i: CAST((doc_id * 2654435761 // CAST(pow(2, i + 7) AS BIGINT)) % 2 AS INTEGER)) AS mask, n_chars / 1000.0 AS score FROM documents), fx AS (SELECT trial, score, unnest(mask) AS used, unnest(range(0, 12)) AS feature FROM tr)"


def _trials(spark, folder):
    bits = F.array(*[(F.shiftright(F.col("doc_id") * F.lit(2654435761), i + 7) % 2).cast("int") for i in range(12)])
    return read_table(spark, folder, "documents").select(F.col("doc_id").alias("trial"), bits.alias("mask"), (F.col("n_chars") / 1000.0).alias("score"))


@query(with_(_TRIALS) + " SELECT CAST(feature AS INTEGER) AS feature, CAST(sum(used) AS BIGINT) AS with_n, round(avg(score) FILTER (WHERE used = 1) - avg(score) FILTER (WHERE used = 0), 6) AS gain FROM fx GROUP BY feature")
def feature_marginal(spark, folder):
    return analysis.marginal(_trials(spark, folder)).select("feature", "with_n", F.round("gain", 6).alias("gain"))


@query(with_(_TRIALS) + ", pr AS (SELECT a.feature AS f, b.feature AS g, a.used * 2 + b.used AS q, a.score FROM fx a JOIN fx b ON a.trial = b.trial AND a.feature < b.feature) SELECT CAST(f AS INTEGER) AS f, CAST(g AS INTEGER) AS g, round(avg(score) FILTER (WHERE q = 3) - avg(score) FILTER (WHERE q = 2) - avg(score) FILTER (WHERE q = 1) + avg(score) FILTER (WHERE q = 0), 6) AS synergy FROM pr GROUP BY f, g HAVING least(count(*) FILTER (WHERE q = 0), count(*) FILTER (WHERE q = 1), count(*) FILTER (WHERE q = 2), count(*) FILTER (WHERE q = 3)) >= 10")
def feature_synergy(spark, folder):
    return analysis.synergy(_trials(spark, folder)).select("f", "g", F.round("synergy", 6).alias("synergy"))


@query(with_(_TRIALS) + ", dm AS (SELECT DISTINCT mask FROM tr), ux AS (SELECT unnest(mask) AS used, unnest(range(0, 12)) AS feature FROM dm) SELECT CAST(feature AS INTEGER) AS feature, CAST(sum(used) AS BIGINT) AS n, round(sum(used) / (SELECT count(*) FROM dm), 6) AS share FROM ux GROUP BY feature")
def feature_frequency(spark, folder):
    return analysis.feature_frequency(_trials(spark, folder)).select("feature", "n", F.round("share", 6).alias("share"))


# ------------------------------------------------------------ queries whose html walk SQL cannot express


def _html(spark, folder, *more):
    """All scrapes; the operators choose the current ones among what they made of the html."""
    return read_table(spark, folder, "pages").select("page_id", "scraped_at", "status", "url", "html", *more)


@query("WITH cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST) AS rn FROM (SELECT DISTINCT * FROM pages)) WHERE rn = 1) SELECT page_id, markdown FROM cp WHERE status = 'success' AND html IS NOT NULL")
def html_render(spark, folder):
    """The walk against the markdown that was stored when the page was scraped."""
    return items.rendered(_html(spark, folder)).select("page_id", "markdown")


@query()
def html_render_light(spark, folder):
    return items.rendered(_html(spark, folder)).select("page_id", "light")


_USER = "list_filter(messages, lambda m: m.role = 'user')[1].content"


@query(
    with_(CP)
    + f"""
SELECT DISTINCT t.page_id, {_USER} AS light FROM train t JOIN cp USING (page_id)
WHERE messages IS NOT NULL AND t.url IS NOT NULL AND cp.status = 'success' AND cp.html IS NOT NULL"""
)
def light_of_train(spark, folder):
    """The light view of the pages of the training rows against the content of those rows."""
    rows = read_table(spark, folder, "train").where("messages is not null and url is not null").select("page_id", F.col("url").alias("own")).distinct()
    views = items.rendered(sifted(_html(spark, folder), rows, "page_id"))
    return views.join(rows, "page_id").select("page_id", "light")


@query(with_(MEASURED) + r", tw AS (SELECT page_id, line_num, text, md_prefix FROM tl) SELECT page_id, line_num, text, md_prefix FROM tw WHERE NOT regexp_matches(text, '^\[cookies\] - [0-9]+ lines?$')")
def html_lines(spark, folder):
    """Lines of the walk against those read back from the stored markdown, whose list marks may stand in the text as well."""
    rows = items.page_lines(_html(spark, folder)).where("item_type = 'text'")
    whole = F.concat("md_prefix", "text")
    mark = F.regexp_extract(whole, r"^(#{1,6} |- |[0-9]+\. )", 1)
    return rows.select("page_id", "line_num", F.substr(whole, F.length(mark) + 1, F.length(whole)).alias("text"), mark.alias("md_prefix"))


@query()
def html_outline(spark, folder):
    return items.outline(_html(spark, folder))


@query()
def consent_audit(spark, folder):
    return items.consent_audit(_html(spark, folder))


def _feature_parts(spark, folder):
    """(lines, labels) of the validated pages: the walk is done once and kept, since several parts of the table read it."""
    use_checkpoints(spark)
    labels = current_annotations(spark, folder).where("validated").select("page_id", "ranges")
    pages = sifted(_html(spark, folder, "dataset"), labels, "page_id")
    walked = items.walked_lines(pages, carry=("dataset",)).join(labels, "page_id").checkpoint()
    return items.unrolled(walked), walked.select("page_id", "dataset", "ranges")


@query()
def page_features_85(spark, folder):
    """The whole feature table of annotated pages."""
    return features.feature_table(*_feature_parts(spark, folder))


@query()
def collapsed_lines(spark, folder):
    rows = items.page_lines(_html(spark, folder), collapse_links=True)
    return features.line_features(rows).where("item_type <> 'text'").select("page_id", "line_num", "span_lines", "item_type", "link_count", "is_link_only")


@query()
def shuffled_feature(spark, folder):
    rows = measured(spark, folder).select("page_id", "line_num", "text_length")
    return analysis.shuffled_within_pages(rows, "text_length")


@query(with_(MEASURED) + " SELECT page_id, count(*) AS lines FROM st GROUP BY page_id")
def page_line_counts(spark, folder):
    return lines(spark, folder).groupBy("page_id").agg(F.count("*").alias("lines"))


@query("SELECT doc_id, CAST(regexp_extract(text, '[0-9]+', 0) AS BIGINT) * CASE doc_id % 3 WHEN 0 THEN 3600 WHEN 1 THEN 60 ELSE 1 END AS seconds FROM documents WHERE regexp_matches(text, '[0-9]') AND length(regexp_extract(text, '[0-9]+', 0)) < 10")
def duration_seconds(spark, folder):
    """The first number of a text, with a unit by the document, as a duration."""
    docs = read_table(spark, folder, "documents").where("text rlike '[0-9]'").withColumn("n", F.regexp_extract("text", "[0-9]+", 0)).where(F.length("n") < 10)
    unit = F.element_at(F.array(F.lit("h"), F.lit("m"), F.lit("s")), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    return docs.select("doc_id", training.seconds(F.concat("n", unit)).alias("seconds"))
