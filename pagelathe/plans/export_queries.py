"""Queries of looking up, exporting, scoring and watching, and the feature table against the stored markdown."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions import ranges as R
from ..functions import scores as S
from ..functions import text as T
from ..functions import training
from ..operators import analysis, export, features, review, store
from ..operators.current import latest
from ..sources.tables import read_table, use_checkpoints
from ..streaming import scrape
from .analysis_queries import _LABELLED, _TRIALS, _feature_parts, _labelled, _trials
from .annotation_queries import LN, RT, RTS
from .base import CA, CP, LINES, MEASURED, TOKENS, current_annotations, current_pages, lines, measured, query, with_

# ------------------------------------------------------------ looking up and exporting


@query(with_(CP, CA) + f" SELECT page_id, url, {RTS.format('ranges')} AS ranges, source, validated, skipped, coalesce(has_cookies, FALSE) AS has_cookies, ranges IS NOT NULL AS acceptable FROM cp LEFT JOIN ca USING (page_id) WHERE status = 'success' AND page_id = 7")
def page_lookup(spark, folder):
    rows = review.looked_up(current_pages(spark, folder, "url"), current_annotations(spark, folder), F.col("page_id") == 7)
    return rows.select("page_id", "url", RT(F.col("ranges")).alias("ranges"), "source", "validated", "skipped", "has_cookies", "acceptable")


@query(with_(CP, CA) + " SELECT page_id, url FROM cp JOIN ca USING (page_id) WHERE status = 'success' AND validated AND coalesce(dataset, 'original') = 'original'")
def annotated_original(spark, folder):
    return review.annotated(current_pages(spark, folder, "url", "dataset"), current_annotations(spark, folder), dataset="original").select("page_id", "url")


@query(with_(CP, CA) + " SELECT page_id, url FROM cp WHERE status = 'success' AND page_id NOT IN (SELECT page_id FROM ca WHERE page_id IS NOT NULL) ORDER BY page_id LIMIT 50")
def unannotated_scan(spark, folder):
    """The first pages to annotate, in a stable order."""
    rows = review.unannotated(current_pages(spark, folder, "url", "urgent"), current_annotations(spark, folder))
    return review.scan(rows, 50)


@query(with_(CP, CA) + ", e AS (SELECT unnest(test_page_ids) AS page_id FROM split_manifest), j AS (SELECT page_id, page_id IN (FROM e) AS test FROM cp JOIN ca USING (page_id) WHERE status = 'success' AND validated) SELECT CAST(42 AS BIGINT) AS seed, count(*) AS total, array_to_string(list_sort(list(page_id) FILTER (WHERE NOT test)), ',') AS train_page_ids, array_to_string(list_sort(list(page_id) FILTER (WHERE test)), ',') AS test_page_ids FROM j")
def manifest_next(spark, folder):
    """The manifest of a new export, whose test pages are those of the earlier ones."""
    ids = review.annotated(current_pages(spark, folder, "url", "dataset"), current_annotations(spark, folder)).select("page_id")
    made = export.next_manifest(ids, read_table(spark, folder, "split_manifest"))
    return made.select("seed", "total", F.array_join("train_page_ids", ",").alias("train_page_ids"), F.array_join("test_page_ids", ",").alias("test_page_ids"))


@query(with_(CP) + " SELECT (SELECT count(*) FROM cp WHERE status = 'success' AND html IS NOT NULL) AS pages, (SELECT count(*) FROM annotations) AS annotations")
def regeneration_counts(spark, folder):
    return store.regeneration_counts(_with_html(spark, folder), read_table(spark, folder, "annotations"))


def _with_html(spark, folder):
    """Current pages with an empty html in place of any other, so that none is shuffled."""
    rows = read_table(spark, folder, "pages").withColumn("html", F.when(F.col("html").isNotNull(), ""))
    return latest(rows.select("page_id", "scraped_at", "status", "html"), "page_id", "scraped_at")


@query(with_(CA) + """ SELECT page_id, CASE WHEN ranges IS NULL THEN NULL ELSE '[' || array_to_string(list_transform(ranges, lambda r: '{"start": ' || coalesce(CAST(r."start" AS VARCHAR), 'null') || ', "end": ' || coalesce(CAST(r."end" AS VARCHAR), 'null') || '}'), ', ') || ']' END AS ranges FROM ca""")
def ranges_json(spark, folder):
    return current_annotations(spark, folder).select("page_id", R.ranges_json(F.col("ranges")).alias("ranges"))


# ------------------------------------------------------------ truth, scores and losses

_TRUTH = f"tr AS (SELECT page_id, {LN.format('ranges')} AS t FROM ca WHERE validated AND ranges IS NOT NULL), pl AS (SELECT page_id, list(line_num) AS l, coalesce(list(line_num) FILTER (WHERE length(text) >= 40), []) AS f FROM tl GROUP BY page_id)"


def _truth(spark, folder):
    truth = current_annotations(spark, folder).where("validated and ranges is not null").select("page_id", R.range_lines(F.col("ranges")).alias("truth"))
    own = F.collect_list(F.when(F.length("text") >= 40, F.col("line_num")))
    return lines(spark, folder).groupBy("page_id").agg(F.collect_list("line_num").alias("lines"), own.alias("found")).join(truth, "page_id")


@query(with_(LINES, CA, _TRUTH) + " SELECT page_id, len(t) AS named, len(list_filter(t, lambda x: list_contains(l, x))) AS there FROM tr JOIN pl USING (page_id)")
def truth_cut(spark, folder):
    """How many of the annotated lines a page has."""
    rows = _truth(spark, folder)
    size = lambda c: F.size(c).cast("bigint")
    return rows.select("page_id", size(F.col("truth")).alias("named"), size(S.cut_to_lines(F.col("truth"), F.col("lines"))).alias("there"))


@query(with_(LINES, CA, _TRUTH) + " SELECT page_id, array_to_string(list_sort(list_filter(t, lambda x: list_contains(l, x) AND NOT list_contains(f, x))), ',') AS missed FROM tr JOIN pl USING (page_id)")
def missed_lines(spark, folder):
    """Annotated lines of a page that a rule for long lines leaves out."""
    rows = _truth(spark, folder)
    return rows.select("page_id", F.array_join(S.missed(F.col("found"), S.cut_to_lines(F.col("truth"), F.col("lines"))), ",").alias("missed"))


_WEIGHTS = {"text_length": 0.02, "link_ratio": -3.0, "is_heading": 1.5, "comma_count": 0.1}
_LOGIT = "sc AS (SELECT st.*, -1e0 + 2e-2 * text_length - 3e0 * link_ratio + 15e-1 * is_heading + 1e-1 * comma_count AS logit FROM st)"


def _scored(spark, folder):
    return analysis.linear_scores(measured(spark, folder), _WEIGHTS, -1.0)


@query(with_(MEASURED, _LOGIT) + " SELECT page_id, line_num, round(1 / (1 + exp(-logit)), 6) AS probability, CASE WHEN 1 / (1 + exp(-logit)) >= 0.5 THEN 1 ELSE 0 END AS predicted FROM sc")
def linear_scorer(spark, folder):
    rows = analysis.thresholded(_scored(spark, folder))
    return rows.select("page_id", "line_num", F.round("probability", 6).alias("probability"), "predicted")


@query(with_(MEASURED, CA) + _LABELLED + ", " + _LOGIT + ", lo AS (SELECT sc.page_id, logit, label, 1 / (1 + exp(-logit)) AS p FROM sc JOIN lb USING (page_id, line_num)), pg AS (SELECT page_id, sum((greatest(logit, 0) - logit * label + ln(1 + exp(-abs(logit)))) * CASE WHEN label = 1 THEN 2.0 ELSE 1.0 END) AS bce, count(*) AS n, sum(p * label) AS shared, sum(p + label - p * label) AS whole FROM lo GROUP BY page_id) SELECT round(sum(bce) / sum(n), 6) AS bce, round(1 - avg((shared + 1) / (whole + 1)), 6) AS iou_loss FROM pg")
def soft_loss(spark, folder):
    truth = _labelled(spark, folder).select("page_id", "line_num", F.col("label").alias("truth"))
    got = analysis.soft_loss(_scored(spark, folder).join(truth, ["page_id", "line_num"]), 2.0)
    return got.select(F.round("bce", 6).alias("bce"), F.round("iou_loss", 6).alias("iou_loss"))


_SYNERGY = ", pr AS (SELECT a.feature AS f, b.feature AS g, a.used * 2 + b.used AS q, a.score FROM fx a JOIN fx b ON a.trial = b.trial AND a.feature < b.feature), sy AS (SELECT CAST(f AS INTEGER) AS f, CAST(g AS INTEGER) AS g, avg(score) FILTER (WHERE q = 3) - avg(score) FILTER (WHERE q = 2) - avg(score) FILTER (WHERE q = 1) + avg(score) FILTER (WHERE q = 0) AS s FROM pr GROUP BY f, g HAVING least(count(*) FILTER (WHERE q = 0), count(*) FILTER (WHERE q = 1), count(*) FILTER (WHERE q = 2), count(*) FILTER (WHERE q = 3)) >= 10)"


@query(with_(_TRIALS) + _SYNERGY + " SELECT * FROM (SELECT 'top' AS \"end\", f, g, round(s, 6) AS synergy FROM sy ORDER BY s DESC, f, g LIMIT 15) UNION ALL SELECT * FROM (SELECT 'bottom', f, g, round(s, 6) FROM sy ORDER BY s, f, g LIMIT 15)")
def synergy_extremes(spark, folder):
    got = analysis.extreme_pairs(analysis.synergy(_trials(spark, folder)), 15)
    return got.select("end", "f", "g", F.round("synergy", 6).alias("synergy"))


@query("SELECT doc_id, m AS model, round((CASE m WHEN '0.5B' THEN 4 WHEN '1.5B' THEN 8 ELSE 14 END + CASE m WHEN '0.5B' THEN 0.5 WHEN '1.5B' THEN 1.0 ELSE 2.0 END * n_chars / 1024) * (1 + doc_id % 4), 6) AS gb FROM documents, (VALUES ('0.5B'), ('1.5B'), ('3B')) v(m) WHERE n_chars IS NOT NULL")
def memory_estimates(spark, folder):
    """Device memory of runs as long as the documents."""
    docs = read_table(spark, folder, "documents").where("n_chars is not null").select("doc_id", "n_chars", F.explode(F.array(*map(F.lit, training.MODELS))).alias("model"))
    gb = training.memory_gb(F.col("model"), F.col("n_chars"), F.pmod("doc_id", F.lit(4)) + 1)
    return docs.select("doc_id", "model", F.round(gb, 6).alias("gb"))


def _weight_sql(column: str) -> str:
    has = lambda p: f"CASE WHEN regexp_matches({column}, '(?i){p}') THEN 25 ELSE 0 END"
    return f"{has(T.POSITIVE)} - {has(T.NEGATIVE)} - {has(T.UNLIKELY)}"


@query(
    with_(CP)
    + ", u AS (SELECT page_id, list_reverse(list_filter(string_split(regexp_replace(url, '^[A-Za-z]+://[^/?#]*', ''), '/'), lambda x: x <> '')) AS chain FROM cp WHERE status = 'success' AND url IS NOT NULL)"
    + f" SELECT page_id, {_weight_sql('coalesce(chain[1], chr(32))')} AS own_class_weight, "
    + ", ".join(f"CASE WHEN regexp_matches(array_to_string(chain, ' '), '(?i){p}') THEN 1 ELSE 0 END AS has_{n}_class" for n, p in (("positive", T.POSITIVE), ("negative", T.NEGATIVE), ("unlikely", T.UNLIKELY), ("boilerplate", T.BOILERPLATE)))
    + " FROM u"
)
def class_weight(spark, folder):
    """Name patterns over the parts of a page's path, the last one in the place of the nearest classes."""
    path = F.split(F.regexp_replace("url", "^[A-Za-z]+://[^/?#]*", ""), "/")
    rows = current_pages(spark, folder, "url").where("status = 'success' and url is not null").withColumn("chain", F.reverse(F.filter(path, lambda x: x != "")))
    return rows.select("page_id", *[c.alias(n) for n, c in T.class_features(F.col("chain")).items()])


# ------------------------------------------------------------ watching


@query("SELECT DISTINCT page_id, url FROM pages WHERE status = 'success' AND page_id IS NOT NULL AND page_id NOT IN (SELECT page_id FROM annotations WHERE page_id IS NOT NULL)")
def watch_unannotated(spark, folder):
    """What a stream over the scrapes hands on to be annotated, if it ends with what there is now."""
    use_checkpoints(spark)
    schema = read_table(spark, folder, "pages").schema
    # A pattern, since a stream takes no single file by its name.
    path = f"{folder}/pages.parque[t]"
    stream = spark.readStream.schema(schema).parquet(path).select("page_id", "url", "status", "urgent")
    place = os.path.join(spark.sparkContext._jsc.sc().getCheckpointDir().get(), "watch-" + spark._jvm.java.util.UUID.randomUUID().toString())
    annotations = lambda: read_table(spark, folder, "annotations")

    def keep(rows, epoch) -> None:
        rows.write.mode("overwrite").parquet(f"{place}/batch={epoch}")

    scrape.watch(stream, annotations, keep, f"{place}-log", None).awaitTermination()
    return spark.read.schema("page_id bigint, url string").parquet(f"{place}/batch=*").distinct()


# ------------------------------------------------------------ the feature table against the stored markdown

_COOKIES = r"md_prefix = '' AND regexp_matches(text, '^\[cookies\] - [0-9]+ lines?$')"
_FEATURES = (
    LINES
    + ",\n"
    + CA
    + rf""",
cl AS (SELECT tl.page_id, url, coalesce(dataset, 'original') AS dataset, ranges, line_num, {_COOKIES} AS ck, CASE WHEN {_COOKIES} THEN '' ELSE md_prefix END AS md_prefix, CASE WHEN {_COOKIES} THEN '' ELSE text END AS text,
  CASE WHEN {_COOKIES} THEN CAST(regexp_extract(text, '([0-9]+)', 1) AS INTEGER) ELSE 1 END AS span FROM tl JOIN ca USING (page_id) JOIN cp USING (page_id) WHERE validated),
"""
    + MEASURED[len(LINES) :].lstrip(",\n").replace("FROM tl)", "FROM cl)").replace("CASE WHEN text_length > 0 THEN", "CASE WHEN ck THEN 1 WHEN text_length > 0 THEN", 1)
    + ",\n"
    + TOKENS[len(LINES) :].lstrip(",\n").replace("FROM tl)", "FROM cl)")
    + r""",
pn AS (SELECT page_id, count(*) AS lines FROM cl GROUP BY page_id),
wc AS (SELECT page_id, word, count(*) AS n, count(DISTINCT line_num) AS df FROM fl GROUP BY page_id, word),
ws AS (SELECT page_id, line_num, avg(ln(lines / df)) AS mean_idf, max(ln(lines / df)) AS max_idf, avg(1 / n) AS word_novelty, sum(1 / n) AS word_novelty_sum FROM fl JOIN wc USING (page_id, word) JOIN pn USING (page_id) GROUP BY page_id, line_num),
bg AS (SELECT page_id, line_num, word, lead(word) OVER (PARTITION BY page_id, line_num ORDER BY pos) AS next FROM fl),
bc AS (SELECT page_id, word, next, count(*) AS n FROM bg WHERE next IS NOT NULL GROUP BY page_id, word, next),
bs AS (SELECT page_id, line_num, avg(1 / n) AS bigram_novelty FROM bg JOIN bc USING (page_id, word, next) GROUP BY page_id, line_num),
np AS (SELECT count(DISTINCT page_id) AS pages FROM cl),
fr AS (SELECT trim(text, ' ') AS k, count(DISTINCT page_id) AS n FROM cl WHERE trim(text, ' ') <> '' GROUP BY 1),
wi AS (SELECT *, sum(span) OVER p AS total_lines, CASE WHEN sum(text_length) OVER p > 0 THEN sum(text_length) OVER r / sum(text_length) OVER p ELSE 0 END AS cumulative, avg(text_length) OVER n AS mean_length, avg(link_ratio) OVER n AS mean_links,
  list_transform(regexp_extract_all(text, '\[([^\]]*)\]\(([^)]*)\)', 2), lambda u: regexp_replace(lower(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^[w.]+', '')) AS hosts,
  regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^[w.]+', '') AS own,
  length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS upper_n, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters, length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS digits,
  text_length - length(translate(text, '.,;:!?()[]{}"''-', '')) AS marks, len(list_distinct(list_transform(words, lambda w: lower(w)))) AS different, len(list_filter(labels, lambda x: length(x) < 10)) AS short_n
  FROM st WINDOW p AS (PARTITION BY page_id), r AS (PARTITION BY page_id ORDER BY line_num ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY page_id ORDER BY line_num ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))"""
)


@query(
    "WITH "
    + _FEATURES
    + r"""
SELECT page_id, dataset, line_num, CAST(total_lines AS BIGINT) AS total_lines, round(line_num / total_lines, 6) AS position_pct, CAST(text_length AS INTEGER) AS text_length, CAST(word_count AS INTEGER) AS word_count, round(link_ratio, 6) AS link_ratio, CAST(link_count AS INTEGER) AS link_count,
  is_link_only, is_heading, CAST(heading_level AS INTEGER) AS heading_level, CASE WHEN contains(text, '**') THEN 1 ELSE 0 END AS has_bold, is_list_item,
  CAST(marks AS INTEGER) AS punctuation_count, round(CASE WHEN text_length > 0 THEN marks / text_length ELSE 0 END, 6) AS punctuation_ratio, CAST(len(regexp_extract_all(text, '[.!?](?:\s|$)')) AS INTEGER) AS sentence_count,
  CASE WHEN word_count > 0 THEN round(CAST(list_sum(list_transform(words, lambda w: length(w))) AS DOUBLE) / word_count, 9) ELSE 0 END AS avg_word_length,
  CAST(upper_n AS INTEGER) AS uppercase_count, round(CASE WHEN letters > 0 THEN upper_n / letters ELSE 0 END, 6) AS uppercase_ratio, CAST(digits AS INTEGER) AS number_count, round(CASE WHEN text_length > 0 THEN digits / text_length ELSE 0 END, 6) AS number_ratio,
  CAST(different AS INTEGER) AS unique_word_count, round(CASE WHEN word_count > 0 THEN different / word_count ELSE 0 END, 6) AS type_token_ratio,
  CAST(short_n AS INTEGER) AS short_link_count, round(short_n / greatest(link_count, 1), 6) AS short_link_ratio, CAST(comma_count AS INTEGER) AS comma_count,
  CAST(len(list_filter(hosts, lambda h: h <> '' AND h <> coalesce(own, ''))) AS INTEGER) AS external_link_count, round(cumulative, 6) AS cumulative_text_pct, round(mean_length, 4) AS mean_text_length_w5, round(mean_links, 6) AS mean_link_ratio_w5,
  round(coalesce(mean_idf, 0), 6) AS mean_idf, round(coalesce(max_idf, 0), 6) AS max_idf, round(coalesce(word_novelty, 0), 9) AS word_novelty, round(coalesce(word_novelty_sum, 0), 9) AS word_novelty_sum, round(coalesce(bigram_novelty, 0), 9) AS bigram_novelty,
  round(coalesce(fr.n, 0) / (SELECT pages FROM np), 6) AS line_frequency,
  CASE WHEN list_bool_or(list_transform(ranges, lambda r: line_num >= coalesce(r."start", 0) AND line_num <= coalesce(r."end", 0))) THEN 1 ELSE 0 END AS label
FROM wi LEFT JOIN ws USING (page_id, line_num) LEFT JOIN bs USING (page_id, line_num) LEFT JOIN fr ON trim(text, ' ') = k WHERE NOT ck"""
)
def page_features_text(spark, folder):
    """The columns of the feature table that the markdown determines, from the walk over the html, against the markdown that was stored.

    Marks typed at the beginning of a text cannot be told from those of the
    view there, so they count as marks here.
    """
    rows, labels = _feature_parts(spark, folder)
    whole = F.concat("md_prefix", "text")
    mark = F.regexp_extract(whole, r"^(#{1,6} |- |[0-9]+\. )", 1)
    rows = rows.withColumn("__whole", whole).withColumn("md_prefix", mark).withColumn("text", F.substr("__whole", F.length(mark) + 1, F.length("__whole"))).drop("__whole")
    full = features.features_of(rows, labels).where("item_type = 'text'")
    digits = dict.fromkeys("position_pct link_ratio punctuation_ratio uppercase_ratio number_ratio type_token_ratio short_link_ratio cumulative_text_pct mean_link_ratio_w5 mean_idf max_idf line_frequency".split(), 6)
    digits |= dict.fromkeys("avg_word_length word_novelty word_novelty_sum bigram_novelty".split(), 9) | {"mean_text_length_w5": 4}
    whole_numbers = "text_length word_count link_count is_link_only is_heading heading_level has_bold is_list_item punctuation_count sentence_count uppercase_count number_count unique_word_count short_link_count comma_count external_link_count".split()
    return full.select("page_id", "dataset", "line_num", "total_lines", *whole_numbers, *[F.round(c, n).alias(c) for c, n in digits.items()], "label")
