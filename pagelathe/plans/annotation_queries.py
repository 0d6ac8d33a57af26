"""Queries over annotations, predictions, reviews and changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import ranges as R
from ..functions import scores as S
from ..functions import text as T
from ..operators import analysis, export, features, predictors, review, store, vote
from ..operators.current import latest
from ..operators.selection import selected_lines
from ..operators.skew import sifted
from ..sources.tables import read_table
from ..streaming import scrape
from .base import BLOCKS, CA, CP, LINES, MEASURED, current_annotations, current_pages, lines, measured, query, with_

# Ranges as text, so that both engines give the same value.
RT = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", F.coalesce(x["start"].cast("string"), F.lit("x")), F.coalesce(x["end"].cast("string"), F.lit("x")))), ",")
RTS = "array_to_string(list_transform({0}, lambda r: coalesce(CAST(r.\"start\" AS VARCHAR), 'x') || '-' || coalesce(CAST(r.\"end\" AS VARCHAR), 'x')), ',')"
LN = "list_sort(list_distinct(flatten(list_transform(list_filter({0}, lambda r: r.\"start\" <= r.\"end\"), lambda r: range(r.\"start\", r.\"end\" + 1)))))"
LAST = "mx AS (SELECT page_id, max(line_num) AS last_line FROM tl GROUP BY page_id)"


def _last(spark, folder):
    return lines(spark, folder).groupBy("page_id").agg(F.max("line_num").alias("last_line"))


def _queue(spark, folder):
    return review.with_annotations(current_pages(spark, folder, "url", "dataset", "urgent"), current_annotations(spark, folder))


QUEUE = "q AS (SELECT p.page_id, p.url, p.dataset, p.urgent, p.scraped_at, a.source, a.validated, a.skipped, a.has_cookies FROM cp p LEFT JOIN ca a USING (page_id) WHERE p.status = 'success')"
OPEN = "NOT coalesce(validated, FALSE) AND NOT coalesce(skipped, FALSE)"


@query(with_(CP, CA, QUEUE) + f" SELECT page_id, url, source, coalesce(has_cookies, FALSE) AS has_cookies FROM q WHERE {OPEN} AND url ILIKE '%aa%' ORDER BY coalesce(urgent, FALSE) DESC, url DESC, page_id LIMIT 25 OFFSET 25")
def review_list(spark, folder):
    rows = review.listed(_queue(spark, folder), "unvalidated", "AA", "url", "desc", 2)
    return rows.select("page_id", "url", "source", F.coalesce("has_cookies", F.lit(False)).alias("has_cookies"))


@query(with_(CP, CA, QUEUE) + f" SELECT count(*) AS total, greatest(CAST(ceil(count(*) / 25) AS BIGINT), 1) AS pages FROM q WHERE {OPEN}")
def review_count(spark, folder):
    return review.counted(_queue(spark, folder), "unvalidated")


@query(with_(CP, CA, QUEUE) + f' SELECT count(*) AS "all", count(*) FILTER (WHERE {OPEN}) AS unvalidated, count(*) FILTER (WHERE coalesce(validated, FALSE)) AS validated FROM q')
def tab_counts(spark, folder):
    return review.tab_counts(_queue(spark, folder))


@query(with_(CP, CA, QUEUE) + f" SELECT page_id, url FROM q WHERE {OPEN} AND page_id > 50 ORDER BY coalesce(urgent, FALSE) DESC, page_id LIMIT 1")
def next_unvalidated(spark, folder):
    return review.following(_queue(spark, folder), 50)


@query(with_(CP) + " SELECT page_id, url FROM cp WHERE status IS NULL")
def pending_scan(spark, folder):
    return review.pending(current_pages(spark, folder, "url"))


@query(with_(CP, CA) + " SELECT page_id, url FROM cp WHERE status = 'success' AND page_id NOT IN (SELECT page_id FROM ca WHERE page_id IS NOT NULL)")
def unannotated_pages(spark, folder):
    return review.unannotated(current_pages(spark, folder, "url", "urgent"), current_annotations(spark, folder))


@query(with_(CP, CA) + " SELECT page_id, url FROM cp WHERE status = 'success' AND urgent AND page_id NOT IN (SELECT page_id FROM ca WHERE page_id IS NOT NULL)")
def unannotated_urgent(spark, folder):
    return review.unannotated(current_pages(spark, folder, "url", "urgent"), current_annotations(spark, folder), True)


@query(with_(CP, CA) + f" SELECT page_id, url, coalesce(dataset, 'original') AS dataset, {RTS.format('ranges')} AS ranges FROM cp JOIN ca USING (page_id) WHERE status = 'success' AND validated AND source = 'manual'")
def annotated_pages(spark, folder):
    rows = review.annotated(current_pages(spark, folder, "url", "dataset"), current_annotations(spark, folder), "manual")
    return rows.withColumn("ranges", RT(F.col("ranges")))


@query(with_(LINES, CA) + ' SELECT tl.page_id, line_num, CASE WHEN list_bool_or(list_transform(ranges, lambda r: line_num >= coalesce(r."start", 0) AND line_num <= coalesce(r."end", 0))) THEN 1 ELSE 0 END AS label FROM tl JOIN ca USING (page_id)')
def label_overlap(spark, folder):
    rows = lines(spark, folder).join(current_annotations(spark, folder).select("page_id", "ranges"), "page_id")
    return rows.select("page_id", "line_num", R.overlaps(F.col("ranges"), F.col("line_num"), F.col("line_num")).alias("label"))


@query(with_(CA) + ', x AS (SELECT page_id, unnest(ranges) AS r, unnest(range(1, len(ranges) + 1)) AS i FROM ca) SELECT a.page_id, a.i, b.i AS j FROM x a JOIN x b ON a.page_id = b.page_id AND a.i < b.i AND a.r."start" <= b.r."end" AND a.r."end" >= b.r."start"')
def range_conflicts(spark, folder):
    flat = current_annotations(spark, folder).select("page_id", F.posexplode("ranges").alias("p", "r")).select("page_id", (F.col("p") + 1).cast("bigint").alias("i"), "r")
    other = flat.select("page_id", F.col("i").alias("j"), F.col("r").alias("s"))
    return flat.join(other, "page_id").where("i < j and r.start <= s.end and r.end >= s.start").select("page_id", "i", "j")


@query(with_(CA) + ', f AS (SELECT page_id, list_filter(ranges, lambda r: r."start" = 11 OR r."end" = 20)[1] AS r FROM ca) SELECT page_id, r."start" AS "start", r."end" AS "end" FROM f WHERE r IS NOT NULL')
def range_boundary(spark, folder):
    hit = F.try_element_at(F.filter("ranges", lambda r: (r["start"] == 11) | (r["end"] == 20)), F.lit(1))
    return current_annotations(spark, folder).select("page_id", hit.alias("r")).where("r is not null").select("page_id", "r.start", "r.end")


@query(with_(LINES, CA, LAST) + ', x AS (SELECT page_id, last_line, unnest(ranges) AS r FROM ca JOIN mx USING (page_id)) SELECT page_id, r."start" AS "start", r."end" AS "end", coalesce(lag(r."end") OVER w, 0) + 1 AS lowest_start, coalesce(lead(r."start") OVER w - 1, last_line) AS highest_end FROM x WINDOW w AS (PARTITION BY page_id ORDER BY r."start", r."end")')
def range_limits(spark, folder):
    rows = current_annotations(spark, folder).join(_last(spark, folder), "page_id").select("page_id", "last_line", F.inline("ranges"))
    return R.moved(rows, "last_line").drop("last_line")


@query(with_(CA) + f", x AS (SELECT page_id, unnest({LN.format('ranges')}) AS line FROM ca), y AS (SELECT page_id, line, line - row_number() OVER (PARTITION BY page_id ORDER BY line) AS run FROM x) SELECT page_id, CAST(min(line) AS INTEGER) AS \"start\", CAST(max(line) AS INTEGER) AS \"end\" FROM y GROUP BY page_id, run")
def lines_to_ranges(spark, folder):
    flat = current_annotations(spark, folder).select("page_id", F.explode(R.range_lines(F.col("ranges"))).alias("line_num"))
    return R.islands(flat, ["page_id"])


@query(with_(CA) + f", x AS (SELECT page_id, unnest({LN.format('ranges')}) AS line FROM ca), y AS (SELECT page_id, line, line - row_number() OVER (PARTITION BY page_id ORDER BY line) AS run FROM x), z AS (SELECT page_id, run, min(line) AS a, max(line) AS b FROM y GROUP BY page_id, run) SELECT page_id, string_agg(a || '-' || b, ',' ORDER BY a) AS ranges FROM z GROUP BY page_id")
def normal_ranges(spark, folder):
    rows = current_annotations(spark, folder).where("ranges is not null")
    return rows.select("page_id", RT(R.lines_ranges(R.range_lines(F.col("ranges")))).alias("ranges")).where("ranges <> ''")


_BAD = 'list_bool_or(list_transform(ranges, lambda r: r."start" IS NULL OR r."end" IS NULL OR r."start" < 1 OR r."start" > r."end"))'


@query(with_(LINES, CA, LAST) + f", v AS (SELECT page_id, CASE WHEN coalesce({_BAD}, FALSE) OR len(ranges) > 500 THEN NULL ELSE list_transform(list_filter(ranges, lambda r: r.\"start\" <= last_line), lambda r: {{'start': r.\"start\", 'end': least(r.\"end\", last_line)}}) END AS v FROM ca JOIN mx USING (page_id) WHERE ranges IS NOT NULL) SELECT page_id, {RTS.format('v')} AS ranges FROM v")
def validate_ranges_strict(spark, folder):
    rows = current_annotations(spark, folder).where("ranges is not null").join(_last(spark, folder), "page_id")
    return rows.select("page_id", RT(R.valid_strict(F.col("ranges"), F.col("last_line"))).alias("ranges"))


@query(with_(LINES, CA, LAST) + f", v AS (SELECT page_id, list_filter(ranges, lambda r: r.\"start\" >= 1 AND r.\"start\" <= r.\"end\" AND r.\"end\" <= last_line) AS v FROM ca JOIN mx USING (page_id) WHERE ranges IS NOT NULL) SELECT page_id, {RTS.format('v')} AS ranges FROM v")
def validate_ranges_lenient(spark, folder):
    rows = current_annotations(spark, folder).where("ranges is not null").join(_last(spark, folder), "page_id")
    return rows.select("page_id", RT(R.valid_lenient(F.col("ranges"), F.col("last_line"))).alias("ranges"))


@query(with_(CA) + f" SELECT page_id, ranges IS NOT NULL AND len(ranges) <= 500 AND NOT coalesce({_BAD}, FALSE) AND source IN ('manual', 'llm') AS ok FROM ca")
def acceptable_bodies(spark, folder):
    return current_annotations(spark, folder).select("page_id", R.acceptable(F.col("ranges"), F.col("source")).alias("ok"))


@query(with_(CA) + " SELECT page_id, CASE WHEN ranges IS NULL THEN NULL WHEN len(ranges) = 0 THEN '1:1' ELSE array_to_string(list_transform(ranges, lambda r: r.\"start\" || ':' || r.\"end\"), ',') END AS compact FROM ca")
def format_compact(spark, folder):
    return current_annotations(spark, folder).select("page_id", R.compact(F.col("ranges")).alias("compact"))


@query("WITH t AS (SELECT DISTINCT page_id, list_filter(messages, lambda m: m.role = 'assistant')[1].content AS answer FROM train WHERE messages IS NOT NULL), p AS (SELECT page_id, answer, string_split(answer, ',') AS parts FROM t WHERE answer IS NOT NULL), n AS (SELECT page_id, answer, list_filter(list_transform(parts, lambda x: {'start': TRY_CAST(split_part(x, ':', 1) AS INTEGER), 'end': TRY_CAST(split_part(x, ':', 2) AS INTEGER)}), lambda r: r.\"start\" >= 1 AND r.\"start\" <= r.\"end\" AND r.\"end\" <= 40) AS ranges, list_bool_and(list_transform(parts, lambda x: regexp_matches(trim(x), '^[0-9]+:[0-9]+$'))) AS good FROM p) SELECT page_id, answer, CASE WHEN good THEN " + RTS.format("ranges") + " END AS ranges FROM n")
def parse_compact(spark, folder):
    answer = F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(1))["content"]
    rows = read_table(spark, folder, "train").where("messages is not null").select("page_id", answer.alias("answer")).where("answer is not null").distinct()
    return rows.select("page_id", "answer", RT(R.parse_compact(F.col("answer"), F.lit(40))).alias("ranges"))


@query(with_(CA) + " SELECT page_id, CASE WHEN ranges IS NULL THEN 'N/A' WHEN len(ranges) = 0 THEN '[]' ELSE CASE WHEN length(t) > 15 THEN substr(t, 1, 12) || '...' ELSE t END END AS shown FROM (SELECT *, array_to_string(list_transform(ranges, lambda r: r.\"start\" || '-' || r.\"end\"), ', ') AS t FROM ca)")
def shown_ranges(spark, folder):
    return current_annotations(spark, folder).select("page_id", R.shown(F.col("ranges")).alias("shown"))


# ------------------------------------------------------------ predictions

_A = "an AS (SELECT page_id, " + ", ".join(f"max(list_sort(ranges)) FILTER (WHERE model_idx = {i}) AS a{i}" for i in range(3)) + " FROM predictions GROUP BY page_id)"


def _iou(a: str, b: str) -> str:
    i, u = f"len(list_intersect({a}, {b}))", f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {u} = 0 THEN 1.0 ELSE {i} / {u} END"


_L = "ln AS (SELECT *, " + ", ".join(f"{LN.format(f'a{i}')} AS l{i}" for i in range(3)) + " FROM an)"


@query(with_(_A) + f", m AS (SELECT page_id, CASE WHEN a0 = a1 THEN 'A+B' WHEN a0 = a2 THEN 'A+C' WHEN a1 = a2 THEN 'B+C' END AS label, CASE WHEN a0 = a1 OR a0 = a2 THEN a0 WHEN a1 = a2 THEN a1 END AS ranges FROM an) SELECT page_id, label, {RTS.format('ranges')} AS ranges FROM m WHERE label IS NOT NULL")
def majority_vote(spark, folder):
    table = vote.answers(read_table(spark, folder, "predictions"))
    ranges, label = vote.majority(table)
    return table.select("page_id", label.alias("label"), RT(ranges).alias("ranges")).where("label is not null")


_PAIRS = [(0, 1, "A|B"), (0, 2, "A|C"), (1, 2, "B|C")]
_CLOSE = (
    "cl AS ("
    + " UNION ALL ".join(f"SELECT page_id, {n} AS n, '{label}' AS label, {_iou(f'l{i}', f'l{j}')} AS iou, list_sort(list_distinct(list_concat(l{i}, l{j}))) AS lines FROM ln" for n, (i, j, label) in enumerate(_PAIRS))
    + "), best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY iou DESC, n) AS rn FROM cl WHERE iou IS NOT NULL) WHERE rn = 1)"
)


@query(with_(_A, _L, _CLOSE) + " SELECT page_id, label, round(iou, 6) AS iou, array_to_string(lines, ',') AS lines FROM best")
def closest_pair(spark, folder):
    table = vote.answers(read_table(spark, folder, "predictions"))
    ranges, label, iou = vote.closest_pair(table)
    rows = table.select("page_id", label.alias("label"), F.round(iou, 6).alias("iou"), F.array_join(R.range_lines(ranges), ",").alias("lines"))
    return rows.where("label is not null")


_OUT = "oc AS (SELECT an.page_id, (a0 IS NOT NULL)::INT + (a1 IS NOT NULL)::INT + (a2 IS NOT NULL)::INT AS answered, a0 = a1 AS ab, a0 = a2 AS ac, a1 = a2 AS bc, best.label AS near FROM an LEFT JOIN best USING (page_id))"


@query(with_(_A, _L, _CLOSE, _OUT) + " SELECT page_id, answered, CASE WHEN answered < 2 THEN 'failed' WHEN ab OR ac OR bc THEN 'agreed' ELSE 'merged' END AS outcome, CASE WHEN answered < 2 THEN NULL WHEN ab THEN 'A+B' WHEN ac THEN 'A+C' WHEN bc THEN 'B+C' ELSE near END AS label FROM oc")
def vote_outcome(spark, folder):
    return vote.outcomes(read_table(spark, folder, "predictions")).select("page_id", "answered", "outcome", "label")


@query(with_(CA, _A, _L) + f", tr AS (SELECT page_id, {LN.format('ranges')} AS t FROM ca WHERE validated AND source = 'manual' AND ranges IS NOT NULL), mm AS (SELECT ln.*, t, (a0 IS NOT NULL)::INT + (a1 IS NOT NULL)::INT + (a2 IS NOT NULL)::INT AS n, coalesce(a0 = a1, FALSE) OR coalesce(a0 = a2, FALSE) OR coalesce(a1 = a2, FALSE) AS agreed, CASE WHEN a0 = a1 OR a0 = a2 THEN l0 WHEN a1 = a2 THEN l1 END AS most FROM ln JOIN tr USING (page_id)) SELECT count(*) AS pages, count(*) FILTER (WHERE agreed AND n >= 2) AS agreed, count(*) FILTER (WHERE NOT agreed AND n >= 2) AS merged, count(*) FILTER (WHERE n < 2) AS failed, round(avg({_iou('most', 't')}), 6) AS majority_iou, round(avg({_iou('l0', 't')}), 6) AS iou_a, round(avg({_iou('l1', 't')}), 6) AS iou_b, round(avg({_iou('l2', 't')}), 6) AS iou_c FROM mm")
def vote_agreement(spark, folder):
    truth = current_annotations(spark, folder).where("validated and source = 'manual' and ranges is not null")
    got = vote.agreement(read_table(spark, folder, "predictions"), truth)
    return got.select("pages", "agreed", "merged", "failed", *[F.round(c, 6).alias(c) for c in ("majority_iou", "iou_a", "iou_b", "iou_c")])


def _metrics(spark, folder):
    table = vote.answers(read_table(spark, folder, "predictions")).select("page_id", F.col("a0").alias("ranges"))
    truth = current_annotations(spark, folder).where("validated and ranges is not null").select("page_id", R.range_lines(F.col("ranges")).alias("truth"))
    found = table.select("page_id", R.range_lines(F.col("ranges")).alias("found"))
    return found.join(truth, "page_id")


_MT = f"tr AS (SELECT page_id, {LN.format('ranges')} AS t FROM ca WHERE validated AND ranges IS NOT NULL), jm AS (SELECT page_id, l0 AS f, t, len(list_intersect(l0, t)) AS i FROM ln JOIN tr USING (page_id)), me AS (SELECT page_id, f, t, CASE WHEN f IS NULL THEN NULL WHEN len(f) = 0 AND len(t) = 0 THEN 1.0 ELSE i / (len(f) + len(t) - i) END AS iou, CASE WHEN f IS NULL THEN NULL WHEN len(f) = 0 AND len(t) = 0 THEN 1.0 WHEN len(f) = 0 THEN 0.0 ELSE i / len(f) END AS precision, CASE WHEN f IS NULL THEN NULL WHEN len(f) = 0 AND len(t) = 0 THEN 1.0 WHEN len(t) = 0 THEN 0.0 ELSE i / len(t) END AS recall FROM jm)"


@query(with_(CA, _A, _L, _MT) + " SELECT page_id, round(iou, 6) AS iou, round(precision, 6) AS precision, round(recall, 6) AS recall FROM me")
def iou_metrics(spark, folder):
    f, t = F.col("found"), F.col("truth")
    return _metrics(spark, folder).select("page_id", F.round(S.iou(f, t), 6).alias("iou"), F.round(S.precision(f, t), 6).alias("precision"), F.round(S.recall(f, t), 6).alias("recall"))


@query(with_(CA, _A, _L, _MT) + " SELECT page_id, round(CASE WHEN f IS NULL THEN 0.0 WHEN len(f) = 0 AND len(t) = 0 THEN 1.0 WHEN precision + recall = 0 THEN 0.0 ELSE 5 * precision * recall / (4 * precision + recall) END, 6) AS f_beta FROM me")
def fbeta(spark, folder):
    return _metrics(spark, folder).select("page_id", F.round(S.f_beta(F.col("found"), F.col("truth")), 6).alias("f_beta"))


@query(with_(CA, _A, _L, _MT) + " SELECT count(*) AS pages, count(iou) AS scored, round(avg(iou), 6) AS mean_iou, round(stddev_pop(iou), 6) AS std_iou, round(avg(precision), 6) AS mean_precision, round(avg(recall), 6) AS mean_recall, count(*) FILTER (WHERE iou < 0.5) AS bad, count(*) FILTER (WHERE iou > 0.9) AS good, count(*) FILTER (WHERE iou = 1.0) AS perfect FROM me")
def metric_summary(spark, folder):
    f, t = F.col("found"), F.col("truth")
    rows = _metrics(spark, folder).select("page_id", S.iou(f, t).alias("iou"), S.precision(f, t).alias("precision"), S.recall(f, t).alias("recall"))
    got = analysis.metric_summary(rows)
    return got.select(*[F.round(c, 6).alias(c) if c.startswith(("mean", "std")) else F.col(c) for c in got.columns])


@query(with_(CA, _A, _L, _MT) + " SELECT page_id, round(iou, 6) AS iou FROM me WHERE iou IS NOT NULL ORDER BY me.iou, page_id LIMIT 10")
def worst_pages(spark, folder):
    rows = _metrics(spark, folder).select("page_id", S.iou(F.col("found"), F.col("truth")).alias("iou"))
    return analysis.worst(rows).select("page_id", F.round("iou", 6).alias("iou"))


@query(r"SELECT page_id, model_idx, trim(CASE WHEN regexp_matches(response, '(?s)```(?:json)?\s*.*?```') THEN regexp_extract(response, '(?s)```(?:json)?\s*(.*?)```', 1) ELSE response END, E' \t\r\n') AS body FROM predictions WHERE response IS NOT NULL")
def extract_json(spark, folder):
    return read_table(spark, folder, "predictions").where("response is not null").select("page_id", "model_idx", A.json_part(F.col("response")).alias("body"))


@query(r"""WITH b AS (SELECT page_id, model_idx, trim(CASE WHEN regexp_matches(response, '(?s)```(?:json)?\s*.*?```') THEN regexp_extract(response, '(?s)```(?:json)?\s*(.*?)```', 1) ELSE response END, E' \t\r\n') AS body FROM predictions WHERE response IS NOT NULL),
j AS (SELECT page_id, model_idx, CASE WHEN body LIKE '[%' AND json_valid(body) THEN from_json(body, '[{"start":"INTEGER","end":"INTEGER"}]') END AS ranges FROM b) SELECT page_id, model_idx, """ + RTS.format("ranges") + " AS ranges FROM j")
def json_ranges(spark, folder):
    rows = read_table(spark, folder, "predictions").where("response is not null")
    return rows.select("page_id", "model_idx", RT(A.json_ranges(F.col("response"))).alias("ranges"))


_N = "[0-9]+:[0-9]+"


@query(
    "WITH t AS (SELECT list_filter(messages, lambda m: m.role = 'assistant')[1].content AS answer FROM train WHERE messages IS NOT NULL UNION SELECT response FROM predictions)"
    f" SELECT answer, regexp_full_match(answer, '{_N}(,{_N})*') AS accepted, CASE WHEN answer = '' THEN 0 WHEN regexp_full_match(answer, '({_N},)*[0-9]+') THEN 1 WHEN regexp_full_match(answer, '({_N},)*[0-9]+:') THEN 2"
    f" WHEN regexp_full_match(answer, '{_N}(,{_N})*') THEN 3 WHEN regexp_full_match(answer, '({_N},)+') THEN 4 ELSE -1 END AS state FROM t WHERE answer IS NOT NULL"
)
def grammar_accept(spark, folder):
    """Every different answer of the training rows and of the models."""
    answer = F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(1))["content"]
    said = read_table(spark, folder, "train").where("messages is not null").select(answer.alias("answer"))
    rows = said.union(read_table(spark, folder, "predictions").select("response")).where("answer is not null").distinct()
    return rows.select("answer", A.accepted(F.col("answer")).alias("accepted"), A.grammar_state(F.col("answer")).alias("state"))


# ------------------------------------------------------------ changes

_ROW = f"page_id, {RTS.format('ranges')} AS ranges, source, validated, skipped, has_cookies"
_VIEW = lambda df: df.select("page_id", RT(F.col("ranges")).alias("ranges"), "source", "validated", "skipped", "has_cookies")


def _changes(spark, folder):
    return vote.outcomes(read_table(spark, folder, "predictions")).where("outcome <> 'failed'").select("page_id", "ranges", "validated", F.to_timestamp(F.lit("2026-11-01 00:00:00")).alias("at"))


_CH = "ch AS (SELECT page_id, CASE WHEN ab OR ac THEN a0 WHEN bc THEN a1 ELSE z.ranges END AS ranges, coalesce(ab, FALSE) OR coalesce(ac, FALSE) OR coalesce(bc, FALSE) AS validated FROM oc JOIN an USING (page_id) LEFT JOIN z USING (page_id) WHERE answered >= 2)"
_Z = "zl AS (SELECT page_id, unnest(lines) AS line FROM best), zr AS (SELECT page_id, line, line - row_number() OVER (PARTITION BY page_id ORDER BY line) AS run FROM zl), zz AS (SELECT page_id, run, CAST(min(line) AS INTEGER) AS a, CAST(max(line) AS INTEGER) AS b FROM zr GROUP BY page_id, run), zg AS (SELECT page_id, list({'start': a, 'end': b} ORDER BY a) AS ranges FROM zz GROUP BY page_id), z AS (SELECT best.page_id, coalesce(zg.ranges, []) AS ranges FROM best LEFT JOIN zg USING (page_id))"
_CHG = (_A, _L, _CLOSE, _OUT, _Z, _CH)


@query(with_(CA, *_CHG) + f", j AS (SELECT coalesce(ca.page_id, ch.page_id) AS page_id, CASE WHEN ch.page_id IS NOT NULL THEN ch.ranges ELSE ca.ranges END AS ranges, CASE WHEN ch.page_id IS NOT NULL THEN 'llm' ELSE source END AS source, CASE WHEN ch.page_id IS NOT NULL THEN ch.validated ELSE ca.validated END AS validated, CASE WHEN ch.page_id IS NOT NULL THEN FALSE ELSE skipped END AS skipped, CASE WHEN ca.page_id IS NULL THEN FALSE ELSE has_cookies END AS has_cookies FROM ca FULL JOIN ch ON ca.page_id = ch.page_id) SELECT {_ROW} FROM j")
def upsert_answers(spark, folder):
    return _VIEW(store.save_answers(current_annotations(spark, folder), _changes(spark, folder)))


@query(with_(CA, *_CHG) + f", j AS (SELECT coalesce(ca.page_id, ch.page_id) AS page_id, CASE WHEN ch.page_id IS NOT NULL THEN ch.ranges ELSE ca.ranges END AS ranges, CASE WHEN ch.page_id IS NOT NULL THEN 'manual' ELSE source END AS source, CASE WHEN ch.page_id IS NOT NULL THEN TRUE ELSE ca.validated END AS validated, CASE WHEN ch.page_id IS NOT NULL THEN FALSE ELSE skipped END AS skipped, CASE WHEN ca.page_id IS NULL THEN FALSE ELSE has_cookies END AS has_cookies FROM ca FULL JOIN ch ON ca.page_id = ch.page_id) SELECT {_ROW} FROM j")
def upsert_save(spark, folder):
    return _VIEW(store.save(current_annotations(spark, folder), _changes(spark, folder).withColumn("source", F.lit("manual")).drop("validated")))


@query(with_(CP, CA) + f", hit AS (SELECT page_id FROM cp WHERE status = 'skipped'), j AS (SELECT coalesce(ca.page_id, hit.page_id) AS page_id, CASE WHEN ca.page_id IS NULL THEN [] ELSE ranges END AS ranges, CASE WHEN ca.page_id IS NULL THEN 'manual' ELSE source END AS source, CASE WHEN hit.page_id IS NOT NULL THEN FALSE ELSE validated END AS validated, CASE WHEN hit.page_id IS NOT NULL THEN TRUE ELSE skipped END AS skipped, CASE WHEN ca.page_id IS NULL THEN FALSE ELSE has_cookies END AS has_cookies FROM ca FULL JOIN hit ON ca.page_id = hit.page_id) SELECT {_ROW} FROM j")
def upsert_skip(spark, folder):
    hit = current_pages(spark, folder).where("status = 'skipped'").select("page_id", F.to_timestamp(F.lit("2026-11-01 00:00:00")).alias("at"))
    return _VIEW(store.skip(current_annotations(spark, folder), hit))


@query(with_(CP, CA) + f", hit AS (SELECT page_id FROM cp WHERE urgent), j AS (SELECT coalesce(ca.page_id, hit.page_id) AS page_id, CASE WHEN ca.page_id IS NULL THEN [] ELSE ranges END AS ranges, CASE WHEN ca.page_id IS NULL THEN 'manual' ELSE source END AS source, CASE WHEN ca.page_id IS NULL THEN FALSE ELSE validated END AS validated, CASE WHEN ca.page_id IS NULL THEN FALSE ELSE skipped END AS skipped, CASE WHEN hit.page_id IS NOT NULL THEN NOT coalesce(has_cookies, FALSE) ELSE has_cookies END AS has_cookies FROM ca FULL JOIN hit ON ca.page_id = hit.page_id) SELECT {_ROW} FROM j")
def toggle_flag(spark, folder):
    hit = current_pages(spark, folder, "urgent").where("urgent").select("page_id", F.to_timestamp(F.lit("2026-11-01 00:00:00")).alias("at"))
    return _VIEW(store.toggle_cookies(current_annotations(spark, folder), hit))


@query(with_(CP, CA) + f" SELECT {_ROW.replace('validated', 'CASE WHEN urgent THEN TRUE ELSE validated END AS validated').replace('skipped', 'CASE WHEN urgent THEN FALSE ELSE skipped END AS skipped')} FROM ca LEFT JOIN (SELECT page_id, urgent FROM cp WHERE urgent) USING (page_id)")
def accept_annotation(spark, folder):
    hit = current_pages(spark, folder, "urgent").where("urgent").select("page_id", F.to_timestamp(F.lit("2026-11-01 00:00:00")).alias("at"))
    return _VIEW(store.accept(current_annotations(spark, folder), hit))


@query(with_(CP) + ", oc AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'skipped' END AS s FROM cp WHERE status IS NULL) SELECT page_id, coalesce(s, status) AS status, CASE WHEN s IS NULL OR s = 'success' THEN error ELSE 'tried' END AS error, CASE WHEN s = 'success' THEN '<p>new</p>' ELSE html END AS html FROM cp LEFT JOIN oc USING (page_id)")
def status_update(spark, folder):
    pages = current_pages(spark, folder, "error", "html", "markdown")
    status = F.when(F.col("page_id") % 3 == 0, "success").when(F.col("page_id") % 3 == 1, "failed").otherwise("skipped")
    outcomes = pages.where("status is null").select(
        "page_id", status.alias("status"), F.lit("tried").alias("error"), F.lit("<p>new</p>").alias("html"), F.lit(" 1 | new").alias("markdown"), F.to_timestamp(F.lit("2026-11-01 00:00:00")).alias("at")
    )
    return store.record_scrapes(pages, outcomes).select("page_id", "status", "error", "html")


@query(with_(CP) + " SELECT coalesce(status, 'pending') AS status, count(*) AS n FROM cp GROUP BY 1")
def scrape_counts(spark, folder):
    return scrape.scrape_counts(current_pages(spark, folder).select(F.coalesce("status", F.lit("pending")).alias("status")))


# ------------------------------------------------------------ splits, rows and rates


@query(with_(CP) + ", m AS (SELECT DISTINCT unnest(test_page_ids) AS page_id FROM split_manifest), t AS (SELECT DISTINCT unnest(train_page_ids) AS page_id FROM split_manifest) SELECT page_id, url, CASE WHEN page_id IN (FROM m) THEN 1 ELSE 0 END AS in_test, CASE WHEN page_id IN (FROM m) OR page_id IN (FROM t) THEN 1 ELSE 0 END AS in_any FROM cp WHERE status = 'success'")
def split_semi_anti(spark, folder):
    pages = current_pages(spark, folder, "url").where("status = 'success'").select("page_id", "url")
    manifest = read_table(spark, folder, "split_manifest")
    test = export.split_by_manifest(pages, manifest, "test").select("page_id", F.lit(1).alias("in_test"))
    none = export.not_in_manifest(pages, manifest).select("page_id", F.lit(0).alias("in_any"))
    return pages.join(test, "page_id", "left").join(none, "page_id", "left").select("page_id", "url", F.coalesce("in_test", F.lit(0)).alias("in_test"), F.coalesce("in_any", F.lit(1)).alias("in_any"))


@query(with_(CP, CA) + f" SELECT page_id, '{export.SYSTEM}' || chr(10) || markdown || chr(10) || CASE WHEN ranges IS NULL OR len(ranges) = 0 THEN '1:1' ELSE array_to_string(list_transform(ranges, lambda r: r.\"start\" || ':' || r.\"end\"), ',') END AS said, url FROM cp JOIN ca USING (page_id) WHERE status = 'success' AND validated")
def chat_rows(spark, folder):
    pages = current_pages(spark, folder, "url", "markdown").where("status = 'success'").withColumnRenamed("markdown", "light")
    rows = export.chat_rows(pages.join(current_annotations(spark, folder).where("validated").select("page_id", "ranges"), "page_id"))
    return rows.select("page_id", F.array_join(F.col("messages.content"), "\n").alias("said"), "url")


@query("WITH a AS (SELECT user_id AS domain, event_id, epoch(ts) AS arrival, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts), event_id) - 1 AS k FROM events) SELECT domain, event_id, round(max(arrival - k * 10) OVER (PARTITION BY domain ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) + k * 10, 3) AS start FROM a")
def rate_limit_schedule(spark, folder):
    events = read_table(spark, folder, "events").select(F.col("user_id").alias("domain"), F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("arrival"))
    return scrape.schedule(events, 10.0).select("domain", F.col("seq").alias("event_id"), F.round("start", 3).alias("start"))


@query(with_(LINES) + r", dk AS (SELECT page_id, list_distinct(list_transform(regexp_extract_all(html, '[a-zA-Z0-9À-ɏ]{3,}'), lambda w: lower(w))) AS dk FROM cp WHERE status = 'success' AND page_id IN (SELECT page_id FROM annotations)), lk AS (SELECT page_id, line_num, list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z0-9À-ɏ]{3,}'), lambda w: lower(w))) AS kw FROM tl), j AS (SELECT page_id, line_num, len(list_intersect(kw, dk)) / len(kw) AS share FROM lk JOIN dk USING (page_id) WHERE len(kw) > 0) SELECT page_id, line_num, round(share, 6) AS share FROM j WHERE share >= 0.5")
def keyword_containment(spark, folder):
    known = read_table(spark, folder, "annotations").select("page_id").distinct()
    scrapes = sifted(read_table(spark, folder, "pages"), known, "page_id").select("page_id", "scraped_at", "status", T.keywords(F.col("html")).alias("kw"))
    docs = latest(scrapes, "page_id", "scraped_at").where("status = 'success'").join(known, "page_id", "left_semi").select("page_id", "kw")
    rows = lines(spark, folder).select("page_id", "line_num", T.keywords(F.col("text")).alias("kw"))
    return analysis.keyword_lines(rows, docs).select("page_id", "line_num", F.round("share", 6).alias("share"))


_NORM = r"array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(regexp_replace(text, '!?\[([^\]]*)\]\([^)]*\)', '\1', 'g')), '[^0-9A-Za-z_\s]', '', 'g'), ' +', ' ', 'g'), ' '), ' '), lambda w: w <> ''), ' ')"


@query(
    with_(LINES)
    + f""",
sw AS (SELECT page_id, line_num, {_NORM} AS words FROM tl),
bg AS (SELECT *, greatest(coalesce(sum(CASE WHEN words <> '' THEN length(words) + 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY line_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1, 0) AS begins FROM sw),
pg AS (SELECT page_id, string_agg(words, ' ' ORDER BY line_num) FILTER (WHERE words <> '') AS aw FROM sw GROUP BY page_id),
se AS (SELECT page_id, line_num AS selection, string_split(words, ' ') AS w FROM sw WHERE words <> ''),
ht AS (SELECT page_id, selection, array_to_string(w[1:5], ' ') AS head, array_to_string(w[greatest(len(w) - 4, 1):len(w)], ' ') AS tail FROM se),
fp AS (SELECT page_id, selection, tail, instr(aw, head) AS s, CASE WHEN head = tail THEN instr(aw, head) ELSE length(aw) - instr(reverse(aw), reverse(tail)) - length(tail) + 2 END AS f FROM ht JOIN pg USING (page_id)),
ab AS (SELECT fp.page_id, selection, max(line_num) FILTER (WHERE begins <= s - 1) AS a, max(line_num) FILTER (WHERE begins <= f - 1 + length(tail)) AS b FROM fp JOIN bg USING (page_id) GROUP BY fp.page_id, selection, s, f, tail)
SELECT page_id, selection, least(a, b) AS first_line, greatest(a, b) AS last_line FROM ab"""
)
def selection_lines(spark, folder):
    """Every line of a page, taken as a selected text, is found again."""
    rows = lines(spark, folder)
    picked = rows.select("page_id", F.col("line_num").alias("selection"), F.col("text").alias("selected"))
    return selected_lines(rows, picked)


@query(
    with_(MEASURED, BLOCKS, CA)
    + f""",
tr AS (SELECT page_id, {LN.format('ranges')} AS t FROM ca WHERE validated AND ranges IS NOT NULL),
bt AS (SELECT page_id, block, sum(text_length) AS t FROM bl GROUP BY page_id, block),
bb AS (SELECT page_id, block, t, row_number() OVER (PARTITION BY page_id ORDER BY t DESC, block) AS rn, sum(t) OVER (PARTITION BY page_id) AS total FROM bt),
fo AS (SELECT 'long_lines' AS method, page_id, coalesce(list(line_num ORDER BY line_num) FILTER (WHERE text_length >= 40 AND link_ratio < 0.5), []) AS f FROM bl GROUP BY page_id
 UNION ALL SELECT 'largest_block', bl.page_id, coalesce(list(bl.line_num ORDER BY bl.line_num) FILTER (WHERE bb.block IS NOT NULL), []) FROM bl LEFT JOIN bb ON bl.page_id = bb.page_id AND bl.block = bb.block AND bb.rn = 1 AND bb.t > 0.5 * bb.total GROUP BY bl.page_id),
jm AS (SELECT method, page_id, f, t, len(list_intersect(f, t)) AS i FROM fo JOIN tr USING (page_id))
SELECT method, page_id, round(CASE WHEN len(f) = 0 AND len(t) = 0 THEN 1.0 ELSE i / (len(f) + len(t) - i) END, 6) AS iou FROM jm"""
)
def method_comparison(spark, folder):
    rows = features.with_content_region(features.with_blocks(measured(spark, folder), ("level",)))
    truth = current_annotations(spark, folder).where("validated and ranges is not null").select("page_id", R.range_lines(F.col("ranges")).alias("truth"))
    return predictors.compare(rows, truth).select("method", "page_id", F.round("iou", 6).alias("iou"))
