"""The queries p1 to p10: each takes a session and the folder of the tables."""

from __future__ import annotations

from ..sources.tables import read_table
from . import p1_main_body, p10_spam, p2_overlap, p3_clean_text, p4_residue, p5_repeated_lines, p6_near_pages, p7_splits, p8_encoding, p9_mixing
from .page_model import PageModel

_models: dict[tuple[str, str], PageModel] = {}


def page_model(spark, folder) -> PageModel:
    """The page models of the tables of a folder: fitted by the first query of a session that needs them, then shared."""
    return _models.setdefault((spark.sparkContext.applicationId, folder), PageModel())


def p1_found(spark, folder):
    return p1_main_body.found(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p1_texts(spark, folder):
    return p1_main_body.texts(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p2_found(spark, folder):
    return p2_overlap.found(read_table(spark, folder, "train"), read_table(spark, folder, "test"))


def p2_report(spark, folder):
    return p2_overlap.report(read_table(spark, folder, "train"), read_table(spark, folder, "test"))


def p3_found(spark, folder):
    return p3_clean_text.found(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p3_cleaned(spark, folder):
    return p3_clean_text.cleaned(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p4_found(spark, folder):
    return p4_residue.found(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p4_kept(spark, folder):
    return p4_residue.kept(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p5_found(spark, folder):
    return p5_repeated_lines.found(read_table(spark, folder, "pages"))


def p5_cleaned(spark, folder):
    return p5_repeated_lines.without_repeated(read_table(spark, folder, "pages"))


def p6_found(spark, folder):
    return p6_near_pages.found(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p6_groups(spark, folder):
    return p6_near_pages.groups(read_table(spark, folder, "pages"), read_table(spark, folder, "annotations"), page_model(spark, folder))


def p7_found(spark, folder):
    return p7_splits.found(read_table(spark, folder, "pages"), read_table(spark, folder, "split_manifest"))


def p7_assignment(spark, folder):
    return p7_splits.new_splits(read_table(spark, folder, "pages"))


def p8_ids(spark, folder):
    return p8_encoding.encode(read_table(spark, folder, "documents"))


def p9_selection(spark, folder):
    targets = read_table(spark, folder, "mix_targets")
    return p9_mixing.mix(p9_mixing.sizes_of(read_table(spark, folder, "documents")), targets).select("doc_id", "source", "copies")


def p9_shares(spark, folder):
    targets = read_table(spark, folder, "mix_targets")
    return p9_mixing.shares(p9_mixing.mix(p9_mixing.sizes_of(read_table(spark, folder, "documents")), targets), targets)


def p10_found(spark, folder):
    return p10_spam.found(read_table(spark, folder, "documents"))


def p10_scores(spark, folder):
    return p10_spam.scores(read_table(spark, folder, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit() and name[2:3] in "_0" and callable(f)}


# What problems 2, 5 and 7 ask for is defined by rules that SQL can state, so their whole results can be compared.
_P5 = r"""
WITH cur AS (SELECT page_id, url, markdown, status, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST) rn FROM (SELECT DISTINCT page_id, url, markdown, status, scraped_at FROM pages)),
p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', '') AS site, markdown FROM cur WHERE rn = 1 AND status = 'success'),
l AS (SELECT site, page_id, unnest(string_split(markdown, chr(10))) AS raw FROM p),
n AS (SELECT site, page_id, CAST(regexp_extract(raw, '^\s*([0-9]+) \|', 1) AS INT) AS line_num,
  array_to_string(regexp_extract_all(lower(regexp_replace(regexp_replace(raw, '^\s*[0-9]+ \|\s*', ''), '\]\([^)]*\)', ']', 'g')), '\p{L}+'), ' ') AS k FROM l WHERE regexp_matches(raw, '^\s*[0-9]+ \|')),
f AS (SELECT * FROM n WHERE length(replace(k, ' ', '')) >= 10),
s AS (SELECT site, count(*) AS pages FROM p GROUP BY site),
r AS (SELECT f.site, k FROM f JOIN s USING (site) GROUP BY f.site, k, s.pages HAVING count(DISTINCT page_id) >= 4 AND count(DISTINCT page_id) >= 0.2 * s.pages)
SELECT page_id, line_num FROM f JOIN r USING (site, k)
"""

# Bodies by the lines that the answer names, their different runs of three words, and pairs that share enough of them.
_P2_SIDE = r"""
{0}_u AS (SELECT DISTINCT page_id, list_filter(messages, lambda m: m.role = 'user')[-1].content AS u, list_filter(messages, lambda m: m.role = 'assistant')[-1].content AS a
  FROM {0} WHERE messages IS NOT NULL AND page_id IS NOT NULL),
{0}_l AS (SELECT page_id, a, unnest(string_split(u, chr(10))) AS raw, unnest(range(0, len(string_split(u, chr(10))))) AS pos FROM {0}_u
  WHERE regexp_full_match(trim(a), '[0-9]+:[0-9]+(,[0-9]+:[0-9]+)*')),
{0}_n AS (SELECT page_id, a, pos, CAST(regexp_extract(raw, '^\s*([0-9]+) \|', 1) AS INT) AS n, regexp_replace(raw, '^\s*[0-9]+ \| ?', '') AS t FROM {0}_l WHERE regexp_matches(raw, '^\s*[0-9]+ \|')),
{0}_k AS (SELECT page_id, a, pos, t FROM {0}_n
  WHERE list_bool_or(list_transform(string_split(trim(a), ','), lambda r: n BETWEEN CAST(split_part(r, ':', 1) AS INT) AND CAST(split_part(r, ':', 2) AS INT)))),
{0}_w AS (SELECT page_id, a, regexp_extract_all(lower(regexp_replace(string_agg(t, chr(10) ORDER BY pos), '\]\([^)]*\)', ']', 'g')), '[\p{{L}}\p{{N}}]+') AS w FROM {0}_k GROUP BY page_id, a),
{0}_s AS (SELECT DISTINCT page_id, a, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT page_id, a, w, unnest(range(1, len(w) - 1)) AS i FROM {0}_w)),
{0}_c AS (SELECT page_id, a, count(*) AS c FROM {0}_s GROUP BY page_id, a)"""
_P2 = (
    "WITH "
    + _P2_SIDE.format("train").strip()
    + ","
    + _P2_SIDE.format("test")
    + """,
pr AS (SELECT x.page_id AS p, x.a AS pa, y.page_id AS q, y.a AS qa, count(*) AS k FROM train_s x JOIN test_s y ON x.s = y.s GROUP BY 1, 2, 3, 4)
SELECT DISTINCT least(p, q) AS page_id_1, greatest(p, q) AS page_id_2 FROM pr JOIN train_c x ON x.page_id = p AND x.a = pa JOIN test_c y ON y.page_id = q AND y.a = qa
WHERE k >= 0.6 * (x.c + y.c - k)"""
)

# Sites and handles that a page of a manifest row joins, and what can be reached from a training page's site.
_P7 = r"""
WITH RECURSIVE cur AS (SELECT page_id, url, status, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST) AS rn FROM (SELECT DISTINCT page_id, url, status, scraped_at FROM pages)),
p AS (SELECT page_id, 's:' || regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', '') AS site,
  lower(coalesce(nullif(regexp_extract(regexp_replace(url, '^[A-Za-z]+://[^/?#]*', ''), '^[^?#]*?/(?:(?:author|authors|user|users)/|[@~])([^/?#]+)', 1), ''), nullif(regexp_extract(url, '[?&]author=([^&#]+)', 1), ''))) AS handle
  FROM cur WHERE rn = 1 AND status = 'success'),
m AS (SELECT seed, unnest(train_page_ids) AS page_id, 'train' AS side FROM split_manifest UNION SELECT seed, unnest(test_page_ids), 'test' FROM split_manifest),
k AS (SELECT m.seed, m.page_id, m.side, p.site, 'h:' || p.handle AS handle FROM m JOIN p USING (page_id)),
e AS (SELECT DISTINCT seed, site AS a, handle AS b FROM k WHERE handle IS NOT NULL UNION SELECT DISTINCT seed, handle, site FROM k WHERE handle IS NOT NULL),
r AS (SELECT DISTINCT seed, site AS node FROM k WHERE side = 'train' UNION SELECT r.seed, e.b FROM r JOIN e ON r.seed = e.seed AND r.node = e.a)
SELECT DISTINCT k.seed, k.page_id FROM k JOIN r ON k.seed = r.seed AND k.site = r.node WHERE side = 'test'
"""


def oracle_sql() -> dict:
    return {"p2_found": _P2, "p5_found": _P5, "p7_found": _P7}
