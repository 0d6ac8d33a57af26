"""Problems 1, 3, 4 and 6 on the small tables and on odd rows."""

import datetime as dt
import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelathe.llm import markup, p1_main_body, p3_clean_text, p4_residue, p6_near_pages, page_model, pages, residue_model, shingles
from pagelathe.llm.lines import lines_of
from pagelathe.operators.html_walk import walk
from pagelathe.sources.tables import read_table

PAGE = "page_id bigint, url string, html string, status string, scraped_at timestamp, lines string, residue int"
ANN = "page_id bigint, ranges array<struct<start:int,end:int>>, source string, validated boolean, created_at timestamp, updated_at timestamp"
T0, T1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return read_table(spark, folder, "pages"), read_table(spark, folder, "annotations")


@pytest.fixture(scope="module")
def model(tables):
    return pages.fit_page_model(*tables)


def test_regions():
    best = page_model.best_regions
    assert best([], 1.0) == best([-1.0, -2.0], 1.0) == best([0.5], 1.0) == []
    assert best([-9.0, 3.0, -0.5, 3.0, -9.0], 1.0) == [(1, 3)]  # a doubtful line does not end a region
    assert best([3.0, -2.0, 3.0], 1.0) == [(0, 0), (2, 2)]  # one that costs more than a new region does
    assert best([-9.0, 0.8, -9.0, 3.0, 0.1], 1.0) == [(3, 4)]  # a lonely doubtful line begins none


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=9), st.integers(1, 4))
def test_regions_are_the_best_of_all(scores, cost):
    def worth(chosen):
        begins = sum(c and not (i and chosen[i - 1]) for i, c in enumerate(chosen))
        return sum(s for s, c in zip(scores, chosen) if c) - cost * begins

    regions = page_model.best_regions([float(s) for s in scores], float(cost))
    got = [any(a <= i <= b for a, b in regions) for i in range(len(scores))]
    assert worth(got) == max(map(worth, itertools.product([False, True], repeat=len(scores))))


def test_expected_regions_against_all_choices():
    r = np.random.default_rng(4)
    scores, cost = r.normal(0, 2, 6), 1.3
    total, lines, regions = 0.0, np.zeros(6), 0.0
    for chosen in itertools.product([0, 1], repeat=6):
        begins = sum(c and not (i and chosen[i - 1]) for i, c in enumerate(chosen))
        w = np.exp(np.dot(scores, chosen) - cost * begins)
        total, lines, regions = total + w, lines + w * np.array(chosen), regions + w * begins
    padded, is_line = np.zeros((1, 8)), np.arange(8)[None, :] < 6
    padded[0, :6] = scores
    got, n = page_model._expected(padded, is_line, cost)
    assert np.allclose(got[0, :6], lines / total) and np.isclose(n, regions / total) and not got[0, 6:].any()


def test_main_body_on_pages_kept_from_the_fit(spark, tables):
    rows, ann = tables
    held = F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0
    fitted = pages.fit_body_model(rows, ann.where(~held))
    truth = pages.validated_annotations(ann.where(held)).where("source = 'manual' and size(ranges) > 0")
    want = truth.select("page_id", F.explode(F.flatten(F.transform("ranges", lambda r: F.when(r["start"] <= r["end"], F.sequence(r["start"], r["end"])).otherwise(F.array())))).alias("n")).distinct()
    got = p1_main_body.main_bodies(rows, ann, fitted).join(truth.select("page_id"), "page_id", "left_semi").select("page_id", F.explode("lines").alias("n"))
    hits, found, wanted = got.join(want, ["page_id", "n"]).count(), got.count(), want.count()
    assert hits / found > 0.95 and hits / wanted > 0.93


def test_found_leaves_out_validated_and_residue_pages(spark, tables, model):
    rows, ann = tables
    got = {r.page_id for r in p1_main_body.found(rows, ann, model).select("page_id").distinct().collect()}
    assert not got & {r.page_id for r in pages.validated_annotations(ann).collect()}
    assert not got & {r.page_id for r in p4_residue.found(rows, ann, model).collect()}
    assert len(got) > 80


BODY = "<body><h1>Why Kelba moved</h1>" + "".join(f"<p>What surprised the town in {1900 + i} was how slowly the {w} had been moved near the old harbour, because nobody wanted it.</p>" for i, w in enumerate("bridge tower kiln mill ferry".split())) + "</body>"
ODD = [
    (1, "http://a.b/1", "<body><h1>Page not found</h1><p>The link may be broken, or the page may have been moved.</p></body>", "failed", T0, "x", 1),
    (2, "http://a.b/2", "<body><h1>{{ title }}</h1><p>{{ body }}</p><p>Dear {{ name }}</p></body>", "success", T0, None, None),
    (3, "http://a.b/3", BODY, "success", T0, None, None),
    (3, "http://a.b/3", BODY, "success", T0, None, None),
    (4, "http://a.b/4", "<body><p>old</p></body>", "success", None, None, None),
    (4, "http://a.b/4", BODY, "success", T1, None, None),
    (5, None, None, "success", T0, None, None),
    (6, None, "", None, T0, None, None),
    (7, "http://a.b/7", "<body>" + "<div>" * 3000 + "<p>" + "Nobody in the harbour expected that slow ferries would need more ropes than the old mill. " * 20000 + "</p></body>", "success", T0, None, None),
    (None, "http://a.b/8", BODY, "success", T0, None, None),
]


def test_odd_rows(spark, model):
    rows = spark.createDataFrame(ODD, PAGE)
    none = spark.createDataFrame([(99, None, None, None, None, None)], ANN)
    residue = {r.page_id for r in p4_residue.found(rows, none, model).collect()}
    assert {1, 2} <= residue and not residue & {3, 4, 5, 6, 7}
    body = {(r.page_id, r.line_num) for r in p1_main_body.found(rows, none, model).collect()}
    assert {(3, i) for i in range(1, 7)} | {(4, i) for i in range(1, 7)} <= body and not {p for p, _ in body} & {1, 2, 5, 6}
    texts = {r.page_id: r.text for r in p1_main_body.texts(rows, none, model).collect()}
    assert set(texts) == {3, 4, 7} and texts[3].startswith("# Why Kelba moved\nWhat surprised") and texts[3] == texts[4]
    assert sorted(r.page_id for r in p4_residue.kept(rows, none, model).collect()) == [3, 4, 7]
    assert [tuple(r) for r in p6_near_pages.found(rows, none, model).collect()] == [(3, 4)]
    groups = {r.page_id: r.group_id for r in p6_near_pages.groups(rows, none, model).collect()}
    assert groups[3] == groups[4] == 3
    assert p3_clean_text.found(rows, none, model).count() == 0
    assert {r.page_id for r in p3_clean_text.cleaned(rows, none, model).collect()} >= {3, 4, 7}


def test_empty_tables(spark):
    rows, none = spark.createDataFrame([], PAGE), spark.createDataFrame([], ANN)
    assert p1_main_body.found(rows, none).count() == 0
    assert p4_residue.found(rows, none).count() == 0
    assert p3_clean_text.found(rows, none).count() == 0
    assert p6_near_pages.found(rows, none).count() == 0
    odd = spark.createDataFrame(ODD[:2], PAGE)
    assert p1_main_body.found(odd, none).count() == 0  # nothing labelled, nothing learned


def test_near_pages_against_all_pairs(spark, tables, model):
    """Every pair that is similar by its exact sets comes out, and no other."""
    rows, _ = tables
    latest = {}
    for r in rows.where("status is not null").select("page_id", "scraped_at", "status", "url", "html").collect():
        if r.page_id not in latest or str(r.scraped_at) > str(latest[r.page_id].scraped_at):
            latest[r.page_id] = r
    sets = {}
    for r in latest.values():
        if r.status == "success" and r.html:
            lines = lines_of(walk(r.html, r.url))
            scores = model.scores(lines)
            kept = set(page_model.body_lines(lines, scores, model.cost))
            words = shingles.words_of("\n".join(i[3] + i[2] for n, i, _, _ in lines if n in kept))
            sets[r.page_id] = set(zip(words, words[1:], words[2:]))
    residue = {r.page_id for r in p4_residue.found(*tables, model).collect()}
    ids = sorted(set(sets) - residue)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = {tuple(r) for r in p6_near_pages.found(*tables, model).collect()}
    assert got == want and want
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    same = lambda a, b: len(sets[a] & sets[b]) == len(sets[a] | sets[b])
    classes = {a: min(b for b in ids if same(a, b)) for a in ids if sets[a]}
    links = {a: len({classes[b] for b in ids if ((min(a, b), max(a, b)) in want) and classes[b] != classes[a]}) for a in classes}
    groups = {r.page_id: (r.group_id, r.links) for r in p6_near_pages.groups(*tables, model).collect()}
    assert groups == {a: (root[a], links[a]) for a in classes}


def test_forest_parameters():
    assert p6_near_pages.chance(0.6, p6_near_pages.shortest_prefix(0.6)) >= p6_near_pages.RECALL
    assert p6_near_pages.shortest_prefix(0.9) >= p6_near_pages.shortest_prefix(0.5)
    assert 0 < p6_near_pages.least_agreement(0.6, 160) < 96


def set_tables(spark, sets):
    def signature(runs):
        return shingles.signature(runs, p6_near_pages.TREES * p6_near_pages.LONGEST).astype("<u4").view("<u2")[::2].tobytes()

    runs = {k: np.unique(shingles.mix(np.array(sorted(v), np.uint64))) for k, v in sets.items()}
    df = spark.createDataFrame([(k, bytearray(signature(v)), v.astype(np.int64).tolist()) for k, v in runs.items()], "key bigint, signature binary, runs array<bigint>")
    return df.select("key", "signature"), df.select("key", "runs")


def all_near(sets, least=0.6):
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])}


def test_forest_with_a_template_on_a_third_of_all_pages(spark):
    """Nodes that too many bodies share pair nothing; the exact way finds what is similar among their bodies."""
    pages.use_checkpoints(spark)
    r = np.random.default_rng(5)
    template = set(range(100))
    sets = {i: template | set(r.integers(1000, 10**9, 90 if i % 9 else 30).tolist()) for i in range(60)}
    sets |= {100 + i: (sets[i] - {1, 2, 3}) | {10**10 + i} for i in range(0, 60, 5)}
    sets |= {200 + i: set(r.integers(1000, 10**9, 60).tolist()) for i in range(60)}
    want = all_near(sets)
    for most in (5, 100):
        got = {(x.a, x.b): x.similarity for x in p6_near_pages.near_pairs(*set_tables(spark, sets), 0.6, most).collect()}
        assert set(got) == want and want
        assert all(abs(v - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 1e-9 for (a, b), v in got.items())
    _, busy = p6_near_pages.meetings(set_tables(spark, sets)[0], p6_near_pages.shortest_prefix(0.6), 5)
    assert busy.count() > 20


def test_forest_recall(spark):
    """Pairs just above the limit are found, against all pairs."""
    pages.use_checkpoints(spark)
    r = np.random.default_rng(6)
    sets = {}
    for i in range(0, 400, 2):
        a = r.integers(0, 10**9, 160).tolist()
        sets[i], sets[i + 1] = set(a[:130]), set(a[:98]) | set(a[130:])
    want = all_near(sets)
    got = {(x.a, x.b) for x in p6_near_pages.near_pairs(*set_tables(spark, sets), 0.6).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 150


ERROR = "<body><nav><a href='/a'>Home</a></nav><h1>{0}</h1><p>{1}</p></body>"


def test_residue_is_learned_from_trusted_records(spark):
    """Words that only trusted records show tell others; a body with the same notice is no case."""
    says = ["Zorbel kaput, bitte warten", "Plomp: zorbel weg", "kaput kaput zorbel plomp"]
    bodies = [BODY.replace("Kelba", f"Kelba{i}") for i in range(60)]
    rows = [(i, f"http://a{i}.b/", ERROR.format(says[i % 3], says[(i + 1) % 3]), "failed", T0, None, None) for i in range(9)]
    rows += [(20 + i, f"http://c{i}.b/", ERROR.format(says[(i + 2) % 3], says[i % 3]), "success", T0, None, None) for i in range(6)]
    rows += [(100 + i, f"http://d{i}.b/", b, "success", T0, None, None) for i, b in enumerate(bodies)]
    rows += [(200, "http://e.b/", bodies[0].replace("<p>", "<p>Zorbel kaput, bitte warten</p><p>", 1), "success", T0, None, None)]
    df = spark.createDataFrame(rows, PAGE)
    ann = spark.createDataFrame([(100 + i, [(1, 6)], "manual", True, T0, T0) for i in range(40)], ANN)
    assert {r.page_id for r in p4_residue.found(df, ann).collect()} == {*range(9), *range(20, 26)}
    none = df.where("status = 'success' and page_id >= 100")
    assert p4_residue.found(none, ann).count() == 0  # nothing trusted, nothing learned


def test_evidence():
    assert residue_model.noscript_texts("<p>x</p><NOSCRIPT>Turn <b>on</b> &amp; go</NOSCRIPT>") == ["Turn on & go"]
    assert residue_model.noscript_texts("") == [] and residue_model.evidence_of("", None, [], [])[3] is None
    lines = lines_of(walk("<body><h1>{{ title }}</h1><p>{{ body }} today</p></body>"))
    cells, sizes, weights, amount, trusted = residue_model.evidence_of("", "success", lines, [1.0, -1.0])
    assert trusted and 0 < amount < residue_model.LITTLE and len(sizes) == 8 and np.frombuffer(weights, "<f4")[0] == 0
    long = [(n, (*i[:2], i[2] * 50, *i[3:]), w, t) for n, i, w, t in lines]
    assert not residue_model.evidence_of("", "success", long, [9.0, 9.0])[4]


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("The <b>old</b> mill", ["html"]),
        ("&copy; 2021", ["html"]),
        ("a <!-- x --> b", ["html"]),
        ("**Note** this", ["markdown"]),
        ("see [here](/a/b)", ["markdown"]),
        ("## Head", ["markdown"]),
        ("| a | b |", ["markdown"]),
        ("the `war` began", ["markdown"]),
        ("[[Town|the town]] hall", ["wiki"]),
        ("it{{cite x|year=1990}} fell", ["wiki"]),
        ("'''bold''' word", ["wiki"]),
        ("== Head ==", ["wiki"]),
        (r"\textbf{so} it", ["latex"]),
        ("a < 11 and b > 2", []),
        (r"C:\new\files and 5 * 3 * 8", []),
        ("#1 on the list, R&D pays $5 to $7", []),
        ("temporary [sic] closed, see note [35]", []),
        ("the variable my_old_total in C#", []),
        ("Hello %NAME%, {0} items", []),
        ("#tag", []),
        ("", []),
    ],
)
def test_kinds_of_markup(text, kinds):
    assert markup.kinds_in(text) == kinds


@pytest.mark.parametrize(
    "text,want",
    [
        ("The <b>old</b><br /> mill &amp; &lt;i&gt;more&lt;/i&gt;", "The old mill & more"),
        ("![x](/y.png) **Note** [here](/a)", "Note here"),
        ("[[File:a.jpg|thumb|left|the mill]] and [[Town|the town]]", "the mill and the town"),
        (r"\textbf{so}~\cite{x1} it", "so it"),
        ("== Head ==", "Head"),
        ("5 * 3 * 8 < 130", "5 * 3 * 8 < 130"),
    ],
)
def test_plain(text, want):
    assert markup.plain(text) == want


def test_clean_text_keeps_structure():
    nav = "<ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(8)) + "</ul>"
    main = "<div><h1>T &lt;b&gt;x&lt;/b&gt;</h1><p>" + "A long sentence of plain words stands here. " * 8 + "</p><ul><li>one <b>item</b> of the list</li></ul><pre>for i in x:\n  y &lt; 2</pre><p>$x = 2$</p><p>" + "More words follow in this paragraph too. " * 6 + "</p></div>"
    lines = p3_clean_text.clean(walk(f"<body>{nav}{main}<div>{nav}</div></body>", "http://a.b/"))
    kinds = [k for k, _ in lines]
    assert kinds[0] == "heading1" and lines[0][1] == "T x"
    assert {"item", "code", "formula", "text"} <= set(kinds) and not any("Menu" in t for _, t in lines)
    assert dict(lines)["code"] == "for i in x:\n  y < 2"
    assert "```\nfor i in x:" in p3_clean_text.as_markdown(lines)
    assert p3_clean_text.clean(walk("")) == []


def test_density_keeps_bodies_and_drops_chrome(spark, tables):
    """Against annotated bodies: no line of them is lost, and much of what stands around them is."""
    rows, ann = tables
    truth = pages.validated_annotations(ann).where("source = 'manual' and size(ranges) > 0").collect()
    inside = {r.page_id: {n for x in r.ranges if x.start is not None and x.end is not None for n in range(x.start, x.end + 1)} for r in truth}
    kept = body = lines = hits = 0
    for r in rows.where("status = 'success' and html is not null").select("page_id", "url", "html").collect():
        if r.page_id in inside:
            items = walk(r.html, r.url or "")
            got = {n for n, _ in p3_clean_text.text_lines(items)}
            have = {n for n, *_ in lines_of(items)}
            want = inside[r.page_id] & have
            kept, body, lines, hits = kept + len(got), body + len(want), lines + len(have), hits + len(got & want)
    assert hits > 0.98 * body and kept < 0.75 * lines


@pytest.mark.parametrize("mark,plain_text", [("&lt;b&gt;{0}&lt;/b&gt;", "{0}"), ("**{0}**", "{0}"), ("[[Page|{0}]]", "{0}"), ("\\textbf{{{0}}}", "{0}"), ("{0} &amp;amp; more", "{0} & more")])
def test_planted_markup_is_cleaned(mark, plain_text):
    """Markup planted in a heading, a list item and a paragraph goes; the structure, the code and the formula stay."""
    words = "slowly moved harbour bridge"
    filler = "<p>" + "A long sentence of plain words stands here. " * 8 + "</p>"
    html = f"<body><h2>{mark.format(words)}</h2>{filler}<ul><li>{mark.format('first item')}</li></ul><p>{mark.format(words)}</p><pre>**code** &amp;lt;b&amp;gt;</pre><p>$x_1 = 2$</p>{filler}</body>"
    items = walk(html)
    text = p3_clean_text.as_markdown(p3_clean_text.clean(items)).split("\n")
    assert "## " + plain_text.format(words) in text and "- " + plain_text.format("first item") in text and plain_text.format(words) in text
    assert "**code** &lt;b&gt;" in text and "$x_1 = 2$" in text
    assert p3_clean_text.marked_lines(items) == [1, 3, 4]


def test_residue_kinds_spare_code_and_formulas():
    items = [x for x in walk("<body><pre>&lt;b&gt;x&lt;/b&gt;</pre><p>\\( \\frac{a}{b} \\)</p><p>a &lt;b&gt;x&lt;/b&gt;</p><p>use <code>&lt;b&gt;</code> here</p></body>") if x[1] == "text"]
    assert [p3_clean_text.residue_kinds(i) for i in items] == [[], [], ["html"], [], []]
