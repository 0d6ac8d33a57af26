"""Problems 2, 5, 7, 8, 9 and 10 on small fixtures."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelathe.llm import p2_overlap, p5_repeated_lines, p7_splits, p8_encoding, p9_mixing, p10_spam, shingles
from pagelathe.sources.tables import read_table

SMALL = "/root/testdata/sf0.01"
T0 = dt.datetime(2026, 1, 1)

# ---------------------------------------------------------------- problem 8

RANKS = p8_encoding.parse_ranks(p8_encoding.read_ranks())
ENCODER = p8_encoding.Encoder(RANKS)
ORACLE = tiktoken.Encoding("own", pat_str=p8_encoding.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abceinost ", max_size=120), st.text(alphabet="aé日 \n\t'́1😀", max_size=60)))
def test_encoding_agrees_with_the_library(text):
    assert ENCODER.encode(text) == ORACLE.encode_ordinary(text)


def test_encoding_table(spark):
    texts = [(1, "Hello world", "x"), (2, None, None), (3, "", "y"), (3, "", "y"), (4, "ab" * 50_000, "z"), (5, "<|endoftext|>", "w"), (None, "q", None)]
    df = spark.createDataFrame(texts, "doc_id int, text string, ids string")
    got = [(r.doc_id, list(r.ids)) for r in p8_encoding.encode(df).collect()]
    assert sorted(got, key=str) == sorted([(d, ORACLE.encode_ordinary(t) if t else []) for d, t, _ in texts], key=str)
    assert p8_encoding.encode(df.limit(0)).count() == 0


def test_long_piece_takes_no_quadratic_time():
    piece = "".join(random.Random(1).choice("abcdefgh") for _ in range(100_000))
    assert ORACLE.decode(ENCODER.encode(piece)) == piece


# ---------------------------------------------------------------- problem 5

PAGES = "page_id bigint, url string, markdown string, status string, scraped_at timestamp, mask string, n int"


def page(i, lines, url=None, status="success"):
    return (i, url or f"http://www.s.x/{i}", None if lines is None else "   | [body]\n" + "\n".join(f"{n:2} |   {t}" for n, t in enumerate(lines, 1)), status, T0, None, None)


def test_repeated_lines(spark):
    share = "Share this [page number {0}](/p/{0}) with {0} friends"
    rows = [page(i, [share.format(i), f"text of its own {chr(97 + i) * 12}", "short 12"]) for i in range(6)]
    rows += [rows[0], page(6, ["SHARE this page-number with friends!"], "HTTP://S.X:80/6"), page(7, None), page(8, [""]), page(9, ["x"], None, "failed"), page(10, [share.format(1)], "no url")]
    rows += [page(20 + i, ["the same line on three pages only"], f"http://t.x/{i}") for i in range(3)]
    df = spark.createDataFrame(rows, PAGES)
    assert sorted(tuple(r) for r in p5_repeated_lines.found(df).collect()) == [(i, 1) for i in range(7)]
    clean = {r.page_id: r.markdown for r in p5_repeated_lines.without_repeated(df).collect()}
    assert clean[0] == "   | [body]\n 2 |   text of its own aaaaaaaaaaaa\n 3 |   short 12" and clean[7] is None
    assert p5_repeated_lines.found(df.limit(0)).count() == 0


def test_lines_of_equal_hash(spark):
    """Whole lines are compared: two words of the same 64 bits on two pages each are no line on four pages."""
    one, other = "harbourlanternsx", "uobtxwglhaoxzehf"
    assert len({r[0] for r in spark.createDataFrame([(one,), (other,)], "w string").select(F.xxhash64("w")).collect()}) == 1
    df = spark.createDataFrame([page(i, [one if i < 2 else other, "the line of all pages"]) for i in range(4)], PAGES)
    assert sorted(tuple(r) for r in p5_repeated_lines.found(df).collect()) == [(i, 2) for i in range(4)]
    lines = spark.createDataFrame([(1, i, 1, one if i < 2 else other) for i in range(4)], "site int, page_id int, line_num int, text string")
    assert p5_repeated_lines.repeated(lines, lines.select("site", "page_id")).count() == 0


def test_exact_lines_are_not_clustered(spark):
    """The mask alone is the key of a line, and no hash of minima is computed for it."""
    lines, members = p5_repeated_lines.keyed_lines(spark.createDataFrame([page(i, ["the line of all pages"]) for i in range(4)], PAGES))
    assert lines.columns == ["site", "page_id", "line_num", "mask"]
    hot = p5_repeated_lines.repeated_keys(lines, members)
    assert hot.columns == ["site", "mask"] and hot.count() == 1
    assert "array_min" not in hot._jdf.queryExecution().toString()


def test_near_lines(spark):
    """With `near`, lines that differ in names, dates and a word count as one; without, they don't."""
    names = "Mira Tolvane Berk Asku Runa Felk Osto Dalv".split()
    months = "January March May October".split()
    lines = [(1, i, 1, f"Written by {names[i]} {names[i + 4]} for the weekend pages on {3 + i}. {months[i]} {1990 + i}, all rights kept here") for i in range(4)]
    lines += [(1, i, 2, f"a line about the {w} that nobody else has") for i, w in enumerate(["quarry of old", "river bend", "market hall", "tall tower"])]
    df = spark.createDataFrame(lines, "site int, page_id int, line_num int, text string")
    members = df.select("site", "page_id").distinct()
    assert p5_repeated_lines.repeated(df, members).count() == 0
    got = {(r.page_id, r.line_num) for r in p5_repeated_lines.repeated(df, members, near=True).collect()}
    assert got == {(i, 1) for i in range(4)}


def test_line_on_a_third_of_all_pages_of_one_site(spark):
    rows = [page(i, ["the footer line of the largest site", f"own text {chr(97 + i % 26) * 12} {chr(97 + i // 26) * 9}"]) for i in range(300)]
    rows += [page(1000 + i, [f"other text {chr(97 + i % 26) * 12} {chr(97 + i // 26) * 9}"], f"http://t{i}.x/") for i in range(600)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert sorted(tuple(r) for r in p5_repeated_lines.found(spark.createDataFrame(rows, PAGES)).collect()) == [(i, 1) for i in range(300)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_share_of_pages(spark):
    rows = [page(i, ["a line on four pages"] if i < 4 else [f"other {i}"]) for i in range(21)]
    assert p5_repeated_lines.found(spark.createDataFrame(rows, PAGES)).count() == 0
    assert p5_repeated_lines.found(spark.createDataFrame(rows[:20], PAGES)).count() == 4


# ---------------------------------------------------------------- problem 2

RECORD = "messages array<struct<role:string,content:string>>, page_id bigint, url string, words string, a int"


def record(i, body, answer="2:9", url=None):
    content = "[url: u]\n   | [body]\n 1 |   menu\n" + "\n".join(f"{n:2} |   {t}" for n, t in enumerate(body, 2))
    return ([("system", "s"), ("user", content), ("assistant", answer)], i, url, None, None)


def words(seed, n=80):
    r = random.Random(seed)
    return [r.choice("alpha beta gamma delta mill harbour kiln ferry tower slowly often never moved sold built".split()) + str(r.randrange(50)) for _ in range(n)]


def test_overlap_odd_rows(spark):
    w = words(1)
    edited = w[:]
    for k in range(10, 80, 20):
        edited[k] = "other"
    train = [record(1, [" ".join(w)]), record(1, [" ".join(w)]), record(2, [" ".join(words(2))]), (None, 3, None, None, None), record(4, ["x"], None), ([("user", "u")], 5, None, None, None), record(6, [" ".join(words(3) * 3000)])]
    test = [record(11, [" ".join(edited)], url="http://www.q.r/1"), record(12, [" ".join(w[40:] + w[:40])]), record(13, [" ".join(words(9))]), record(14, [""], "2:2"), record(15, ["a b"], "junk"), (None, None, None, None, None)]
    a, b = spark.createDataFrame(train, RECORD), spark.createDataFrame(test, RECORD)
    assert sorted(tuple(r) for r in p2_overlap.found(a, b).collect()) == [(1, 11), (1, 12)]
    report = {(r.split, r.site): (r.pairs, r.records) for r in p2_overlap.report(a, b).collect()}
    assert report == {("train", None): (2, 1), ("test", "q.r"): (1, 1), ("test", None): (1, 1)}
    assert p2_overlap.found(a.limit(0), b).count() == 0 and p2_overlap.found(a, b.limit(0)).count() == 0


def test_overlap_against_all_pairs(spark):
    def load(name):
        out = []
        for r in read_table(spark, SMALL, name).collect():
            said = {m.role: m.content for m in r.messages or []}
            body = p2_overlap.body_of(said.get("user"), said.get("assistant"))
            if body is not None:
                w = shingles.words_of(body)
                out.append((r.page_id, set(zip(w, w[1:], w[2:]))))
        return out

    want = {(min(p, q), max(p, q)) for p, a in load("train") for q, b in load("test") if a and b and len(a & b) >= 0.6 * len(a | b)}
    got = {tuple(r) for r in p2_overlap.found(read_table(spark, SMALL, "train"), read_table(spark, SMALL, "test")).collect()}
    assert got == want and want


def test_overlap_of_repeated_texts(spark):
    w, x = words(21, 60), words(22, 240)
    evenly = [v if i % 12 else "other" for i, v in enumerate(x)]
    train = [record(1, [" ".join(w * 12)]), record(2, [" ".join(x)])]
    test = [record(11, [" ".join(w * 12)]), record(12, [" ".join(w)]), record(13, [" ".join(evenly)])]
    a, b = spark.createDataFrame(train, RECORD), spark.createDataFrame(test, RECORD)
    got = {(r.train_page, r.test_page): r.overlap for r in p2_overlap.pairs(a, b).collect()}

    def close(s, t):
        s, t = ({*zip(v, v[1:], v[2:])} for v in (s, t))
        return len(s & t) >= 0.6 * len(s | t)

    assert close(w * 12, w) and close(x, evenly) and not close(w, x)
    assert set(got) == {(1, 11), (1, 12), (2, 13)}
    p2_overlap.use_checkpoints(spark)
    side = lambda df: p2_overlap.records(df).select(F.col("page_id").alias("key"), "chunks")
    chunked = {tuple(r) for r in p2_overlap.overlaps(side(a), side(b)).collect()}
    assert (1, 11) in chunked and chunked <= {(1, 11), (1, 12), (2, 13)}  # the chunks alone find what is whole
    assert got[1, 11] == 1.0 and got[1, 12] > 0.5


def test_chunks_follow_the_content():
    h = shingles.word_hashes(words(5, 400))
    whole, cut = set(p2_overlap.chunks_of(h).tolist()), set(p2_overlap.chunks_of(h[37:]).tolist())
    assert len(whole & cut) > 0.8 * len(cut)
    assert sum(int(d) & 255 for d in p2_overlap.chunks_of(h)) == 400
    assert len(p2_overlap.chunks_of(h[:0])) == 0 and len(p2_overlap.chunks_of(h[:1])) == 1


# ---------------------------------------------------------------- problem 7

URL = "page_id bigint, url string, status string, scraped_at timestamp, dataset string, component string"


def test_handles(spark):
    urls = {
        "http://a.b/author/Jo.Doe/x-1": "jo.doe", "http://a.b/@Jo.Doe/x": "jo.doe", "http://a.b/users/jo.doe/posts/3": "jo.doe",
        "http://a.b/~JO.DOE/3.html": "jo.doe", "http://a.b/x?id=1&author=Jo.Doe": "jo.doe", "http://a.b/%7Ejo.doe/3": "jo.doe",
        "http://a.b/x?p=3": None, "http://user@a.b/x": None, "http://a.b/authors-of/x": None, "": None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.h for r in df.select("u", p7_splits.handle_of("u").alias("h")).collect()} == urls


def test_related_test_pages(spark):
    urls = [(1, "http://a.x/1"), (2, "http://www.A.x:80/2"), (3, "http://b.x/author/Jo/1"), (4, "http://c.x/@jo/1"), (5, "http://c.x/5"), (6, "http://d.x/6"), (7, None), (8, "http://a.x/8")]
    rows = [(i, u, "failed" if i == 8 else "success", T0, None, None) for i, u in urls] + [(1, "http://a.x/1", "success", T0, None, None)]
    manifest = [(42, 8, [1, 3, None], [2, 4, 5, 6, 7, 8, 99]), (43, 2, [6], [1, 5]), (44, 0, None, []), (42, 8, [1, 3, None], [2, 4, 5, 6, 7, 8, 99])]
    df = spark.createDataFrame(manifest, "seed bigint, total bigint, train_page_ids array<bigint>, test_page_ids array<bigint>")
    got = sorted(tuple(r) for r in p7_splits.found(spark.createDataFrame(rows, URL), df).collect())
    assert got == [(42, 2), (42, 4), (42, 5)]
    assert p7_splits.found(spark.createDataFrame([], URL), df).count() == 0


def test_assignment_keeps_together(spark):
    sizes = [400] + [7] * 40 + [1] * 700
    rows = [(i, c, "x" if i % 3 else None) for i, c in enumerate(k for k, n in enumerate(sizes) for _ in range(n))]
    df = spark.createDataFrame(rows, "page_id bigint, component bigint, label string")
    got = p7_splits.assign(df, (0.6, 0.2, 0.2)).collect()
    sides, label = defaultdict(set), {i: x for i, _, x in rows}
    for r in got:
        sides[r.component].add(r.split)
    assert len(got) == len(rows) and all(len(s) == 1 for s in sides.values())
    share = Counter(r.split for r in got)
    assert share["train"] / len(rows) == pytest.approx(0.6, abs=0.002) and share["test"] / len(rows) == pytest.approx(0.2, abs=0.002)
    for x in ("x", None):
        n = sum(v == x for v in label.values())
        own = Counter(r.split for r in got if label[r.page_id] == x)
        assert own["train"] / n == pytest.approx(0.6, abs=0.02) and own["test"] / n == pytest.approx(0.2, abs=0.02)
    portions = p7_splits.assign(df, (0.6, 0.2, 0.2), portion=2).collect()
    assert sorted(map(tuple, portions)) == sorted(map(tuple, got))  # however the bundles are portioned
    assert p7_splits.assign(df.limit(0)).count() == 0


@pytest.fixture
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_site_with_a_third_of_all_pages(spark, fixed_plans):
    """One site has a third of the pages, and one author links another site to it."""
    urls = [f"http://big.x/{i}" for i in range(200)] + [f"http://s{i % 90}.x/{i}" for i in range(398)] + ["http://big.x/@jo/1", "http://s7.x/users/Jo/2"]
    df = spark.createDataFrame([(i, u, "success", T0, None, None) for i, u in enumerate(urls)], URL)
    train, test = [0, 205], list(range(1, 204)) + list(range(206, len(urls)))
    manifest = spark.createDataFrame([(1, len(urls), train, test)], "seed bigint, total bigint, train_page_ids array<bigint>, test_page_ids array<bigint>")
    site = lambda u: u.split("/")[2]
    reached = {"big.x", "s7.x", site(urls[205])}
    want = {i for i in test if site(urls[i]) in reached}
    assert {r.page_id for r in p7_splits.found(df, manifest).collect()} == want and len(want) > 200


def test_record_with_a_third_of_all_copies(spark, fixed_plans):
    same, near = " ".join(words(31)), " ".join([*words(31)[:70], *words(32)[:10]])
    train = [record(i, [same], url="http://a.b/") for i in range(60)] + [record(100 + i, [" ".join(words(100 + i))]) for i in range(60)]
    test = [record(1000 + i, [same]) for i in range(5)] + [record(2000, [near], url="http://c.d/"), record(2001, [" ".join(words(900))])]
    a, b = spark.createDataFrame(train, RECORD), spark.createDataFrame(test, RECORD)
    assert {tuple(r) for r in p2_overlap.found(a, b).collect()} == {(i, j) for i in range(60) for j in (*range(1000, 1005), 2000)}
    report = {(r.split, r.site): (r.pairs, r.records) for r in p2_overlap.report(a, b).collect()}
    assert report == {("train", "a.b"): (360, 60), ("test", None): (300, 5), ("test", "c.d"): (60, 1)}


def test_assignment_of_the_small_tables(spark):
    """No key in two splits, and every split and dataset near its share, on the registered query."""
    rows = read_table(spark, SMALL, "pages")
    keys = {r.page_id: (r.site, r.handle) for r in p7_splits.page_keys(rows).collect()}
    got = {r.page_id: r.split for r in p7_splits.new_splits(rows).collect()}
    assert set(got) == set(keys)
    for i in (0, 1):
        sides = defaultdict(set)
        for page_id, k in keys.items():
            if k[i] is not None:
                sides[k[i]].add(got[page_id])
        assert all(len(s) == 1 for s in sides.values())
    share = Counter(got.values())
    assert abs(share["train"] / len(got) - 0.8) < 0.03 and abs(share["test"] / len(got) - 0.1) < 0.03


# ---------------------------------------------------------------- problem 9

SIZES, TARGETS = "doc_id bigint, source string, tokens bigint, copy int", "source string, target_share double, max_repeats int"


def test_mixing(spark):
    r = random.Random(2)
    docs = [(i, s, r.randrange(20, 400), 0) for i, s in enumerate(["big"] * 4000 + ["mid"] * 700 + ["small"] * 150)]
    targets = [("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4), (None, 0.1, 2)]
    odd = [(-1, None, 50, 0), (-2, "other", 50, 0), (-3, "big", 0, 0), (-4, "mid", None, 0), docs[0]]
    sizes, wish = spark.createDataFrame(docs + odd, SIZES), spark.createDataFrame(targets, TARGETS)
    chosen = p9_mixing.mix(sizes, wish)
    rows = chosen.collect()
    assert len({x.doc_id for x in rows}) == len(rows) and not {x.source for x in rows} - {"big", "mid", "small"}
    assert max(x.copies for x in rows if x.source == "small") <= 4 and max(x.copies for x in rows if x.source == "big") == 1
    shares = {x.source: x for x in p9_mixing.shares(chosen, wish).collect()}
    for s, t, _ in targets[:3]:
        assert shares[s].actual_share == pytest.approx(t, abs=0.005)
    # Every source is within one document of its size, and what is drawn once more is larger than the mean.
    plan = {x.source: x.goal for x in p9_mixing.source_plan(sizes.where("source is not null and tokens > 0").distinct(), wish).collect() if x.goal}
    assert plan and all(abs(shares[s].tokens - goal) <= 400 for s, goal in plan.items())
    drawn = [x.tokens for x in rows if x.source == "mid"]
    least = min(x.copies for x in rows if x.source == "mid")
    more = [x.tokens for x in rows if x.source == "mid" and x.copies > least]
    assert not more or sum(more) / len(more) > sum(drawn) / len(drawn)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, p9_mixing.mix(sizes, wish).collect()))
    assert sorted(map(tuple, rows)) != sorted(map(tuple, p9_mixing.mix(sizes, wish, seed=1).collect()))


def test_mixing_with_a_total_and_with_nothing(spark):
    sizes = spark.createDataFrame([(i, "a" if i < 90 else "b", 10, 0) for i in range(100)], SIZES)
    wish = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2), ("gone", 0.2, 2)], TARGETS)
    shares = {x.source: x for x in p9_mixing.shares(p9_mixing.mix(sizes, wish, total=1000), wish).collect()}
    assert (shares["b"].tokens, shares["a"].tokens, shares["gone"].tokens) == (200, 500, 0)
    assert p9_mixing.mix(sizes.limit(0), wish).count() == 0
    assert p9_mixing.mix(sizes, wish.limit(0)).count() == 0


# ---------------------------------------------------------------- problem 10

PROSE = "What surprised the town was how slowly the {a} had been moved near the {b}. Nobody expected that the {a} would need {n} ropes and a {b}. After {n} days the old {b} was sold, because the {a} stayed empty.\n"


def prose(seed, n=6):
    r = random.Random(seed)
    return "".join(PROSE.format(a=f"{r.choice('bdfglmprst')}{r.choice('aeiou')}ll", b=f"{r.choice('bdfglmprst')}{r.choice('aeiou')}wer", n=r.randrange(900)) for _ in range(n))


@pytest.fixture(scope="module")
def prose_model():
    return p10_spam.fit([prose(i) for i in range(300)])


def test_min_cost_flow():
    arcs = [(0, 2, 3, 0.0), (0, 3, 2, 0.0), (2, 4, 2, 1.0), (2, 5, 3, 4.0), (3, 4, 2, 1.0), (3, 5, 2, 2.0), (4, 1, 3, 0.0), (5, 1, 3, 0.0)]
    flow = p7_splits.min_cost_flow(6, arcs, 0, 1)
    assert sum(flow[:2]) == 5 and sum(f * c for f, (_, _, _, c) in zip(flow, arcs)) == 9.0  # the best of all flows of 5


def test_quotas_are_met_for_labels_too():
    bundles = [([("x", 30), ("y", 20)], 1), ([("x", 3)], 20), ([("x", 1)], 300), ([("y", 10)], 6), ([("y", 1)], 100)]
    got = p7_splits.solve_quotas(bundles, (0.7, 0.2, 0.1))
    assert [sum(g) for g in got] == [n for _, n in bundles]
    for label in "xy":
        have = [sum(g[k] * dict(p).get(label, 0) for g, (p, _) in zip(got, bundles)) for k in range(3)]
        assert all(abs(h - p * sum(have)) <= 1 for h, p in zip(have, (0.7, 0.2, 0.1)))


@pytest.mark.parametrize(
    "spam",
    [
        " | ".join(f"cheap boots ({i})" for i in range(80)),
        "\n".join(f"- [red boots {i}](http://x.y/{i})" for i in range(60)),
        "  ".join(f"http://x.y/z?id={i}" for i in range(60)),
        "Our red boots is the best red boots if you need red boots in Town. Order red boots today, red boots tomorrow, red boots every day! " * 8,
        prose(1, 1) + "#redboots #boots #cheapboots " * 40,
    ],
)
def test_spam_is_flagged(prose_model, spam):
    assert prose_model.judge(spam)[2]


def test_prose_is_not(prose_model):
    for text in (prose(900), prose(901, 9) + "References\nhttp://a.b/c\nhttp://a.b/d", "", "  ", "...", prose(902).encode().decode("latin-1")):
        assert not prose_model.judge(text)[2]


def test_sentences_do_not_hide_a_list_of_links(prose_model):
    texts = [prose(3, 2) + "\n".join(f"http://x{i}.y/z?id={i}" for i in range(k)) for k in range(20, 260)]
    got = [(prose_model.judge(t)[1], prose_model.judge(t)[2]) for t in texts]
    unsure = [flagged for share, flagged in got if 0.55 < share <= 0.75]
    assert unsure and all(unsure)


def test_misread_text_is_read_again():
    assert p10_spam.tokens_of("semblé Ã©tÃ©")[:2] == ["semblé", "été"]
    assert p10_spam.tokens_of("ÑÃÐ°Ð´ ãÃ¯")[:2] == ["сад", "は"]  # with bytes that were lost


def test_spam_table(spark, prose_model):
    rows = [(1, "cheap boots, " * 100, 0.1), (1, "cheap boots, " * 100, 0.1), (2, None, None), (3, "", 0.0), (4, prose(5), 0.0), (None, "x", None), (5, "a" * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, bits double")
    assert [r.doc_id for r in p10_spam.found(df, prose_model).where("doc_id < 5").collect()] == [1]
    assert p10_spam.scores(df, prose_model).count() == len(rows)
    assert p10_spam.found(df.limit(0)).count() == 0
    few = df.where("doc_id = 1")
    assert p10_spam.scores(few).where(F.col("odd_share") > 0).count() == 0  # no prose, no model


def test_spam_model_is_of_all_texts(spark):
    texts = [prose(i, 2) for i in range(6300)] + [prose(9000 + i, 120) for i in range(2)] + [None, "", "x y"]
    assert len(texts[6300]) > 20_000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(7)
    got, want = p10_spam.fit_prose_model(df), p10_spam.fit([t for t in texts if t])
    assert (got.words == want.words).all() and (got.places == want.places).all() and (got.low, got.high) == (want.low, want.high)
    assert (got.keys == want.keys).all() and np.allclose(got.tri, want.tri) and np.allclose(got.bi, want.bi)
    assert p10_spam.fit_prose_model(df.where("length(text) > 20000")) is not None


def test_spam_of_the_small_tables(spark):
    docs = read_table(spark, SMALL, "documents")
    got = p10_spam.found(docs).count()
    assert 0.02 < got / docs.count() < 0.15
