import datetime as dt
import time
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pagelathe.functions import training
from pagelathe.operators import analysis, export, features, items, predictors, review, store, vote
from pagelathe.operators.components import connected_components
from pagelathe.operators.current import latest
from pagelathe.operators.html_walk import to_markdown
from pagelathe.operators.ranking import bucketed_rank
from pagelathe.operators.sampling import smallest_hashes
from pagelathe.operators.skew import sifted, spread_join
from pagelathe.sources.tables import use_checkpoints
from pagelathe.streaming import scrape

RT = "array<struct<start:int,end:int>>"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "b"), (2, None, "c"), (2, 1, "d"), (3, None, "e"), (None, 1, "f")], "k int, at int, v string")
    assert {(r.k, r.v) for r in latest(df, "k", "at").collect()} == {(1, "b"), (2, "d"), (3, "e")}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (200, 200), (None, 3), (101, 100)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert all(got[i] == 0 for i in range(61))
    assert (got[100], got[101], got[200]) == (100, 100, 200)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_smallest_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    want = sorted((r.h, r.k) for r in df.withColumn("h", F.xxhash64("k", F.lit(3))).collect())[:100]
    got = smallest_hashes(df.repartition(7), "k", 100, 3)
    assert {r.k for r in got.collect()} == {k for _, k in want}
    assert smallest_hashes(df.limit(5), "k", 100).count() == 5 and smallest_hashes(df.limit(0), "k", 9).count() == 0


def test_bucketed_rank_is_a_rank(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.xxhash64("id").alias("h"))
    got = bucketed_rank(df, ["k"], F.struct("h", "v"), F.shiftright("h", 58), F.lit(2)).collect()
    for k in range(3):
        mine = sorted([r for r in got if r.k == k], key=lambda r: (r.h, r.v))
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r.upto for r in mine] == [2 * i for i in range(1, len(mine) + 1)]


PAGES = [
    (1, "http://a.b/x", '<body><nav class="menu"><a href="/a">A</a></nav><article class="post"><h1>T</h1><p style="display:none">hid</p><p class="byline">by me, you</p><table><tr><td>c<img></td></tr></table></article></body>'),
    (2, None, "<body><p>one</p></body>"),
    (3, "http://a.b/y", None),
    (4, "http://a.b/z", ""),
]


def test_page_lines(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = {(r.page_id, r.line_num): r for r in items.page_lines(df).collect()}
    assert set(got) == {(1, i) for i in range(1, 6)} | {(2, 1)}
    assert got[1, 1].ancestors == ["body", "nav"] and got[1, 1].class_chain == ["menu"]
    assert got[1, 3].is_hidden == 1 and got[1, 2].is_hidden == 0
    assert got[1, 4].is_byline == 1 and got[1, 4].class_chain == ["byline", "post"]
    assert (got[1, 5].in_table, got[1, 5].has_image, got[1, 5].is_last_child) == (1, 1, 1)
    views = {r.page_id: r.markdown for r in items.rendered(df).collect()}
    assert views[1] == to_markdown(PAGES[0][2], PAGES[0][1]) and set(views) == {1, 2, 4}
    assert items.page_lines(df.limit(0)).count() == 0


def test_feature_table(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    labels = spark.createDataFrame([(1, None, [(2, 3)]), (2, "d", None)], f"page_id bigint, dataset string, ranges {RT}")
    table = features.feature_table(items.page_lines(df), labels)
    assert table.columns == list(features.COLUMNS) and len(table.columns) == 85
    got = {(r.page_id, r.line_num): r for r in table.collect()}
    assert [got[1, i].label for i in range(1, 6)] == [0, 1, 1, 0, 0] and got[2, 1].label == 0
    assert got[1, 1].dataset == "original" and got[1, 5].cumulative_text_pct == 1.0
    assert got[1, 1].total_lines == 5 and got[1, 4].comma_count == 1


def test_style_groups_merge_upwards(spark):
    chains = [["a", "p"], ["a", "p"], ["b", "p"], ["p"]]
    df = spark.createDataFrame([(1, i, c, 0.0, 1) for i, c in enumerate(chains)], "page_id int, line_num int, class_chain array<string>, link_ratio double, word_count int")
    got = features.with_style_groups(df).collect()
    assert {(r.style_group, r.style_group_size) for r in got} == {("p", 4)}


def test_heading_distance_and_rolling(spark):
    df = spark.createDataFrame([(1, i + 1, h, "x", n, 0.0) for i, (h, n) in enumerate([(0, 10), (0, 20), (1, 30), (0, 0)])], "page_id int, line_num int, is_heading int, parent_tag string, text_length int, link_ratio double")
    got = sorted(features.with_heading_distance(features.with_rolling(df)).collect(), key=lambda r: r.line_num)
    assert [r.dist_to_heading for r in got] == [0, 1, 0, 1]
    assert got[0].mean_text_length_w5 == 20.0


def predictions(spark, *answers):
    data = [(p, i, None if r is None else list(r)) for p, rs in answers for i, r in enumerate(rs)]
    return spark.createDataFrame(data, f"page_id bigint, model_idx int, ranges {RT}")


def test_votes(spark):
    df = predictions(spark, (1, ([(1, 3)], None, [(1, 3)])), (2, ([(1, 4)], [(3, 6)], [(10, 12)])), (3, ([(1, 2)], None, None)), (4, ([], [], [(1, 1)])))
    got = {r.page_id: r for r in vote.outcomes(df).collect()}
    assert (got[1].outcome, got[1].label, [(x.start, x.end) for x in got[1].ranges]) == ("agreed", "A+C", [(1, 3)])
    assert (got[2].outcome, got[2].label, [(x.start, x.end) for x in got[2].ranges]) == ("merged", "A|B", [(1, 6)])
    assert (got[3].outcome, got[3].ranges) == ("failed", None)
    assert (got[4].outcome, got[4].label, got[4].ranges) == ("agreed", "A+B", [])


ANN = f"page_id bigint, ranges {RT}, source string, validated boolean, skipped boolean, has_cookies boolean, created_at timestamp, updated_at timestamp"
T0, T1, T2 = (dt.datetime(2026, 1, d) for d in (1, 2, 3))


def test_store(spark):
    base = spark.createDataFrame([(1, [(1, 2)], "manual", False, True, True, T0, T0), (2, [], "llm", True, False, None, T0, T0)], ANN)
    change = spark.createDataFrame([(1, [(3, 4)], "llm", T1), (1, [(5, 6)], "manual", T2), (3, [(7, 8)], "manual", T1)], f"page_id bigint, ranges {RT}, source string, at timestamp")
    saved = {r.page_id: r for r in store.save(base, change).collect()}
    assert (saved[1].ranges[0].start, saved[1].validated, saved[1].skipped, saved[1].has_cookies, saved[1].updated_at) == (5, True, False, True, T2)
    assert saved[2].source == "llm" and saved[3].created_at == T1 and saved[3].has_cookies is False
    keys = change.select("page_id", "at")
    assert {r.page_id: r.skipped for r in store.skip(base, keys).collect()} == {1: True, 2: False, 3: True}
    assert {r.page_id: r.has_cookies for r in store.toggle_cookies(base, keys).collect()} == {1: False, 2: None, 3: True}
    assert {r.page_id: r.validated for r in store.accept(base, keys).collect()} == {1: True, 2: True}
    assert store.save(base, change.limit(0)).count() == 2


def test_record_scrapes(spark):
    pages = spark.createDataFrame([(1, None, "old", None, None, None), (2, "success", None, "h", "m", T0)], "page_id bigint, status string, error string, html string, markdown string, scraped_at timestamp")
    out = spark.createDataFrame([(1, "success", "x", "H", "M", T1), (2, "failed", "E", None, None, T1)], "page_id bigint, status string, error string, html string, markdown string, at timestamp")
    got = {r.page_id: tuple(r) for r in store.record_scrapes(pages, out).collect()}
    assert got == {1: (1, "success", "old", "H", "M", T1), 2: (2, "failed", "E", "h", "m", T1)}
    fresh = spark.createDataFrame([(2, "new")], "page_id bigint, markdown string")
    assert {r.page_id: r.markdown for r in store.regenerate(pages, fresh).collect()} == {1: None, 2: "new"}


def test_review(spark):
    pages = spark.createDataFrame([(i, f"http://x/{'A_b' if i == 3 else i}", "success" if i != 9 else None, None, i == 5, None) for i in range(1, 10)], "page_id bigint, url string, status string, dataset string, urgent boolean, scraped_at timestamp")
    ann = spark.createDataFrame([(1, [], "manual", True, False, False, T0, T0), (2, [], "llm", None, True, False, T0, T0)], ANN)
    queue = review.with_annotations(pages, ann)
    ids = lambda df: [r.page_id for r in df.collect()]
    assert ids(review.listed(queue, "unvalidated", per_page=3)) == [5, 3, 4]
    assert ids(review.listed(queue, "unvalidated", per_page=3, page=2)) == [6, 7, 8]
    assert ids(review.listed(queue, text="a_B")) == [3] and ids(review.listed(queue, text="_")) == [3] and ids(review.listed(queue, text=" 7 ")) == [7]
    assert tuple(review.counted(queue, "unvalidated", per_page=4).first()) == (6, 2)
    assert tuple(review.tab_counts(queue).first()) == (8, 6, 1)
    assert ids(review.following(queue, 5)) == [6] and ids(review.following(queue, 2)) == [5]
    assert ids(review.pending(pages)) == [9]
    assert sorted(ids(review.unannotated(pages, ann))) == [3, 4, 5, 6, 7, 8] and ids(review.unannotated(pages, ann, True)) == [5]


def test_span_agreement(spark):
    df = spark.createDataFrame([(1, 1, 1, 1), (1, 3, 1, 0), (2, 2, 0, 0)], "page_id int, span_lines int, predicted int, truth int")
    assert rows(analysis.span_agreement(df)) == [(1, 0.25), (2, 1.0)]


def test_trials(spark):
    df = spark.createDataFrame([(i, [i & 1, i >> 1 & 1], float((i & 1) + 2 * (i >> 1 & 1) + 4 * (i == 3))) for i in range(4)] * 10, "trial int, mask array<int>, score double")
    assert rows(analysis.synergy(df, 10)) == [(0, 1, 4.0)] and analysis.synergy(df, 11).count() == 0
    assert rows(analysis.marginal(df)) == [(0, 20, 3.0), (1, 20, 4.0)]
    assert rows(analysis.feature_frequency(df)) == [(0, 2, 0.5), (1, 2, 0.5)]


def test_export(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "light", [(1, 2)]), (2, None, "l2", None)], f"page_id bigint, url string, light string, ranges {RT}")
    chat = export.chat_rows(pages)
    assert [m.content for m in chat.where("page_id = 2").first().messages] == [export.SYSTEM, "l2", "1:1"]
    export.write_jsonl(chat, str(tmp_path / "j"))
    assert rows(export.read_jsonl(spark, str(tmp_path / "j"), chat.schema)) == rows(chat)
    flat = spark.createDataFrame([(1, 'say "x", or\ny', 0.1 + 0.2), (2, None, None), (3, "", -1e-300), (4, "\\", 1e20)], "page_id bigint, text string, x double")
    export.write_csv(flat, str(tmp_path / "c"))
    assert rows(export.read_csv(spark, str(tmp_path / "c"), flat.schema)) == rows(flat.withColumn("text", F.nullif("text", F.lit(""))))
    split = export.hash_split(spark.range(20000).withColumnRenamed("id", "page_id"))
    assert split.where("split = 'train'").count() / 20000 == pytest.approx(0.8, abs=0.02)
    train, test = export.shuffled_split(range(10))
    assert sorted(train + test) == list(range(10)) and len(train) == 8
    assert spark.range(1).select(export.prompt("a {structured_markdown} b", F.lit("X"))).first()[0] == "a X b"
    html = spark.createDataFrame([("<html><head lang=x><title>",), ("none",)], "h string").select(export.debug_html(F.col("h"), F.lit("B")).alias("v"))
    assert [r.v for r in html.collect()] == ['<html><head lang=x><base href="B"><title>', "none"]


def test_schedule(spark):
    df = spark.createDataFrame([("d", 0.0, 1), ("d", 1.0, 2), ("d", 25.0, 3), ("e", 5.0, 4), ("d", 25.0, 5)], "domain string, arrival double, seq bigint")
    got = {r.seq: r.start for r in scrape.schedule(df, 10.0).collect()}
    assert got == {1: 0.0, 2: 10.0, 3: 25.0, 4: 5.0, 5: 35.0}


def test_schedule_over_spans(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("string").alias("domain"), (F.pmod(F.xxhash64("id"), F.lit(3000)) / 2).alias("arrival"), F.col("id").alias("seq"))
    got = {r.seq: r.start for r in scrape.schedule(df, 7.0, span=50.0).collect()}
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r.arrival, r.seq)):
        last[r.domain] = max(r.arrival, last[r.domain] + 7.0) if r.domain in last else r.arrival
        assert got[r.seq] == pytest.approx(last[r.domain])


def test_schedule_stream_agrees_with_batch(spark, tmp_path):
    df = spark.createDataFrame([(f"d{i % 3}", float(i * 7 % 40), i) for i in range(30)], "domain string, arrival double, seq bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = scrape.schedule_stream(stream, 10.0).writeStream.format("memory").queryName("starts").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    want = {r.seq: r.start for r in scrape.schedule(df, 10.0).collect()}
    assert {r.seq: r.start for r in spark.table("starts").collect()} == want


def test_watch_and_scrape(spark, tmp_path):
    schema = "page_id bigint, url string, status string, urgent boolean"
    spark.createDataFrame([(1, "u", "success", None), (2, "v", "success", None), (3, "w", None, None)], schema).write.parquet(str(tmp_path / "p"))
    ann = spark.createDataFrame([(1,)], "page_id bigint")
    seen = []
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "p"))
    q = scrape.watch(stream, lambda: ann, lambda df, _: seen.extend(r.page_id for r in df.collect()), str(tmp_path / "c"), "1 second")
    q.processAllAvailable()
    q.stop()
    assert seen == [2]

    def fetch(url):
        if url == "v":
            raise ValueError("no")
        return "<body><p>hi</p></body>"

    got = {r.page_id: (r.status, r.error) for r in scrape.scrape(spark.createDataFrame([(1, "u"), (2, "v")], "page_id bigint, url string"), fetch).collect()}
    assert got == {1: ("success", None), 2: ("failed", "no")}
    rules = spark.createDataFrame([("http://a", "/", True), ("http://a", "/no", False)], "origin string, prefix string, allow boolean")
    pages = spark.createDataFrame([("http://a/x",), ("http://a/no/x",), ("http://b/no",)], "url string")
    assert sorted(r.url for r in scrape.allowed(pages, rules).collect()) == ["http://a/x", "http://b/no"]


def test_permutation_keeps_values(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("page_id"), F.col("id").alias("line_num"), (F.col("id") * 2).alias("v"))
    got = analysis.shuffled_within_pages(df, "v")
    assert rows(got.select("page_id", "v")) == rows(df.select("page_id", "v"))
    assert rows(got.select("line_num", "v")) != rows(df.select("line_num", "v"))


def test_masked_labels(spark):
    from pagelathe.functions.training import has_labels, masked_labels, seconds

    df = spark.createDataFrame([([1, 8, 9, 3, 8, 9, 5, 6, 0, 4, 0],), ([1, 2],), ([],), ([8, 9],)], "ids array<int>").withColumn("l", masked_labels(F.col("ids"), [8, 9], 0))
    got = [(r.l, r.h) for r in df.select("l", has_labels(F.col("l")).alias("h")).collect()]
    assert got == [([-100] * 6 + [5, 6, 0, -100, -100], True), ([-100, -100], False), ([], False), ([-100, -100], False)]
    d = spark.createDataFrame([("6h",), ("30m",), ("7s",), ("x",), ("5",)], "d string")
    assert [r.s for r in d.select(seconds(F.col("d")).alias("s")).collect()] == [21600, 1800, 7, None, None]


def test_selected_lines(spark):
    from pagelathe.operators.selection import selected_lines

    lines = spark.createDataFrame([(1, 1, "The [old mill](http://x) stands"), (1, 2, "---"), (1, 3, "by the wide river, north of town"), (1, 5, "and turns slowly every day"), (2, 1, "x")], "page_id bigint, line_num int, text string")
    asked = [(1, "a", "old mill stands by the wide river"), (1, "b", "Turns, slowly"), (1, "c", "nothing of this"), (1, "d", "  "), (3, "e", "old")]
    got = {(r.selection, r.first_line, r.last_line) for r in selected_lines(lines, spark.createDataFrame(asked, "page_id bigint, selection string, selected string")).collect()}
    assert got == {("a", 1, 3), ("b", 5, 5)}


def test_predictors_and_resuming(spark):
    from pagelathe.operators import predictors

    lines = spark.createDataFrame([(1, 1, 100, 0.0, 1), (1, 2, 5, 0.0, 0)], "page_id bigint, line_num int, text_length int, link_ratio double, content_region_ratio int")
    truth = spark.createDataFrame([(1, [1])], "page_id bigint, truth array<int>")
    assert {(r.method, r.iou) for r in predictors.compare(lines, truth).collect()} == {("long_lines", 1.0), ("largest_block", 1.0)}
    todo = predictors.random_subsets(spark, 56, 20)
    assert all(15 <= sum(r["mask"]) <= 45 and len(r["mask"]) == 56 for r in todo.collect())
    assert predictors.remaining(todo, todo.where("trial < 15"), "trial").count() == 5


# ------------------------------------------------------------ hot keys


def test_spread_join_is_a_join(spark):
    """With a third of all rows on one key and without adaptive plans, no task gets them all, and the rows are those of a join."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).repartition(5)
        right = spark.createDataFrame([(7, "hot"), (1, "a"), (2, None), (9999, "none")], "k bigint, w string")
        for how in ("inner", "left", "left_semi", "left_anti"):
            assert rows(spread_join(left, right, ["k"], ["v"], how)) == rows(left.join(right, "k", how))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        parts = Counter(r.p for r in spread_join(left, right, ["k"], ["v"]).withColumn("p", F.spark_partition_id()).collect() if r.k == 7)
        assert len(parts) > 1 and max(parts.values()) < 800 and sum(parts.values()) == 1001
        assert spread_join(left.limit(0), right, ["k"], ["v"]).count() == 0 and spread_join(left, right.limit(0), ["k"], ["v"], "left").count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sifted(spark):
    wide, keys = spark.range(100).withColumnRenamed("id", "k"), spark.createDataFrame([(3,), (3,), (5,), (None,)], "k bigint")
    assert rows(sifted(wide, keys, "k")) == [(3,), (5,)]
    assert sifted(wide, keys, "k", most=1).count() == 100  # too many keys: the caller joins later


def test_components_of_a_hub(spark):
    edges = [(0, i) for i in range(1, 400)] + [(400, 401), (401, 402)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert all(got[i] == 0 for i in range(400)) and {got[i] for i in (400, 401, 402)} == {400}


def test_line_frequency_of_a_text_on_every_page(spark):
    df = spark.createDataFrame([(p, n, "Home" if n == 1 else f"own {p}" if n == 2 else " ") for p in range(30) for n in (1, 2, 3)], "page_id int, line_num int, text string")
    got = {(r.page_id, r.line_num): r.line_frequency for r in features.line_frequency(df).collect()}
    assert all(got[p, 1] == 1.0 and got[p, 2] == pytest.approx(1 / 30) and got[p, 3] == 0 for p in range(30))
    few = features.line_frequency(df, df.where("page_id < 3")).where("page_id = 20").collect()
    assert sorted((r.line_num, r.line_frequency) for r in few) == [(1, 1.0), (2, 0.0), (3, 0.0)]


def test_checkpoints_need_a_shared_folder_on_a_cluster(monkeypatch):
    def session(master, shared):
        context = SimpleNamespace(master=master, folder=None, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))))
        context.setCheckpointDir = lambda x: setattr(context, "folder", x)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: shared))

    with pytest.raises(RuntimeError):
        use_checkpoints(session("spark://host:7077", None))
    for master, shared in (("spark://host:7077", "hdfs://x/y"), ("local[4]", None), ("local[4]", "/shared")):
        s = session(master, shared)
        use_checkpoints(s)
        assert s.sparkContext.folder == shared if shared else s.sparkContext.folder


# ------------------------------------------------------------ current rows, lookups, files and seams


def test_current_scrapes_are_chosen_after_the_walk(spark):
    html = "<body><p>{0}</p></body>"
    data = [(1, T1, "success", "http://a/", html.format("new")), (1, T0, "success", "http://a/", html.format("old")), (1, T1, "success", "http://a/", html.format("new")), (2, T1, "failed", None, html.format("x")), (2, T0, "success", None, html.format("y")), (3, T1, "success", None, None), (3, None, "success", None, html.format("z"))]
    df = spark.createDataFrame(data, "page_id bigint, scraped_at timestamp, status string, url string, html string")
    assert [(r.page_id, r.text) for r in items.page_lines(df).collect()] == [(1, "new")]
    plan = items.page_lines(df)._jdf.queryExecution().executedPlan().toString()
    shuffled = [x for x in plan.split("\n") if "Exchange" in x or "SortAggregate" in x]
    assert shuffled and not any("html" in x for x in shuffled)


def test_lookup(spark):
    pages = spark.createDataFrame([(1, "u", "success"), (2, "v", "success"), (3, "w", None)], "page_id bigint, url string, status string")
    ann = spark.createDataFrame([(1, [(1, 2)], "manual", True, False, None, T0, T0)], ANN)
    got = {r.page_id: (r.source, r.has_cookies, r.acceptable) for i in (1, 2, 3, 9) for r in review.looked_up(pages, ann, F.col("page_id") == i).collect()}
    assert got == {1: ("manual", False, True), 2: (None, False, False)}
    assert [r.page_id for r in review.scan(pages, 2, 1).collect()] == [2, 3]


def test_manifest_and_idf_files(spark, tmp_path):
    ids = spark.createDataFrame([(i,) for i in [5, 3, 1, 3]], "page_id bigint")
    earlier = spark.createDataFrame([(42, 2, [1], [3, 77])], "seed bigint, total bigint, train_page_ids array<bigint>, test_page_ids array<bigint>")
    made = export.next_manifest(ids, earlier)
    assert [tuple(r) for r in made.collect()] == [(42, 3, [1, 5], [3])]
    export.write_manifest(made, str(tmp_path / "m"))
    assert [tuple(r) for r in export.read_manifest(spark, str(tmp_path / "m")).collect()] == [(42, 3, [1, 5], [3])]
    fresh = export.next_manifest(spark.range(500).withColumnRenamed("id", "page_id"), None).first()
    assert len(fresh.train_page_ids) + len(fresh.test_page_ids) == 500 and 340 < len(fresh.train_page_ids) < 460
    assert export.next_manifest(ids.limit(0), None).first().total == 0
    idf = spark.createDataFrame([("b", 0.1 + 0.2), ("a", 1.0), ('"', 0.0)], "word string, idf double")
    export.write_idf(idf, str(tmp_path / "i"))
    assert rows(export.read_idf(spark, str(tmp_path / "i"))) == rows(idf)


def test_prompts_that_fit(spark):
    df = spark.createDataFrame([("a b c",), (None,), ("",)], "t string")
    assert [r.v for r in df.select(export.fits(F.col("t"), 2).alias("v")).collect()] == [False, False, True]
    assert [r.v for r in df.select(export.fits(F.col("t"), 5, F.length).alias("v")).collect()] == [True, False, True]


def test_permutation_importance(spark):
    data = [(p, n, 100 if n < 4 else 1, 7) for p in range(6) for n in range(1, 9)]
    df = spark.createDataFrame(data, "page_id int, line_num int, text_length int, other int")
    truth = spark.createDataFrame([(p, [1, 2, 3]) for p in range(6)], "page_id int, truth array<int>")
    found = lambda x: x.groupBy("page_id").agg(F.collect_list(F.when(F.col("text_length") > 50, F.col("line_num"))).alias("found"))
    got = {r.feature: (r.score, r.drop) for r in analysis.permutation_importance(df, ["text_length", "other"], found, truth).collect()}
    assert got[None] == (1.0, 0.0) and got["other"] == (1.0, 0.0) and got["text_length"][1] > 0.3
    shuffled = found(analysis.shuffled_within_pages(df, "text_length", 0)).join(truth, "page_id").collect()
    want = sum(len(set(r.found) & set(r.truth)) / len(set(r.found) | set(r.truth)) for r in shuffled) / 6
    assert got["text_length"][0] == pytest.approx(want)


def test_answers_are_asked_on_the_executors(spark):
    def ask(markdown, model):
        if model == 2:
            raise ValueError("busy")
        return f'[{{"start": {len(markdown)}, "end": 9}}]' if model == 0 else "nothing"

    df = spark.createDataFrame([(1, "abc"), (2, None)], "page_id bigint, markdown string")
    got = {r.model_idx: None if r.ranges is None else [tuple(x) for x in r.ranges] for r in predictors.answers(df, ask).collect()}
    assert got == {0: [(3, 9)], 1: None, 2: None}


def test_tag_numbers(spark):
    df = spark.createDataFrame([("nav",), ("div",), (None,), ("form",), ("body",)], "t string")
    assert [r.v for r in df.select(features.tag_number(F.col("t")).alias("v")).collect()] == [2, 0, 0, 8, 0]


def test_robots_files(spark):
    files = [("http://a.b", 200, "User-agent: *\nDisallow: /x\nAllow: /\n\nUser-agent: own\nDisallow: /"), ("http://c.d", 404, "User-agent: *\nDisallow: /"), ("http://e.f", 200, None)]
    robots = spark.createDataFrame(files, "origin string, status int, text string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(["http://a.b/x/1", "http://A.b/y", "http://c.d/x", "http://e.f/", "http://g.h/x", None])], "page_id int, url string")
    ids = lambda df: sorted(r.page_id for r in df.collect())
    assert ids(scrape.allowed_by_files(pages, robots)) == [1, 2, 3, 4, 5]
    assert ids(scrape.allowed_by_files(pages, robots, "own")) == [2, 3, 4, 5]


def test_runners_bound_the_fetches(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.x/{i}") for i in range(40)], "page_id bigint, url string").repartition(8)
    got = scrape.scrape(pages, lambda url: f"<p>{url}</p>", runners=2)
    assert got.rdd.getNumPartitions() <= 2 and got.where("status = 'success'").count() == 40


def test_settings():
    good = {"run_name": "a-1", "model": "0.5B", "phases": "sft", "max_seq_len": 8192, "max_runtime": "6h", "hf_dataset_revision": "0a1b2c3", "gpu_type": "NVIDIA GeForce RTX 4090"}
    assert training.setting_problems(good) == ([], [])
    errors, warnings = training.setting_problems({**good, "model": "7B", "max_runtime": "6d", "sft_epoch": 3, "lora_r": 12, "sft_lr": 1.0, "max_seq_len": 10, "phases": "sft,x"})
    assert [e.split(":")[0] for e in errors] == ["sft_epoch", "model", "phases", "max_seq_len", "max_runtime", "lora_r", "sft_lr"] and warnings == []
    assert [w.split(":")[0] for w in training.setting_problems({**good, "model": "3B", "hf_dataset_revision": "main"})[1]] == ["hf_dataset_revision", "gpu_type"]
    assert training.setting_problems({**good, "phases": "sft,grpo", "sft_max_steps": 5})[0] and training.setting_problems({})[0]


def test_progress_of_streams(spark, tmp_path):
    listener = scrape.Progress()
    spark.streams.addListener(listener)
    try:
        spark.range(5).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        stream.writeStream.format("noop").queryName("count").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "log")).start().awaitTermination()
        for _ in range(50):
            if any(n == "count" and r == 5 for n, _, r, _ in listener.batches):
                break
            time.sleep(0.2)
        assert any(n == "count" and r == 5 for n, _, r, _ in listener.batches)
    finally:
        spark.streams.removeListener(listener)
