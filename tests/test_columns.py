"""Column functions against values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from pagelathe.functions import answers as A
from pagelathe.functions import ranges as R
from pagelathe.functions import scores as S
from pagelathe.functions import text as T
from pagelathe.functions import urls as U

RT = "array<struct<start:int,end:int>>"


def one(spark, column, **values):
    types = {"r": RT, "a": "array<int>", "b": "array<int>"}
    schema = ", ".join(f"{k} {types.get(k, 'int' if isinstance(v, int) else 'string')}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first().v


def ranges(v):
    return None if v is None else [(x.start, x.end) for x in v]


@pytest.mark.parametrize("lines,want", [([1, 2, 3, 7, 9, 10], [(1, 3), (7, 7), (9, 10)]), ([], []), ([5, 5, 4], [(4, 5)]), (None, None)])
def test_lines_to_ranges(spark, lines, want):
    assert ranges(one(spark, R.lines_ranges(F.col("a")), a=lines)) == want


def test_ranges_to_lines_and_back(spark):
    assert one(spark, R.range_lines(F.col("r")), r=[(3, 1)]) == []
    assert one(spark, R.range_lines(F.col("r")), r=[(2, 3), (1, 2), (None, 4)]) == [1, 2, 3]
    assert ranges(one(spark, R.lines_ranges(R.range_lines(F.col("r"))), r=[(4, 6), (1, 2), (3, 3)])) == [(1, 6)]


@pytest.mark.parametrize("text,want", [("10:12,15:20", [(10, 12)]), ("10", None), ("", []), ("0:3", []), ("4:2", []), ("1:2,", None)])
def test_parse_compact(spark, text, want):
    assert ranges(one(spark, R.parse_compact(F.col("t"), F.lit(18)), t=text)) == want


def test_compact(spark):
    assert one(spark, R.compact(F.col("r")), r=[(1, 2), (4, 4)]) == "1:2,4:4"
    assert one(spark, R.compact(F.col("r")), r=[]) == "1:1"
    assert one(spark, R.compact(F.col("r"), None), r=[]) == ""
    assert one(spark, R.compact(F.col("r")), r=None) is None


def test_validation(spark):
    assert ranges(one(spark, R.valid_strict(F.col("r"), F.lit(20)), r=[(5, 30), (25, 26)])) == [(5, 20)]
    assert one(spark, R.valid_strict(F.col("r"), F.lit(20)), r=[(5, 4)]) is None
    assert ranges(one(spark, R.valid_lenient(F.col("r"), F.lit(20)), r=[(5, 30), (2, 3), (0, 1)])) == [(2, 3)]
    assert one(spark, R.acceptable(F.col("r"), F.lit("manual")), r=[(1, 1)]) is True
    assert one(spark, R.acceptable(F.col("r"), F.lit("other")), r=[(1, 1)]) is False


def test_overlap_and_boundary(spark):
    label = lambda n: one(spark, R.overlaps(F.col("r"), F.lit(3), F.lit(3 + n - 1)), r=[(5, 9)])
    assert (label(2), label(3)) == (0, 1)
    assert one(spark, R.boundary(F.col("r"), F.lit(9)), r=[(1, 2), (5, 9), (9, 10)]).start == 5
    assert ranges(one(spark, R.conflicts(F.col("r"), F.lit(2), F.lit(5)), r=[(1, 2), (5, 9), (10, 11)])) == [(1, 2), (5, 9)]


def test_shown(spark):
    assert one(spark, R.shown(F.col("r")), r=None) == "N/A"
    assert one(spark, R.shown(F.col("r")), r=[]) == "[]"
    assert one(spark, R.shown(F.col("r")), r=[(1, 22), (30, 44), (50, 60)]) == "1-22, 30-44,..."


def test_scores(spark):
    a, b = F.col("a"), F.col("b")
    assert one(spark, S.iou(a, b), a=[1, 2, 3], b=[2, 3, 4, 5]) == 2 / 5
    assert one(spark, S.iou(a, b), a=[], b=[]) == 1.0
    assert one(spark, S.iou(a, b), a=None, b=[1]) is None
    assert one(spark, S.f_beta(a, b), a=[1, 2], b=[2, 3, 4]) == pytest.approx(5 * 0.5 / 3 / (4 * 0.5 + 1 / 3))
    assert one(spark, S.f_beta(a, b), a=None, b=[1]) == 0.0
    assert one(spark, S.precision(a, b), a=[], b=[1]) == 0.0


def test_tokens(spark):
    assert one(spark, T.clean_tokens(F.col("t")), t="[Foo Bar](u) a -- baz,") == ["foo", "bar", "", "baz"]
    assert one(spark, T.keywords(F.col("t")), t="Ab abc ABC d-efg 123") == ["abc", "efg", "123"]
    assert one(spark, T.words(F.col("t")), t=" a b  c ") == ["a", "b", "c"]
    assert one(spark, T.words(F.col("t")), t="") == []
    assert one(spark, T.selection_words(F.col("t")), t="See [This Page](x), now!") == ["see", "this", "page", "now"]


def test_links(spark):
    text = "[a](http://x.y/1) and [long label here](http://www.w3.org/)"
    assert one(spark, T.link_count(F.col("t")), t=text) == 2
    assert one(spark, T.is_link_only(F.col("t")), t="[a](b) [c](d)") is True
    assert one(spark, T.is_link_only(F.col("t")), t=text) is False
    assert one(spark, T.short_links(F.col("t")), t=text) == 1
    assert one(spark, T.external_links(F.col("t"), F.lit("https://www.x.y/z")), t=text) == 1


def test_line_stats(spark):
    stats = T.line_stats(F.col("t"), F.col("p"))
    row = spark.createDataFrame([("Hello, **big** World 42! Bye.", "12. ")], "t string, p string").select(*[c.alias(n) for n, c in stats.items()]).first()
    assert (row.text_length, row.word_count, row.number_count, row.uppercase_count, row.sentence_count, row.comma_count) == (29, 5, 2, 3, 2, 1)
    assert (row.has_bold, row.is_list_item, row.is_heading, row.punctuation_count) == (1, 1, 0, 3)


def test_class_features(spark):
    row = spark.createDataFrame([(["post-footer", "page"],)], "c array<string>").select(*[c.alias(n) for n, c in T.class_features(F.col("c")).items()]).first()
    assert row.own_class_weight == 25 - 25 - 25
    assert (row.has_positive_class, row.has_boilerplate_class) == (1, 0)


def test_answers(spark):
    assert one(spark, A.json_part(F.col("t")), t='text\n```json\n[{"start":1,"end":2}]\n```') == '[{"start":1,"end":2}]'
    assert ranges(one(spark, A.json_ranges(F.col("t")), t='[{"start":1,"end":2},{"start":"x","end":3}]')) == [(1, 2), (None, 3)]
    assert one(spark, A.json_ranges(F.col("t")), t='{"start":1}') is None
    assert one(spark, A.message_content(F.col("t")), t='{"choices":[{"message":{"content":"hi"}}]}') == "hi"
    for text, good in (("1:2,3:4", True), ("1:2,", False), ("15:85", True), ("", False), ("a", False)):
        assert one(spark, A.accepted(F.col("t")), t=text) is good
        assert (one(spark, A.grammar_state(F.col("t")), t=text) == 3) is good


def test_urls(spark):
    assert one(spark, U.site_of(F.col("t")), t="HTTP://WWW.Ex.Com:8080/a?b") == "ex.com"
    assert one(spark, U.site_of(F.col("t")), t="no url") is None
