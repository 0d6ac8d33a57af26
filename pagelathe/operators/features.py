"""Features of lines: page windows, blocks, style groups and uniqueness.

All windows of a page are partitioned by page_id or more, so the whole feature
set of pages costs one exchange on page_id. Ratios stay unrounded until
`feature_table` writes the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.ranges import overlaps
from .skew import spread_join

IN_LABELS = ("header", "nav", "main", "article", "footer", "aside", "form")


def page_window(*more: str):
    return Window.partitionBy("page_id", *more)


def line_features(lines: DataFrame) -> DataFrame:
    """Text, link, class and place features of `items.page_lines` rows; summaries have the statistics of no text."""
    plain = F.col("item_type") == "text"
    stats = T.line_stats(F.col("text"), F.col("md_prefix"))
    summary = {"link_ratio": F.lit(1.0), "link_count": F.col("link_lines"), "is_link_only": T.flag(F.col("link_lines") > 0), "is_list_item": T.flag(F.col("link_lines") > 0)}
    none = lambda name: summary.get(name, F.lit(0.0) if name.endswith("ratio") or name == "avg_word_length" else F.lit(0))
    out = lines.select(
        "*",
        T.ratio(F.size("ancestors"), F.col("depth")).alias("ancestor_depth_ratio"),
        F.coalesce(F.try_element_at("ancestors", F.lit(-1)), F.lit("body")).alias("parent_tag"),
        *[T.flag(F.array_contains("ancestors", x)).alias(f"in_{x}") for x in IN_LABELS],
        T.flag(F.col("item_type") == "link_summary").alias("is_link_summary"),
        T.flag(F.col("item_type") == "cookie_summary").alias("is_cookie_summary"),
        T.external_links(F.col("text"), F.col("url")).alias("external_link_count"),
        *[F.when(plain, c).otherwise(none(n)).alias(n) for n, c in stats.items()],
    )
    return out.select("*", *[c.alias(n) for n, c in T.class_features(F.col("class_chain")).items()])


# Numbers of the labels that a line may stand in; any other label counts as the body.
TAG_NUMBERS = {"body": 0, "header": 1, "nav": 2, "main": 3, "article": 4, "section": 5, "footer": 6, "aside": 7, "form": 8}


def tag_number(tag: Column) -> Column:
    """Number of a parent tag; 0 for unknown and null ones."""
    found = F.lit(0)
    for name, number in TAG_NUMBERS.items():
        found = F.when(tag == name, number).otherwise(found)
    return found


def with_position(lines: DataFrame) -> DataFrame:
    """total_lines, position_pct and cumulative_text_pct of lines with line_num, span_lines and text_length."""
    page, run = page_window(), page_window().orderBy("line_num").rowsBetween(Window.unboundedPreceding, 0)
    return (
        lines.withColumn("total_lines", F.sum("span_lines").over(page))
        .withColumn("position_pct", T.ratio(F.col("line_num"), F.col("total_lines")))
        .withColumn("cumulative_text_pct", T.ratio(F.sum("text_length").over(run), F.sum("text_length").over(page)))
    )


def running_numbers(lines: DataFrame, order: str = "seq") -> DataFrame:
    """line_num from the spans of the rows before."""
    run = page_window().orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("line_num", (F.sum("span_lines").over(run) - F.col("span_lines") + 1).cast("int"))


def with_rolling(lines: DataFrame, half: int = 2) -> DataFrame:
    """Means of text_length and link_ratio over the rows from `half` before to `half` behind, cut at the page's ends."""
    near = page_window().orderBy("line_num").rowsBetween(-half, half)
    return lines.withColumn("mean_text_length_w5", F.avg("text_length").over(near)).withColumn("mean_link_ratio_w5", F.avg("link_ratio").over(near))


def with_blocks(lines: DataFrame, keys: tuple[str, ...] = ("parent_tag", "depth")) -> DataFrame:
    """block: number from 1 of the contiguous run of rows that agree on `keys`."""
    order = page_window().orderBy("line_num")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.lag(k).over(order))
    new = F.when((F.row_number().over(order) > 1) & same, 0).otherwise(1)
    return lines.withColumn("__new", new).withColumn("block", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def with_block_features(lines: DataFrame) -> DataFrame:
    """Sizes, densities and places of blocks; `lines` has block, text_length, link_ratio and the flags of lines."""
    b = page_window("block")
    total = lambda c: F.sum(c).over(b)
    size = F.count("*").over(b)
    mean = F.avg("text_length").over(b)
    p = T.flag((F.col("is_heading") == 0) & (F.col("is_list_item") == 0) & (F.col("is_link_summary") == 0) & (F.col("is_cookie_summary") == 0))
    rank = F.row_number().over(b.orderBy("line_num")) - 1
    columns = {
        "block_size": size.cast("int"),
        "block_text_density": mean,
        "block_link_density": T.ratio(total(F.col("text_length") * F.col("link_ratio")), total(F.col("text_length"))),
        "relative_position_in_block": T.ratio(rank, size - 1),
        "sibling_text_variance": F.when((size > 1) & (mean > 0), F.stddev_pop("text_length").over(b) / mean).otherwise(0.0),
        "block_heading_density": total(F.col("is_heading")) / size,
        "block_li_p_ratio": total(F.col("is_list_item")) / F.greatest(total(p), F.lit(1)),
        "block_img_p_ratio": total(F.col("has_image")) / F.greatest(total(p), F.lit(1)),
        "block_input_density": total(F.col("has_input")) / size,
        "container_p_ratio": total(p) / size,
        "container_content_score": total(1 + F.col("comma_count") + F.least(F.lit(3.0), F.col("text_length") / 100)),
    }
    return lines.select("*", *[c.alias(n) for n, c in columns.items()])


def with_content_region(lines: DataFrame) -> DataFrame:
    """content_region_ratio: 1 in the first block with the most text, if that is more than half of the page's."""
    page = page_window()
    sized = lines.withColumn("__block_text", F.sum("text_length").over(page_window("block"))).withColumn("__all", F.sum("text_length").over(page))
    best = F.min(F.when(F.col("__block_text") == F.col("__most"), F.col("block"))).over(page)
    return (
        sized.withColumn("__most", F.max("__block_text").over(page))
        .withColumn("__best", best)
        .withColumn("content_region_ratio", T.flag((F.col("block") == F.col("__best")) & (F.col("__most") > 0.5 * F.col("__all")) & (F.col("__all") > 0)))
        .drop("__block_text", "__all", "__most", "__best")
    )


def with_style_groups(lines: DataFrame, least: int = 3, rounds: int = 8) -> DataFrame:
    """Size, mean link ratio and mean words of the style group of each row.

    A row begins with its nearest styled ancestor's classes. In each round the
    rows of groups smaller than `least` move to the next classes of their own
    chain, if there are any; rounds after the last change do nothing.
    """
    out = lines.withColumn("style_group", F.coalesce(F.try_element_at("class_chain", F.lit(1)), F.lit("_no_class")))
    for _ in range(rounds):
        place = F.array_position("class_chain", F.col("style_group"))
        following = F.when(place > 0, F.try_element_at("class_chain", (place + 1).cast("int")))
        out = out.withColumn("__n", F.count("*").over(page_window("style_group"))).withColumn(
            "style_group", F.when(F.col("__n") < least, F.coalesce(following, F.col("style_group"))).otherwise(F.col("style_group"))
        )
    group = page_window("style_group")
    return (
        out.withColumn("style_group_size", F.count("*").over(group).cast("int"))
        .withColumn("style_group_link_density", F.avg("link_ratio").over(group))
        .withColumn("style_group_mean_words", F.avg("word_count").over(group))
        .drop("__n")
    )


def with_heading_distance(lines: DataFrame) -> DataFrame:
    """tag_transition, and rows since the last heading (before the first: the row's place from 0)."""
    order = page_window().orderBy("line_num")
    place = F.row_number().over(order) - 1
    last = F.max(F.when(F.col("is_heading") == 1, F.col("__place"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        lines.withColumn("__place", place)
        .withColumn("tag_transition", T.flag((F.col("__place") > 0) & (F.col("parent_tag") != F.lag("parent_tag").over(order))))
        .withColumn("dist_to_heading", F.col("__place") - F.coalesce(last, F.lit(0)))
        .drop("__place")
    )


# ------------------------------------------------------------- words of a page


def word_scores(lines: DataFrame) -> DataFrame:
    """(page_id, line_num) with mean_idf, max_idf, word_novelty, word_novelty_sum and bigram_novelty.

    Words count on their page: inverse frequency against its lines, novelty
    against its words. Lines without tokens have 0 in all. `lines` has text.
    """
    tokens = lines.select("page_id", "line_num", T.clean_tokens(F.col("text")).alias("tokens"))
    sized = tokens.withColumn("__lines", F.count("*").over(page_window()))
    flat = sized.select("page_id", "line_num", "__lines", F.posexplode("tokens").alias("pos", "word"))
    word = page_window("word")
    first = F.row_number().over(page_window("word", "line_num").orderBy("pos")) == 1
    scored = (
        flat.withColumn("__first", T.flag(first))
        .withColumn("n", F.count("*").over(word))
        .withColumn("df", F.sum("__first").over(word))
        .withColumn("next", F.lead("word").over(page_window("line_num").orderBy("pos")))
        .withColumn("bn", F.count("*").over(page_window("word", "next")))
    )
    idf = F.log(F.col("__lines") / F.col("df"))
    per_line = scored.groupBy("page_id", "line_num").agg(
        F.avg(idf).alias("mean_idf"),
        F.max(idf).alias("max_idf"),
        F.avg(1 / F.col("n")).alias("word_novelty"),
        F.sum(1 / F.col("n")).alias("word_novelty_sum"),
        F.avg(F.when(F.col("next").isNotNull(), 1 / F.col("bn"))).alias("bigram_novelty"),
    )
    names = ["mean_idf", "max_idf", "word_novelty", "word_novelty_sum", "bigram_novelty"]
    return lines.select("page_id", "line_num").join(per_line, ["page_id", "line_num"], "left").fillna(0.0, names)


def corpus_idf(lines: DataFrame) -> DataFrame:
    """(word, df, idf): pages that hold a word, and log(pages / df). A word counts once a page, before any shuffle of words."""
    pages = lines.select("page_id").distinct().agg(F.count("*").alias("pages"))
    words = lines.select("page_id", F.explode(F.array_distinct(T.clean_tokens(F.col("text")))).alias("word")).distinct()
    counts = words.groupBy("word").agg(F.count("*").alias("df"))
    total = pages.first()[0]
    return counts.withColumn("idf", F.log(F.lit(float(total)) / F.col("df")))


def line_frequency(lines: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """(page_id, line_num, line_frequency): share of the pages of `fit_on` (by default of `lines`) that hold the very text.

    Texts are compared by a 64-bit hash, and a text on every page is dealt out
    over several tasks. Empty texts have 0.
    """
    known = fit_on if fit_on is not None else lines
    hashed = lambda rows: rows.select("page_id", *(["line_num"] if rows is lines else []), F.xxhash64(F.trim("text")).alias("key"), (F.trim("text") != "").alias("said"))
    pages = known.select("page_id").distinct().count()
    once = hashed(known).where("said").select("page_id", "key").distinct()
    counts = once.groupBy("key").agg(F.count("*").alias("n"))
    # Where the lines are their own fit, most texts stand on one page; only the others are looked up.
    least, alone = (1, 0) if fit_on is not None else (2, 1)
    found = spread_join(hashed(lines), counts.where(F.col("n") >= least), ["key"], ["page_id", "line_num"], "left")
    n = F.when(F.col("said"), F.coalesce("n", F.lit(alone))).otherwise(0)
    return found.select("page_id", "line_num", (n / F.lit(float(max(pages, 1)))).alias("line_frequency"))


# ---------------------------------------------------------------- whole table

#: The columns of the feature table in their order, with the digits that ratios are rounded to.
COLUMNS: dict[str, int | None] = dict.fromkeys(
    "page_id dataset line_num span_lines position_pct total_lines depth ancestor_depth_ratio parent_tag in_header in_nav"
    " in_main in_article in_footer in_aside in_form text_length word_count link_ratio link_count is_link_only is_heading"
    " heading_level has_bold is_list_item is_link_summary is_cookie_summary punctuation_ratio punctuation_count"
    " sentence_count avg_word_length uppercase_ratio uppercase_count number_ratio number_count type_token_ratio"
    " unique_word_count short_link_count short_link_ratio comma_count external_link_count has_positive_class"
    " has_negative_class has_unlikely_class has_boilerplate_class own_class_weight has_image has_input is_button"
    " has_aria_hidden in_table in_details is_hidden role_is_boilerplate has_schema_content is_byline in_figure"
    " is_last_child sibling_count sibling_tag_uniformity mean_idf max_idf line_frequency word_novelty word_novelty_sum"
    " bigram_novelty cumulative_text_pct mean_text_length_w5 mean_link_ratio_w5 block_size block_text_density"
    " block_link_density relative_position_in_block sibling_text_variance block_heading_density block_li_p_ratio"
    " block_img_p_ratio block_input_density container_p_ratio container_content_score content_region_ratio"
    " style_group_size style_group_link_density style_group_mean_words label".split()
)
COLUMNS.update(dict.fromkeys("mean_text_length_w5 block_text_density style_group_mean_words".split(), 1))
COLUMNS.update(dict.fromkeys("container_content_score avg_word_length".split(), 2))
COLUMNS.update(
    dict.fromkeys(
        "ancestor_depth_ratio punctuation_ratio uppercase_ratio number_ratio type_token_ratio position_pct mean_idf max_idf line_frequency word_novelty word_novelty_sum bigram_novelty cumulative_text_pct"
        " mean_link_ratio_w5 block_link_density relative_position_in_block sibling_text_variance block_heading_density"
        " block_li_p_ratio block_img_p_ratio block_input_density container_p_ratio style_group_link_density".split(),
        4,
    )
)


def feature_table(lines: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """All feature columns of `items.page_lines` rows and their label, rounded as the table is written."""
    full = features_of(lines, labels, fit_on)
    return full.select(*[(F.round(c, d) if d is not None else F.col(c)).alias(c) for c, d in COLUMNS.items()])


def features_of(lines: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """All features of `items.page_lines` rows and their label, beside the columns of the lines.

    `labels` has page_id, dataset and ranges; pages without a row there are left
    out. A line is labelled 1 if it touches a range.
    """
    base = line_features(lines).join(labels.select("page_id", F.coalesce("dataset", F.lit("original")).alias("dataset"), "ranges"), "page_id")
    base = with_block_features(with_blocks(with_rolling(with_position(base))))
    base = with_style_groups(with_content_region(base))
    base = base.withColumn("label", overlaps(F.col("ranges"), F.col("line_num"), F.col("line_num") + F.col("span_lines") - 1))
    keys = ["page_id", "line_num"]
    return base.join(word_scores(lines), keys).join(line_frequency(lines, fit_on), keys)
