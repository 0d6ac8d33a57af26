"""Statistics and tokens of one line of text, as column expressions.

A null text gives null everywhere. Words are split at white space of any
script; ratios of an empty text are 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and character sets of the line features.
LINK = r"\[.*?\]\([^)]*\)"
LINK_PARTS = r"\[([^\]]*)\]\(([^)]*)\)"
PUNCTUATION = ".,;:!?()[]{}\"'-"
SENTENCE_END = r"[.!?](?:\s|$)"
POSITIVE = "article|body|content|entry|hentry|h-entry|main|page|pagination|post|text|blog|story"
NEGATIVE = (
    "-ad-|hidden|banner|combx|comment|com-|contact|footer|gdpr|masthead|media|meta|outbrain|promo|related|scroll|share"
    "|shoutbox|sidebar|skyscraper|sponsor|shopping|tags|widget"
)
UNLIKELY = (
    "-ad-|ai2html|banner|breadcrumbs|combx|comment|community|cover-wrap|disqus|extra|footer|gdpr|header|legends|menu"
    "|related|remark|replies|rss|shoutbox|sidebar|skyscraper|social|sponsor|supplemental|ad-break|agegate|pagination"
    "|pager|popup|yom-remote"
)
BOILERPLATE = (
    "byline|author|timestamp|outbrain|taboola|criteo|consent|modal|paywall|obfuscated|blurred|overlay|embed|newsletter"
    "|subscribe|login|rating"
)


def flag(c: Column) -> Column:
    """1 or 0; null counts as 0."""
    return F.when(c, 1).otherwise(0)


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(0.0)


def collapse(text: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def words(text: Column) -> Column:
    """Words split at white space; an empty text has none."""
    return F.filter(F.split(collapse(text), " "), lambda w: w != "")


def without_links(text: Column) -> Column:
    return F.regexp_replace(text, LINK, "")


def link_chars(text: Column) -> Column:
    return F.length(text) - F.length(without_links(text))


def link_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LINK))


def is_link_only(text: Column) -> Column:
    """At least one link and nothing beside links but white space."""
    return (link_count(text) > 0) & (collapse(without_links(text)) == "")


def char_count(text: Column, kind: str) -> Column:
    """Characters of a Unicode class like \\p{L}."""
    return F.length(F.regexp_replace(text, f"[^{kind}]", ""))


def short_links(text: Column) -> Column:
    """Links whose label has fewer than ten characters."""
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(LINK_PARTS), F.lit(1)), lambda x: F.length(x) < 10))


def line_stats(text: Column, prefix: Column) -> dict[str, Column]:
    """The text statistics of a line by name, in the order of the feature table."""
    n, w = F.length(text), words(text)
    count = F.size(w)
    lower = F.array_distinct(F.transform(w, F.lower))
    letters, upper = char_count(text, r"\p{L}"), char_count(text, r"\p{IsUppercase}")
    digits = char_count(text, r"\p{Nd}")
    marks = n - F.length(F.translate(text, PUNCTUATION, ""))
    head = F.rtrim(prefix)
    return {
        "text_length": n,
        "word_count": count,
        "link_ratio": ratio(link_chars(text), n),
        "link_count": link_count(text),
        "is_link_only": flag(is_link_only(text)),
        "is_heading": flag(head.startswith("#")),
        "heading_level": F.when(head.startswith("#"), F.length(head)).otherwise(0),
        "has_bold": flag(text.contains("**")),
        "is_list_item": flag((prefix == "- ") | prefix.rlike(r"^\d+\. $")),
        "punctuation_ratio": ratio(marks, n),
        "punctuation_count": marks,
        "sentence_count": F.regexp_count(text, F.lit(SENTENCE_END)),
        "avg_word_length": ratio(F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)), count),
        "uppercase_ratio": ratio(upper, letters),
        "uppercase_count": upper,
        "number_ratio": ratio(digits, n),
        "number_count": digits,
        "type_token_ratio": ratio(F.size(lower), count),
        "unique_word_count": F.size(lower),
        "short_link_count": short_links(text),
        "short_link_ratio": short_links(text) / F.greatest(link_count(text), F.lit(1)),
        "comma_count": n - F.length(F.translate(text, ",，", "")),
    }


def clean_tokens(text: Column) -> Column:
    """Words of more than one character, lower case, links as their labels, without marks at the ends.

    A word of marks only becomes an empty token and stays.
    """
    plain = F.regexp_replace(text, r"\[(.*?)\]\([^)]*\)", "$1")
    return F.transform(F.filter(words(plain), lambda w: F.length(w) > 1), lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION)))


def keywords(text: Column) -> Column:
    """Different runs of three or more Latin letters and digits, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"[a-zA-Z0-9À-ɏ]{3,}"), F.lit(0)), F.lower))


def domain_of(url: Column) -> Column:
    """The authority of a url in lower case, without leading letters w and dots; empty for relative urls."""
    found = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.lower(found), r"^[w.]+", "")


def external_links(text: Column, base_url: Column) -> Column:
    """Links to another domain than that of the page; targets without a domain do not count."""
    own = domain_of(base_url)
    targets = F.regexp_extract_all(text, F.lit(LINK_PARTS), F.lit(2))
    return F.size(F.filter(targets, lambda u: (domain_of(u) != "") & (domain_of(u) != F.coalesce(own, F.lit("")))))


def class_features(chain: Column) -> dict[str, Column]:
    """Name patterns over the classes of an element and its ancestors; the weight looks at the nearest styled one."""
    whole = F.array_join(chain, " ")
    own = F.coalesce(F.try_element_at(chain, F.lit(1)), F.lit(""))
    has = lambda c, pattern: F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False))
    weight = F.when(has(own, POSITIVE), 25).otherwise(0)
    for pattern in (NEGATIVE, UNLIKELY):
        weight = weight - F.when(has(own, pattern), 25).otherwise(0)
    return {
        "has_positive_class": flag(has(whole, POSITIVE)),
        "has_negative_class": flag(has(whole, NEGATIVE)),
        "has_unlikely_class": flag(has(whole, UNLIKELY)),
        "has_boilerplate_class": flag(has(whole, BOILERPLATE)),
        "own_class_weight": weight,
    }


def selection_words(text: Column) -> Column:
    """Words of a text with links as labels, in lower case and without marks."""
    plain = F.regexp_replace(text, r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    return words(F.regexp_replace(F.lower(plain), r"[^\w\s]", ""))
