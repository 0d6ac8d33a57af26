"""Answers of models: finding the JSON in a text, and the grammar of compact ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ranges import RANGE

MOST_CHARS = 50_000


def json_part(text: Column) -> Column:
    """What stands in the first fenced block, or the whole text, without white space at the ends."""
    inside = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    fenced = text.rlike(r"(?s)```(?:json)?\s*.*?```")
    return F.btrim(F.when(fenced, inside).otherwise(text), F.lit(" \t\r\n"))


def json_ranges(text: Column) -> Column:
    """Ranges of a JSON list; null if the text is no list. Entries of wrong types have null ends."""
    body = json_part(text)
    return F.when(body.startswith("["), F.from_json(body, f"array<{RANGE}>"))


def message_content(response: Column) -> Column:
    """The first choice's content of a response; null if it is missing, empty or too long."""
    content = F.get_json_object(response, "$.choices[0].message.content")
    return F.when((F.length(content) > 0) & (F.length(content) <= MOST_CHARS), content)


def accepted(text: Column) -> Column:
    """Whether a text is a complete list start:end,start:end of digits."""
    return text.rlike(r"^[0-9]+:[0-9]+(,[0-9]+:[0-9]+)*$")


def grammar_state(text: Column) -> Column:
    """State after reading a text: 0 begin, 1 first number, 2 colon, 3 second number, 4 comma, -1 refused.

    States 3 accepts; after a comma the states 1 to 4 come again.
    """
    digit = lambda c: c.rlike("^[0-9]$")

    def step(state: Column, c: Column) -> Column:
        return (
            F.when(digit(c) & state.isin(0, 1, 4), 1)
            .when(digit(c) & state.isin(2, 3), 3)
            .when((c == ":") & (state == 1), 2)
            .when((c == ",") & (state == 3), 4)
            .otherwise(-1)
        )

    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0), step)
