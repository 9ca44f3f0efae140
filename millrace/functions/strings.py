"""String expressions: Column in, Column out, no Python at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The places a year can have in a title, tried in this order.
YEAR_PATTERNS = [r"\((\d{4})\)", r"\((\d{4})\-", r"\((\d{4})–"]

# The characters string.punctuation lists, as a character class.
PUNCTUATION_CLASS = "[!\"#$%&'()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~]"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(text: str | Column, patterns: Sequence[str]) -> Column:
    """Group 1 of the first pattern that matches, '' when none does."""
    found = [F.regexp_extract(col(text), p, 1) for p in patterns]
    out = F.lit("")
    for match in reversed(found):
        out = F.when(match != "", match).otherwise(out)
    return out


def title_year(title: str | Column) -> Column:
    return first_match(title, YEAR_PATTERNS)


def words_found(text: str | Column, searched: Sequence[str]) -> list[Column]:
    """One boolean column per word: whether the text holds it."""
    return [F.locate(w.upper(), F.upper(col(text))).cast("boolean").alias(f"is_{w}") for w in searched]


def decade(year: str | Column) -> Column:
    """'1990s' for 1995."""
    return F.format_string("%d0s", F.floor(col(year) / 10).cast("int"))


def clean_punctuation(text: str | Column) -> Column:
    return F.regexp_replace(F.lower(col(text)), PUNCTUATION_CLASS, "")


def title_case(text: str | Column) -> Column:
    return F.initcap(col(text))
