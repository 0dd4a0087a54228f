"""Text columns: titles with years, slugs, search, names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelweave.fixed_values import ANY_YEAR_PATTERN, TITLE_YEAR_PATTERN

WHITESPACE = " \t\r\n\x0b\x0c"


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def parse_title_year(raw: Column) -> Column:
    """``struct(title, year)`` of "Title (YYYY)"; null when the text has another shape."""
    text = strip(raw)
    year = F.regexp_extract(text, TITLE_YEAR_PATTERN, 2).try_cast("int")
    title = strip(F.regexp_extract(text, TITLE_YEAR_PATTERN, 1))
    return F.when(year.isNotNull(), F.struct(title.alias("title"), year.alias("year")))


def title_year_or_raw(raw: Column) -> Column:
    """As ``parse_title_year``, but a text without a year stays the title, with a null year."""
    keep = F.struct(raw.alias("title"), F.lit(None).cast("int").alias("year"))
    return F.when(raw.isNotNull(), F.coalesce(parse_title_year(raw), keep))


def title_year_anywhere(raw: Column, default_year: int | None = 2000) -> Column:
    """Takes the first bracketed year from anywhere in the text, cuts it out of the title."""
    year = F.regexp_extract(raw, ANY_YEAR_PATTERN, 1).try_cast("int")
    title = F.regexp_replace(raw, r"^(.*?)\s*\(\d{4}\)", "$1")
    default = F.lit(default_year).cast("int")
    return F.when(raw.isNotNull(), F.struct(title.alias("title"), F.coalesce(year, default).alias("year")))


def slugify(text: Column, max_length: int | None = None, trim_dashes: bool = True) -> Column:
    """Lower case, only ``a-z0-9-``; runs of blanks and dashes become one dash."""
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9\s\p{Z}-]", "")
    slug = F.regexp_replace(plain, r"[\s\p{Z}-]+", "-")
    if trim_dashes:
        slug = F.trim(slug, F.lit("-"))
    return slug if max_length is None else F.substring(slug, 1, max_length)


def contains_any_case(columns: list[Column], query: str) -> Column:
    """True where one of the columns contains the query, whatever the case; wildcards have no meaning."""
    needle = query.lower()
    return reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(needle), F.lit(False)) for c in columns])


def key_text(*columns: Column, separator: str = "_", fold: bool = True) -> Column:
    """Message key: the parts joined, each in lower case with ``_`` for blanks when ``fold`` is set."""
    parts = [c.cast("string") for c in columns]
    if fold:
        parts = [F.replace(F.lower(c), F.lit(" "), F.lit("_")) for c in parts]
    return F.concat_ws(separator, *parts)


def title_case(text: Column) -> Column:
    """Upper-cases the first letter after anything that is not a letter, as in ``Xbox-One``."""
    spaced = F.regexp_replace(F.lower(text), r"([^\p{L} ])", "$1\u0001 ")
    return F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit(""))


def camel_case_columns(df: DataFrame) -> DataFrame:
    """Renames ``snake_case`` columns to ``camelCase``."""
    return df.toDF(*[re.sub(r"_([a-z0-9])", lambda m: m.group(1).upper(), c) for c in df.columns])


def member_of_json_array(json_text: Column, value: Column | str) -> Column:
    """Membership of a value in an array that is stored as JSON text."""
    return F.array_contains(F.from_json(json_text, "array<string>"), value)


def iso_date(text: Column) -> Column:
    """The date of a text that is an ISO date or timestamp as a whole; null for any other text."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ].+)?$")
    return F.when(shaped & F.try_to_timestamp(text).isNotNull(), F.try_to_date(F.substring(text, 1, 10)))
