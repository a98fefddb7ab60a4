"""Titles, keys, slugs, counts and other scalar projections."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What titles are stripped of, with and without curly quotes.
MARKUP, QUOTED, CURLY = "*_`#", '*_`#"', "*_`#“”‘’\""


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def strip_title(x: Column, marks: str = MARKUP) -> Column:
    return stripped(F.translate(x, marks, ""))


def heading_key(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.translate(x, MARKUP, "")), "[^a-z0-9]", "")


def camel_split(x: Column) -> Column:
    return F.regexp_replace(x, "(?<=[a-z])(?=[A-Z])", " ")


def spaced_title(x: Column) -> Column:
    """Emphasis dropped, camel case split, white space collapsed."""
    return stripped(F.regexp_replace(F.translate(camel_split(x), "_*", ""), r"\s+", " "))


def spoken_header(num: Column, label: Column, title: Column) -> Column:
    return F.when(num > 0, F.concat(label, F.lit(". "), title, F.lit("."))).otherwise(F.concat(title, F.lit(".")))


def chapter_number(label: Column) -> Column:
    """0 for a label without a number, or with one that is no 32-bit number."""
    found = F.regexp_extract(label, r"(?i)^CHAPTER\s+(\d+)", 1)
    return F.coalesce(found.try_cast("int"), F.lit(0))


@F.pandas_udf(T.StringType())
def title_case(x: pd.Series) -> pd.Series:
    """str.title(), which initcap isn't: letters after an apostrophe rise too."""
    return x.map(lambda s: None if s is None else s.title())


def page_title(page_text: Column, label: Column) -> Column:
    """The second filled line of an opening page whose first says CHAPTER or PRELUDE, else the label in title case."""
    lines = F.filter(F.transform(F.split(page_text, "\n"), stripped), lambda s: s != "")
    head = F.upper(F.get(lines, F.lit(0)))
    opens = F.coalesce(head.startswith("CHAPTER") | head.startswith("PRELUDE"), F.lit(False))
    return F.when(opens & (F.size(lines) > 1), F.btrim(F.get(lines, F.lit(1)), F.lit(" -–—:"))).otherwise(title_case(label))


def slug(title: Column, num: Column | None = None, length: int | None = None, trimmed: bool = False) -> Column:
    x = F.regexp_replace(F.lower(title), "[^a-z0-9]+", "_")
    if trimmed:
        x = F.btrim(x, F.lit("_"))
    if length:
        x = F.substring(x, 1, length)
    return x if num is None else F.concat(F.format_string("%03d", num), F.lit("_"), x)


def output_paths(slug_col: Column, folder: str) -> list[Column]:
    return [F.concat(F.lit(folder + "/"), slug_col, F.lit("." + e)).alias(e) for e in ("mp4", "wav", "raw", "idx")]


def chunk_id(prefix: Column, n: Column) -> Column:
    return F.format_string("%s-%05d", prefix, n)


def rough_tokens(x: Column) -> Column:
    return F.floor(F.length(x) / 4)


def word_count(x: Column) -> Column:
    return F.regexp_count(x, F.lit(r"\S+"))


def space_count(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
