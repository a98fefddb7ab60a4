"""Ordered cleaning rules as chained column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRIP = r"^\s+|\s+$"

# The rules' patterns, which must be these for right results. (?d): only \n ends a line.
BASIC = (
    ("picture", r"(?id)==>.*?intentionally omitted.*?<==", ""),
    ("link", r"\[([^\]]+)\]\([^)]*\)", "$1"),
    ("code", r"`[^`]*`", ""),
    ("header", r"(?md)^#{1,6}\s*", ""),
    ("emphasis", r"\*{1,2}|_{1,2}", ""),
    ("em_dash", "—", ", "),
    ("apostrophes", "[‘’]", "'"),
    ("quotes", "[“”]", '"'),
    ("nfkc", None, None),
    ("newlines", r"\n{3,}", "\n\n"),
    ("strip", STRIP, ""),
)
PAGES = (
    ("page_mark", r"<!--PAGE:\d+-->", ""),
    ("caption", r"(?mds)^_\*\*.*?\((?:Courtesy|Cou\w*)[^)]*\)_\s*$", ""),
    ("page_picture", r"(?d)\*{0,2}==>.*?intentionally omitted.*?<==\*{0,2}", ""),
    ("credit", r"\((?:Courtesy of|Photo by)[^)]*\)", ""),
    ("endnote", r"\[\s*\d{1,3}\s*\]", ""),
    ("link", r"\[([^\]]+)\]\([^)]*\)", "$1"),
    ("code", r"`[^`]*`", ""),
    ("header", r"(?md)^#{1,6}\s*", ""),
    ("emphasis", r"\*{1,2}|_{1,2}", ""),
    ("dashes", "[—–]", ", "),
    ("apostrophes", "[‘’]", "'"),
    ("quotes", "[“”]", '"'),
    ("nfkc", None, None),
    ("spaces", r"[ \t]{2,}", " "),
    ("newlines", r"\n{3,}", "\n\n"),
    ("strip", STRIP, ""),
)
RULES = {"basic": BASIC, "pages": PAGES}


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode NFKC, for which Spark has no function."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def rule(text: Column, name: str, kind: str = "pages") -> Column:
    """One cleaning rule by name."""
    _, pattern, to = next(r for r in (*RULES[kind], *BASIC, *PAGES) if r[0] == name)
    return nfkc(text) if pattern is None else F.regexp_replace(text, pattern, F.lit(to))


def clean(text: Column, kind: str = "basic", normalise: bool = True) -> Column:
    """All rules of a kind in their order; normalise=False leaves NFKC out and stays in the JVM."""
    for name, pattern, _ in RULES[kind]:
        if pattern is not None or normalise:
            text = rule(text, name, kind)
    return text
