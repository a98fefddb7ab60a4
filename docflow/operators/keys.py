"""Joins in which null keys are equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matched(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows joined with other where the keys agree, null with null; the keys are those of rows."""
    own = other.select(*(F.col(f"`{c}`").alias(f"_of_{keys.index(c)}" if c in keys else c) for c in other.columns))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & rows[f"`{k}`"].eqNullSafe(own[f"_of_{i}"])
    out = rows.join(own, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*(f"_of_{i}" for i in range(len(keys))))
