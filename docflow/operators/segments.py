"""Paragraphs, sentences and greedily packed segments."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.titles import stripped

SENTENCE_END = r"(?<=[.!?])\s+"


def sentences(paragraph: Column) -> Column:
    return F.filter(F.transform(F.split(paragraph, SENTENCE_END), stripped), lambda s: s != "")


def bounds(most: int):
    """From the lengths of pieces to (first, last) of the pieces of every segment: joined by a space, they have at most `most`
    characters; a longer piece stays alone."""

    @F.arrow_udf("array<struct<first:int,last:int>>")
    def run(lengths: pa.Array) -> pa.Array:
        firsts, lasts, n = [], [], []
        for one in lengths:
            total = np.concatenate([[0], np.cumsum(one.values.to_numpy(zero_copy_only=False).astype(np.int64) + 1)]) if one.is_valid else np.zeros(1)
            at = count = 0
            while at < len(total) - 1:
                end = max(at + 1, int(np.searchsorted(total, total[at] + most + 1, "right")) - 1)
                firsts.append(at)
                lasts.append(end - 1)
                at, count = end, count + 1
            n.append(count)
        both = pa.StructArray.from_arrays([pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], ["first", "last"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), both)

    return run


def packed(rows: DataFrame, pieces: str, most: int, name: str) -> DataFrame:
    """rows with `name`: the array column `pieces` joined into segments.

    Where segments begin is found from lengths alone, in one pass over each array; texts stay in the JVM and are joined after.
    (A fold over the texts would be quadratic: Spark copies a fold's state, and any array that a lambda names, at every step.)
    """
    found = rows.withColumn("_bounds", bounds(most)(F.transform(pieces, F.length)))
    join = F.transform("_bounds", lambda b: F.array_join(F.transform(F.sequence(b["first"], b["last"]), lambda k: F.get(pieces, k)), " "))
    return found.withColumn(name, join).drop("_bounds")


def wrap(sentence: str, most: int) -> list[str]:
    """A sentence cut after commas, semicolons and colons, then at spaces, then anywhere: nothing is over `most`.

    Text order is kept, and a piece without a space is cut at the cap.
    """
    if len(sentence) <= most:
        return [sentence]
    out, held = [], ""
    for clause in re.split(r"(?<=[,;:])\s+", sentence):
        if held and len(held) + 1 + len(clause) > most:
            out.append(held)
            held = ""
        while len(clause) > most:
            at = clause.rfind(" ", 0, most + 1)
            head, clause = (clause[:at], clause[at + 1:]) if at > 0 else (clause[:most], clause[most:])
            out.append(head.strip())
            clause = clause.strip()
        held = f"{held} {clause}" if held else clause
    return [x for x in [*out, held] if x]


def hard_wrap(most: int):
    @F.pandas_udf("array<string>")
    def run(pieces: pd.Series) -> pd.Series:
        return pieces.map(lambda xs: None if xs is None else [w for x in xs for w in wrap(x, most)])

    return run


def segments(rows: DataFrame, keys: list[str], text: str, most: int, wrap_long: bool = False) -> DataFrame:
    """keys, para_no, seg_no, seg and ends_paragraph of the paragraphs (blank lines apart) of rows' text."""
    para = rows.select(*keys, F.posexplode(F.split(F.col(text), "\n\n")).alias("para_no", "para")).where(stripped(F.col("para")) != "")
    pieces = sentences(F.col("para"))
    if wrap_long:
        pieces = hard_wrap(most)(pieces)
    # What is needed of the whole array is told before it is exploded, or every row would carry it.
    segs = packed(para.select(*keys, "para_no", pieces.alias("pieces")), "pieces", most, "segs").select(*keys, "para_no", "segs", F.size("segs").alias("n"))
    # An inner explode would be guarded by a filter on the array, for which all of it is computed a second time.
    return segs.select(*keys, "para_no", "n", F.posexplode_outer("segs").alias("seg_no", "seg")).where("seg is not null").select(*keys, "para_no", "seg_no", "seg", (F.col("seg_no") == F.col("n") - 1).alias("ends_paragraph"))
