"""What is left to do, who does it, and how long it takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import titles
from docflow.operators.keys import matched


def pending(chapters: DataFrame, done: DataFrame, by: str) -> DataFrame:
    """Chapters without an output."""
    return chapters.join(done.select(by), by, "left_anti")


def progress(chapters: DataFrame, done: DataFrame, by: str) -> DataFrame:
    """n_done and n_left."""
    seen = chapters.join(done.select(by).distinct().withColumn("_d", F.lit(True)), by, "left")
    return seen.agg(F.count_if(F.col("_d").isNotNull()).alias("n_done"), F.count_if(F.col("_d").isNull()).alias("n_left"))


#: Values of the first ordering column that are numbered together.
SPAN = 1 << 16


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """rows with their place (from 0) within keys by order, whose first column is a whole number.

    Rows are numbered in spans of that column's values, each after the rows of the spans before it: no task
    sorts a whole key, and a hot key is spread over its spans. Null keys are a key.
    """
    span = F.floor(F.col(order[0]) / SPAN)
    at = rows.withColumn("_span", F.coalesce(span, F.lit(-(1 << 62))))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    counts = at.groupBy(*keys, "_span").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    number = F.row_number().over(Window.partitionBy(*keys, "_span").orderBy(*order)) - 1
    return matched(at.withColumn("_in", number), counts, [*keys, "_span"]).withColumn(name, F.col("_before") + F.col("_in")).drop("_span", "_before", "_in")


def dealt(rows: DataFrame, keys: list[str], order: list[str], workers: int) -> DataFrame:
    """Round robin: bucket 0 to workers - 1."""
    return numbered(rows, keys, order, "bucket").withColumn("bucket", (F.col("bucket") % workers).cast("int"))


def batched(rows: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    return numbered(rows, keys, order, "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("int"))


def chapter_numbered(chapters: DataFrame, number: int, num: str = "num") -> DataFrame:
    """The chapter of that number (with several, all of them)."""
    return chapters.where(F.col(num) == number)


def nth_chapter(chapters: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The chapter at place n (from 0) of every book."""
    return numbered(chapters, keys, order, "_place").where(F.col("_place") == n).drop("_place")


def real_time_factor(audio_s: Column, wall_s: Column) -> Column:
    """Seconds of audio for a second of work; null where no time passed."""
    return audio_s / F.when(wall_s > 0, wall_s)


def dry_run(segs: DataFrame, keys: list[str]) -> DataFrame:
    """Segments and characters of every chapter."""
    return segs.groupBy(*keys).agg(F.count("*").alias("n_segs"), F.sum(F.length("seg")).cast("long").alias("n_chars"))


def estimates(report: DataFrame, chars: str = "n_chars", speed: float = 11.0, spoken: float = 14.0, bytes_s: int = 8000) -> DataFrame:
    """Totals; hours on one, two and three workers; hours and GB of audio."""
    t = report.agg(F.coalesce(F.sum("n_segs"), F.lit(0)).cast("long").alias("n_segs"), F.coalesce(F.sum(chars), F.lit(0)).cast("long").alias("n_chars"))
    c = F.col("n_chars")
    return t.select("n_segs", "n_chars", *(F.round(c / (speed * n) / 3600, 6).alias(f"hours_{n}") for n in (1, 2, 3)), F.round(c / spoken / 3600, 6).alias("audio_hours"), F.round(c / spoken * bytes_s / 1e9, 6).alias("audio_gb"))


def word_report(rows: DataFrame, keys: list[str], body: str) -> DataFrame:
    return rows.select(*keys, titles.word_count(F.col(body)).alias("n_words"))
