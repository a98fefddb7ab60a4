"""Pages and chapters: page markers, chapter maps, the range join of pages into chapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import titles
from docflow.operators.keys import matched


def marked(page: Column, text: Column) -> Column:
    return F.concat(F.lit("\n\n<!--PAGE:"), page.cast("string"), F.lit("-->\n\n"), text)


def split_marked(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, page and text of a marked text; what stands before the first marker is dropped. A page that is no 32-bit number is null."""
    mark = r"<!--PAGE:(\d+)-->"
    parts = F.split(F.col(text), mark)
    both = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(mark), 1).alias("page"), F.slice(parts, F.lit(2), F.size(parts)).alias("text"))
    return rows.select(*keys, F.explode(both).alias("x")).select(*keys, F.col("x.page").try_cast("int").alias("page"), F.col("x.text").alias("text"))


def page_map(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """As split_marked(), with the last text of a page that is marked more than once."""
    mark = r"<!--PAGE:(\d+)-->"
    parts = F.split(F.col(text), mark)
    both = F.arrays_zip(F.regexp_extract_all(F.col(text), F.lit(mark), 1).alias("page"), F.slice(parts, F.lit(2), F.size(parts)).alias("text"))
    found = rows.select(*keys, F.posexplode(both).alias("at", "x")).select(*keys, "at", F.col("x.page").try_cast("int").alias("page"), F.col("x.text").alias("text"))
    return found.where("page is not null").groupBy(*keys, "page").agg(F.max_by("text", "at").alias("text"))


def chapter_map(toc: DataFrame, keys: list[str], last_page: str, start_at: str | None = None, stop_at: str | None = None) -> DataFrame:
    """keys, num, label, start_page and end_page from toc rows (keys, ord, title, page, last_page).

    From the entry titled start_at to before stop_at; a chapter ends before the next entry's page, the last at
    the text's; entries without a number get -N + place for N entries.
    """
    w = Window.partitionBy(*keys).orderBy("ord")
    rows = toc.withColumn("next_page", F.lead("page").over(w))
    if start_at or stop_at:
        all_ = Window.partitionBy(*keys)
        at = lambda t: F.min(F.when(F.upper(F.trim("title")) == t, F.col("ord"))).over(all_) if t else F.lit(None)
        rows = rows.withColumn("_a", F.coalesce(at(start_at), F.lit(0))).withColumn("_z", F.coalesce(at(stop_at), F.lit(1 << 30))).where("ord >= _a and ord < _z")
    idx, n = F.row_number().over(w) - 1, F.count("*").over(Window.partitionBy(*keys))
    num = titles.chapter_number(F.col("title"))
    return rows.select(*keys, F.when(num == 0, idx - n).otherwise(num).cast("int").alias("num"), F.col("title").alias("label"), F.col("page").alias("start_page"), F.coalesce(F.col("next_page") - 1, F.col(last_page)).cast("int").alias("end_page"))


def chapters_from_pages(chapters: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """The chapters with body: their pages' texts, in order; '' where there is none.

    Chapters are exploded to their pages, so the range join is an equi-join on book and page; null books are a book.
    """
    wanted = chapters.select(*keys, "start_page", "end_page", F.explode_outer(F.when(F.col("end_page") >= F.col("start_page"), F.sequence("start_page", "end_page"))).alias("page"))
    got = matched(wanted, pages.select(*keys, "page", F.col("text").alias("_t")).where("page is not null"), [*keys, "page"], "left")
    return got.groupBy(*keys, "start_page", "end_page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", F.coalesce("_t", F.lit("")).alias("t")))), lambda x: x["t"]), "").alias("body"))
