"""Markdown to sections: by headings of several shapes, by text marks, by elected titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import clean, titles
from docflow.operators.keys import matched

# Heading shapes; group 1 is the number or the title, group 2 the title after a number.
HEADINGS = {
    "numbered": r"##\s+.*?\b(\d+)\.\s+(.+?)[\*_]*\s*",
    "bold_numbered": r"##\s+\*\*(\d{1,2})\s+(.+?)\*\*\s*",
    "any": r"#{1,3}\s+(.+)",
    "bold": r"## \*\*(.+?)\*\*\s*",
}
# Titles that open no chapter.
BACK_MATTER = ("Photographs", "Acknowledgments", "About the Authors", "Notes", "Bibliography", "Index")
BOILERPLATE = ("Contents", "CLICK HERE TO SIGN UP", "Thank you for downloading this Simon & Schuster ebook.")
FOOTER_KEYS = ("hackerspainters",)
NUMBERED = ("numbered", "bold_numbered")
# The lines that mark the parts of a marked book.
MARKS = {"chapter": r"##\s*_Chapter\s+(\d+)_\s*", "note": r"##\s*_Note to readers_\s*", "contents": r"##\s*Contents\s*", "preface": r"##\s*Preface\s*", "notes": r"##\s*Notes\s*"}


def real_chapter(title: Column, marks: str = titles.QUOTED) -> Column:
    t = titles.strip_title(title, marks)
    return ~(t.startswith("—") | t.startswith("-")) & ~t.rlike(r"^\d+$") & ~t.isin(*BACK_MATTER, *BOILERPLATE)


def lines(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    return rows.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def _sliced(rows: DataFrame, keys: list[str], text: str, opens, extra: Sequence[str] = ()) -> DataFrame:
    """Runs of lines from one that opens(line) to the next: keys, part (0: before the first), head, body and what is extra in rows."""
    all_ = lines(rows, [*keys, *extra], text).withColumn("opens", opens(F.col("line")))
    run = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    all_ = all_.withColumn("part", F.sum(F.col("opens").cast("int")).over(run).cast("int"))
    body = F.array_sort(F.collect_list(F.when(~F.col("opens"), F.struct("line_no", "line"))))
    parts = all_.groupBy(*keys, "part").agg(F.max(F.when(F.col("opens"), F.col("line"))).alias("head"), body.alias("_body"), *(F.max(c).alias(c) for c in extra))
    return parts.select(*keys, "part", "head", F.array_join(F.transform("_body", lambda x: x["line"]), "\n").alias("body"), *extra)


def sections(rows: DataFrame, keys: list[str], text: str, kind: str, most_number: int = 200, marks: str = titles.QUOTED, whole: str = "Introduction") -> DataFrame:
    """keys, part, num, title, head (the heading line, null without one) and body of the sections of rows' markdown.

    A text without a heading is one section, titled `whole`, number 0. Text before the first heading is the section
    "Introduction" (num 0), but for `bold`, which drops it. Numbered kinds drop numbers over most_number. For `any`, sections
    with a title of 1 to 80 characters and 30 words at least, the heading's among them, stay; the introduction stays whatever its
    length. For `bold`, headings that open no chapter are part of the section before, and titles lose the marks named.
    Sections of these two are numbered anew. A number that is no 32-bit number is over most_number. `marked` books are
    marked_sections. Null keys are a book; a null text has no section.
    """
    if kind == "marked":
        return marked_sections(rows, keys, text)
    pattern = "(?d)^" + HEADINGS[kind] + "$"
    rows = rows.withColumn("_headed", F.col(text).rlike("(?md)^" + HEADINGS[kind] + "$"))
    found = (lambda x: x.rlike(pattern) & real_chapter(F.regexp_extract(x, pattern, 1), marks)) if kind == "bold" else (lambda x: x.rlike(pattern))
    parts = _sliced(rows, keys, text, found, ["_headed"]).withColumn("body", titles.stripped(F.col("body")))
    front = F.col("head").isNull()
    opening = F.when(F.col("_headed"), F.lit("Introduction")).otherwise(F.lit(whole))
    if kind in NUMBERED:
        num = F.when(front, F.lit(0)).otherwise(F.regexp_extract("head", pattern, 1).try_cast("int"))
        title = F.when(front, opening).otherwise(titles.strip_title(F.regexp_extract("head", pattern, 2)))
        return parts.select(*keys, "part", num.alias("num"), title.alias("title"), "head", "body").where("num is not null").where((F.col("body") != "") | (F.col("num") > 0)).where(F.col("num") <= most_number)
    title = F.when(front, opening).otherwise(titles.strip_title(F.regexp_extract("head", pattern, 1), marks if kind == "bold" else titles.MARKUP))
    out = parts.withColumn("title", title)
    if kind == "bold":
        out = out.where(~front | ~F.col("_headed")).where(~front | (F.col("body") != ""))
    else:
        spoken = clean.clean(section_text(F.col("head"), F.col("body")), "basic", normalise=False)
        out = out.where(F.when(front, F.col("body") != "").otherwise(F.length("title").between(1, 80) & (titles.word_count(spoken) >= 30)))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("part")) - 1
    return out.select(*keys, "part", number.alias("num"), "title", "head", "body")


def section_text(head: Column, body: Column) -> Column:
    """A section with its heading line, if it has one."""
    return F.concat_ws("\n\n", head, body)


def best_by_key(rows: DataFrame, keys: list[str], num: str, body: str, place: str) -> DataFrame:
    """Of sections with one number the longest by words; the first of equals. place tells all rows apart; null numbers and keys are equal.

    Aggregated in part before the shuffle; the bodies are joined after.
    """
    best = rows.groupBy(*keys, num).agg(F.min(F.struct((-titles.word_count(F.col(body))).alias("words"), F.col(place).alias("place"))).alias("_best"))
    best = best.select(*keys, num, F.col("_best.place").alias(place))
    return matched(rows, best, [*keys, num, place], "left_semi")


def between(text: Column, start: str, end: str) -> Column:
    """Text from the first match of start (if any) to before the next match of end (if any)."""
    tail = F.when(text.rlike(start), F.concat(F.regexp_substr(text, F.lit(start)), F.get(F.split(text, start, 2), F.lit(1)))).otherwise(text)
    return F.get(F.split(tail, end, 2), F.lit(0))


def carried_headings(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, sec_no, content and h1, h2, h3 of the header sections; a higher heading ends the lower ones."""
    parts = _sliced(rows, keys, text, lambda x: x.rlike(r"^#{1,3} "))
    level = F.length(F.regexp_extract("head", "^(#{1,3}) ", 1))
    base = parts.withColumn("level", F.coalesce(level, F.lit(0))).withColumn("name", F.regexp_replace("head", r"^#{1,3} +| +$", ""))
    run = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("r1", F.sum((F.col("level") == 1).cast("int")).over(run)).withColumn("r2", F.sum(F.col("level").isin(1, 2).cast("int")).over(run))
    for k, reset in ((1, []), (2, ["r1"]), (3, ["r2"])):
        w = Window.partitionBy(*keys, *reset).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        base = base.withColumn(f"h{k}", F.last(F.when(F.col("level") == k, F.col("name")), ignorenulls=True).over(w))
    content = F.when(F.col("head").isNull(), F.col("body")).otherwise(F.concat_ws("\n", F.col("head"), F.col("body")))
    return base.select(*keys, F.col("part").alias("sec_no"), titles.stripped(content).alias("content"), "h1", "h2", "h3").where("content <> ''")


def elected_titles(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, title and line_no: among a text's heading lines, of the key that occurs most often (the first of equals) the form with most spaces."""
    heads = lines(rows, keys, text).where(F.col("line").rlike(r"^#{1,6}[ \t]*\S")).withColumn("raw", F.regexp_replace("line", r"^#{1,6}[ \t]*|[ \t]*$", ""))
    heads = heads.withColumn("key", titles.heading_key(F.col("raw"))).where((F.col("key") != "") & ~F.col("key").isin(*FOOTER_KEYS))
    by_key = Window.partitionBy(*keys, "key")
    heads = heads.withColumn("n", F.count("*").over(by_key)).withColumn("first", F.min("line_no").over(by_key)).withColumn("spaces", titles.space_count(F.col("raw")))
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "first", F.desc("spaces"), "line_no"))
    return heads.withColumn("_b", best).where("_b = 1").select(*keys, titles.spaced_title(F.col("raw")).alias("title"), F.col("line_no"), "key")


def without_lines(rows: DataFrame, keys: list[str], text: str, drop: DataFrame) -> DataFrame:
    """keys and body: the text without the heading lines whose key drop (keys, key) names, is empty or a footer's."""
    heading = F.col("line").rlike("(?d)^#{1,6}[ \t]*.+$")
    all_ = lines(rows, keys, text).withColumn("key", F.when(heading, titles.heading_key(F.col("line"))))
    all_ = all_.where(F.col("key").isNull() | ((F.col("key") != "") & ~F.col("key").isin(*FOOTER_KEYS)))
    kept = matched(all_, drop.select(*keys, "key").where("key is not null").distinct(), [*keys, "key"], "left_anti")
    body = kept.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return matched(rows.select(*keys), body, keys, "left").withColumn("body", F.coalesce("body", F.lit("")))


def marked_sections(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, part, num, title, head (null) and body of a book whose chapters begin at mark lines.

    The last chapter ends before the first line that marks the notes. Part 0 is the note to readers (up to the contents)
    and the preface (up to the first chapter), if all three marks are there. Titles are elected among a section's
    heading lines (else "Chapter n" or "Preface"), which then leave its body.
    """
    all_ = lines(rows, keys, text)
    is_ = {name: F.col("line").rlike(f"(?d)^{pattern}$") for name, pattern in MARKS.items()}
    book = Window.partitionBy(*keys)
    for name in ("note", "contents", "preface", "notes"):
        all_ = all_.withColumn(name, F.min(F.when(is_[name], F.col("line_no"))).over(book))
    run = book.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    all_ = all_.withColumn("part", F.sum(is_["chapter"].cast("int")).over(run).cast("int")).withColumn("parts", F.max("part").over(book))
    front = F.when((F.col("line_no") > F.col("note")) & (F.col("line_no") < F.col("contents")) & F.col("preface").isNotNull(), 0)
    front = front.when((F.col("line_no") > F.col("preface")) & F.col("note").isNotNull() & F.col("contents").isNotNull(), 1)
    all_ = all_.withColumn("piece", F.when(F.col("part") > 0, 0).otherwise(front)).where("piece is not null")
    all_ = all_.where((F.col("part") < F.col("parts")) | F.col("notes").isNull() | (F.col("line_no") < F.col("notes")) | ((F.col("part") == 0) & (F.col("piece") == 0)))
    line = F.when(~is_["chapter"], F.struct("piece", "line_no", "line"))
    number = F.max(F.when(is_["chapter"], F.regexp_extract("line", MARKS["chapter"], 1).try_cast("int")))
    spans = all_.groupBy(*keys, "part").agg(number.alias("num"), F.array_sort(F.collect_list(line)).alias("x"))

    def piece(n: int) -> Column:
        return F.array_join(F.transform(F.filter("x", lambda v: v["piece"] == n), lambda v: v["line"]), "\n")

    pieces = [piece(0), piece(1)]
    span = F.when(F.col("part") > 0, pieces[0]).otherwise(F.concat_ws("\n\n", *pieces))
    spans = spans.select(*keys, "part", F.when(F.col("part") > 0, F.col("num")).otherwise(0).alias("num"), span.alias("span")).where("num is not null")
    elected = elected_titles(spans, [*keys, "part"], "span")
    bodies = without_lines(spans, [*keys, "part"], "span", elected)
    label = F.when(F.col("part") > 0, F.concat(F.lit("Chapter "), F.col("num").cast("string"))).otherwise(F.lit("Preface"))
    named = matched(matched(spans.drop("span"), elected.select(*keys, "part", "title"), [*keys, "part"], "left"), bodies, [*keys, "part"])
    return named.select(*keys, "part", "num", F.coalesce(F.when(F.col("title") != "", F.col("title")), label).alias("title"), F.lit(None).cast("string").alias("head"), titles.stripped(F.col("body")).alias("body"))
