"""python -m docflow INPUT OUT: renders books of markdown, or says what rendering them would take.

OUT gets ledger (rendered segments), chapters (a WAV file each), finished and failed (tables), and of a whole run books (a
WAV file each) and manifest (where a chapter lies in its book). A run renders only the segments that the ledger lacks.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import audio, clean, titles
from docflow.operators import chunks, pages, schedule, sections, segments
from docflow.operators.keys import matched
from docflow.profiles import PROFILES, Profile
from docflow.sources import books, ranges, shared
from docflow.streaming import ledger

KEYS = ["path", "part"]
# Where the text of a book with bold headings begins and ends.
BOLD_FROM, BOLD_TO = r"(?md)^## \*\*INTRODUCTION\*\*", r"(?md)^## \*\*Photographs\*\*"


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def mapped_chapters(md: DataFrame, maps: DataFrame) -> DataFrame:
    """Chapters of books of marked pages, by the chapter map whose file is named as the book's."""
    book = md.select("path", stem(F.col("path")).alias("book"))
    of = maps.withColumn("book", stem(F.col("path"))).drop("path").join(book, "book").withColumnRenamed("place", "part")
    bodies = pages.chapters_from_pages(of.select("path", "start_page", "end_page").distinct(), pages.page_map(md, ["path"], "text"), ["path"])
    return matched(of, bodies, ["path", "start_page", "end_page"]).select(*KEYS, "num", "title", "body")


def chapters(spark: SparkSession, path: str, profile: Profile, maps: str | None = None) -> DataFrame:
    """path, part, num, title and text of the books' chapters: what is spoken of them, cleaned.

    Of numbered chapters the longest of each number stays. Marked books begin a chapter with its label and title, others with
    its heading line, books of pages with their pages' text.
    """
    md = books.whole_texts(spark, path)
    if profile.sections == "pages":
        if not maps:
            raise ValueError("books of pages need their chapter maps")
        found, spoken = mapped_chapters(md, books.map_files(spark, maps)), F.col("body")
    else:
        if profile.sections == "bold":
            md = md.withColumn("text", sections.between(F.col("text"), BOLD_FROM, BOLD_TO))
        found = sections.sections(md, ["path"], "text", profile.sections, marks=profile.marks)
        label = F.concat(F.lit("Chapter "), F.col("num").cast("string"))
        header = titles.spoken_header(F.col("num"), label, F.col("title"))
        spoken = F.concat_ws("\n\n", header, "body") if profile.sections == "marked" else sections.section_text(F.col("head"), F.col("body"))
    found = found.select(*KEYS, "num", "title", clean.clean(spoken, profile.cleaning).alias("text"))
    return sections.best_by_key(found, ["path"], "num", "text", "part") if profile.sections in sections.NUMBERED else found


def finished(spark: SparkSession, out: str) -> DataFrame | None:
    """path, part, file and n_bytes of the chapters that lie in out, if any."""
    try:
        return spark.read.parquet(f"{out}/finished")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def render(todo: DataFrame, profile: Profile, out: str, make_voice=audio.Tone) -> None:
    """Renders what the ledger lacks of the chapters; files those that are whole, and notes those that failed."""
    spark = todo.sparkSession
    todo = shared.written(todo, "chapters")
    segs = shared.written(segments.segments(todo, KEYS, "text", profile.max_chars, profile.wrap_long), "segments")
    ledger.render(segs, KEYS, profile, f"{out}/ledger", make_voice).write.mode("overwrite").parquet(f"{out}/failed")
    done = ledger.finished(spark, f"{out}/ledger", segs, KEYS, profile)
    name = F.concat(stem(F.col("path")), F.lit("/"), titles.slug(F.col("title"), F.col("part"), profile.slug_length), F.lit(".wav"))
    files = matched(ledger.complete(segs, done, KEYS), todo.select(*KEYS, name.alias("file")), KEYS).select(*KEYS, "file", "n_bytes")
    files = shared.written(files, "files")
    if files.groupBy("file").count().where("count > 1").limit(1).count():
        raise ValueError("two books have one name")
    ranges.write_wavs(matched(done, files.select(*KEYS, "file"), KEYS), "file", ["para_no", "seg_no"], "pcm", f"{out}/chapters", replace=False)
    files.write.mode("append").parquet(f"{out}/finished")


def merge(spark: SparkSession, out: str) -> None:
    """out/books: the chapters' files of every book as one, in the order of their parts, written by many tasks; out/manifest: where each lies."""
    files = finished(spark, out)
    if files is None:
        raise ValueError("no chapter is rendered")
    books.manifest(files, ["path"], "part", "n_bytes").write.mode("overwrite").parquet(f"{out}/manifest")
    header = F.when(F.col("start") > 0, 0).when(F.expr("substring(data, 1, 4) = cast('RF64' as binary)"), audio.RF64_HEADER).otherwise(audio.WAV_HEADER)
    pcm = ranges.read_ranges(spark, f"{out}/chapters").withColumn("header", header).select("name", "start", F.expr("substring(data, header + 1)").alias("pcm"))
    pieces = pcm.join(files.select(F.col("file").alias("name"), "part", F.concat(stem(F.col("path")), F.lit(".wav")).alias("book")), "name")
    ranges.write_wavs(pieces, "book", ["part", "start"], "pcm", f"{out}/books")


def said(rows: DataFrame) -> None:
    """Prints every row, as they come from the cluster."""
    print("\t".join(rows.columns))
    for r in rows.toLocalIterator():
        print("\t".join(str(v) for v in r))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="docflow", description=__doc__)
    ap.add_argument("input", help="markdown files, a folder or a pattern")
    ap.add_argument("out")
    ap.add_argument("--profile", choices=list(PROFILES), default="numbered_a")
    ap.add_argument("--maps", help="chapter maps (JSON arrays) of books of pages, named as the books")
    ap.add_argument("--list-chapters", action="store_true", help="chapters and their words")
    ap.add_argument("--dry-run", action="store_true", help="segments, characters and hours, without rendering")
    ap.add_argument("--merge-only", action="store_true", help="only the books of what is rendered")
    ap.add_argument("--chapter", type=int, help="only the chapter at this place of every book, from 0")
    ap.add_argument("--chapter-number", type=int, help="only the chapter of this number")
    ap.add_argument("--batch", type=int, help="texts that the voice gets at once")
    ap.add_argument("--chunk-tokens", type=int, help="write chunks of so many tokens as JSON lines, and render nothing")
    ap.add_argument("--overlap", type=int, default=120, help="tokens that a chunk repeats of the one before")
    args = ap.parse_args(argv)
    spark, profile = spark or SparkSession.builder.appName("docflow").getOrCreate(), PROFILES[args.profile]
    try:
        return _run(args, spark, dataclasses.replace(profile, batch=args.batch) if args.batch else profile)
    finally:
        shared.sweep(spark)


def _run(args: argparse.Namespace, spark: SparkSession, profile: Profile) -> int:
    if args.merge_only:
        merge(spark, args.out)
        return 0
    if args.chunk_tokens:
        md = books.whole_texts(spark, args.input).select(stem(F.col("path")).alias("book"), "text")
        books.write_chunks(chunks.chunks(md, "book", "text", args.chunk_tokens, args.overlap), args.out)
        said(chunks.chunk_stats(books.chunk_files(spark, args.out, "n_tokens int"), "n_tokens"))
        return 0
    todo = chapters(spark, args.input, profile, args.maps)
    if args.list_chapters:
        said(todo.select("path", "part", "num", "title", titles.word_count(F.col("text")).alias("n_words")).orderBy("path", "part"))
        return 0
    if args.chapter is not None:
        todo = schedule.nth_chapter(todo, ["path"], ["part"], args.chapter)
    if args.chapter_number is not None:
        todo = schedule.chapter_numbered(todo, args.chapter_number)
    if args.dry_run:
        report = shared.written(schedule.dry_run(segments.segments(todo, KEYS, "text", profile.max_chars, profile.wrap_long), KEYS), "report")
        said(report.orderBy(*KEYS))
        said(schedule.estimates(report))
        return 0
    one_only = args.chapter is not None or args.chapter_number is not None
    if one_only and not todo.limit(1).count():
        print("no such chapter", file=sys.stderr)
        return 1
    done = finished(spark, args.out)
    render(todo if done is None else matched(todo, done.select(*KEYS), KEYS, "left_anti"), profile, args.out)
    if not one_only:
        merge(spark, args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
