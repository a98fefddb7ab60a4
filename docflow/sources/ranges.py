"""Files written and read by byte ranges: many tasks write one file, and many read one.

`byte_ranges` is a data source. Its writer takes rows (name, start, total, data) in any order and from any task, and
writes each at its offset of a staged file; the commit checks that every file has got all its bytes and only then moves
the files to their names, so a reader never sees half of one, a failed job leaves nothing, and a task that runs again
writes the same bytes to the same places. Blocks of zeros are left as holes, which read as zeros and take no disk. Its
reader packs ranges of many files into a partition. The folder must be one that driver and executors share as files
(file:/ or a plain path).

placed() gives parts their offsets by running sums over their sizes, so neither a book nor its list of parts is one
row, one group or one task, and no row is longer than the longest part.
"""

from __future__ import annotations

import glob
import os
import shutil
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, InputPartition, WriterCommitMessage

from docflow.functions import audio
from docflow.operators.running import running
from docflow.profiles import SAMPLE_RATE
from docflow.sources import shared

#: Bytes of a file that one row of the reader holds, and that one partition reads at least, if there are so many. More are
#: read by one where there would be more than PARTS partitions: each is a task, so files of any number are read by few.
ROW_BYTES, PART_BYTES, PARTS = 1 << 20, 64 << 20, 512
#: Bytes of a file that take disk together, or are a hole.
BLOCK = 4096


def local(path: str) -> str:
    """The path without its file: scheme; other stores have no byte ranges to write."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"byte ranges need a shared folder of files, not {path}")
    return path


def _inside(folder: str, name: str) -> str:
    at = os.path.normpath(os.path.join(folder, name))
    if not at.startswith(folder + os.sep):
        raise ValueError(f"{name} is not a name below the folder")
    return at


def _spoken(piece: memoryview, start: int) -> Iterator[tuple[int, int]]:
    """From where to where a piece that lies at `start` of a file has blocks that aren't all zeros."""
    if not len(piece):
        return
    head = min(len(piece), -start % BLOCK)
    some = (len(piece) - head) // BLOCK
    x, tail = np.frombuffer(piece, np.uint8), head + some * BLOCK
    full = x[head:tail].view(np.uint64).reshape(some, BLOCK // 8).any(axis=1)
    said = np.array([False, x[:head].any(), *full, x[tail:].any(), False])
    ends = [0, *range(head, tail + 1, BLOCK), len(piece)]
    turns = np.flatnonzero(said[1:] != said[:-1])
    yield from ((ends[i], ends[j]) for i, j in zip(turns[::2], turns[1::2]))


@dataclass
class Written(WriterCommitMessage):
    """Bytes written of every file of a task, where the last of them ends, and the totals that its rows said."""

    sizes: dict
    ends: dict
    totals: dict


class RangeWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool, deflated: bool):
        self.folder, self.overwrite, self.deflated = os.path.normpath(folder), overwrite, deflated
        self.staged = os.path.join(os.path.dirname(self.folder), f"_{os.path.basename(self.folder)}-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        sizes: dict[str, int] = {}
        ends: dict[str, int] = {}
        totals: dict[str, int] = {}
        now, file = None, None
        try:
            for b in iterator:
                for name, start, total, data in zip(b.column("name").to_pylist(), b.column("start").to_pylist(), b.column("total").to_pylist(), b.column("data")):
                    if name != now:
                        if file is not None:
                            os.fsync(file)
                            os.close(file)
                        at = _inside(self.staged, name)
                        os.makedirs(os.path.dirname(at), exist_ok=True)
                        now, file = name, os.open(at, os.O_CREAT | os.O_WRONLY, 0o644)
                    piece = memoryview(data.as_buffer()) if data.is_valid else memoryview(b"")
                    if self.deflated and len(piece):
                        piece = memoryview(zlib.decompress(piece))
                    for done, end in _spoken(piece, start):
                        while done < end:
                            done += os.pwrite(file, piece[done:end], start + done)
                    sizes[name] = sizes.get(name, 0) + len(piece)
                    ends[name] = max(ends.get(name, 0), start + len(piece))
                    if total is not None:
                        if totals.setdefault(name, total) != total:
                            raise ValueError(f"two sizes are given for {name}")
                        if start == 0 or start + len(piece) == total:
                            os.ftruncate(file, total)  # its end may be a hole
        finally:
            if file is not None:
                os.fsync(file)
                os.close(file)
        return Written(sizes, ends, totals)

    def commit(self, messages: list) -> None:
        sizes: dict[str, int] = {}
        ends: dict[str, int] = {}
        totals: dict[str, int] = {}
        for m in filter(None, messages):
            for name, n in m.sizes.items():
                sizes[name], ends[name] = sizes.get(name, 0) + n, max(ends.get(name, 0), m.ends[name])
            for name, n in m.totals.items():
                if totals.setdefault(name, n) != n:
                    raise ValueError(f"two sizes are given for {name}")
        for name, n in sizes.items():
            if not n == ends[name] == totals.get(name) == os.path.getsize(_inside(self.staged, name)):
                raise ValueError(f"{name} has {n} of {totals.get(name)} bytes")
        if self.overwrite:
            shutil.rmtree(self.folder, ignore_errors=True)
        os.makedirs(self.folder, exist_ok=True)
        for name in sizes:
            at = _inside(self.folder, name)
            os.makedirs(os.path.dirname(at), exist_ok=True)
            os.replace(_inside(self.staged, name), at)
        shutil.rmtree(self.staged, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.staged, ignore_errors=True)


@dataclass
class Ranges(InputPartition):
    """Pieces of files: name, start and end."""

    pieces: list


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = os.path.normpath(local(options["path"])), options.get("pattern", "**")
        self.row, self.part = int(options.get("row_bytes", ROW_BYTES)), int(options.get("part_bytes", PART_BYTES))
        self.name = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("name",):
                self.name = f.value if self.name in (None, f.value) else ""
            else:
                yield f

    def partitions(self) -> list[Ranges]:
        found = [x for x in glob.glob(self.pattern, root_dir=self.folder, recursive=True) if os.path.isfile(os.path.join(self.folder, x))]
        sizes = [(x, os.path.getsize(os.path.join(self.folder, x))) for x in sorted(found) if self.name in (None, x)]
        step = max(self.row, self.part // self.row * self.row)
        most, held, out = max(step, sum(n for _, n in sizes) // PARTS), 0, [Ranges([])]
        for name, size in sizes:
            for i in range(0, size, step):
                end = min(size, i + step)
                if held and held + end - i > most:
                    out.append(Ranges([]))
                    held = 0
                out[-1].pieces.append((name, i, end))
                held += end - i
        return out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for name, start, end in partition.pieces:
            with open(_inside(self.folder, name), "rb") as f:
                f.seek(start)
                for at in range(start, end, self.row):
                    data = f.read(min(self.row, end - at))
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int64()), pa.array([data], pa.binary())], names=["name", "start", "data"])


class ByteRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "name string, start long, data binary"

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)

    def writer(self, schema, overwrite: bool) -> RangeWriter:
        return RangeWriter(local(self.options["path"]), overwrite, self.options.get("deflated") == "true")


def registered(spark: SparkSession) -> SparkSession:
    """The session, which knows the source and pushes filters into Python sources (an error where a source can take them, but they aren't pushed)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ByteRanges)
    return spark


def _parts(parts: DataFrame, name: str, order: list[str], data: str, size: str | None = None) -> tuple[DataFrame, list[str]]:
    """name, order, data and _size (what the data has, or the column size) of parts, and what the order's columns are now called."""
    keys = [f"_order{i}" for i in range(len(order))]
    parts = parts.where(F.col(f"`{name}`").isNotNull()).select(F.col(f"`{name}`").cast("string").alias("name"), *(F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)), F.col(f"`{data}`").cast("binary").alias("data"), *([F.col(f"`{size}`").alias("_size")] if size else []))
    return parts.withColumn("_size", F.coalesce(F.col("_size") if size else F.octet_length("data"), F.lit(0)).cast("long")), keys


def placed(parts: DataFrame, name: str, order: list[str], data: str) -> DataFrame:
    """name, start, total and data of parts: the files of every name are its parts' data in order. A null name is no file and a null data no bytes."""
    parts, keys = _parts(parts, name, order, data)
    at = running(parts, ["name"], list(keys), {"start": "_size"})
    totals = at.groupBy("name").agg(F.sum("_size").alias("total"))
    return at.join(totals, "name").select("name", "start", "total", "data")


def write_ranges(rows: DataFrame, path: str, replace: bool = True, deflated: bool = False, dealt: bool = False) -> None:
    """Files below path from placed rows. What was there is replaced when all is written; without replace, other files stay.

    Rows are dealt by ranges, unless they come so, and a file is opened and synced once by each of the few tasks that have
    some of it. A file's total must be in one of its rows and may be null in others.
    """
    registered(rows.sparkSession)
    rows = rows.select("name", "start", "total", "data")
    if not dealt:
        rows = rows.repartitionByRange("name", "start").sortWithinPartitions("name", "start")
    rows.write.format("byte_ranges").option("path", local(path)).option("deflated", str(deflated).lower()).mode("overwrite" if replace else "append").save()


def read_ranges(spark: SparkSession, path: str, pattern: str = "**", row_bytes: int = ROW_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """name, start and data of the files below path, a row for every row_bytes."""
    return registered(spark).read.format("byte_ranges").option("path", local(path)).option("pattern", pattern).option("row_bytes", row_bytes).option("part_bytes", part_bytes).load()


def write_texts(parts: DataFrame, name: str, order: list[str], text: str, path: str, between: str = "\n\n") -> None:
    """A text file for every name: its parts in order, with `between` between them; a null text is an empty part."""
    gap = len(between.encode())
    at = placed(parts.withColumn(text, F.concat(F.lit(between), F.coalesce(text, F.lit("")))), name, order, text)
    first = F.col("start") == 0 if gap else F.lit(False)
    data = F.when(first, F.expr(f"substring(data, {gap + 1})")).otherwise(F.col("data"))
    write_ranges(at.select("name", F.when(first, F.lit(0)).otherwise(F.col("start") - gap).cast("long").alias("start"), (F.col("total") - gap).alias("total"), data.alias("data")), path)


def write_json_arrays(rows: DataFrame, name: str, order: list[str], columns: list[str], path: str) -> None:
    """A file for every name: its rows' columns, in order, as one JSON array, a row a line."""
    as_json = F.to_json(F.struct(*columns))
    parts = rows.select(name, *order, F.concat(F.lit(",\n"), as_json).alias("_json"))
    at = placed(parts, name, order, "_json")
    opened = at.select("name", "start", (F.col("total") + 2).alias("total"), F.when(F.col("start") == 0, F.concat(F.lit("[\n").cast("binary"), F.expr("substring(data, 3)"))).otherwise(F.col("data")).alias("data"))
    closed = at.where("start = 0").select("name", F.col("total").alias("start"), (F.col("total") + 2).alias("total"), F.lit("\n]").cast("binary").alias("data"))
    write_ranges(opened.unionByName(closed), path)


def write_wavs(parts: DataFrame, name: str, order: list[str], pcm: str, path: str, rate: int = SAMPLE_RATE, replace: bool = True, size: str | None = None) -> None:
    """A WAV file for every name: its parts' 16-bit PCM in order, behind a header that knows the whole length.

    With size, a column of the PCM's bytes, PCM comes deflated; a size that isn't so fails the commit.
    The header is a file's first part, so PCM is dealt once, deflated, for the running sums, whose table is written as it lies.
    Tables made on the way are deleted.
    """
    spark = parts.sparkSession
    parts, keys = _parts(parts, name, order, pcm, size)
    with shared.passing(spark) as made:
        kept = shared.written(parts.select("name", *keys, "_size", "data" if size else audio.deflated("data").alias("data")), "parts")
        head = F.when(F.col("_pcm") >= audio.WAV_MOST, F.lit(audio.RF64_HEADER)).otherwise(F.lit(audio.WAV_HEADER)).cast("long")
        heads = kept.groupBy("name").agg(F.sum("_size").alias("_pcm")).select("name", head.alias("_size"), (F.col("_pcm") + head).alias("total"), audio.deflated(audio.wav_header_of(rate)("_pcm")).alias("data"))
        rows = kept.withColumn("_head", F.lit(0)).unionByName(heads.withColumn("_head", F.lit(-1)), allowMissingColumns=True)
        at = running(rows, ["name"], ["_head", *keys], {"start": "_size"})
        shared.delete(spark, made[0])  # its rows are in the sums' table
        write_ranges(at, path, replace, deflated=True, dealt=True)
