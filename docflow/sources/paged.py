"""Documents read page by page: a data source with a partition for a run of a document's pages.

Filters on `page` (=, in, <, <=, >, >=) are pushed into the source, so other pages are neither extracted nor shipped. An
extractor is a class: Extractor(path) opens a document, len() is its number of pages, [n] the text of page n from 1, close()
ends it. A page that can't be read is a row with the error; a document that can't be opened is one with a null page, which, as
in any table, a filter on page leaves out.
"""

from __future__ import annotations

import glob
import importlib
import mmap
import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from docflow.sources.ranges import local

#: Bytes of a document for which it gets one more partition.
PART_BYTES = 16 << 20


class FormFeeds:
    """Pages of a plain text, divided by form feeds: only the feeds are searched, and only the pages asked for decoded."""

    def __init__(self, path: str):
        self.file = open(path, "rb")  # noqa: SIM115  closed by close()
        empty = os.path.getsize(path) == 0
        self.data = b"" if empty else mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        self.ends, at = [], self.data.find(b"\f")
        while at >= 0:
            self.ends.append(at)
            at = self.data.find(b"\f", at + 1)
        self.ends.append(len(self.data))

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, page: int) -> str:
        return bytes(self.data[self.ends[page - 2] + 1 if page > 1 else 0:self.ends[page - 1]]).decode("utf-8", "replace")

    def close(self) -> None:
        if self.data:
            self.data.close()
        self.file.close()


@dataclass
class Pages(InputPartition):
    """The part-th of `parts` equal runs of a document's wanted pages."""

    path: str
    part: int
    parts: int


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = local(options["path"]), options.get("pattern", "**")
        self.extractor, self.part_bytes = options.get("extractor", f"{__name__}:FormFeeds"), int(options.get("part_bytes", PART_BYTES))
        self.first, self.last, self.only, self.errors = 1, None, None, True

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute == ("page",):
                self.errors = False
            elif getattr(f, "attribute", None) != ("page",) or not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
            elif isinstance(f, (EqualTo, In)):
                asked = set(f.value) if isinstance(f, In) else {f.value}
                self.only = asked if self.only is None else self.only & asked
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            else:
                most = f.value - isinstance(f, LessThan)
                self.last = most if self.last is None else min(self.last, most)

    def partitions(self) -> list[Pages]:
        found = sorted(x for x in glob.glob(os.path.join(self.folder, self.pattern), recursive=True) if os.path.isfile(x))
        out = []
        for x in found:
            parts = max(1, -(-os.path.getsize(x) // self.part_bytes))
            if self.only is not None:
                parts = min(parts, max(1, len(self.only)))
            out += [Pages(x, i, parts) for i in range(parts)]
        return out or [Pages("", 0, 1)]

    def _wanted(self, n: int) -> list[int]:
        pages = range(max(1, self.first), min(n, n if self.last is None else self.last) + 1)
        return [p for p in pages if self.only is None or p in self.only]

    def read(self, partition: Pages) -> Iterator[tuple]:
        if not partition.path:
            return
        module, _, name = self.extractor.partition(":")
        path = f"file:{partition.path}"
        try:
            document = getattr(importlib.import_module(module), name)(partition.path)
        except Exception as e:  # noqa: BLE001  one bad document must not end the others
            if partition.part == 0 and self.errors:
                yield path, None, None, f"{type(e).__name__}: {e}"
            return
        try:
            pages = self._wanted(len(document))
            at = [len(pages) * i // partition.parts for i in (partition.part, partition.part + 1)]
            for p in pages[at[0]:at[1]]:
                try:
                    yield path, p, document[p], None
                except Exception as e:  # noqa: BLE001
                    yield path, p, None, f"{type(e).__name__}: {e}"
        finally:
            document.close()


class PagedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_documents"

    def schema(self) -> str:
        return "path string, page int, text string, error string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def document_pages(spark: SparkSession, path: str, pattern: str = "**", extractor: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """path, page, text and error of the documents below path; filter on page to read some pages only.

    extractor is "module:class", importable by executors. The session's pushdown into Python sources is turned on.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedDocuments)
    reader = spark.read.format("paged_documents").option("path", local(path)).option("pattern", pattern).option("part_bytes", part_bytes)
    return (reader.option("extractor", extractor) if extractor else reader).load()
