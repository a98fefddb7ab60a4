"""Token-bounded, overlapping chunks for retrieval."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import titles
from docflow.operators.sections import carried_headings

#: Separators, strongest first.
SEPARATORS = ("\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ", "")


class Quarter:
    """A rough token count: four characters each."""

    exact = True  # a joined text never counts over what its pieces' weights say

    def weights(self, pieces: list[str]) -> list[int]:
        return [len(p) for p in pieces]

    def most(self, size: int) -> int:
        """The greatest sum of weights that is `size` tokens."""
        return 4 * size + 3

    def count(self, text: str) -> int:
        return len(text) // 4


class BpeCounter:
    """Exact token counts by a byte-pair encoding: ranks_path names a public ranks file, pattern its pre-token pattern.

    Sent to workers as these two strings; the encoding is built there once. Pieces weigh their own tokens; a text joined of them
    nearly always has as many or fewer, and is counted itself before it becomes a chunk.
    """

    exact = False

    def __init__(self, ranks_path: str, pattern: str):
        self.args, self.encoding = (ranks_path, pattern), None

    def __reduce__(self):
        return BpeCounter, self.args

    def count(self, text: str) -> int:
        if self.encoding is None:
            import base64

            import tiktoken

            with open(self.args[0], "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("counter", pat_str=self.args[1], mergeable_ranks=ranks, special_tokens={})
        return len(self.encoding.encode_ordinary(text))

    def weights(self, pieces: list[str]) -> list[int]:
        known: dict[str, int] = {}
        return [known[p] if p in known else known.setdefault(p, self.count(p)) for p in pieces]

    def most(self, size: int) -> int:
        return size


QUARTER = Quarter()


def split_tokens(text: str, size: int, overlap: int, counter=QUARTER, separators=SEPARATORS) -> list[str]:
    """Chunks of at most `size` tokens, each starting with up to `overlap` tokens of whole pieces of the one before.

    A text is cut at the strongest separator in it; pieces still too long are cut by weaker ones. Tokens of pieces are
    counted once; their running sums say where a chunk ends and how far back the next one begins, so time is linear in
    the text. A piece that no separator can cut is a chunk, however long.
    """
    if counter.count(text) <= size:
        return [text] if text.strip() else []
    sep = next(s for s in separators if s == "" or s in text)
    weaker = separators[separators.index(sep) + 1:]
    pieces = list(text) if sep == "" else [p + sep for p in text.split(sep)[:-1]] + [text.split(sep)[-1]]
    pieces = [p for p in pieces if p]
    weights, most = np.array(counter.weights(pieces), np.int64), counter.most(size)
    long = np.flatnonzero(weights > most).tolist() if weaker else []
    out: list[str] = []
    for start, end in zip([0, *(i + 1 for i in long)], [*long, len(pieces)]):
        out += _packed(pieces[start:end], weights[start:end], size, overlap, counter)
        if end < len(pieces):
            out += split_tokens(pieces[end], size, overlap, counter, weaker)
    return [x.strip() for x in out if x.strip()]


def _packed(pieces: list[str], weights: np.ndarray, size: int, overlap: int, counter) -> Iterator[str]:
    """Runs of pieces: as many as fit, then from as far back as the overlap and the next piece allow."""
    total, most, back = np.concatenate([[0], np.cumsum(weights)]), counter.most(size), counter.most(overlap)
    start = end = 0
    while end < len(pieces):
        last, end = end, max(end + 1, int(np.searchsorted(total, total[start] + most, "right")) - 1)
        chunk = "".join(pieces[start:end])
        while not counter.exact and end > max(last + 1, start + 1) and counter.count(chunk) > size:
            end -= 1
            chunk = "".join(pieces[start:end])
        yield chunk
        if end < len(pieces):
            start = min(end, int(np.searchsorted(total, max(total[end] - back, total[end + 1] - most), "left")))


def chunks(rows: DataFrame, key: str, text: str, size: int = 800, overlap: int = 120, counter=QUARTER) -> DataFrame:
    """id, text, n_tokens, headers and source of the chunks of rows' markdown, numbered within a source. Null keys are one source."""
    heads = carried_headings(rows.select(F.col(f"`{key}`").alias("source"), F.col(f"`{text}`").alias("md")), ["source"], "md")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            cut = [split_tokens(t, size, overlap, counter) for t in p["content"]]
            n = np.array([len(c) for c in cut], np.int64)
            out = p[["source", "sec_no", "h1", "h2", "h3"]].loc[p.index.repeat(n)]
            own = [t for c in cut for t in c]
            yield out.assign(n=[i for c in cut for i in range(len(c))], text=own, n_tokens=[counter.count(t) for t in own])

    kinds = dict(heads.dtypes)
    cut = heads.mapInPandas(run, f"source {kinds['source']}, sec_no int, h1 string, h2 string, h3 string, n long, text string, n_tokens int")
    number = F.row_number().over(Window.partitionBy("source").orderBy("sec_no", "n")) - 1
    headers = F.map_filter(F.create_map(F.lit("h1"), F.col("h1"), F.lit("h2"), F.col("h2"), F.lit("h3"), F.col("h3")), lambda k, v: v.isNotNull())
    return cut.select(titles.chunk_id(F.col("source").cast("string"), number).alias("id"), "text", "n_tokens", headers.alias("headers"), F.col("source").cast("string").alias("source"))


def chunk_stats(rows: DataFrame, tokens: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n_chunks"), F.round(F.coalesce(F.avg(tokens), F.lit(0.0)), 6).alias("avg_tokens"), F.min(tokens).alias("min_tokens"), F.max(tokens).alias("max_tokens"))
