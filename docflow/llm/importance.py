"""Resampling towards a target corpus by hashed n-gram weights.

Features of a text are its words and pairs of neighbouring words, each in a bucket by CRC-32. A bucket's
gain is the log ratio of its smoothed shares in the target and in the corpus; a text's weight is its
features' mean gain. Noise of Gumbel's distribution by doc_id, added to the weight, makes the greatest
scores a draw without replacement.

Identical texts are collapsed by grouping full texts: features and weight are computed once for a text,
its counts are multiplied by its copies, and the weight is joined back to the documents before the noise.
Texts are shuffled once; the documents are joined by their text's SHA-256. Texts with more than a
thousandth of all documents (at most a thousand of them) are joined by broadcast, so a hot text doesn't
meet in one task. Ranks come from a range sort, not from one task.

Defined cases: a null text is an empty one, without features, of weight 0 and no candidate of the draw; a
null doc_id has noise of its own and is the least of equals; rows that repeat are rows; an empty table
gives none, an empty target counts nothing. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.running import running

from .common import in_rows, joined, pieces, text_blocks, tidy, written

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Words up to this many bytes are hashed together, longer ones one by one.
SHORT = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


STEP = _crc_table()


def _shift_tables() -> np.ndarray:
    """[n, i, v]: the register with v in its byte i after n zero bytes."""
    out = np.empty((SHORT + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(SHORT):
        out[n + 1] = STEP[out[n] & 255] ^ (out[n] >> 8)
    return out


SHIFT = _shift_tables()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def _hashed(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of the words, and of the words with a space behind them."""
    order = np.argsort(-sizes, kind="stable")
    s, n, c = starts[order], sizes[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    first = int(np.searchsorted(-n, -SHORT, "left"))  # words before it are longer than SHORT
    for i in range(first):
        c[i] = zlib.crc32(low[s[i]:s[i] + n[i]].tobytes()) ^ 0xFFFFFFFF
    for j in range(int(n[first]) if first < len(n) else 0):
        to = int(np.searchsorted(-n, -j, "left"))
        x = c[first:to]
        c[first:to] = STEP[(x ^ low[s[first:to] + j]) & 255] ^ (x >> 8)
    word, spaced = np.empty_like(c), np.empty_like(c)
    word[order], spaced[order] = c ^ 0xFFFFFFFF, (STEP[(c ^ 32) & 255] ^ (c >> 8)) ^ 0xFFFFFFFF
    return word, spaced


def _joined(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings, one behind the other, from theirs and the second's size (up to SHORT)."""
    return SHIFT[n, 0, a & 255] ^ SHIFT[n, 1, (a >> 8) & 255] ^ SHIFT[n, 2, (a >> 16) & 255] ^ SHIFT[n, 3, a >> 24] ^ b


def features(raw: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of every text, text of every feature, its bucket) of a block of texts, sorted by text and bucket."""
    low = LOWER[raw]
    inside = IN_WORD[low]
    begins = np.zeros(len(low) + 1, bool)
    begins[offsets] = True
    opens = inside & (np.concatenate([[False], ~inside[:-1]]) | begins[:-1]) if len(low) else inside
    if len(low):
        opens[0] = inside[0]
    closes = inside & (np.concatenate([~inside[1:], [True]]) | begins[1:]) if len(low) else inside
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sizes = ends - starts
    text = np.searchsorted(offsets, starts, "right") - 1
    word, spaced = _hashed(low, starts, sizes)
    two = np.flatnonzero(text[1:] == text[:-1])
    pair = _joined(spaced[two], word[two + 1], np.minimum(sizes[two + 1], SHORT))
    for i in np.flatnonzero(sizes[two + 1] > SHORT).tolist():
        a = two[i]
        pair[i] = zlib.crc32(low[starts[a + 1]:ends[a + 1]].tobytes(), int(spaced[a]))
    key = np.sort(np.concatenate([text, text[two]]) * buckets + np.concatenate([word, pair]) % np.uint32(buckets))
    return np.bincount(text, minlength=len(offsets) - 1), key // buckets, key % buckets


def _coded(buckets: int):
    """m, text to m, key, n_words, n_features and gaps: the differences of the text's sorted buckets as 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            for i, j, raw, offsets in text_blocks(b.column(1)):
                words, text, bucket = features(raw, offsets, buckets)
                n = np.bincount(text, minlength=j - i)
                gap, head = np.diff(bucket, prepend=0), np.cumsum(n) - n
                head = head[n > 0]
                gap[head] = bucket[head]
                places = np.concatenate([[0], 2 * np.cumsum(n)]).astype(np.int32)
                gaps = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(places), pa.py_buffer(gap.astype("<u2"))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(words, pa.int64()), pa.array(n, pa.int64()), gaps], names=["m", "key", "n_words", "n_features", "gaps"])

    return run


def _buckets(gaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows' features, and where each row's begin (one more for the end)."""
    _, offsets, data = gaps.buffers()
    places = np.frombuffer(offsets, np.int32, len(gaps) + 1 + gaps.offset)[gaps.offset:].astype(np.int64)
    gap = np.frombuffer(data, np.uint8)[places[0]:places[-1]].view("<u2").astype(np.int64) if data is not None and len(gaps) else np.zeros(0, np.int64)
    start = (places - places[0]) // 2
    total = np.concatenate([[0], np.cumsum(gap)])
    return total[1:] - np.repeat(total[start[:-1]], np.diff(start)), start


def _counted(buckets: int):
    """bucket and n: a task's counts, each text's times its copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            bucket, start = _buckets(b.column(1))
            if len(bucket):
                n += np.bincount(bucket, np.repeat(b.column(0).to_numpy(), np.diff(start)), buckets).astype(np.int64)
        own = np.flatnonzero(n)
        yield from in_rows(pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(n[own], pa.int64())], names=["bucket", "n"]))

    return run


def _weighed(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, start = _buckets(b.column(4))
            total = np.concatenate([[0], np.cumsum(gains[bucket])])
            n = np.diff(start)
            weight = np.where(n > 0, (total[start[1:]] - total[start[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(weight, pa.int64())], names=["m", "key", "n_words", "n_features", "weight"])

    return run


def collapsed(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """m (copies), key, n_words, n_features and gaps of every distinct text, written."""
    texts = rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("m"))
    texts = texts.select("m", "text", F.unhex(F.sha2("text", 256)).alias("key"))
    return written(texts.mapInArrow(tidy(_coded(buckets)), "m long, key binary, n_words long, n_features long, gaps binary"), "features")


def counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in every bucket: at most `buckets` numbers reach the driver."""
    out = np.zeros(buckets, np.int64)
    for r in texts.select("m", "gaps").mapInArrow(tidy(_counted(buckets)), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of every bucket."""
    size = len(corpus)
    up = (target + 1).astype(float) * float(corpus.sum() + size)
    return np.floor(1000 * np.log(up / ((corpus + 1).astype(float) * float(target.sum() + size)))).astype(np.int64)


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document: rank from 1 for the drawn percentage, else null."""
    own = collapsed(docs, buckets)
    gain = gains(counts(own, buckets), counts(collapsed(target, buckets), buckets))
    weights = written(own.mapInArrow(tidy(_weighed(gain)), "m long, key binary, n_words long, n_features long, weight long"), "weights")
    n = weights.agg(F.sum("m").alias("all"), F.sum(F.when(F.col("n_words") >= least_words, F.col("m"))).alias("long")).first()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("key"))
    rows = joined(ids, weights, ["key"], F.col("m") > (n["all"] or 0) / 1000)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = rows.select("doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= least_words).alias("long"))
    placed = running(rows, ["long"], [F.desc("score"), F.asc_nulls_first("doc_id")], {"place": None})
    rank = F.when(F.col("long") & (F.col("place") < percent * (n["long"] or 0) // 100), F.col("place") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
