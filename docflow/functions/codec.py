"""A lossless encoder for 16-bit PCM behind an encoder interface, and the stage that encodes, verifies and only then deletes.

An encoder has encode(bytes) -> bytes and decode(bytes) -> bytes. LinearRice predicts each sample of a block by the
polynomial through the ones before (order 0 to 3, the best of them) and writes the differences as Rice codes, the unary
parts and the remainders of a block each in a row, so both ways are array operations.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.audio import OUT_BYTES
from docflow.sources import shared

MAGIC, BLOCK, ORDERS = b"LPR1", 4096, 4


class LinearRice:
    """Block-wise linear prediction and Rice codes. Bytes beyond whole samples are kept as they are."""

    def encode(self, pcm: bytes) -> bytes:
        x = np.frombuffer(pcm[: len(pcm) // 2 * 2], "<i2").astype(np.int64)
        return b"".join([MAGIC, struct.pack("<QB", len(x), len(pcm) % 2), pcm[len(x) * 2:], *(_block(b) if b.any() else _silent(len(b)) for b in np.split(x, range(BLOCK, len(x), BLOCK)) if len(b))])

    def decode(self, coded: bytes) -> bytes:
        if coded[:4] != MAGIC:
            raise ValueError("not of this encoder")
        n, odd = struct.unpack_from("<QB", coded, 4)
        at, out = 13 + odd, []
        for i in range(0, n, BLOCK):
            most = min(BLOCK, n - i)
            if coded.startswith(_silent(most), at):
                x, at = np.zeros(most, np.int64), at + len(_silent(most))
            else:
                x, at = _samples(coded, at, most)
            out.append(x)
        return (np.concatenate(out).astype("<i2").tobytes() if out else b"") + coded[13:13 + odd]


def _spoken(x: np.ndarray) -> int:
    """Samples up to the last that isn't zero."""
    i = np.flatnonzero(x)
    return int(i[-1]) + 1 if len(i) else 0


@lru_cache(BLOCK)
def _silent(n: int) -> bytes:
    """A block of zeros."""
    return _block(np.zeros(n, np.int64))


def _block(x: np.ndarray) -> bytes:
    """order, parameter, first samples, bytes of the unary parts, unary parts, remainders.

    Only what comes before a block's closing silence is computed with: differences of zeros are zeros.
    """
    best, end = None, _spoken(x)
    for order in range(min(ORDERS, len(x))):
        n = len(x) - order
        d = np.diff(x[: end + order], order)[:n]
        u = np.where(d >= 0, 2 * d, -2 * d - 1)
        k = max(0, int(u.sum() / n + 1).bit_length() - 1)
        bits = min((int((u >> j).sum()) + n * (j + 1), j) for j in {max(0, k - 1), k, k + 1})
        if best is None or bits[0] < best[0]:
            best = bits[0], order, bits[1], u
    _, order, k, u = best
    n, high = len(x) - order, u >> k
    ends = np.cumsum(high + 1)
    said = int(ends[-1]) if len(ends) else 0
    unary = np.ones(said + n - len(u), np.uint8)
    unary[:said] = 0
    unary[ends - 1] = 1
    rest = ((u[:, None] >> np.arange(k - 1, -1, -1)) & 1).astype(np.uint8).ravel() if k else np.zeros(0, np.uint8)
    packed, low = np.packbits(unary).tobytes(), np.packbits(rest).tobytes()
    return struct.pack("<BB", order, k) + x[:order].astype("<i2").tobytes() + struct.pack("<I", len(packed)) + packed + low + bytes(-(-n * k // 8) - len(low))


def _samples(coded: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The n samples of the block at `at`, and where the next one begins."""
    order, k = coded[at], coded[at + 1]
    head = np.frombuffer(coded, "<i2", order, at + 2).astype(np.int64)
    at += 2 + 2 * order
    (size,) = struct.unpack_from("<I", coded, at)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(coded, np.uint8, size, at + 4)))[: n - order]
    at += 4 + size
    u = ends - np.arange(n - order)
    u[1:] -= u[:-1].copy()
    said = _spoken(u)
    u <<= k
    if k:
        size = -(-(n - order) * k // 8)
        low = np.frombuffer(coded, np.uint8, size, at)
        some = min(n - order, _spoken(low) * 8 // k + 1)  # remainders behind the last bit that is set are zero
        bits = np.unpackbits(low)[: some * k].reshape(-1, k)
        for j in range(k):
            u[:some] |= bits[:, j].astype(np.int64) << (k - 1 - j)
        at, said = at + size, max(said, some)
    x = u
    x[:said] = (u[:said] >> 1) ^ -(u[:said] & 1)
    for j in range(order - 1, -1, -1):  # sums undo differences, from where the first samples say
        x = np.concatenate([[0], np.cumsum(x)]) + np.diff(head, j)[0]
    return x, at


def encoded(rows: DataFrame, pcm: str, encoder=LinearRice) -> DataFrame:
    """rows with coded, n_bytes and crc (of the PCM) in the PCM's place; null stays null. A coded row that doesn't decode to its PCM fails the job."""
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != pcm), T.StructField("coded", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("crc", T.LongType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder()
        for p in parts:
            raw = [None if x is None else bytes(x) for x in p[pcm]]
            coded = [None if x is None else code.encode(x) for x in raw]
            if any(x is not None and code.decode(c) != x for x, c in zip(raw, coded)):
                raise ValueError("a coded row doesn't decode to what it was")
            sizes = pd.array([None if x is None else len(x) for x in raw], "Int64")
            yield p.drop(columns=pcm).assign(coded=coded, n_bytes=sizes, crc=pd.array([None if x is None else zlib.crc32(x) for x in raw], "Int64"))

    return rows.mapInPandas(run, schema)


def decoded(rows: DataFrame, pcm: str = "pcm", encoder=LinearRice) -> DataFrame:
    """rows of encoded() with their PCM again, and sound: whether its length and checksum are those noted."""
    kept = [f for f in rows.schema.fields if f.name != "coded"]
    schema = T.StructType([*kept, T.StructField(pcm, T.BinaryType()), T.StructField("sound", T.BooleanType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder()
        for p in parts:
            raw, sound, at, size = [], [], 0, 0
            for i, (c, n, crc) in enumerate(zip(p["coded"], p["n_bytes"], p["crc"])):
                try:
                    raw.append(None if c is None else code.decode(bytes(c)))
                    sound.append(c is None or (len(raw[-1]) == n and zlib.crc32(raw[-1]) == crc))
                except (ValueError, IndexError, struct.error):
                    raw.append(None)
                    sound.append(False)
                size += len(raw[-1] or b"")
                if size >= OUT_BYTES or i + 1 == len(p):
                    yield p.iloc[at:i + 1].drop(columns="coded").assign(**{pcm: raw}, sound=sound)
                    raw, sound, at, size = [], [], i + 1, 0

    return rows.mapInPandas(run, schema)


def transcode(spark: SparkSession, source: str, out: str, pcm: str = "pcm", encoder=LinearRice) -> DataFrame:
    """Encodes the stored table at source to out, reads that back, and deletes source only if every row is there and sound; else out goes."""
    encoded(spark.read.parquet(source), pcm, encoder).write.mode("overwrite").parquet(out)
    n = spark.read.parquet(source).select(F.lit(1)).count()
    found = decoded(spark.read.parquet(out), pcm, encoder).agg(F.count("*").alias("n"), F.count_if(~F.col("sound")).alias("bad")).first()
    if found["n"] != n or found["bad"]:
        shared.delete(spark, out)
        raise ValueError(f"{found['bad']} rows of {found['n']} (of {n}) aren't sound; the source stays")
    shared.delete(spark, source)
    return spark.read.parquet(out)
