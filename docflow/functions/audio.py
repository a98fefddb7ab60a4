"""Samples: silence lengths, 16-bit PCM, and a deterministic stand-in voice behind a model interface."""

from __future__ import annotations

import struct
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.profiles import SAMPLE_RATE, Profile


def silence_samples(ends_paragraph: Column, profile: Profile, rate: int = SAMPLE_RATE) -> Column:
    return F.when(ends_paragraph, F.lit(int(rate * profile.paragraph_s))).otherwise(F.lit(int(rate * profile.sentence_s)))


def to_pcm16(x: Column) -> Column:
    """Clipped to -1..1, scaled, truncated; NaN is silence."""
    x = F.nanvl(x.cast("double"), F.lit(0.0))
    return (F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0)) * 32767).cast("smallint")


def pcm_bytes(x: np.ndarray) -> bytes:
    return (np.clip(np.nan_to_num(x, nan=0.0), -1, 1) * 32767).astype("<i2").tobytes()


def silence(ends_paragraph: bool, profile: Profile, rate: int = SAMPLE_RATE) -> bytes:
    """The PCM of the silence behind a segment."""
    return bytes(2 * int(rate * (profile.paragraph_s if ends_paragraph else profile.sentence_s)))


#: Bytes of PCM that a task gathers before it passes them on.
OUT_BYTES = 8 << 20


@F.arrow_udf(T.BinaryType())
def deflated(data: pa.Array) -> pa.Array:
    """PCM for a shuffle or a sort: silence takes next to nothing. Null stays null."""
    return pa.array([zlib.compress(x.as_buffer(), 1) if x.is_valid else None for x in data], pa.binary())


def inflated(rows: DataFrame, column: str) -> DataFrame:
    """rows with what deflated() made of a column as it was."""
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size, start = [], 0, 0
            for i, x in enumerate(b.column(at)):
                out.append(zlib.decompress(x.as_buffer()) if x.is_valid else None)
                size += len(out[-1] or b"")
                if size >= OUT_BYTES or i + 1 == b.num_rows:
                    yield b.slice(start, len(out)).set_column(at, column, pa.array(out, pa.binary()))
                    out, size, start = [], 0, i + 1

    return rows.mapInArrow(run, rows.schema)


#: Bytes of a WAV header, and of one with 64-bit sizes, which PCM of WAV_MOST bytes and more needs.
WAV_HEADER, RF64_HEADER, WAV_MOST = 44, 80, (1 << 32) - 44


def wav_header(n_bytes: int, rate: int = SAMPLE_RATE) -> bytes:
    """The header of a WAV file of so many bytes of one channel's 16-bit PCM."""
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, 2 * rate, 2, 16)
    if n_bytes < WAV_MOST:
        return struct.pack("<4sI4s", b"RIFF", 36 + n_bytes, b"WAVE") + form + struct.pack("<4sI", b"data", n_bytes)
    large = struct.pack("<4sIQQQI", b"ds64", 28, 72 + n_bytes, n_bytes, n_bytes // 2, 0)
    return struct.pack("<4sI4s", b"RF64", 0xFFFFFFFF, b"WAVE") + large + form + struct.pack("<4sI", b"data", 0xFFFFFFFF)


def wav_header_of(rate: int = SAMPLE_RATE):
    @F.pandas_udf("binary")
    def run(n_bytes: pd.Series) -> pd.Series:
        return n_bytes.map(lambda n: wav_header(int(n), rate))

    return run


def wav_bytes(pcm: bytes, rate: int = SAMPLE_RATE) -> bytes:
    """PCM in a WAV file."""
    return wav_header(len(pcm), rate) + pcm


@F.pandas_udf(T.LongType())
def sample_sum(pcm: pd.Series, first: pd.Series) -> pd.Series:
    """A checksum that adds up over pieces: the sum of 16-bit samples, each times 1 + its place modulo 1009; first is the first's place."""

    def one(data: bytes, at: int) -> int:
        x = np.frombuffer(data, "<i2")
        i = np.flatnonzero(x)  # most is silence
        return int((x[i].astype(np.int64) * (1 + (at + i) % 1009)).sum())

    return pd.Series([None if d is None else one(d, int(a)) for d, a in zip(pcm, first)], dtype="Int64")


class Tone:
    """Stands in for a neural voice: a tone by the text's checksum, 100 samples a character."""

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.sin(np.arange(100 * len(t), dtype=np.float32) * (0.01 + zlib.crc32(t.encode()) % 97 / 1000)).astype(np.float32) for t in texts]


class Steps:
    """Another stand-in, of four samples a character in steps that follow from the text's length: whole 32768ths, so that SQL can say them."""

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [(((np.arange(4 * len(t)) + 1) * (17 + 2 * len(t)) % 4001 - 2000) / 32768).astype(np.float32) for t in texts]


def speak_with_retries(voice: Callable, texts: list[str], tries: int = 20, pause_s: float = 0.0) -> list[np.ndarray]:
    """The batch; failing that, text by text, with up to `tries` attempts each and pauses that grow linearly; failing that, halves at a space, tried once."""
    try:
        return voice(texts)
    except (MemoryError, RuntimeError):
        if len(texts) > 1:
            return [speak_with_retries(voice, [t], tries, pause_s)[0] for t in texts]
    for attempt in range(1, tries):
        time.sleep(pause_s * attempt)
        try:
            return voice(texts)
        except (MemoryError, RuntimeError):
            pass
    at = texts[0].find(" ", len(texts[0]) // 2)
    if at < 0:
        raise RuntimeError("the voice failed")
    return [np.concatenate(speak_with_retries(voice, [texts[0][:at]], 1) + speak_with_retries(voice, [texts[0][at + 1:]], 1))]


def _spoken(voice: Callable, texts: list[str], tries: int, pause_s: float) -> Iterator[tuple[np.ndarray | None, str | None]]:
    """Samples, or the error, of every text."""
    try:
        yield from ((x, None) for x in speak_with_retries(voice, texts, tries, pause_s))
    except Exception as e:  # noqa: BLE001  a bad text must not end the others
        if len(texts) == 1:
            yield None, f"{type(e).__name__}: {e}"
        else:
            for t in texts:
                yield from _spoken(voice, [t], tries, pause_s)


def synthesise(segments: DataFrame, profile: Profile, make_voice: Callable[[], Callable] = Tone, tries: int = 20, pause_s: float = 0.0, deflate: bool = False) -> DataFrame:
    """Adds pcm (with the silence that follows), error and n_pcm (its bytes) to segments (seg, ends_paragraph); the model loads once a task.

    A text that the voice can't render has null pcm and the error; all others are rendered. n_pcm is there with deflate,
    where pcm comes as deflated() makes it, before it leaves Python.
    """
    schema = T.StructType([*segments.schema.fields, T.StructField("pcm", T.BinaryType()), T.StructField("error", T.StringType()), *([T.StructField("n_pcm", T.LongType())] if deflate else [])])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voice = make_voice()
        for p in parts:
            texts, lasts = p["seg"].tolist(), p["ends_paragraph"].tolist()
            out, errors, sizes, at, size = [], [], [], 0, 0
            for i in range(0, len(p), profile.batch):
                for (x, error), last in zip(_spoken(voice, texts[i:i + profile.batch], tries, pause_s), lasts[i:i + profile.batch]):
                    raw = None if x is None else pcm_bytes(x) + silence(last, profile)
                    out.append(zlib.compress(raw, 1) if deflate and raw is not None else raw)
                    errors.append(error)
                    sizes.append(None if raw is None else len(raw))
                    size += len(out[-1] or b"")
                if size >= OUT_BYTES or i + profile.batch >= len(p):
                    made = {"pcm": out, "error": errors} | ({"n_pcm": pd.array(sizes, "Int64")} if deflate else {})
                    yield p.iloc[at:at + len(out)].assign(**made)
                    out, errors, sizes, at, size = [], [], [], at + len(out), 0

    return segments.mapInPandas(run, schema)


def failed(said: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_failed and error (the first) of chapters with a text that could not be rendered."""
    bad = said.where("error is not null")
    return bad.groupBy(*keys).agg(F.count("*").alias("n_failed"), F.min_by("error", F.struct("para_no", "seg_no")).alias("error"))
