"""What the operators share: tables, the shared folder, texts as byte blocks, hashes over blocks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the vectorised scans take at a time; one longer text makes a block of its own.
BLOCK_BYTES = 1 << 18
#: Bytes of text for which rows are gathered before they are sent on, and rows of a batch that is sent:
#: the JVM holds a batch outside its heap.
PIECE_BYTES, BATCH_ROWS = 4 << 20, 8_192
#: Bytes of input for each partition of a shuffle whose number of partitions is not left to adaptive execution.
PARTITION_BYTES = 64 << 20
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a folder of our own only where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table written in the shared folder: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/docflow-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Batches that the session's tasks send to Python hold about PIECE_BYTES, not 10,000 texts: the JVM builds a batch outside its
    heap, in buffers that double, and the worker holds it too. Set for the session, as plans may run after this; a smaller limit stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(key, "2147483647")) > PIECE_BYTES:
        spark.conf.set(key, str(PIECE_BYTES))


def _bytes(x: str) -> int:
    """A size as Spark writes it: 4194304, 4194304b, 4m, 4mb."""
    x = x.strip().lower().rstrip("b")
    return int(x[:-1]) << 10 * (1 + "kmgt".index(x[-1])) if x[-1:] in tuple("kmgt") else int(x)


def joined(rows: DataFrame, facts: DataFrame, keys: list[str], hot: Column) -> DataFrame:
    """rows with the one row of facts that agrees in keys (rows without any go).

    hot must hold for a bounded number of facts, those with many rows: these are broadcast, so that their rows needn't meet in
    one task; the others are joined by a shuffle.
    """
    few = F.broadcast(facts.where(hot))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(facts.where(~hot), keys))


#: Bits of a filter of ids, whatever their number: 8 MB.
FILTER_BITS = 1 << 26


def id_filter(ids: DataFrame) -> Callable[[Column], Column]:
    """A test of a column of longs: true for every one of ids (one column) and, where these are far fewer than FILTER_BITS, for few others.

    It keeps rows that a join would drop out of its shuffle. The filter has one size; of many ids it lets all pass.
    """
    bit = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(FILTER_BITS)).cast("int")
    parts = ids.select(F.shiftright(bit, 16).alias("part"), bit.bitwiseAND(0xFFFF).alias("bit")).groupBy("part").agg(F.collect_set("bit").alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1):
                own = np.zeros(1 << 16, bool)
                own[x.values.to_numpy()] = True
                out.append(np.packbits(own).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["part", "bits"])

    all_ = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.mapInArrow(tidy(pack), "part int, bits binary").collect():  # at most 1,024 rows of 8 KB
        all_[r["part"] << 13:(r["part"] + 1) << 13] = np.frombuffer(r["bits"], np.uint8)
    sent = ids.sparkSession.sparkContext.broadcast(all_)

    @F.arrow_udf("boolean")
    def test(h: pa.Array) -> pa.Array:
        at = h.to_numpy(zero_copy_only=False) & (FILTER_BITS - 1)
        return pa.array((sent.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    return lambda c: test(F.xxhash64(c))


def n_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of df: as many as the session asks for, more where the files read are large."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [x for x in map(leaves.apply, range(leaves.size())) if x.getClass().getSimpleName() == "LogicalRelation"]
    size = sum(int(str(x.stats().sizeInBytes())) for x in files)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PARTITION_BYTES)


def tidy(run: Callable) -> Callable:
    """run, a function of batches, after which the worker gives freed memory back: it stays alive beside later stages."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole


def spans(col: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """First and end row of runs of about `most` bytes of text; a longer text makes a run of its own."""
    at, end = 0, np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < len(col):
        to = int(np.searchsorted(end, (end[at - 1] if at else 0) + most, "right"))
        yield at, (at := max(at + 1, to))


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of about PIECE_BYTES of the text column."""
    for b in batches:
        for i, j in spans(b.column(text)):
            yield b.slice(i, j - i)


def in_rows(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most BATCH_ROWS."""
    for i in range(0, b.num_rows, BATCH_ROWS):
        yield b.slice(i, BATCH_ROWS)


def unique_ids(docs: DataFrame) -> bool:
    """Whether no doc_id repeats (nulls aside)."""
    return docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count() == 0


def keyed(docs: DataFrame, unique: bool | None = None) -> DataFrame:
    """doc_id, text and th, which tells apart different texts under one doc_id; 0 where ids are unique."""
    th = F.lit(0).cast("long") if (unique_ids(docs) if unique is None else unique) else F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), th.alias("th"))


def text_blocks(col: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) of consecutive texts; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # more than 2 GB of texts
        raise ValueError("an Arrow batch of more than 2 GB")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=len(col) + col.offset + 1)[col.offset:].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + BLOCK_BYTES, "right")) - 1)
        j = min(j, len(col))
        yield i, j, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Rolling:
    """Hashes of any ranges of one array of 64-bit symbols, in constant time each, from prefix sums.

    The hash of [i, j) is sum(sym[t] * B**(t - i)) modulo 2**64, mixed with the length.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if self.up.size < n:
            n = max(n, 2 * self.up.size, 1 << 12)
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, b, U64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def prefixes(self, sym: np.ndarray) -> np.ndarray:
        self._powers(sym.size + 1)
        out = np.zeros(sym.size + 1, U64)
        np.cumsum(sym * self.up[: sym.size], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix((prefix[j] - prefix[i]) * self.down[i] + (j - i).astype(U64) * U64(0x9E3779B97F4A7C15))


#: A random 64-bit word for every byte, fixed so that all executors agree.
BYTE_WORDS = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over every window of the width: element i covers x[i : i + width]."""
    step = 1
    while step * 2 <= width:
        x = op(x[:-step], x[step:])
        step *= 2
    return op(x[: x.size - (width - step)], x[width - step:]) if width > step else x


def minimizers(h: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Positions whose h is the least of some window of `width` positions that starts where ok holds.

    h has the value of every position; ok has h.size - width + 1 entries. All ties are taken, so
    equal windows give equal relative positions.
    """
    if ok.size <= 0 or not ok.any():
        return np.zeros(0, np.int64)
    least = sliding(np.minimum, h, width)
    least = np.where(ok, least, 0)  # 0 never equals h, which is made positive
    pad = np.zeros(width - 1, h.dtype)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return np.flatnonzero(most == h)


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
