"""Token-ID files: fixed-size id blocks, transposed into byte or bit planes, each plane compressed.

A token file is a table of chunks. A chunk holds the ids of whole documents, about CHUNK_IDS of
them, in blocks of BLOCK_IDS. The planes of a block (4 byte planes or 32 bit planes of the
little-endian 32-bit ids) are compressed one by one with zstandard; planes of zeros take no room.
The chunk index has the documents with their id counts and the offset of every plane. Chunks are
rows that Spark's Parquet writer commits, so files can lie in any store and a task that is run
again leaves no second copy.

Defined cases: a null or empty text gives the end id alone; a null doc_id sorts first; repeated
rows are repeated documents, in the order of their texts; an empty table gives no rows; other
columns are ignored; text of any length stays in one chunk.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_partitions, shared_dir, spans, tidy

BLOCK_IDS = 1 << 15
CHUNK_IDS = 1 << 20
#: Distinct space-led pieces that a worker remembers; beyond that it starts anew.
PIECES_KEPT = 1_000_000
#: Bytes of text that are encoded at a time, and pieces whose ids are gathered at a time.
ENCODED_BYTES, GATHERED = 8 << 20, 1 << 20
#: Leads a piece that no space leads; texts that hold it are encoded whole.
BARE = "\0"
#: A letter and a mark after it. Only Latin letters, on whose class all versions of Unicode agree; no apostrophe, which can begin
#: a token of letters.
LETTER_MARK = r'([A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?()\[\]{}*#$%&/+=<>@^~|"-])'
WHITE = re.compile(r"\s")
#: Two adjacent characters that are white space to Unicode or ASCII's separators.
TWO_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"


class PieceEncoder:
    """Ids of texts by the tokenizers library, each distinct piece encoded once a worker.

    A byte-level pre-tokenizer starts a token at every single space, between a letter and a mark
    after it, and on both sides of a single line end, so a text without two adjacent white-space
    characters is the concatenation of its pieces between these places. A piece that no space leads
    is BARE. Other texts, and those holding a special token's string, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.led = np.zeros(max(vocab.values()) + 1, bool)
        self.led[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        pre = json.loads(self.tok.to_str()).get("pre_tokenizer") or {}
        self.by_class = pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
        self.special = [BARE, *(t.content for t in self.tok.get_added_tokens_decoder().values())]
        self.kept: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return self.ids(text).tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text. Pieces are cut and numbered by Arrow, so that Python meets each distinct one once a call."""
        if len(self.kept) > PIECES_KEPT:
            self.kept.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, TWO_SPACES)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        is_plain = pc.and_not(pc.greater(pc.binary_length(texts), 0), odd).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(is_plain).tolist()
        out = [b""] * len(texts)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.whole(texts[i].as_py())
        if not plain:
            return out
        cut = texts.filter(pa.array(is_plain))
        if self.by_class:
            cut = pc.replace_substring(pc.replace_substring_regex(cut, LETTER_MARK, rf"\1 {BARE}\2"), "\n", f" {BARE}\n {BARE}")
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), cut, pa.scalar(BARE, pa.large_string())), " ")
        numbered = lists.flatten().dictionary_encode()
        pieces = numbered.dictionary.to_pylist()
        self.learn(pieces)
        found = [*map(self.kept.__getitem__, pieces)]
        of = numbered.indices.to_numpy()
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        known, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n
        parts = []
        for i in range(0, of.size, GATHERED):
            m = n[of[i:i + GATHERED]]
            parts.append(known[np.repeat(start[of[i:i + GATHERED]] - np.cumsum(m) + m, m) + np.arange(m.sum())])
        ids, ends = np.concatenate(parts), np.concatenate([[0], np.cumsum(n[of])])[lists.offsets.to_numpy()]
        for i, x, y in zip(plain, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = ids[x:y].tobytes()
        return out

    def learn(self, pieces: list[str]) -> None:
        """Encodes the pieces not met yet, many at a time: those led by a space joined by spaces, bare ones by line ends."""
        kept = self.kept
        new = [p for p in pieces if p not in kept]
        self._learn(kept, [p for p in new if p and p[0] != BARE], " ", lambda ids: np.flatnonzero(self.led[ids]))
        kept.setdefault("", self.whole(" "))
        bare = [p for p in new if p and p[0] == BARE]
        alone = [p for p in bare if not self.by_class or len(p) == 1 or WHITE.search(p)]
        kept.update((p, self.whole(p[1:])) for p in alone)
        bare = [p[1:] for p in bare if p not in kept]
        got, end = {}, self.ids("\n")[0]
        self._learn(got, bare, "\n", lambda ids: np.flatnonzero(ids == end), skip=1)
        kept.update((BARE + p, x) for p, x in got.items())

    def _learn(self, kept: dict[str, bytes], new: list[str], led_by: str, starts, skip: int = 0) -> None:
        """kept gets the ids of new; starts finds in the ids of all, each led by led_by, where each begins, `skip` ids after."""
        for i in range(0, len(new), 20_000):
            some = new[i:i + 20_000]
            ids = self.ids(led_by + led_by.join(some))
            at = np.append(starts(ids), ids.size)
            if at.size != len(some) + 1:
                raise ValueError("the tokenizer doesn't start a token at every space and line end")
            raw = ids.tobytes()
            kept.update((p, raw[4 * (a + skip):4 * b]) for p, a, b in zip(some, at[:-1].tolist(), at[1:].tolist()))


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def pack(ids: np.ndarray, planes: str = "byte") -> tuple[bytes, np.ndarray]:
    """The compressed planes of ids, one after another, and the end of each: [block, plane]."""
    out, ends, at = [], [], 0
    squeeze = zstandard.ZstdCompressor(level=1)
    for i in range(0, max(1, ids.size), BLOCK_IDS):
        block = np.ascontiguousarray(ids[i:i + BLOCK_IDS].astype("<u4")).view(np.uint8).reshape(-1, 4)
        if planes == "bit":
            bits = np.unpackbits(block, axis=1, bitorder="little")
            rows = np.packbits(bits.T, axis=1, bitorder="little")
        else:
            rows = block.T
        for row in rows:
            if row.any():
                out.append(squeeze.compress(np.ascontiguousarray(row).tobytes()))
                at += len(out[-1])
            ends.append(at)
    return b"".join(out), np.array(ends, np.int64).reshape(-1, 32 if planes == "bit" else 4)


def unpack(data: bytes, ends: np.ndarray, n: int, planes: str = "byte") -> np.ndarray:
    """The n ids that pack() took."""
    out, at, d = np.zeros(n, "<u4"), 0, zstandard.ZstdDecompressor()
    for b, row in enumerate(ends):
        m = min(BLOCK_IDS, n - b * BLOCK_IDS)
        width = (m + 7) // 8 if planes == "bit" else m
        block = np.zeros((len(row), width), np.uint8)
        for p, end in enumerate(row):
            if end > at:
                block[p] = np.frombuffer(d.decompress(data[at:end], max_output_size=width), np.uint8)
                at = int(end)
        if planes == "bit":
            bits = np.unpackbits(block, axis=1, bitorder="little")[:, :m]
            block = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
        out[b * BLOCK_IDS:b * BLOCK_IDS + m] = np.ascontiguousarray(block.T).view("<u4")[:, 0]
    return out


CHUNK = "file_no int, chunk_no int, n_ids long, planes string, doc_ids array<long>, counts array<long>, plane_ends array<long>, payload binary"


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, planes: str = "byte") -> None:
    """Encodes docs (doc_id, text) and writes their token file at path, in ascending doc_id order."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file_no, no = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end, ids, raw, counts, held = struct.pack("<I", end_id), [], [], [], 0

        def row() -> pa.RecordBatch:
            all_ids = np.frombuffer(b"".join(raw), "<u4")
            payload, ends = pack(all_ids, planes)
            return pa.RecordBatch.from_arrays([
                pa.array([file_no], pa.int32()), pa.array([no], pa.int32()), pa.array([all_ids.size], pa.int64()), pa.array([planes]),
                pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([ends.ravel().tolist()], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
            ], names=["file_no", "chunk_no", "n_ids", "planes", "doc_ids", "counts", "plane_ends", "payload"])

        for b in batches:
            for i, j in spans(b.column(1), ENCODED_BYTES):
                part = b.slice(i, j - i)
                for d, x in zip(part.column(0).to_pylist(), enc.encode(part.column(1))):
                    ids.append(d)
                    raw.append(x + end)
                    counts.append(len(x) // 4 + 1)
                    held += counts[-1]
                    if held >= CHUNK_IDS:
                        yield row()
                        no, ids, raw, counts, held = no + 1, [], [], [], 0
        if ids:
            yield row()

    n = n_partitions(docs)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = base.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    order.mapInArrow(tidy(chunks), CHUNK).write.option("compression", "none").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a token file, from the file alone."""

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = unpack(r["payload"], np.array(r["plane_ends"], np.int64).reshape(-1, 32 if r["planes"] == "bit" else 4), r["n_ids"], r["planes"])
                raw, at = ids.tobytes(), np.concatenate([[0], np.cumsum(r["counts"])]).astype(np.int64)
                crc = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                m = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([r["file_no"]] * m, pa.int32()), pa.array([r["chunk_no"]] * m, pa.int32()), pa.array(r["doc_ids"], pa.int64()), pa.array(at[:-1]), pa.array(r["counts"], pa.int64()), pa.array(crc, pa.int64())], names=["file_no", "chunk_no", "doc_id", "at", "n_tokens", "ids_crc32"])

    stored = spark.read.schema(CHUNK).parquet(path)
    index = stored.select("file_no", "chunk_no", "n_ids")
    # Starts of chunks within their file, then of files: a file has few chunks, and files are as many as partitions.
    w = Window.partitionBy("file_no").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    in_file = index.withColumn("before", F.coalesce(F.sum("n_ids").over(w), F.lit(0)))
    totals = index.groupBy("file_no").agg(F.sum("n_ids").alias("n")).collect()  # one number a file
    base, starts = 0, []
    for r in sorted(totals):
        starts.append((r["file_no"], base))
        base += r["n"]
    files = spark.createDataFrame(starts, "file_no int, base long")
    at = in_file.join(F.broadcast(files), "file_no").select("file_no", "chunk_no", (F.col("base") + F.col("before")).alias("chunk_start"))
    rows = stored.mapInArrow(tidy(docs), "file_no int, chunk_no int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(at, ["file_no", "chunk_no"]).select("doc_id", (F.col("chunk_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_file(docs: DataFrame, tokenizer: str, end_id: int = 0, planes: str = "byte") -> DataFrame:
    """Writes the token file of docs in the shared folder and gives what reading it back shows."""
    path = f"{shared_dir(docs.sparkSession)}/docflow-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, path, end_id, planes)
    return read_tokens(docs.sparkSession, path)
