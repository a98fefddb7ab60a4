"""Byte-level BPE by a global shuffle of distinct words.

1. Every task cuts its texts into pre-tokens and, for chunks of about CHUNK_BYTES of text, explodes
   them into distinct words and the positions that hold them: the words go out once a chunk, dealt
   by their hash, with the chunk's positions as one sequence of word numbers.
2. The rows are shuffled by word. A task meets every chunk's use of its words and encodes each
   distinct word once, by the ranks.
3. The ids go back to the chunks, where they are joined to the positions and documents reassembled.
   Decoding looks the ids up in the token-byte table.
A frequent word comes once a chunk, not once a use, and chunks are bounded, so no key is hot.

Defined cases: a null or empty text has no token; null and repeated doc_ids are kept row by row; an
empty table gives no rows; a text longer than CHUNK_BYTES is a chunk alone; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, tidy

CHUNK_BYTES = 24 << 20
#: Words are dealt to so many buckets: one for every BUCKET_BYTES of text, at most BUCKETS.
BUCKET_BYTES, BUCKETS = 8 << 20, 4096
#: Distinct words that a task remembers at a time.
WORDS_KEPT = 1_500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merger:
    """BPE of single words by ranks: merges the adjacent pair of least rank until none is left."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.ranks = ranks
        # The library's own merge of one piece, with a pattern that never splits it.
        self.one = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.kept: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        got = self.kept.get(word)
        if got is None:
            if len(self.kept) > WORDS_KEPT:
                self.kept.clear()
            ids = self.one.encode_ordinary(word)
            got = self.kept[word] = struct.pack(f"<{len(ids)}I", *ids)
        return got


_mergers: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    if path not in _mergers:
        _mergers[path] = Merger(load_ranks(path))
    return _mergers[path]


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes."""
    return squeezed(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(opened(data), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


ROWS = "bucket int, chunk long, payload binary, extra binary"
NAMES = ["bucket", "chunk", "payload", "extra"]


def _explode(pattern: str, buckets: int):
    """Chunks of texts: a row of words for each bucket, and a row (bucket < 0) of documents and positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, part, no = regex.compile(pattern).findall, TaskContext.get().partitionId(), 0
        number: dict[str, int] = {}
        docs, lens, seq, held = [], [], [], 0

        def rows() -> pa.RecordBatch:
            chunk = part << 32 | no
            # Numbers by falling count, words used once last and in text order: their positions need no number.
            used = np.concatenate(seq)
            count = np.bincount(used, minlength=len(number))
            rank = np.empty(len(number), np.int64)
            rank[np.argsort(-count, kind="stable")] = np.arange(len(number))
            positions = np.where(count[used] == 1, 0, rank[used] + 1)
            words = sorted((zlib.crc32(w.encode()) % buckets, rank[i], w) for w, i in number.items())
            out_b, out_p = [], []
            at = 0
            while at < len(words):
                b, end = words[at][0], at
                while end < len(words) and words[end][0] == b:
                    end += 1
                raw = [w.encode() for _, _, w in words[at:end]]
                steps = np.diff([r for _, r, _ in words[at:end]], prepend=0)
                out_b.append(b)
                numbers = planes(np.concatenate([steps, [len(r) for r in raw]]))
                out_p.append(struct.pack("<II", len(raw), len(numbers)) + numbers + squeezed(b"".join(raw)))
                at = end
            head = pa.record_batch([pa.array(docs, pa.int64()), pa.array(lens, pa.int64())], names=["doc_id", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as w:
                w.write_batch(head)
            return pa.RecordBatch.from_arrays([
                pa.array([*out_b, -1 - int(chunk % 1_000_003)], pa.int32()), pa.array([chunk] * (len(out_b) + 1), pa.int64()),
                pa.array([*out_p, planes(positions)], pa.binary()), pa.array([*[None] * len(out_b), squeezed(sink.getvalue().to_pybytes())], pa.binary()),
            ], names=NAMES)

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = find(t) if t else []
                seq.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                docs.append(d)
                lens.append(len(words))
                held += len(t or "")
                if held >= CHUNK_BYTES:
                    yield rows()
                    number, docs, lens, seq, held, no = {}, [], [], [], 0, no + 1
        if docs:
            yield rows()

    return tidy(run)


def _encode(ranks_path: str):
    """Words to ids, each distinct word of the task's buckets once; position rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = merger(ranks_path).ids
        for b in batches:
            out = []
            for bucket, payload in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if bucket < 0:
                    out.append(payload)
                    continue
                n, m = struct.unpack_from("<II", payload)
                numbers, raw = unplanes(payload[8:8 + m]), opened(payload[8 + m:])
                at, got = 0, []
                for size in numbers[n:].tolist():
                    got.append(ids(raw[at:at + size].decode()))
                    at += size
                flat = np.frombuffer(b"".join(got), "<u4")
                out.append(struct.pack("<I", n) + planes(np.concatenate([numbers[:n], [len(g) // 4 for g in got], flat])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary()), b.column(3)], names=NAMES)

    return tidy(run)


def _reassemble(ranks_path: str, keep: bool):
    """A chunk's rows to its documents; decodes the ids by the token-byte table."""

    def run(rows: pa.Table) -> pa.Table:
        table = merger(ranks_path)
        if not hasattr(table, "bytes_of"):
            by_id = sorted((i, t) for t, i in table.ranks.items())
            table.bytes_of = [b""] * (by_id[-1][0] + 1)
            for i, t in by_id:
                table.bytes_of[i] = t
        ranks, counts, flats, positions, head = [], [], [], None, None
        for r in rows.to_pylist():
            if r["bucket"] < 0:
                positions, head = unplanes(r["payload"]).astype(np.int64), pa.ipc.open_stream(opened(r["extra"])).read_all()
            else:
                n = struct.unpack_from("<I", r["payload"])[0]
                x = unplanes(r["payload"][4:])
                ranks.append(np.cumsum(x[:n].astype(np.int64)))
                counts.append(x[n:2 * n].astype(np.int64))
                flats.append(x[2 * n:])
        none = np.zeros(0, np.int64)
        rank, came, flat = np.concatenate([none, *ranks]), np.concatenate([none, *counts]), np.concatenate([none.astype("<u4"), *flats])
        count, start = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        count[rank], start[rank] = came, np.cumsum(came) - came
        once = positions == 0
        positions = np.where(once, len(rank) - int(once.sum()) + np.cumsum(once), positions) - 1
        bytes_of = np.array(table.bytes_of, object)
        doc_ids, lens = head.column(0).to_pylist(), np.array(head.column(1)).astype(np.int64)
        n_tok, sha, dec, ids_out, texts = [], [], [], [], []
        at = 0
        for m in lens.tolist():
            p = positions[at:at + m]
            at += m
            c = count[p]
            total = int(c.sum())
            idx = np.repeat(start[p] - (np.cumsum(c) - c), c) + np.arange(total)
            ids = np.ascontiguousarray(flat[idx], "<u4")
            text = b"".join(bytes_of[ids].tolist())
            n_tok.append(total)
            sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
            dec.append(hashlib.sha256(text).hexdigest())
            if keep:
                ids_out.append(ids.astype(np.int32))
                texts.append(text)
        cols = {"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(n_tok, pa.int64()), "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(dec, pa.string())}
        if keep:
            cols |= {"ids": pa.array(ids_out, pa.list_(pa.int32())), "decoded": pa.array(texts, pa.binary())}
        return pa.table(cols)

    return run


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; with keep, also ids and decoded."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(BUCKETS, max(n_partitions(docs), size // BUCKET_BYTES)))
    words = base.mapInArrow(_explode(pattern, buckets), ROWS)
    encoded = words.repartition(buckets, "bucket").mapInArrow(_encode(ranks_path), ROWS)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if keep else "")
    return encoded.groupBy("chunk").applyInArrow(_reassemble(ranks_path, keep), schema)
