"""Substring dedup by level-wise doubling of repeated word windows.

Level 1 looks at windows of half the length asked for: anchors, the half-length windows that content
sampling picks, are counted over the corpus. Only those that repeat are extended to twice that
length; where a whole neighbourhood repeats alike, all its windows do, and the others are counted
one by one. Anything longer that repeats is covered by its windows of that length, so no candidate
survives beyond it. Every window is judged on the input.

Words are [^\\x20\\x09-\\x0D]+. Defined cases: a null text has no word; a row with a null doc_id is
returned unchanged and takes no part; rows that repeat a doc_id with another text are never repeats
of each other; repeated rows get the same answer; an empty table gives no rows; other columns are
ignored; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WORD_HASH, Spec, lists_of, repeated, symbols, union_of, with_lists
from .common import in_rows, keyed, pieces, tidy, written


def _windows(spec: Spec):
    """The hashes of all windows around the requested anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, ths = b.column(0).to_pylist(), b.column(1).to_pylist()
            text = b.column(2)
            keys, places, reaches = (lists_of(b.column(i)) for i in (3, 4, 5))
            for i in range(b.num_rows):
                raw = np.frombuffer(text[i].as_buffer(), np.uint8)
                sym, _ = symbols(spec.unit, raw, np.array([0, raw.size]))
                pre = WORD_HASH.prefixes(sym)
                a, lr = places[i].astype(np.int64), reaches[i].astype(np.int64)
                lo, hi = a - (lr >> 16), a + (lr & 0xFFFF)
                n = hi - spec.window - lo + 1
                key = np.repeat(keys[i], n)
                start = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
                h = WORD_HASH.ranges(pre, start, start + spec.window).view(np.int64)
                yield from in_rows(pa.RecordBatch.from_arrays([pa.array(key), pa.array(h), pa.array(np.full(len(h), docs[i])), pa.array(np.full(len(h), ths[i])), pa.array(start.astype(np.int32))], names=["key", "h", "doc", "th", "a"]))

    return tidy(run)


def _cut():
    """Removes the words of the spans and hashes what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            ids, words_n, removed, spans_n, sha = b.column(0), [], [], [], []
            starts, ends = lists_of(b.column(2)), lists_of(b.column(3))
            for t, s, e in zip(b.column(1).to_pylist(), starts, ends):
                words = t.encode().split() if t else []
                words_n.append(len(words))
                gone = runs = 0
                if s is not None and len(s):
                    s, e = union_of(s, e)
                    gone, runs = int((e - s).sum()), len(s)
                    kept, at = [], 0
                    for x, y in zip(s.tolist(), e.tolist()):
                        kept += words[at:x]
                        at = y
                    words = kept + words[at:]
                removed.append(gone)
                spans_n.append(runs)
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(words_n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(spans_n, pa.int64())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"])

    return tidy(run)


def dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and n_spans of every row."""
    spec, base = Spec("word", window, window // 2, within=False), keyed(docs)
    found = written(repeated(base, spec), "level1")
    asked = with_lists(base, found.where("request"), "inner", "key", "a", "b").select("doc_id", "th", "text", "_key", "_a", "_b")
    at = written(asked.mapInArrow(_windows(spec), "key long, h long, doc long, th long, a int"), "level2")
    first = at.groupBy("key", "h").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most")
    later = at.join(first, ["key", "h"]).where("doc > least")
    spans = found.where("not request").select("doc", "th", "a", "b").unionByName(later.select("doc", "th", "a", (F.col("a") + window).alias("b")))
    return with_lists(base, spans, "left", "a", "b").select("doc_id", "text", "_a", "_b").mapInArrow(_cut(), "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long")
