"""Finding strings that repeat anywhere in a corpus, by content-sampled anchors.

Texts are sequences of symbols (bytes or words). Every window of `window` symbols holds an anchor:
the `gram` symbols in it whose hash is least. Equal windows have equal anchors at equal places, so
only anchors (about one in (window - gram) / 2 symbols) need be shuffled, and none is missed.

The context of an anchor is all that windows around it can hold. Occurrences of one anchor with
equal contexts form a class: in all but the earliest, every window repeats. Only where one anchor
has several classes (at the edges of repeats) are the symbols themselves compared, between the
earliest members; the operators do that their own way. Equal contexts are merged inside a task
before the shuffle, so an anchor that a third of all rows hold comes once a task and class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_WORDS, U64, Rolling, in_rows, minimizers, mix, pieces, text_blocks, tidy

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE_HASH, WORD_HASH = Rolling(0x2545F4914F6CDD1D), Rolling(0x9E6C63D0876A9A63)


@dataclass(frozen=True)
class Spec:
    unit: str  # "byte" or "word"
    window: int
    gram: int
    within: bool  # an earlier start in the same document counts as a repeat

    @property
    def reach(self) -> int:
        return self.window - self.gram


def symbols(unit: str, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit symbols of a block, and the offsets of its texts in them."""
    sym = BYTE_WORDS[raw]
    if unit == "byte":
        return sym, off
    start, end = word_bounds(raw, off)
    return BYTE_HASH.ranges(BYTE_HASH.prefixes(sym), start, end), np.searchsorted(start, off)


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words [^\\x20\\x09-\\x0D]+ start and end; a text's end ends a word."""
    word = ~SPACE[raw]
    cut = np.zeros(raw.size + 1, bool)
    cut[off] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


A_SCHEMA = "key long, ctx long, doc long, th long, pos int, lr int"
A_NAMES = ["key", "ctx", "doc", "th", "pos", "lr"]


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def scan(spec: Spec, every: bool = False):
    """Anchors of (doc_id, th, text) batches; lr packs the context's reach, or -1 marks a span [pos, ctx) known to repeat (never with every)."""

    def block(raw, off):
        sym, at = symbols(spec.unit, raw, off)
        n = sym.size
        if n < spec.window:
            return None
        pre = WORD_HASH.prefixes(sym)
        grams = mix((pre[spec.gram:] - pre[: -spec.gram]) * WORD_HASH.down[: n - spec.gram + 1])
        least = (grams >> U64(33)).astype(np.int64) + 1
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        ok = np.arange(n - spec.window + 1) + spec.window <= at[row[: n - spec.window + 1] + 1]
        sel = minimizers(least, ok, spec.reach + 1)
        if not sel.size:
            return None
        r = row[sel]
        lo, hi = np.maximum(at[r], sel - spec.reach), np.minimum(at[r + 1], sel + spec.window)
        ctx = mix(WORD_HASH.ranges(pre, lo, hi) + (sel - lo).astype(U64) * U64(0xD6E8FEB86659FD93))
        return grams[sel], ctx, r, sel - at[r], (sel - lo) << 16 | (hi - sel)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 2):
            found = [(x[0], x[1], x[2] + i, x[3], x[4]) for i, _, raw, off in text_blocks(b.column(2)) if (x := block(raw, off))]
            if not found:
                continue
            key, ctx, row, pos, lr = (np.concatenate(c) for c in zip(*found))
            doc, th = np.asarray(b.column(0))[row], np.asarray(b.column(1))[row]
            if (np.diff(doc) < 0).any() or th.any():
                o = np.lexsort((pos, th, doc))
                key, ctx, doc, th, pos, lr = key[o], ctx[o], doc[o], th[o], pos[o], lr[o]
            both = mix(key) ^ ctx
            o = np.argsort(both, kind="stable")
            new = np.concatenate([[True], both[o][1:] != both[o][:-1]])
            first = o[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
            again = np.zeros(len(o), bool)
            again[o] = ~new if spec.within else doc[o] != doc[first]
            if every:
                again[:] = False
            keep = ~again
            cols = [key[keep], ctx[keep], doc[keep], th[keep], pos[keep], lr[keep]]
            if again.any():
                d, t, left, right = doc[again], th[again], pos[again] - (lr[again] >> 16), pos[again] + (lr[again] & 0xFFFF)
                d, t, left, right = merged(d, t, left, right)
                salt = mix(d.astype(U64) * U64(31) + left.astype(U64))
                more = [salt, right.astype(U64), d, t, left, np.full(len(d), -1)]
                cols = [np.concatenate([a, m]) for a, m in zip(cols, more)]
            yield from in_rows(pa.RecordBatch.from_arrays([
                pa.array(_as_long(cols[0])), pa.array(_as_long(cols[1])), pa.array(cols[2]), pa.array(cols[3]), pa.array(cols[4].astype(np.int32)), pa.array(cols[5].astype(np.int32)),
            ], names=A_NAMES))

    return tidy(run)


def merged(doc, th, left, right):
    """Overlapping or touching spans of rows sorted by (doc, th, left), joined; right must not fall inside a document."""
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (left[1:] > right[:-1])])
    at = np.flatnonzero(new)
    return doc[at], th[at], left[at], right[np.append(at[1:], len(doc)) - 1]


C_SCHEMA = "request boolean, key long, doc long, th long, a int, b int"
C_NAMES = ["request", "key", "doc", "th", "a", "b"]


def classify(spec: Spec):
    """Rows sorted by (key, ctx, doc, th, pos) to spans [a, b) that repeat, and requests (a: place, b: reach) to compare.

    Keeps one open key between batches: its last class, and its first rows until a second class shows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_ctx = last_doc = None
        multi, pending = False, []

        def out(request, key, doc, th, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), request)), pa.array(key), pa.array(doc), pa.array(th), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=C_NAMES)

        for batch in batches:
            key, ctx, doc, th, pos, lr = (np.asarray(c) for c in batch.columns)
            known = lr == -1
            if known.any():
                yield out(False, key[known], doc[known], th[known], pos[known], ctx[known])
                key, ctx, doc, th, pos, lr = (x[~known] for x in (key, ctx, doc, th, pos, lr))
            n = len(key)
            if not n:
                continue
            goes_on = key[0] == last_key
            new_key = np.concatenate([[not goes_on], key[1:] != key[:-1]])
            new_class = new_key | np.concatenate([[not (goes_on and ctx[0] == last_ctx)], ctx[1:] != ctx[:-1]])
            at = np.maximum.accumulate(np.where(new_class, np.arange(n), -1))
            first_doc = np.where(at >= 0, doc[np.maximum(at, 0)], 0 if last_doc is None else last_doc)
            first = new_class if spec.within else doc == first_doc
            if (~first).any():
                s = ~first
                yield out(False, key[s], doc[s], th[s], pos[s] - (lr[s] >> 16), pos[s] + (lr[s] & 0xFFFF))
            group = np.cumsum(new_key) - (0 if goes_on else 1)
            classes = np.bincount(group, new_class)
            if goes_on:
                classes[0] += 2 if multi else 1
            else:
                pending = []
            is_multi = classes >= 2
            ask = first & is_multi[group]
            if pending and goes_on and is_multi[0]:
                yield out(True, *(np.concatenate(c) for c in zip(*pending)))
                pending = []
            if ask.any():
                yield out(True, key[ask], doc[ask], th[ask], pos[ask], lr[ask])
            multi = bool(is_multi[-1])
            if group[-1] > 0:
                pending = []
            if not multi:
                w = first & (group == group[-1])
                if w.any():
                    pending.append((key[w], doc[w], th[w], pos[w], lr[w]))
            last_key, last_ctx, last_doc = key[-1], ctx[-1], first_doc[-1]

    return tidy(run)


def repeated(docs: DataFrame, spec: Spec) -> DataFrame:
    """Spans and requests of docs (doc_id, text, th)."""
    rows = docs.where("doc_id is not null").select("doc_id", "th", "text").mapInArrow(scan(spec), A_SCHEMA)
    return rows.repartition("key").sortWithinPartitions("key", "ctx", "doc", "th", "pos").mapInArrow(classify(spec), C_SCHEMA)


def with_lists(docs: DataFrame, rows: DataFrame, how: str, *fields: str) -> DataFrame:
    """docs joined with the lists of their rows' fields (bounded by the text's length)."""
    lists = rows.groupBy("doc", "th").agg(F.collect_list(F.struct(*fields)).alias("_rows"))
    lists = lists.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), *(F.col(f"_rows.{f}").alias(f"_{f}") for f in fields))
    return docs.join(lists, (docs["doc_id"] == lists["_doc"]) & (docs["th"] == lists["_th"]), how).drop("_doc", "_th")


def lists_of(col: pa.Array) -> list[np.ndarray | None]:
    """The lists of an Arrow list column without nulls inside."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off, flat, null = np.asarray(col.offsets), np.asarray(col.values), np.asarray(col.is_null())
    return [None if null[i] else flat[off[i]:off[i + 1]] for i in range(len(col))]


def union_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans, in order."""
    o = np.argsort(start, kind="stable")
    s, e = start[o], np.maximum.accumulate(end[o])
    at = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return s[at], e[np.append(at[1:], len(s)) - 1]
