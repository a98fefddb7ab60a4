"""Inverted multi-index for nearest neighbours by inner product.

Vectors are cut in two halves and each half has its own codebook, so K centroids a half give K * K
cells. A half is coded with one more component, which brings all halves of the sample to one norm:
then the nearest centroid by distance is the one of greatest inner product, however norms vary.
A query (brought to that norm, with zero as the further component) goes through centroid pairs by
summed distance, with a heap over both sorted lists (the multi-sequence walk), until the cells hold
enough vectors; the entries of those cells are reranked by the exact inner product in double
precision. Codebooks are fitted on a bounded sample (SAMPLE rows, those with the least hash); every
row is indexed. The share of rows to visit is found on that sample too, as the least share whose
recall against brute force reaches TARGET: data without structure need a large share, clustered data
a small one.

Equal vectors tie, and ties go to the smaller vec_id, so of each vector only the k + 1 rows with the
least vec_id can be answers: the others are left out of the lists, which is exact and bounds a
group of copies. Cells are dealt into blocks of about BLOCK_ROWS; a larger cell is split.

Defined cases: null or zero vectors, those with a null or non-finite component, those of another
length than the most frequent, and rows without vec_id take no part; of rows that repeat a vec_id
the one of least vector takes part, once; no usable row gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tidy

SAMPLE, TUNING_QUERIES, TARGET, ROUNDS = 16_000, 256, 0.95, 8
BLOCK_ROWS = 4_096
#: Vectors, a query's once for each block that it visits, that a batch of probes holds at most (one query's, if it visits more).
PROBE_ROWS = 8_192


def _distances(y: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((y * y).sum(1)[:, None] - 2 * y @ c.T + (c * c).sum(1), 0)


def _kmeans(y: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = y[rng.choice(len(y), min(k, len(y)), replace=False)].copy()
    for _ in range(ROUNDS):
        a = _distances(y, c).argmin(1)
        n = np.bincount(a, minlength=len(c))
        for d in range(y.shape[1]):
            s = np.bincount(a, y[:, d], minlength=len(c))
            c[:, d] = np.where(n > 0, s / np.maximum(n, 1), c[:, d])
    return c


class Codebooks:
    """Centroids of both halves; cell = first * K + second."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.most = [(x * x).sum(1).max() for x in self._parts(sample)]
        self.one, self.two = (_kmeans(x, k, i + 1) for i, x in enumerate(self._level(sample)))
        self.cells = len(self.one) * len(self.two)

    def _parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half:]

    def _level(self, x: np.ndarray) -> list[np.ndarray]:
        """The halves with a component that brings them to the greatest norm of the sample (longer ones have zero there)."""
        return [np.hstack([h, np.sqrt(np.maximum(m - (h * h).sum(1), 0))[:, None]]) for h, m in zip(self._parts(x), self.most)]

    def cell(self, x: np.ndarray) -> np.ndarray:
        one, two = self._level(x)
        return _distances(one, self.one).argmin(1) * len(self.two) + _distances(two, self.two).argmin(1)

    def walk(self, q: np.ndarray, counts: np.ndarray, enough: float) -> list[int]:
        """Cells by summed distance until they hold `enough` rows; empty cells are passed over."""
        q = np.append(q * (np.sqrt(sum(self.most)) / np.sqrt(q @ q)), 0.0)[None]
        da = _distances(np.hstack([q[:, : self.half], q[:, -1:]]), self.one)[0]
        db = _distances(q[:, self.half:], self.two)[0]
        ia, ib = da.argsort(kind="stable"), db.argsort(kind="stable")
        sa, sb, ia, ib = da[ia].tolist(), db[ib].tolist(), ia.tolist(), ib.tolist()
        heap, out, held, nb = [(sa[0] + sb[0], 0, 0)], [], 0, len(self.two)
        # Row i of the grid is opened by its element (i, 0); each popped (i, j) pushes (i, j + 1).
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            c = ia[i] * nb + ib[j]
            if n := counts[c]:
                out.append(c)
                held += n
            if j == 0 and i + 1 < len(sa):
                heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))
            if j + 1 < len(sb):
                heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
        return out


def _share(books: Codebooks, sample: np.ndarray, k: int) -> float:
    """The least share of rows to visit whose recall on the sample reaches TARGET."""
    n, counts, cell = len(sample), np.bincount(books.cell(sample), minlength=books.cells), books.cell(sample)
    take = min(n, TUNING_QUERIES)
    ranks = []
    for i in range(take):
        s = sample @ sample[i]
        s[i] = -np.inf
        top = np.argsort(-s, kind="stable")[: min(k, n - 1)]
        order = np.array(books.walk(sample[i], counts, np.inf), np.int64)
        seen = np.zeros(books.cells)
        seen[order] = np.cumsum(counts[order])
        ranks.append(seen[cell[top]])
    ranks = np.concatenate(ranks) if ranks else np.zeros(0)
    return float(np.quantile(ranks, TARGET) / n) if ranks.size else 1.0


def usable(vectors: DataFrame) -> DataFrame:
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        "vec_id is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)"
    )
    size = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    ok = ok.where(F.size("v") == (size["n"] if size else 0))
    if ok.groupBy("vec_id").count().where("count > 1").limit(1).count():
        ok = ok.groupBy("vec_id").agg(F.min("v").alias("v"))
    return ok


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """The k nearest of every row whose vec_id is divisible by `every`: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    ok = usable(vectors)
    n = ok.count()
    if not n:
        return spark.createDataFrame([], out)
    sample = ok.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample = np.array(sample.column("v").combine_chunks().flatten()).reshape(sample.num_rows, -1)
    sample = sample[np.sort(np.unique(sample, axis=0, return_index=True)[1])]
    books = Codebooks(sample, int(np.clip(round(4 * n**0.25), 4, 256)))
    enough = max(k + 1, _share(books, sample, k) * n)
    sent = spark.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            x = np.array(v.flatten()).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.cell(x).astype(np.int32)) if b.num_rows else pa.array([], pa.int32()), v], names=["vec_id", "cell", "v"])

    first = F.row_number().over(Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id"))
    entries = ok.withColumn("nth", first).where(F.col("nth") <= k + 1).select("vec_id", "v").mapInArrow(tidy(coded), "vec_id long, cell int, v array<double>")
    counts = np.zeros(books.cells, np.int64)
    for r in entries.groupBy("cell").count().collect():  # at most 256 * 256 cells
        counts[r["cell"]] = r["count"]
    # Neighbouring cells fill a block; a large cell has blocks of its own.
    block, parts, at, room = np.zeros(books.cells, np.int64), np.ones(books.cells, np.int64), 0, BLOCK_ROWS
    for c in np.flatnonzero(counts).tolist():
        if counts[c] > BLOCK_ROWS:
            at, parts[c] = at + 1, -(-counts[c] // BLOCK_ROWS)
            block[c], at, room = at, at + int(parts[c]), BLOCK_ROWS
        else:
            if counts[c] > room:
                at, room = at + 1, BLOCK_ROWS
            block[c], room = at, room - int(counts[c])
    plan = spark.sparkContext.broadcast((counts, block, parts, float(min(enough, counts.sum()))))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, block, parts, _ = plan.value
        for b in batches:
            c = np.asarray(b.column(1)).astype(np.int64)
            to = block[c] + np.asarray(b.column(0)) % parts[c]
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.zeros(len(c), np.int32)), b.column(0), pa.array([[x] for x in c.tolist()], pa.list_(pa.int32())), b.column(2)], names=names)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, (counts, block, parts, enough) = sent.value, plan.value

        def asked(b: pa.RecordBatch, to: list[int], row: list[int], cells: list[list[int]]) -> pa.RecordBatch:
            pick = pa.array(row, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([1] * len(to), pa.int32()), b.column(0).take(pick), pa.array(cells, pa.list_(pa.int32())), b.column(1).take(pick)], names=names)

        for b in batches:
            x = np.array(b.column(1).flatten()).reshape(b.num_rows, -1)
            to, row, cells = [], [], []
            for i in range(b.num_rows):
                by: dict[int, list[int]] = {}
                for c in books.walk(x[i], counts, enough):
                    for p in range(int(parts[c])):
                        by.setdefault(int(block[c]) + p, []).append(c)
                if to and len(to) + len(by) > PROBE_ROWS:
                    yield asked(b, to, row, cells)
                    to, row, cells = [], [], []
                to += by
                row += [i] * len(by)
                cells += by.values()
            if to:
                yield asked(b, to, row, cells)

    names, kind = ["block", "kind", "id", "cells", "v"], "block long, kind int, id long, cells array<int>, v array<double>"
    asked = ok.where(F.col("vec_id") % every == 0).select("vec_id", "v")
    both = entries.mapInArrow(tidy(dealt), kind).unionByName(asked.mapInArrow(tidy(probes), kind))
    near = both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(tidy(_rerank(k)), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _rerank(k: int):
    """Streams (block, kind)-sorted rows: keeps the entries of one block, answers its probes batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, cells, vecs, ready = None, [], [], [], None
        for b in batches:
            blocks, kinds = np.asarray(b.column(0)), np.asarray(b.column(1))
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if s == e:
                    continue
                part = b.slice(s, e - s)
                if blocks[s] != now:
                    now, ids, cells, vecs, ready = blocks[s], [], [], [], None
                x = np.array(part.column(4).flatten()).reshape(e - s, -1)
                if kinds[s] == 0:
                    ids.append(np.asarray(part.column(2)))
                    cells.append(np.asarray(part.column(3).flatten()))
                    vecs.append(x)
                    continue
                if not ids:
                    continue
                if ready is None:
                    c = np.concatenate(cells)
                    o = np.argsort(c, kind="stable")
                    ready = np.concatenate(ids)[o], np.concatenate(vecs)[o], *np.unique(c[o], return_index=True)
                yield from _answers(k, ready, np.asarray(part.column(2)), part.column(3).to_pylist(), x)

    return run


def _answers(k: int, ready, qids: np.ndarray, probed: list[list[int]], q: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, m, cell, start = ready
    longest = np.sqrt((m * m).sum(1).max())
    end = np.append(start[1:], len(ids))
    for lo in range(0, len(qids), 256):
        qs, ps, qq = qids[lo:lo + 256], probed[lo:lo + 256], q[lo:lo + 256]
        s = np.full((len(qs), len(ids)), -np.inf)
        want: dict[int, list[int]] = {}
        for i, p in enumerate(ps):
            for c in p:
                want.setdefault(c, []).append(i)
        for a, b, c in zip(start.tolist(), end.tolist(), cell.tolist()):
            if w := want.get(c):
                s[w, a:b] = qq[w] @ m[a:b].T
        s[qs[:, None] == ids[None, :]] = -np.inf
        qo, vo, so = [], [], []
        for i in range(len(qs)):
            row = s[i]
            least = np.partition(row, -k)[-k] if len(row) > k else -np.inf
            # Products of matrices and sums round otherwise: what may tie with the k-th is summed too.
            slack = 1e-13 * m.shape[1] * longest * np.sqrt(qq[i] @ qq[i])
            r = np.flatnonzero((row > -np.inf) & (row >= least - slack))
            exact = (m[r] * qq[i]).sum(axis=1)  # the same sum for equal vectors, wherever they lie
            best = r[o] if (o := np.lexsort((ids[r], -exact))[:k]).size else r[:0]
            qo += [int(qs[i])] * len(best)
            vo += ids[best].tolist()
            so += exact[o].tolist()
        yield pa.RecordBatch.from_arrays([pa.array(qo, pa.int64()), pa.array(vo, pa.int64()), pa.array(so, pa.float64())], names=["query_id", "vec_id", "score"])
