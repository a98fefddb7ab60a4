"""Toxicity grades by cumulative-link ordinal regression over sparse word features.

P(grade >= k) is the logistic function of x.w - t[k]: one weight vector is shared by all ordered
thresholds t[1] < t[2] < ... x has a value for every distinct word of the text, hashed to FEATURES
numbers; only words whose trend over the grades is significant have a weight. The model is fitted on the driver from a bounded sample of labelled rows (SAMPLE_DOCS,
those with the least hash of doc_id). The expected severity is the sum of P(grade >= k).

Defined cases: null and empty texts have no feature and get the intercepts' severity; null labels
don't teach; repeated rows are scored one by one; with no labelled row, or only one grade, every
severity is that grade (0 if none); whole texts are read; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, pieces, spans, tidy

SAMPLE_DOCS, FEATURES = 8_000, 1 << 21
#: Rows whose features are counted at once while the model is fitted.
CHUNK = 500
#: A feature teaches only if so many sampled documents have it.
LEAST_DOCS = 4
#: ... and if its trend over the grades reaches this chi-squared value (one degree of freedom, p = 1e-6): of a
#: vocabulary of tens of thousands next to no feature does so by chance, and noise can't outvote those that do.
TREND = 24.0
STEPS, RATE, RIDGE = 150, 0.05, 1e-3
#: The ridge shrinks probabilities, so the one from which a document is rejected is set on a third of
#: the sample that a first fit leaves out: a wrongly rejected document weighs as much as CLEAN_COST missed ones.
CLEAN_COST = 3
#: Distinct words that a task remembers.
WORDS_KEPT = 200_000
WORD = re.compile(r"[^\W\d_]+")


def grade_of(toxic: Column, quality: Column) -> Column:
    """Ordered grades from the labels table: 0 clean, 1 toxic, 2 toxic and of low quality."""
    return F.when(toxic == 0, 0).when(toxic == 1, F.when(quality == 0, 2).otherwise(1))


def number(word: str) -> int:
    return zlib.crc32(word.encode()) % FEATURES


def features(text: str | None) -> list[int]:
    return sorted({number(w) for w in set(WORD.findall(text.lower()))}) if text else []


class Ordinal:
    """Shared weights and ordered thresholds."""

    def __init__(self, grades: list[int], weights: np.ndarray, cuts: np.ndarray):
        self.grades, self.weights, self.cuts, self.reject = grades, weights, cuts, 0.5

    def at_least(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every score and every threshold."""
        return at_least(self.cuts, x)


def at_least(cuts: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(cuts[None, :] - x[:, None], -40, 40)))


def flattened(rows: list, at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of rows[at:to], one after another, and the row of each."""
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows[at:to]])
    return flat, np.repeat(np.arange(at, to), [len(r) for r in rows[at:to]])


def telling(rows: list, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features in enough rows whose linear trend against the grades, (n - 1) r**2, is significant.

    Beside each its value: features of the very same rows (as in copies of one text) share 1.
    """
    n = len(y)
    df, shift, rows_of = np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES)
    mark = np.random.default_rng(0).random(n)
    off = y - y.mean()
    for at in range(0, n, CHUNK):
        flat, row = flattened(rows, at, min(n, at + CHUNK))
        df += np.bincount(flat, minlength=FEATURES)
        shift += np.bincount(flat, off[row], minlength=FEATURES)
        rows_of += np.bincount(flat, mark[row], minlength=FEATURES)
    spread = df * (1 - df / n) * y.var() * n
    chi = np.divide((n - 1) * shift**2, spread, out=np.zeros(FEATURES), where=spread > 0)
    used = np.flatnonzero((df >= min(LEAST_DOCS, max(1, n // 50))) & (chi >= TREND))
    _, which, times = np.unique(np.round(rows_of[used], 6), return_inverse=True, return_counts=True)
    return used, 1 / times[which] if used.size else np.zeros(0)


def thresholds(q: np.ndarray) -> np.ndarray:
    """Ordered thresholds from the first one and the logarithms of the gaps that follow."""
    return np.cumsum(np.concatenate([q[:1], np.exp(q[1:])]))


def loss(p: np.ndarray, flat: np.ndarray, row: np.ndarray, val: np.ndarray, y: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of grades y with the ridge on the weights, and its gradient by p.

    p holds `size` weights, the first threshold and the logarithms of the gaps; entry i of flat, row and
    val says that the row has the feature with that value.
    """
    n, w, cuts = len(y), p[:size], thresholds(p[size:])
    s = at_least(cuts, np.bincount(row, w[flat] * val, minlength=n))
    full = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)
    d = np.concatenate([np.zeros((n, 1)), s * (1 - s), np.zeros((n, 1))], axis=1)
    i = np.arange(n)
    prob = np.maximum(full[i, y] - full[i, y + 1], 1e-9)
    by_score = -(d[i, y] - d[i, y + 1]) / prob / n
    by_cut = np.array([((y == j) * d[:, j] / prob).sum() - ((y == j - 1) * d[:, j] / prob).sum() for j in range(1, len(cuts) + 1)]) / n
    tail = np.cumsum(by_cut[::-1])[::-1]
    g = np.concatenate([np.bincount(flat, by_score[row] * val, minlength=size) + RIDGE * w, tail[:1], tail[1:] * np.exp(p[size + 1:])])
    return float(-np.log(prob).mean() + RIDGE * (w @ w) / 2), g


def fit_ordinal(rows: list, grades: list[int]) -> Ordinal:
    """Proportional-odds fit by full-batch Adam; deterministic for given rows."""
    known = sorted(set(grades))
    if len(known) < 2:
        return Ordinal(known, np.zeros(FEATURES, np.float32), np.zeros(0))
    y = np.searchsorted(known, grades)
    n, k = len(rows), len(known) - 1
    used, value = telling(rows, y)
    at = np.full(FEATURES, -1, np.int32)
    at[used] = np.arange(used.size)
    parts = []
    for i in range(0, n, CHUNK):
        flat, row = flattened(rows, i, min(n, i + CHUNK))
        keep = at[flat] >= 0
        parts.append((at[flat[keep]], row[keep]))
    flat, row = (np.concatenate(x) for x in zip(*parts))
    share = np.array([(y >= j).mean() for j in range(1, k + 1)])
    cuts = np.log((1 - share) / share)
    p = np.concatenate([np.zeros(used.size), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        _, g = loss(p, flat, row, value[flat], y, used.size)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(FEATURES, np.float32)
    weights[used] = p[: used.size] * value
    return Ordinal(known, weights, thresholds(p[used.size:]))


def fit(rows: list, grades: list[int]) -> Ordinal:
    """A fit on all rows whose rejection probability was set on held-out ones."""
    model = fit_ordinal(rows, grades)
    first = fit_ordinal([x for i, x in enumerate(rows) if i % 3], [g for i, g in enumerate(grades) if i % 3])
    if model.cuts.size and first.grades == model.grades:
        p = first.at_least(np.array([first.weights[x].sum(dtype=np.float64) for x in rows[::3]]))[:, 0]
        toxic = np.array(grades[::3]) > model.grades[0]
        o = np.argsort(-p, kind="stable")
        gain = np.cumsum(np.where(toxic[o], 1, -CLEAN_COST))
        k = int(gain.argmax())
        if gain[k] > 0:
            below = p[o[k + 1]] if k + 1 < len(o) else 0.0
            model.reject = float((p[o[k]] + below) / 2)
    return model


def train(docs: DataFrame, graded: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Ordinal:
    """Fits on the texts of docs that graded (doc_id, grade) covers."""
    some = graded.where("doc_id is not null and grade is not null").select("doc_id", F.col("grade").cast("int").alias("grade"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(x) for x in b.column(2).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "grade", "x"])

    # Repeated ids would multiply the rows: of the texts under one id and grade the least teaches, so sample_docs rows at most.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some.distinct()), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    got = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").alias("grade"), "text").mapInArrow(run, "doc_id long, grade int, x array<int>").toArrow().combine_chunks()
    ids, grades, x = (got.column(i).combine_chunks() for i in range(3))
    values, off = x.values.to_numpy(), x.offsets.to_numpy()
    rows = [values[i:j] for i, j in zip(off[:-1], off[1:])]
    marks = [zlib.crc32(r.tobytes()) for r in rows]
    order = np.lexsort((marks, grades.to_numpy(), ids.to_numpy()))
    return fit([rows[i] for i in order], grades.to_numpy()[order].tolist())


class Scorer:
    """P(grade >= k) of texts; a word is hashed once a task."""

    def __init__(self, model: Ordinal):
        self.grades, self.cuts, self.reject = model.grades, model.cuts, model.reject
        on = np.flatnonzero(model.weights)
        self.weights = dict(zip(on.tolist(), model.weights[on].astype(np.float64).tolist()))
        self.known: dict[str, int] = {}  # -1: no weight

    def sum(self, text: str | None) -> float:
        idx, known, weights = set(), self.known, self.weights
        for w in set(WORD.findall(text.lower())) if text else ():
            f = known.get(w)
            if f is None:
                f = number(w)
                f = known[w] = f if f in weights else -1
            if f >= 0:
                idx.add(f)
        if len(known) > WORDS_KEPT:
            known.clear()
        return sum(weights[i] for i in sorted(idx))

    def probabilities(self, texts: list) -> np.ndarray:
        """[text, threshold]; with no threshold, no column."""
        return at_least(self.cuts, np.array([self.sum(t) if self.cuts.size else 0.0 for t in texts]))


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, severity (expected), p_toxic, grade (most likely) and rejected of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(Scorer(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in pieces(batches, 1):
            p = m.probabilities(b.column(1).to_pylist())
            if m.cuts.size:
                steps = np.diff(m.grades)
                severity = m.grades[0] + (p * steps).sum(1)
                each = np.concatenate([1 - p[:, :1], p[:, :-1] - p[:, 1:], p[:, -1:]], axis=1)
                grade, any_ = np.array(m.grades)[each.argmax(1)], p[:, 0]
            else:
                g = m.grades[0] if m.grades else 0
                severity, grade, any_ = np.full(b.num_rows, float(g)), np.full(b.num_rows, g), np.full(b.num_rows, float(g > 0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(severity), pa.array(any_), pa.array(grade.astype(np.int32)), pa.array(any_ >= m.reject)], names=["doc_id", "severity", "p_toxic", "grade", "rejected"])
        m.known.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    graded = labels.select("doc_id", grade_of(F.col("toxic"), F.col("quality")).alias("grade"))
    return score(docs, train(docs, graded, sample_docs))


def keep_clean(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """docs without the rejected rows, all columns kept; the model scores the text beside its row, so no join is needed."""
    bounded_batches(docs.sparkSession)
    model = train(docs, labels.select("doc_id", grade_of(F.col("toxic"), F.col("quality")).alias("grade")), sample_docs)
    sent = docs.sparkSession.sparkContext.broadcast(Scorer(model))

    def rejected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for col in batches:
            if m.cuts.size:
                parts = [m.probabilities(col.slice(i, j - i).to_pylist())[:, 0] >= m.reject for i, j in spans(col)]
                yield pa.array(np.concatenate([np.zeros(0, bool), *parts]))
            else:
                yield pa.array(np.full(len(col), bool(m.grades and m.grades[0] > 0)))
        m.known.clear()

    rejected = tidy(rejected)
    udf = F.arrow_udf(rejected, "boolean", F.ArrowUDFType.SCALAR_ITER) if hasattr(F, "ArrowUDFType") else None
    if udf is None:
        from pyspark.sql.pandas.functions import ArrowUDFType

        udf = F.arrow_udf(rejected, "boolean", ArrowUDFType.SCALAR_ITER)
    return docs.where(~udf(F.col("text").cast("string")))
