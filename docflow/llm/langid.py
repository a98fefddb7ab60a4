"""Language identification, words first.

A word that the model knows scores by its log frequency in every language; an unseen word backs off
to its character n-grams of length LONGEST, those unseen to shorter ones, down to single letters.
The model is counted from a bounded sample of labelled rows (SAMPLE_DOCS, those with the least
hash of doc_id) and keeps the WORDS and GRAMS most frequent entries, so what is broadcast is bounded.
Words of 60 or more letters and words seen once are not kept, but their n-grams count like all others.

A word is a run of letters; numerals that Unicode counts as word characters (as ½) are left out of it.

Defined cases: a null text or one without a letter gives `und` and score 0; texts of any length are
read whole; null doc_ids count as crc32 0 (held_out false) but never teach; repeated rows are
answered one by one and teach once; without any labelled row every text is `und`; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_rows, pieces, tidy, written

SAMPLE_DOCS, WORDS, GRAMS, LONGEST = 6_000, 120_000, 60_000, 4
#: Distinct words whose scores a worker remembers.
WORDS_KEPT = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def only_letters(w: str) -> str:
    """A word of LETTERS without characters that are no letters."""
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


class WordModel:
    """Log probabilities of words and n-grams by language: a number for every entry and a row of scores for every number."""

    def __init__(self, langs: list[str], prior: np.ndarray, words: tuple[dict[str, int], np.ndarray], grams: list[tuple[dict[str, int], np.ndarray]]):
        self.langs, self.prior, self.words, self.grams = langs, prior, words, grams
        self.floor = np.full(len(langs), math.log(1e-6))

    def word(self, w: str) -> np.ndarray | None:
        """None: no letter in it."""
        w = only_letters(w)
        found = self.words[0].get(w)
        if found is not None:
            return self.words[1][found]
        return self.backoff(f"<{w}>", LONGEST) if w else None

    def backoff(self, s: str, n: int) -> np.ndarray:
        """Mean over the n-grams of s; an unseen n-gram is scored by its own shorter ones."""
        if n == 0:
            return self.floor
        numbers, rows = self.grams[n - 1]
        parts = [s[i:i + n] for i in range(max(1, len(s) - n + 1))]
        got = [rows[i] if (i := numbers.get(p)) is not None else self.backoff(p, n - 1) for p in parts]
        return sum(got) / len(got)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> WordModel:
    """Counts a model from the labelled rows of docs (doc_id, text, lang)."""
    rows = docs.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "lang", "text", F.xxhash64("text").alias("th"))
    # Chosen by ids and hashes alone: texts are read again for the sample_docs rows at most that were chosen.
    key = ["doc_id", "lang", "th"]
    chosen = rows.select(key).distinct().orderBy(F.xxhash64("doc_id"), *key).limit(sample_docs)
    rows = written(rows.join(F.broadcast(chosen), key, "left_semi").dropDuplicates(key).select("lang", "text"), "language-sample")
    count = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    langs = [r["lang"] for r in sorted(count)]
    if not langs:
        return WordModel([], np.zeros(0), ({}, np.zeros((0, 0))), [])
    at, n = {x: i for i, x in enumerate(langs)}, len(langs)
    prior = np.log(np.array([r["count"] for r in sorted(count)], float) / sum(r["count"] for r in count))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.update((at[lang], x) for w in LETTERS.findall(text.lower()) if (x := only_letters(w)))
        yield from counted(seen)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for lang, w, c in zip(*(x.to_pylist() for x in b.columns)):
                s = f"<{w}>"
                for k in range(1, LONGEST + 1):
                    for i in range(len(s) - k + 1):
                        seen[lang, s[i:i + k]] += c
        yield from counted(seen)

    def counted(seen: Counter) -> Iterator[pa.RecordBatch]:
        k = list(seen)
        yield from in_rows(pa.RecordBatch.from_arrays([pa.array([x[0] for x in k], pa.int32()), pa.array([x[1] for x in k], pa.string()), pa.array([seen[x] for x in k], pa.int64())], names=["lang", "w", "n"]))

    def most_frequent(table: DataFrame, least: int, most: int) -> dict[str, np.ndarray]:
        kept = table.where(F.col("total") >= least).orderBy(F.desc("total"), "w").limit(most).collect()
        return {r["w"]: np.array(r["by"], float) for r in kept}

    # by has the count of every language, in the order of langs; languages are numbers here, so any name will do.
    by = F.array(*(F.coalesce(F.sum(F.when(F.col("lang") == i, F.col("n"))), F.lit(0)) for i in range(n)))
    sums = (F.sum("n").alias("total"), by.alias("by"))
    every = written(rows.mapInArrow(tidy(words), "lang int, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")), "language-words")
    table = most_frequent(every.where(F.length("w") < 60).groupBy("w").agg(*sums), 2, WORDS)
    # From all words, whatever their length or count: long words seldom repeat where a script has no spaces.
    by_gram = written(every.mapInArrow(tidy(grams), "lang int, w string, n long").groupBy("w").agg(*sums), "language-grams")
    gram_counts = [most_frequent(by_gram.where(F.length("w") == k), 1, GRAMS) for k in range(1, LONGEST + 1)]

    def logs(d: dict[str, np.ndarray], most: int) -> tuple[dict[str, int], np.ndarray]:
        keys = sorted(d, key=lambda x: (-d[x].sum(), x))[:most]
        m = np.array([d[x] for x in keys]).reshape(-1, n)
        return {x: i for i, x in enumerate(keys)}, np.log((m + 0.3) / (m.sum(0) + 0.3 * (len(keys) + 1)))

    return WordModel(langs, prior, logs(table, WORDS), [logs(d, GRAMS) for d in gram_counts])


def predict(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id, lang_pred and score (the predicted language's posterior, spread by text length) of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        number: dict[str, int] = {}
        scores = np.zeros((1 << 12, len(m.langs)))
        for b in pieces(batches, 1):
            pred, conf = [], []
            for text in b.column(1).to_pylist():
                idx = []
                for w in LETTERS.findall(text.lower()) if text and m.langs else ():
                    i = number.get(w)
                    if i is None:
                        s = m.word(w)
                        if s is None:
                            i = -1
                        else:
                            i = len(number)
                            if i >= len(scores):
                                scores = np.concatenate([scores, np.zeros_like(scores)])
                            scores[i] = s
                        number[w] = i
                    if i >= 0:
                        idx.append(i)
                if not idx:
                    pred.append("und")
                    conf.append(0.0)
                    continue
                # Words of one text aren't independent: the evidence grows with the root of their number.
                s = scores[np.array(idx)].sum(0) / math.sqrt(len(idx)) + m.prior / len(idx)
                k = int(s.argmax())
                pred.append(m.langs[k])
                conf.append(float(1 / np.exp(s - s[k]).sum()))
                if len(number) > WORDS_KEPT:
                    number = {}
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(conf, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Learns from the documents that aren't held out (crc32 of doc_id modulo 4 is not 2) and predicts all."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = train(docs.where(~held), sample_docs)
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
