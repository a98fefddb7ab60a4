"""Odd inputs for every operator, and results against plain versions."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docflow.llm import bpe, common, components, decontam, entry, euclid_lsh, importance, langid, multi_index, order_minhash, prefix_trie, repeats, sharding, substring, token_files, toxicity

D = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, th long, key string, label int, _a string, h1 int, a int, w string, hash long, node long, number int, _h int, _id int, _n int, h int, id int, least int, n int, c0 int"
EXTRA = (7, "k", 1, "x", 2, 3, "w", 4, 5, 6, 1, 2, 3, 4, 5, 6, 7, 8)
LONG = "very long text of words " * 20_000


def rows_of(texts):
    return [(i, t, "en", "s", 0, *EXTRA) for i, t in texts]


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one"), (None, "lost text here"), (None, None), (6, LONG), (7, LONG), (8, "é" * 200), (9, "é" * 200), (9, "other text"), (10, "a\x00b  c d <|endoftext|> 3 km"), (11, "!!! 123")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_of(ODD), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 1), (8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "very long text of words very long text of words"), (2, None), (3, "short")], "item_id long, text string")


JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
EACH = {
    "op1": lambda d, l, b: order_minhash.near_duplicates(d),
    "op3": lambda d, l, b: repeats.dedup(d),
    "op4": lambda d, l, b: toxicity.toxicity(d, l),
    "op5": lambda d, l, b: sharding.pack(d),
    "op7": lambda d, l, b: token_files.token_file(d, JSON),
    "op8": lambda d, l, b: langid.language_id(d),
    "op9": lambda d, l, b: substring.dedup(d),
    "op10": lambda d, l, b: bpe.encode_decode(d, RANKS, P.PATTERN),
}


@pytest.mark.parametrize("op", EACH)
def test_odd_rows(odd, labels, bench, op):
    got = EACH[op](odd, labels, bench).collect()
    assert len(got) == len(ODD)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ODD)


@pytest.mark.parametrize("op", EACH)
def test_no_rows(none, labels, bench, op):
    assert EACH[op](none, labels, bench).collect() == []


def test_odd_results(odd, labels, bench):
    near = {}
    for r in order_minhash.near_duplicates(odd).collect():
        near.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert near[5] == {4} and near[7] == {6} and near[2] == {2} and near[3] == {3}
    assert {(r["doc_id"], r["n_removed"]) for r in repeats.dedup(odd).collect() if r["doc_id"] in (7, 8)} == {(7, len(LONG)), (8, 398)}
    assert {r["n_removed"] for r in substring.dedup(odd).collect() if r["doc_id"] == 7} == {100_000}
    pred = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(odd).collect()}
    assert pred[1] == pred[2] == pred[11] == "und" and pred[4] == "en"
    held = decontam.contaminated(odd, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in held} == {(6, 1), (7, 1)}
    start = {r["doc_id"]: r for r in token_files.token_file(odd, JSON).collect() if r["doc_id"] in (1, 4)}
    assert start[1]["n_tokens"] == 1 and start[1]["ids_crc32"] == zlib.crc32(b"\0\0\0\0")


def test_stages_keep_columns(spark, odd, none, labels, bench):
    for docs in (odd, none):
        for f in (lambda d: toxicity.keep_clean(d, labels), order_minhash.keep_one, repeats.cut, lambda d: decontam.keep_clean(d, bench)):
            out = f(docs)
            assert out.columns == docs.columns and out.count() <= docs.count()
    kept = order_minhash.keep_one(odd).groupBy("text").count().where("text is not null and trim(text) <> ''").collect()
    assert all(r["count"] == 1 for r in kept)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    line = " ".join(rng.choice(vocab) for _ in range(70))
    docs = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 200))]
        if i % 3 == 0:
            w[len(w) // 2:len(w) // 2] = line.split()[rng.randint(0, 10):]
        if i % 5 == 4 and docs:
            w = docs[rng.randrange(len(docs))][1].split()
            for _ in range(rng.randint(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        if i % 11 == 10:
            w = ["ab"] * rng.randint(50, 200)
        docs.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return docs


def plain_op3(docs, size=100):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            s = b[p:p + size]
            if s in seen:
                gone[p:p + size] = b"\1" * size
            seen.add(s)
        runs = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out[i] = len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
    return out


def plain_op9(docs, size=50):
    first, out = {}, {}
    split = {i: t.encode().split() for i, t in docs}
    for i in sorted(split):
        for p in range(len(split[i]) - size + 1):
            first.setdefault(tuple(split[i][p:p + size]), i)
    for i, w in split.items():
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p:p + size])] < i:
                gone[p:p + size] = [True] * size
        out[i] = len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("most", [20_000, 2])
def test_op3_against_plain(spark, monkeypatch, seed, most):
    monkeypatch.setattr(repeats, "GROUP_MOST", most)
    docs = corpus(seed)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_op3(docs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_op9_against_plain(spark, seed):
    docs = corpus(seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_op9(docs)


def test_intervals():
    assert sorted(repeats.intervals([2, 3, 1, 0, 4], 1)) == [(1, 0, 4), (2, 0, 3), (3, 1, 3), (4, 4, 6)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 12))] for _ in range(2))
        k, d = rng.randint(0, 8), distance(a, b)
        assert order_minhash.banded_distance(a, b, k) == (d if d <= k else k + 1)


def test_op1_against_all_pairs(spark):
    rng = random.Random(5)
    docs = []
    for g in range(12):
        w = [str(rng.randint(0, 5000)) for _ in range(rng.randint(40, 160))]
        for c in range(rng.randint(1, 6)):
            x = list(w)
            for _ in range(len(x) // 40):
                x[rng.randrange(len(x))] = "new"
            docs.append((len(docs), " ".join(x)))
    label = {i: i for i, _ in docs}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in docs:
        for j, b in docs[:i]:
            x, y = a.split(), b.split()
            if distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                p, q = sorted((root(i), root(j)))
                label[q] = p
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: root(i) for i, _ in docs}


def test_components_of_no_edges(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
    loops = spark.createDataFrame([(1, 1), (None, 2), (3, None), (4, 5), (5, 4)], "a long, b long")
    assert {(r["node"], r["label"]) for r in components.components(loops).collect()} == {(4, 4), (5, 4)}


@pytest.mark.parametrize("one", [200_000, 0])
def test_components(spark, monkeypatch, one):
    monkeypatch.setattr(components, "ONE_TASK", one)
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (200, 201)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 50, 50: 50, 70: 50, 200: 200, 201: 200}


def nearest(rows, x):
    """rows of (vec_id, vector) and the operator's answers: mean share of the 20 nearest that were found."""
    ids, got, share = np.array([i for i, _ in x]), {}, []
    v = np.array([e for _, e in x], np.float32).astype(np.float64)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in ids[ids % 20 == 0]:
        s = (v * v[np.flatnonzero(ids == q)[0]]).sum(1)
        s[ids == q] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]].tolist()
        assert len(got[q]) == len(set(got[q])) == 20 and q not in got[q]
        share.append(len(set(want) & set(got[q])) / 20)
    return np.mean(share), got


def test_op2_recall_and_odd_vectors(spark):
    v = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{D}/embeddings.parquet").collect()]
    odd = [(20_000, None), (20_020, [0.0] * 64), (20_040, [float("nan")] * 64), (20_060, [1.0, None]), (None, v[0][1]), (20_080, [1.0]), (20_100, [])]
    copies = [(30_000 + i, v[3][1]) for i in range(60)]
    again = [v[0], v[0], v[1]]  # a query and a candidate that come again
    df = spark.createDataFrame([(*r, 1) for r in v + odd + copies + again], "vec_id long, embedding array<float>, block int")
    share, got = nearest(multi_index.search(df).collect(), v + copies)
    assert share >= 0.9
    assert got[30_000][:20] == [3, *range(30_001, 30_020)]
    assert multi_index.search(df.limit(0)).collect() == []
    few = multi_index.search(df.where("vec_id < 5")).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, i) for i in (1, 2, 3, 4)]


def test_op2_recall_on_more_vectors(spark):
    x = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    norms = rng.normal(size=(4000, 32)) * np.exp(rng.normal(size=(4000, 1)) / 2)
    for rows in (x, [(i, e.tolist()) for i, e in enumerate(norms)]):
        share, _ = nearest(multi_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), rows)
        assert share >= 0.9


def test_op2_walk_is_in_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 8))
    books = multi_index.Codebooks(x, 6)
    counts = np.bincount(books.cell(x), minlength=books.cells)
    q = x[0] * np.sqrt(sum(books.most) / (x[0] @ x[0]))
    one, two = ((np.append(h, 0) - c) ** 2 for h, c in ((q[:4], books.one), (q[4:], books.two)))
    order = np.argsort((one.sum(1)[:, None] + two.sum(1)).ravel(), kind="stable")
    assert books.walk(x[0], counts, np.inf) == [c for c in order.tolist() if counts[c]]
    part = books.walk(x[0], counts, 100)
    assert counts[part].sum() >= 100 > counts[part[:-1]].sum()


def test_op4_held_out(spark):
    # sf0.1: about 2,000 labelled rows to learn from. From sf0.01's 200 the model is no better than "never" (README).
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    even = labels.where("doc_id % 2 = 0")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, even).collect()}
    odd = labels.where("doc_id % 2 = 1").collect()
    assert np.mean([got[r["doc_id"]]["rejected"] == (r["toxic"] == 1) for r in odd]) > 0.9
    assert np.mean([got[r["doc_id"]]["rejected"] for r in odd if r["toxic"] == 0]) < 0.01
    assert all(0 <= r["severity"] <= 2 for r in got.values())


def test_ordinal_cuts_are_ordered():
    rng = np.random.default_rng(0)
    x = [[1] * 0 + ([1] if g else []) + ([2] if g == 2 else []) + [int(rng.integers(10, 40))] for g in (0, 1, 2) * 60]
    m = toxicity.fit_ordinal(x, [0, 1, 2] * 60)
    p = m.at_least(np.array([m.weights[[10]].sum(), m.weights[[1]].sum(), m.weights[[1, 2]].sum()]))
    assert m.cuts[0] < m.cuts[1] and (np.diff(p.sum(1)) > 0).all()


def test_op5_law(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(spark.range(50_000, 50_500).select(F.col("id").alias("doc_id"), F.lit("hot " * 100).alias("text")))
    rows = sharding.pack(docs).collect()
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    size, slots = {}, {}
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["grown_shard"] is None
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(text) and len(size) == 24 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.1 * sum(size.values()) / 24
    assert min(size.values()) > 0.9 * sum(size.values()) / 24


@pytest.mark.parametrize("sf, off", [("0.01", 0.025), ("0.1", 0.01)])
def test_op5_groups_stay_whole(spark, sf, off):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    shards, size = {}, np.zeros(24)
    for r in sharding.pack(docs).collect():
        shards.setdefault(text[r["doc_id"]], []).append(r["shard"])
        size[r["shard"]] += r["size"]
    assert max(map(len, shards.values())) < len(text) / 24 and all(len(set(s)) == 1 for s in shards.values())
    assert abs(size / size.mean() - 1).max() < off


def test_op5_place_against_plain():
    rng = np.random.default_rng(4)
    w = rng.integers(1, 50, (60, 3)).astype(float)
    got, left = sharding.place(w, 5), [[w[:, m].sum() / 5 for m in range(3)] for _ in range(5)]
    room = [x for x in left[0]]
    for i in sorted(range(60), key=lambda i: (-max(w[i, m] / room[m] for m in range(3)), i)):
        dots = [sum(w[i, m] / room[m] * left[s][m] / room[m] for m in range(3)) for s in range(5)]
        assert np.isclose(dots[got[i]], max(dots))
        for m in range(3):
            left[got[i]][m] -= w[i, m]


@pytest.mark.parametrize("few", [200_000, 0])
def test_op6_against_sql(spark, monkeypatch, few):
    """Broadcast or shuffled, the rows are those of the rules written as SQL; templates with other names and numbers among them."""
    import duckdb

    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", few)
    monkeypatch.setattr(decontam, "BROADCAST_DOCS", few)
    rng, items, docs = random.Random(6), [], []
    for i in range(12):
        items.append((i, " ".join(rng.choice(["Anna", "Ben", "Zoë", "12", "3.5 km", "the", "goes", "to", "market", "with", "apples.", "sells", "How", "many", "für", "7 euros"]) for _ in range(rng.randint(2, 30)))))
    for i in range(60):
        t = rng.choice(items)[1]
        for a, b in (("Anna", "Élodie"), ("12", "40"), ("Ben", "Max"), ("goes", "runs"), ("3.5", "4")):
            t = t.replace(a, b, rng.randint(0, 2)) if rng.random() < 0.5 else t
        docs.append((i % 50, rng.choice(["", "Intro words. ", t + " and "]) + (t.lower() if i % 7 == 0 else t) + rng.choice(["", " end"])))
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).drop("th")
    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", rows)
    rel = con.sql(entry.op6_sql())
    want = sorted(tuple(r) for r in rel.select(*got.columns).fetchall())
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_op6_reparameterised(spark):
    item = "A farmer has 12 cows and sells 5 of them at the market for 30 euros each, how much money does Anna get in total? Anna knows 12 well."
    docs = [
        (1, "Intro. " + item + " End."), (2, item.replace("12", "14").replace("Anna", "Berta").replace("euros", "dollars")), (3, item.replace("12", "14", 1).replace("knows", "knew")),
        (4, "A farmer likes cows and markets but sells none of them."), (5, " ".join(item.split()[:12]) + " other words follow here and nothing else is alike at all"),
    ]
    got = {r["doc_id"]: r["reparameterised"] for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[1] is False and got[2] is True and 4 not in got and 5 not in got
    sue = "Tom has 12 marbles. Sue has 5 marbles. Tom gives 3 marbles to Sue. How many?"
    anna = "Anna walks to the old market with Ben and buys some apples. Ben pays for them. Anna thanks Ben and walks back home alone."
    asked = [(1, sue), (2, anna)]
    told = [(1, sue.replace("Tom", "Max").replace("Sue", "Ida").replace("12", "20")), (2, "First. " + anna.replace("Anna", "Clara").replace("Ben", "Dirk")), (3, anna.replace("Anna", "Zoë").replace("Ben", "Élodie")), (4, sue.replace("Tom has", "Max has")), (5, "Tom gave his marbles away. Anna and Ben went home."), (6, sue.lower().replace("12", "9"))]
    rows = decontam.contaminated(spark.createDataFrame(told, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["reparameterised"]} >= {(1, 1), (2, 2), (3, 2), (6, 1)} and 5 not in {r["doc_id"] for r in rows}
    # Twice in one text, with other values: the alignments don't agree, so the better one counts.
    twice = decontam.contaminated(spark.createDataFrame([(1, anna + " " + anna.replace("Anna", "Clara"))], "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert [(r["item_id"], r["n_matched"] == r["n_windows"]) for r in twice] == [(2, True)]
    # One value stands for two: only the windows without a changed slot count, here most of them.
    clash = item.replace("12 cows", "14 cows").replace("knows 12", "knows 15")
    rows = decontam.contaminated(spark.createDataFrame([(1, clash)], "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r["n_matched"], r["n_windows"], r["reparameterised"]) for r in rows] == [(16, 22, False)]
    # Two people can't become one; two numbers can.
    one = [(1, sue.replace("Tom", "Max").replace("Sue", "Max")), (2, sue.replace("12", "5"))]
    rows = decontam.contaminated(spark.createDataFrame(one, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(2, 1)}


def test_op6_items_without_a_window(spark):
    """Items too short or too bare for a template are found by their exact words."""
    asked = [(1, "What is 2 plus 2?"), (2, "What is it?"), (3, "Anna Ben Carl Dora Emil Fritz Gerd Hans Ida"), (4, None), (5, " ?! "), (6, "")]
    told = [(1, "Tell me: what is 2 plus 2? Four."), (2, "what is 3 plus 3"), (3, "I ask what is it, then"), (4, "What it is"), (5, "so anna ben carl dora emil fritz gerd hans ida"), (6, "Xaver Ben Carl Dora Emil Fritz Gerd Hans Ida"), (7, ""), (8, None), (9, "?!")]
    rows = decontam.contaminated(spark.createDataFrame(told, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in rows} == {(1, 1, False), (3, 2, False), (5, 3, False), (6, 3, False)}


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 40_000, 70_001])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 60_000, n).astype("<u4")
    data, ends = token_files.pack(ids, planes)
    assert (token_files.unpack(data, ends, n, planes) == ids).all()


TEXTS = ["", "a", " a", "a ", "  a  b", "don't we'll 12,5 x\n\ny \t z", "één ça va   x", "日本語 テキスト", "\x1c \x85 z", "a <|endoftext|> b", "|| ## ''", "\n", " ", "x\n y", "é" * 300]


def test_op7_and_op10_against_the_libraries(spark, monkeypatch):
    import tiktoken
    from tokenizers import Tokenizer

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    monkeypatch.setattr(token_files, "CHUNK_IDS", 50)
    tok, start = Tokenizer.from_file(JSON), 0
    got = {r["doc_id"]: r for r in token_files.token_file(docs, JSON, planes="bit").collect()}
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in bpe.encode_decode(docs, RANKS, P.PATTERN, keep=True).collect()}
    for i, t in enumerate(TEXTS):
        assert (rows[i]["ids"], bytes(rows[i]["decoded"]).decode()) == (enc.encode_ordinary(t), t)


def test_op7_pieces_against_the_library():
    import pyarrow as pa

    rng = random.Random(0)
    parts = ["ab", "é", "ß", "x1", "9", "½", "'s", "'", "n't", ".", ",", "***", "$$", "_", "\n", "ĳ", "ǅ", "ﬁ", "中", "-", "(", ")", '"', "||", "\t", "×", "\u00a0"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 7))) for _ in range(2000)]
    texts = [" ".join(rng.sample(words, rng.randint(1, 12))) for _ in range(1500)] + TEXTS + ["a ", "\n", "a\n", "\na", "\0a", "a\0.b"]
    encoder = token_files.PieceEncoder(JSON)
    assert encoder.encode(pa.array([*texts, None])) == [*map(encoder.whole, texts), b""]


def test_op8_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.language_id(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and r["lang_pred"] != "und"]) > 0.95


def test_pipeline_stages(spark):
    """Each stage against a plain version on what the one before kept."""
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("labels", "benchmark"))
    stage = dict(corpus_pipeline.STAGES)
    rejected = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("rejected").collect()}
    one = stage["toxicity"](spark, docs, D).cache()
    assert {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in docs.collect()} - rejected and rejected
    two = stage["minhash_near_dedup"](spark, one, D).cache()
    assert {r["doc_id"] for r in two.collect()} == {r["doc_id"] for r in order_minhash.near_duplicates(one).where("kept").collect()}
    three = stage["suffix_array_dedup"](spark, two, D).cache()
    plain = plain_op3([(r["doc_id"], r["text"] or "") for r in two.collect()])
    assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in three.collect()} == {i: x[3] for i, x in plain.items()}
    four = stage["benchmark_decontamination"](spark, three, D).cache()
    items = [r["text"] for r in bench.collect()]
    held = {r["doc_id"] for r in three.collect() if any(t in r["text"] for t in items)}
    assert {r["doc_id"] for r in four.collect()} == {r["doc_id"] for r in three.collect()} - held
    assert three.columns == four.columns == docs.columns
    five = stage["bpe_encoding"](spark, four, D)
    assert {r["doc_id"]: r["decoded_sha256"] for r in five.collect()} == {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in four.collect()}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_op1_length_classes(spark):
    rows = spark.range(1, 400).select(F.col("id").alias("m")).withColumn("n", F.explode(F.expr("sequence(1, int(m))")))
    can = rows.where(order_minhash.near_in_length(F.col("n"), F.col("m")))
    assert can.where("n < m").count() and not can.where(~F.arrays_overlap(order_minhash.lengths("n"), order_minhash.lengths("m"))).count()
    assert {r["n"] for r in can.where("m = 10").collect()} == {8, 9, 10}


def test_op4_likelihood_and_gradient():
    """The loss against the product of plain probabilities, its gradient against differences."""
    rng = np.random.default_rng(3)
    y, size = rng.integers(0, 3, 40), 5
    at = [(int(f), i) for i in range(40) for f in rng.choice(size, 2, replace=False)]
    flat, row = np.array([f for f, _ in at]), np.array([i for _, i in at])
    val, p = rng.random(len(at)), rng.normal(size=size + 2)
    cuts, x = [p[5], p[5] + np.exp(p[6])], [sum(p[f] * v for (f, i), v in zip(at, val) if i == j) for j in range(40)]

    def chance(s, g):
        above = [1.0, *(1 / (1 + np.exp(c - s)) for c in cuts), 0.0]
        return above[g] - above[g + 1]

    got, g = toxicity.loss(p, flat, row, val, y, size)
    assert np.isclose(got, -np.mean([np.log(chance(s, k)) for s, k in zip(x, y)]) + toxicity.RIDGE * sum(p[:5] ** 2) / 2)
    for i in range(len(p)):
        e = np.eye(len(p))[i] * 1e-6
        assert np.isclose(g[i], (toxicity.loss(p + e, flat, row, val, y, size)[0] - toxicity.loss(p - e, flat, row, val, y, size)[0]) / 2e-6, atol=1e-6)


def test_op4_words_that_tell():
    y = np.array([0, 1] * 50)
    rows = [np.array([1, 2, 10 + i % 7] if g else [10 + i % 7, 3 + i % 4]) for i, g in enumerate(y)]
    used, value = toxicity.telling(rows, y)
    assert {1, 2} <= set(used.tolist()) and not set(range(10, 17)) & set(used.tolist())
    assert [value[list(used).index(i)] for i in (1, 2)] == [0.5, 0.5]


@pytest.mark.parametrize("cell", [4096, 64])
def test_op1_links_among_strangers_of_one_entry(spark, monkeypatch, cell):
    """Pairs of 0.8 that share nothing but a passage that all texts hold: no pivot of an entry meets both."""
    monkeypatch.setattr(order_minhash, "CELL", cell)
    passage, docs = [f"p{i}" for i in range(60)], []
    for g in range(150):
        own = [f"{g}w{i}" for i in range(40)]
        docs += [(2 * g, " ".join(passage + own)), (2 * g + 1, " ".join(passage + [w if i % 2 else "new" + w for i, w in enumerate(own)]))]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in docs}


def test_op1_word_bits_never_rule_out_a_link():
    rng, linked, out = random.Random(8), 0, 0
    for _ in range(200):
        base = [str(rng.randint(0, 60)) for _ in range(rng.randint(1, 150))]
        texts = [base]
        for share in (0.1, 0.2, 0.5):
            x = list(base)
            for _ in range(int(share * len(x))):
                p = rng.randrange(len(x))
                x[p:p + 1] = rng.choice([[], ["a"], [x[p], "b"]]) or x[p:p + 1][len(x) > 1:]
            texts.append(x)
        raw = [" ".join(x).encode() for x in texts]
        _, n, bits = order_minhash.sketch_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        rows = order_minhash._bit_rows(bits, min(map(len, bits)))
        ok, _ = order_minhash.could_link(rows, rows, n, n)
        for i, a in enumerate(raw):
            for j, b in enumerate(raw):
                link = order_minhash.similar(a.decode(), b.decode())
                linked, out = linked + link, out + (not ok[i, j])
                assert ok[i, j] or not link
    assert linked > 800 and out > 100


@pytest.mark.parametrize("words", [10, 40, 100, 300])
@pytest.mark.parametrize("similarity", [0.8, 0.82, 0.85, 0.88, 0.9])
def test_op1_scattered_edits_share_an_entry(words, similarity):
    """Distinct words, substitutions at random places: the harder side of every band."""
    rng, shared, n = random.Random(words), 0, 300
    for g in range(n):
        x = [f"{g}w{i}" for i in range(words)]
        y = list(x)
        for i in rng.sample(range(words), int((1 - similarity) * words + 1e-9)):
            y[i] += "new"
        raw = [" ".join(t).encode() for t in (x, y)]
        e = order_minhash.sketch_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))[0]
        shared += bool(((e[0] == e[1]) & (e[0] != 0)).any())
    assert shared >= 0.99 * n, shared / n


@pytest.mark.parametrize("seed, most", [(1, 20_000), (2, 20_000), (1, 2)])
def test_op3_groups_against_plain(spark, monkeypatch, seed, most):
    """Every group has all places of its string, and the groups cover all places of every window that repeats."""
    monkeypatch.setattr(repeats, "GROUP_MOST", most)
    docs = corpus(seed)
    docs += [(i + 100, docs[0][1]) for i in range(5)]
    raw, found, places = {i: t.encode() for i, t in docs}, {}, {}
    for r in repeats.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        found.setdefault((r["id"], r["length"]), set()).add((r["doc"], r["a"]))
    for i, b in raw.items():
        for p in range(len(b) - 99):
            places.setdefault(b[p:p + 100], set()).add((i, p))
    covered = set()
    for (_, n), got in found.items():
        doc, a = min(got)
        u = raw[doc][a:a + n]
        assert len(u) == n >= 100 and got == {(i, p) for i, p in places[u[:100]] if raw[i][p:p + n] == u} and len(got) > 1
        for i, p in got:
            covered |= {(i, p + k) for k in range(n - 99)}
    assert covered == {x for s in places.values() if len(s) > 1 for x in s}


def test_op8_backoff_against_plain(spark):
    rows = [(0, "the cat sat on the mat", "en"), (1, "le chat est sur le tapis", "w"), (2, "the dog sat", "en"), (3, "un chien est", "w"), (4, None, "en"), (5, "no label", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["en", "w"]
    words, grams = {"en": {}, "w": {}}, {k: {"en": {}, "w": {}} for k in range(1, 5)}
    for _, t, lang in rows[:4]:
        for x in t.split():
            words[lang][x] = words[lang].get(x, 0) + 1
            s = f"<{x}>"
            for k in grams:
                for i in range(len(s) - k + 1):
                    grams[k][lang][s[i:i + k]] = grams[k][lang].get(s[i:i + k], 0) + 1

    def log(table, x, kept, lang):
        total = sum(table[lang].get(y, 0) for y in kept)
        return np.log((table[lang].get(x, 0) + 0.3) / (total + 0.3 * (len(kept) + 1)))

    def plain(s, k, lang):
        if k == 0:
            return np.log(1e-6)
        parts = [s[i:i + k] for i in range(max(1, len(s) - k + 1))]
        kept = set(grams[k]["en"]) | set(grams[k]["w"])
        return np.mean([log(grams[k], p, kept, lang) if p in kept else plain(p, k - 1, lang) for p in parts])

    often = {x for x in set(words["en"]) | set(words["w"]) if sum(words[n].get(x, 0) for n in words) >= 2}
    for x in ("the", "est", "chats", "tapis", "zzz", "x"):
        want = [log(words, x, often, n) if x in often else plain(f"<{x}>", 4, n) for n in ("en", "w")]
        assert np.allclose(model.word(x), want)
    texts = [(1, "½ ½"), (2, "½ the ½cat"), (3, "..."), (4, "the cat le"), (5, "the cat le")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert got[1] == got[3] == ("und", 0.0) and got[2][0] == "en" and got[4] == got[5]


def test_op8_words_that_never_repeat_teach(spark):
    """Texts without spaces: every run of letters is seen once, most have 60 letters or more."""
    rng, docs = random.Random(4), []
    for i in range(80):
        first, lang = ((0x4E00, "zh"), (0x3041, "ja"))[i % 2]
        docs.append((i, "".join(chr(first + rng.randrange(60)) for _ in range(rng.randint(30, 120))), lang))
    model = langid.train(spark.createDataFrame(docs[:40], "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(spark.createDataFrame(docs[40:], "doc_id long, text string, lang string"), model).collect()}
    assert got == {i: lang for i, _, lang in docs[40:]}


def plain_importance(docs, target):
    def grams(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return len(w), [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    own, s, t = [(i, *grams(x)) for i, x in docs], Counter(), Counter()
    for _, _, g in own:
        s.update(g)
    for _, x in target:
        t.update(grams(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    rows = []
    for i, n, g in own:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in g) // len(g) if g else 0
        rows.append((i, n, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    best = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(best[: 25 * len(best) // 100], 1)}
    return sorted((i, g, w, x, rank.get(i)) for i, _, g, w, x in rows)


def test_importance_against_plain(spark):
    rng, target = random.Random(3), [(1, "aé B c d word one"), (2, None), (3, "x" * 70 + " tail x")]
    docs = corpus(11) + [(100 + i, t) for i, t in enumerate(["", None, "x" * 70, "x" * 70 + " " + "Y" * 90 + " y", "É Ａ a1b2\x00c_d", "one\tWORD one"])]
    docs += [(200 + i, "copy of one text " * 8) for i in range(40)] + [(300 + i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 80) for _ in range(50))) for i in range(20)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(target, "item_id long, text string"))
    assert sorted(tuple(r) for r in got.collect()) == plain_importance(docs, target)


def test_importance_of_nothing(spark, odd, none, bench):
    assert importance.resample(none, bench).collect() == []
    got = importance.resample(odd, bench.limit(0)).collect()
    assert len(got) == len(ODD) and {r["weight"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}


def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    whole = {c: own.get(c - int(math.fmod(c, 5)), [])[: (h := zlib.crc32(str(c).encode()) % 9)] + v[h:] for c, v in own.items()}
    members = {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += kids[k] == 0
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()
    )


def test_trie_against_plain(spark):
    rng, rows = random.Random(5), []
    for c in rng.sample(range(400), 120):
        same = rng.random() < 0.4
        for t in range(rng.choice([1, 2, 3, 8, 9, 15, 30])):
            rows.append((c, t, "user" if t % 2 else None, "the same" if same else rng.choice(["é one", "two", None, "", "three"])))
    rows += [(c, t, "user", "hi") for c in (1000, 1001, 1002, 1003, 1004, 2001, 2002) for t in range(c % 3 + 1)]
    rows += [(500, None, "a", "null turn"), (500, None, "b", "null turn"), (500, 3, "a", "x"), (500, 3, "a", "x"), (500, -1, "a", "y"), (None, 1, "a", "lost"), (-7, 0, "a", "minus"), (-5, 0, "a", "base"), (3, 1 << 40, "z", "far")]
    rows += [(700, t, "r", f"turn {t % 3}") for t in range(300)] + [(701, t, "r", f"turn {t % 3}") for t in range(290)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, size long, name string, depth int")
    assert sorted((tuple(r) for r in prefix_trie.trie(table.repartition(6)).collect()), key=str) == sorted(plain_trie(rows), key=str)


def test_trie_of_nothing(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(rows).collect() == []
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    got = prefix_trie.trie(spark.createDataFrame([(c, 0, "a", "b")], rows.schema)).collect()  # its head is that of an absent conversation
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def plain_links(rows, least=0.95):
    """n_links and component of (vec_id, vector) rows that take part."""
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], float)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        u, v = root(ids[a]), root(ids[b])
        up[max(u, v)] = min(u, v)
    return {i: (int(n), root(i), root(i) == i) for i, n in zip(ids, near.sum(1))}


def spread_vectors(seed, size=24):
    """Groups around centres, tight and wide, a chain of neighbours that link pairwise only, equal vectors and lone ones."""
    rng, out = np.random.default_rng(seed), []

    def around(c, noise, n):
        out.extend(c + noise * rng.standard_normal(size) for _ in range(n))

    for noise, n in ((0.01, 700), (0.04, 60), (0.055, 60), (0.07, 40)):
        c = rng.standard_normal(size)
        around(c / np.sqrt(c @ c), noise, n)
    a, b = np.linalg.qr(rng.standard_normal((size, 2)))[0].T
    out += [np.cos(t) * a + np.sin(t) * b for t in np.arange(0, 3, 0.2)]
    out += [out[0]] * 50 + [3 * out[1], 1e200 * out[2], 1e-200 * out[3]]
    around(np.zeros(size), 1, 400)
    return [(int(i) - 50, [float(y) for y in x]) for i, x in zip(rng.permutation(len(out)), out)]


@pytest.mark.parametrize("cells, members", [(512, 256), (2, 7)])
def test_p_stable_links_against_plain(spark, monkeypatch, cells, members):
    monkeypatch.setattr(euclid_lsh, "CELLS", cells)
    monkeypatch.setattr(euclid_lsh, "MEMBERS", members)
    rows = spread_vectors(3)
    got = euclid_lsh.near_duplicates(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, label int, size int, cell string").repartition(3))
    got, want = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got.collect()}, plain_links(rows)
    assert {i: x[1:] for i, x in got.items()} == {i: x[1:] for i, x in want.items()}
    # Hundreds of pairs lie at the threshold, where one in ten thousand may be missed; none is made up.
    assert all(got[i][0] <= want[i][0] for i in want) and sum(want[i][0] - got[i][0] for i in want) <= 2


def test_p_stable_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):  # pairs at a cosine of 0.9501
        a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.9501 * a + np.sqrt(1 - 0.9501**2) * b).tolist())]
    got = euclid_lsh.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("n_links > 0").count() >= 0.99 * 800


def test_p_stable_odd_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    good = [0.5, 0.25, -1.0, 2.0]
    rows = [(1, good), (2, good), (2, good), (3, None), (4, [0.0] * 4), (5, [1.0, None, 2.0, 3.0]), (6, [float("nan"), 1.0, 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0, 1.0]), (8, [1.0]), (None, good), (9, []), (10, [-x for x in good])]
    got = [tuple(r) for r in euclid_lsh.near_duplicates(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (None, 0, None, True), *((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10))], key=str)
    assert euclid_lsh.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in euclid_lsh.near_duplicates(spark.createDataFrame(rows[:1], schema)).collect()] == [(1, 0, 1, True)]


def test_repeated_ids_teach_once(spark, monkeypatch):
    """The sample that reaches the driver holds no more rows than it may, however often an id repeats."""
    docs = spark.createDataFrame([(i % 4, f"text {'bad ' * (i % 2)}{i}") for i in range(400)], "doc_id long, text string")
    graded = spark.createDataFrame([(i, i % 2) for i in range(4)] * 3, "doc_id long, grade int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, grades: seen.append(len(rows)) or (rows, grades))
    toxicity.train(docs, graded)
    assert seen == [4]


@pytest.mark.parametrize("rows", [1, 50])
def test_probe_batches_are_bounded(spark, monkeypatch, rows):
    """Probes cut into batches of any size give the same answers."""
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    want = sorted(tuple(r) for r in multi_index.search(table).collect())
    monkeypatch.setattr(multi_index, "PROBE_ROWS", rows)
    assert sorted(tuple(r) for r in multi_index.search(table).collect()) == want


def test_over_full_entries_lose_nothing(spark, monkeypatch):
    """Entries of a common phrase, split by words or compared whole, give the same classes."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    docs = [f"thanks for the {word()} {word()} {word()} {word()}" for _ in range(600)]
    docs += [" ".join([*t.split()[:5], word(), *t.split()[6:]]) for t in docs[:80]] + [t + " " + word() for t in docs[80:120]] + [f"{word()} thanks for the {word()}" for _ in range(100)]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    want = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(table).collect()}
    monkeypatch.setattr(order_minhash, "CELL", 40)
    seen = []
    split = order_minhash.tokened
    monkeypatch.setattr(order_minhash, "tokened", lambda *a: seen.append(1) or split(*a))
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(table).collect()}
    assert seen and got == want and len(docs) - len(set(got.values())) >= 100

def test_op1_a_short_text_does_not_blunt_the_bound():
    """Strangers of many words that share an entry with one of few words: no pair is told but the one that could link."""
    rng = np.random.default_rng(4)
    docs = [[f"s{i}" for i in range(12)]]
    docs += [[f"w{i}" for i in rng.choice(1000, 300 + 5 * g, replace=False)] for g in range(30)]
    docs.append([w if i % 10 else "new" + w for i, w in enumerate(docs[7])])
    raw = [" ".join(x).encode() for x in docs]
    _, n, bits = order_minhash.sketch_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    rows = [(20, 1, 0, 0, 0, 0, i, i, int(n[i]), bits[i], [i + 1] * 20) for i in range(len(docs))]
    cell = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=order_minhash.CELL_ROW)
    assert [(p["a"], p["b"]) for b in order_minhash._search(iter([cell])) for p in b.to_pylist()] == [(7, 31)]


def test_op1_each_pair_of_a_cell_is_told_once(monkeypatch):
    """Cells cut into any blocks, of texts of all lengths, tell every pair that can link, but for those an earlier entry tells."""
    rng, docs = random.Random(6), []
    for g in range(24):
        x = [f"{g}w{i}" for i in range(rng.randint(1, 120))]
        docs += [x, x + ["more"] * (len(x) // 8), [w for i, w in enumerate(x) if i % 9]]
    raw = [" ".join(x).encode() for x in docs]
    _, n, bits = order_minhash.sketch_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    before = [[i + 1, 900][i % 2:] if i % 4 < 2 else [] for i in range(len(docs))]
    rows = [(20, 1, 0, 0, 0, 0, i, i, int(n[i]), bits[i], before[i]) for i in range(len(docs))]
    cell = pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) if k == 10 else pa.array(c) for k, c in enumerate(zip(*rows))], names=order_minhash.CELL_ROW)
    want = {(i, j) for i in range(len(docs)) for j in range(i + 1, len(docs)) if n[i] and n[j] and order_minhash.similar(raw[i].decode(), raw[j].decode()) and not set(before[i]) & set(before[j])}
    for step in (1, 7, 512):
        monkeypatch.setattr(order_minhash, "STEP", step)
        got = [(p["a"], p["b"]) for b in order_minhash._search(iter([cell])) for p in b.to_pylist()]
        assert len(got) == len(set(got)) and want <= set(got) and not any(set(before[i]) & set(before[j]) for i, j in got)


def test_op1_marks_tell_sharers_of_a_passage_apart():
    """Texts that share hardly fewer words than a link needs make no pairs; links of texts with narrow and wide marks stay."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(560)]
    docs = [passage + [f"{g}w{i}" for i in range(190)] for g in range(40)]
    docs.append([w if i % 10 else "new" + w for i, w in enumerate(docs[3])])
    long = [f"l{i}" for i in rng.integers(0, 3000, 2000)]
    docs += [long, long + [f"m{i}" for i in range(300)], [w if i % 6 else "new" + w for i, w in enumerate(long)]]
    raw = [" ".join(x).encode() for x in docs]
    _, n, marks = order_minhash.sketch_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    rows = [(20, 1, 0, 0, 0, 0, i, i, int(n[i]), marks[i], [i + 1] * 20) for i in range(len(docs))]
    cell = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=order_minhash.CELL_ROW)
    got = {(p["a"], p["b"]): p["lack"] for b in order_minhash._search(iter([cell])) for p in b.to_pylist()}
    assert got.keys() == {(3, 40), (41, 42), (41, 43)}
    assert got[3, 40] == 75 and 290 <= got[41, 42] <= 300


@pytest.mark.parametrize("stage", [repeats.cut, order_minhash.keep_one])
def test_batches_of_long_texts_are_bounded(spark, stage):
    """What a task sends to Python at a time follows bytes, not rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        stage(spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string"))
        texts = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("some text "), 1000).alias("text"))
        sizes = [r["n"] for r in texts.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long").collect()]
        assert sum(sizes) > 40_000_000 and max(sizes) < 2 * common.PIECE_BYTES
    finally:
        spark.conf.set(key, before)
