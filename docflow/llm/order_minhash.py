"""Near-duplicate groups by Order MinHash, verified by banded alignment.

The k-mers are word 5-shingles, each labelled with its occurrence number in the text. For each of
SKETCHES hash orders the PICKED k-mers of least hash are taken and kept in text order: two texts
share that entry only if they share the k-mers and their order, which follows edit similarity.
Scattered edits leave few 5-shingles in common, so MORE adds sketches of one shorter shingle each;
what they share is searched only behind the bound by words.
Texts that share an entry are candidates: each is compared with a pivot of its entry first. Entries that still hold several classes are then split by length, so that a pivot meets only
texts it could be linked with, and each part gets PIVOTS further pivots. What still holds several
classes then is searched whole: every pair of different classes whose lengths and words (see
could_link) don't rule a link out is aligned, first the most alike one of any two classes, then all
that are still of different classes. So each pair that shares an entry is aligned, ruled out, or of
one class. An entry over-full of short texts, as a common phrase makes, is split by words first (see tokened), which loses no
pair. A pair is linked if banded alignment of its words finds an edit distance of at most
(1 - SIMILARITY) of the longer text. Links make classes by connected components.

Equal texts are merged before (by a 128-bit hash, pre-aggregated), so copies cost nothing more.

Defined cases: texts without a word (null, empty, white space) are each a class of their own; a
text of fewer than five words is one k-mer; repeated rows are copies; null or repeated doc_ids
share the class of their text, and the class id is the least doc_id in the class (null if it has
none); an empty table gives no rows; other columns are ignored; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import WORD_HASH, symbols
from .common import U64, bounded_batches, id_filter, in_rows, mix, pieces, text_blocks, tidy, written
from .components import components

SHINGLE, SIMILARITY, SKETCHES, PICKED = 5, 0.8, 10, 2
#: Further sketches of one k-mer: (words of a k-mer, sketches, words of a text at most). Shares of k-mers that scattered edits
#: leave at 0.8: about 0.34 of 3-shingles; all of a short text's may go, but at least a third of its 2-shingles stay.
MORE = ((3, 13, None), (2, 16, 20))
ALL_SKETCHES = SKETCHES + sum(m[1] for m in MORE)
#: Orders by which an entry's pivot is chosen: each entry uses one, so a text meets different pivots.
ORDERS = 4
#: Pivots of each length class of an entry that holds several classes after the first turn.
PIVOTS = 4
#: Rows of a part of an entry that are compared with each other or with as many others in one place; larger parts are cut.
CELL = 4096
#: Rows of an over-full entry whose words are counted, and the share of them that has a common word.
COMMON_SAMPLE, COMMON = 400, 0.02
#: A word is dealt to the cells as a mark of 16 bits, of 32 in texts of more words than WIDE: two different words of one mark hide a
#: difference. Texts are first compared by sets of bits made of the marks, at least WORD_BITS bits a word.
WIDE, WORD_BITS = 2048, 8
#: Bits of the texts of a cell that are unpacked at a time, and the most texts then.
UNPACKED, STEP = 1 << 23, 512
MOST = U64(0xFFFFFFFFFFFFFFFF)


def word_marks(sym: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The words of each text, labelled by occurrence number, as sorted marks."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    h = mix(sym + nth_of(sym, row).astype(U64) * U64(0xC2B2AE3D27D4EB4F)).astype(np.uint32)
    return [np.sort(h[i:j] if j - i > WIDE else h[i:j].astype(np.uint16)).tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


def marks_of(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.uint16 if len(x) <= 2 * WIDE else np.uint32)


def nth_of(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Occurrence numbers of equal values of a row."""
    g = h ^ mix(row.astype(U64) + U64(1))
    o = np.argsort(g, kind="stable")
    new = np.concatenate([[True], g[o][1:] != g[o][:-1]])[: len(h)]
    nth = np.empty(len(h), np.int64)
    nth[o] = np.arange(len(h)) - np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return nth


def sketch_block(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """[text, sketch] entries, 0 where a text has no word; and the number of words and the marks of each text."""
    sym, at = symbols("word", raw, off)
    n = np.diff(at)
    out = np.zeros((len(n), ALL_SKETCHES), U64)
    pre, s = WORD_HASH.prefixes(sym), 0
    for size, sketches, picked, most in [(SHINGLE, SKETCHES, PICKED, None), *((size, sketches, 1, most) for size, sketches, most in MORE)]:
        full = np.maximum(n - size + 1, np.minimum(n, 1))  # k-mers of a text
        has = np.flatnonzero(full if most is None else (full > 0) & (n <= most))
        if has.size:
            _entries(pre, at, has, full[has], size, range(s, s + sketches), picked, out)
        s += sketches
    return out, n, word_marks(sym, at)


def _entries(pre: np.ndarray, at: np.ndarray, has: np.ndarray, m: np.ndarray, size: int, numbers: range, picked: int, out: np.ndarray) -> None:
    """Fills the columns numbers of out for the texts has, which have m k-mers of size words each."""
    first = np.concatenate([[0], np.cumsum(m)[:-1]])
    row = np.repeat(np.arange(len(has)), m)
    start = np.arange(int(m.sum())) - first[row] + at[:-1][has][row]
    end = np.minimum(start + size, at[1:][has][row])
    h = WORD_HASH.ranges(pre, start, end)
    h = mix(h + nth_of(h, row).astype(U64) * U64(0xC2B2AE3D27D4EB4F))
    for s in numbers:
        v = (h ^ U64(0x9E3779B97F4A7C15 * (s + 1) & 0xFFFFFFFFFFFFFFFF)) * U64(0xD6E8FEB86659FD93)
        v ^= v >> U64(32)
        places = []
        for _ in range(picked):
            least = np.minimum.reduceat(v, first)
            hit = np.flatnonzero(v == least[row])
            r = row[hit]
            p = np.full(len(has), -1)
            p[r[::-1]] = hit[::-1]  # the first of equals
            p[least == MOST] = -1
            places.append(p)
            v[hit] = MOST
        p = np.sort(np.stack(places), axis=0)  # text order
        entry = np.full(len(has), s + 1, U64)
        for q in p:
            entry = mix(entry * U64(0x9E3779B97F4A7C15) + np.where(q >= 0, h[np.maximum(q, 0)], U64(7)))
        out[has, s] = entry


@tidy
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 3):
        for i, j, raw, off in text_blocks(b.column(3)):
            e, n, marks = sketch_block(raw, off)
            part, e = b.slice(i, j - i), e.view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(e.ravel()), ALL_SKETCHES).cast(pa.list_(pa.int64())), pa.array(marks, pa.binary())], names=["h1", "h2", "node", "n", "entries", "marks"])


def banded_distance(x: list, y: list, most: int) -> int:
    """Edit distance of two sequences, or most + 1 if greater: bit-parallel, in a diagonal band of half-width `most`."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > most:
        return most + 1
    i = 0
    while i < len(y) and x[i] == y[i]:
        i += 1
    j = 0
    while j < len(y) - i and x[-1 - j] == y[-1 - j]:
        j += 1
    x, y = x[i:len(x) - j], y[i:len(y) - j]
    n, m = len(x), len(y)
    if not m:
        return n if n <= most else most + 1
    most_here = min(most, n)
    # Bit b of the band at row r stands for place r + most_here + 1 - width + b of x.
    width = 2 * most_here + 2
    full = (1 << width) - 1
    where: dict = {}
    for p, s in enumerate(x):
        where[s] = where.get(s, 0) | 1 << p
    vp, vn, dist = full & ~((1 << (width - most_here - 1)) - 1), 0, most_here
    top, low = 1 << (width - 1), width - 2
    at = most_here + 1 - width
    last = most_here + m - (n - most_here)
    for r in range(m):
        bits = where.get(y[r], 0)
        z = ((bits >> at) if at >= 0 else (bits << -at)) & full
        d0 = ((((z & vp) + vp) ^ vp) | z | vn) & full
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if r < n - most_here:
            if not d0 & top:
                dist += 1
        else:
            dist += (hp >> low & 1) - (hn >> low & 1)
            low -= 1
        if dist > last:
            return most + 1
        d0 >>= 1
        vp = hn | (full & ~(d0 | hp))
        vn = d0 & hp
        at += 1
    return dist if dist <= most else most + 1


def similar(x: str, y: str, similarity: float = SIMILARITY) -> bool:
    a, b = x.encode().split(), y.encode().split()
    longest = max(len(a), len(b))
    if not longest:
        return False
    most = int((1 - similarity) * longest + 1e-9)
    return banded_distance(a, b, most) <= most


@tidy
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, 2):
        keep = [similar(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def near_in_length(n: Column, m: Column) -> Column:
    """Whether texts of n and m words can be similar: their edit distance is at least the difference."""
    most = F.greatest(n, m)
    return most - F.least(n, m) <= F.floor((1 - SIMILARITY) * most + 1e-9)


def lengths(n: str) -> Column:
    """Two length classes of a text of n words; texts that can be similar have one in common."""
    at = F.floor(F.log(n) / float(-np.log(SIMILARITY) * (1 + 1e-9))).cast("int")
    return F.array(at, at + 1)


def allowed(n: np.ndarray) -> np.ndarray:
    """The greatest edit distance of similar texts, of which the longer has n words."""
    return np.floor((1 - SIMILARITY) * n + 1e-9)


def could_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether texts of n and m words with bits x and y (a row each) can be similar, and how many bits one lacks of the other.

    An edit changes one labelled word, so no text lacks more bits of the other than the edit distance. Never false for a link.
    """
    both = x @ y.T
    lack = np.maximum(x.sum(1)[:, None], y.sum(1)[None, :]) - both
    longest = np.maximum(n[:, None], m[None, :])
    most = allowed(longest)
    return (lack <= most) & (longest - np.minimum(n[:, None], m[None, :]) <= most), lack


def _bit_rows(marks: list[bytes], size: int) -> np.ndarray:
    """Sets of size bytes made of marks, as rows of zeros and ones."""
    out = np.zeros((len(marks), 8 * size), np.float32)
    for i, x in enumerate(marks):
        out[i, marks_of(x) % (8 * size)] = 1
    return out


def _counted(x: bytes, wide: bool) -> np.ndarray:
    """Sorted marks, each with the number of equal ones before it; wide ones are cut to 16 bits unless asked for."""
    m = marks_of(x)
    m = m.astype(np.int64) if wide or m.itemsize == 2 else np.sort(m.astype(np.uint16)).astype(np.int64)
    return m << 32 | (np.arange(len(m)) - np.searchsorted(m, m))


def lacks(x: np.ndarray, y: np.ndarray) -> int:
    """How many counted marks one text lacks of the other: never more than their edit distance, as no edit changes two labelled words."""
    at = np.searchsorted(y, x)
    return max(len(x), len(y)) - int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))


CELL_KEY = ["s", "entry", "token", "i", "j"]
CELL_ROW = [*CELL_KEY, "own", "node", "label", "n", "marks", "before"]


@tidy
def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell to the pairs of different labels that could link; whole cells at a time."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        cross = rows[0][3] != rows[0][4]
        rows.sort(key=lambda r: r[8])  # by words: texts of like size together, so that little is folded and lengths rule out whole runs
        own, node, label, n = (np.array([r[c] for r in rows], np.int64) for c in range(5, 9))
        longest = np.floor(n / SIMILARITY * (1 + 1e-9)) + 1  # of a text that can be similar to one of n words
        sizes = 1 << np.ceil(np.log2(np.maximum(WORD_BITS * n, 64))).astype(np.int64) - 3  # bytes of a text's set
        before = np.zeros((len(rows), max(len(r[10]) for r in rows)), np.int64)
        for i, r in enumerate(rows):
            before[i, :len(r[10])] = r[10]
        a = 0
        while a < len(rows):
            # The sets of u are of the size of its own texts, not of shorter ones: in small sets all texts look alike.
            size, wide = int(sizes[a]), bool(n[a] > WIDE)
            step = max(1, min(STEP, UNPACKED // (8 * size)))
            u = slice(a, min(a + step, int(np.searchsorted(sizes, size, "right"))))
            x, counted, end = None, {}, int(np.searchsorted(n, longest[u][-1], "right"))
            for b in range(a, end, step):
                v = slice(b, min(b + step, end))
                ok = (label[u][:, None] != label[v][None, :]) & (longest[u][:, None] >= n[v][None, :])
                if cross:
                    ok &= own[u][:, None] != own[v][None, :]
                if a == b:
                    ok = np.triu(ok, 1)
                if not ok.any():
                    continue
                x = _bit_rows([r[9] for r in rows[u]], size) if x is None else x
                near, _ = could_link(x, _bit_rows([r[9] for r in rows[v]], size), n[u], n[v])
                p, q = np.nonzero(ok & near)
                # A pair that shares an entry of a sketch before this one is found there: that entry holds both, so it is mixed.
                one, two = before[u][p], before[v][q]
                new = np.ones(p.size, bool)
                for c in range(before.shape[1]):
                    new &= ~((one[:, c:c + 1] == two) & (two != 0)).any(1)
                # What the sets let pass is compared mark by mark.
                p, q = p[new] + a, q[new] + b
                others = {i: _counted(rows[i][9], wide) for i in np.unique(q).tolist()}
                for i in np.setdiff1d(p, list(counted)).tolist():
                    counted[i] = _counted(rows[i][9], wide)
                lack = np.array([lacks(counted[i], others[j]) for i, j in zip(p.tolist(), q.tolist())], np.int64)
                near = lack <= allowed(np.maximum(n[p], n[q]))
                p, q, lack = p[near], q[near], lack[near]
                if p.size:
                    one, two = node[p], node[q]
                    yield from in_rows(pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(lack)], names=["a", "b", "lack"]))
            a = u.stop

    held: list[tuple] = []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][:5] != r[:5]:
                yield from solve(held)
                held = []
            held.append(r)
    if held:
        yield from solve(held)


@tidy
def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, text to node and the hashes of its words, labelled by occurrence number."""
    for b in pieces(batches, 1):
        for i, j, raw, off in text_blocks(b.column(1)):
            sym, at = symbols("word", raw, off)
            row = np.repeat(np.arange(j - i), np.diff(at))
            h = mix(sym + nth_of(sym, row).astype(U64) * U64(0xC2B2AE3D27D4EB4F)).view(np.int64)
            yield from in_rows(pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h))], names=["node", "tokens"]))


def tokened(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (s, entry, rows, node, label, n) of over-full entries once for each of their rarest words: texts that can be similar share one.

    Texts of n and m words within an edit distance of k lack at most k words of each other, so if words are put in any one order, the
    first k + 1 of both have one in common; k is a quarter of n at most. The order puts the words last that many texts of the entry
    have, as a sample of about COMMON_SAMPLE of them says: how good the sample is decides the work, not what is found.
    """
    key = ["s", "entry"]
    tokens = written(texts.join(crowd.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(_tokens, "node long, tokens array<long>"), "tokens")
    some = crowd.where(F.pmod(F.xxhash64("node", F.lit(5)), F.ceil(F.col("rows") / COMMON_SAMPLE)) == 0)
    seen = some.select(*key, "rows", "node").join(tokens, "node").select(*key, "rows", F.explode("tokens").alias("token")).groupBy(*key, "rows", "token").agg(F.count("*").alias("c"))
    common = seen.where(F.col("c") > 2 + COMMON * F.least("rows", F.lit(COMMON_SAMPLE))).groupBy(*key).agg(F.collect_set("token").alias("common"))
    at = crowd.join(tokens, "node").join(F.broadcast(written(common, "common")), key, "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    order = F.concat(F.array_sort(F.array_except("tokens", "common")), F.array_sort(F.array_intersect("tokens", "common")))
    return at.select(*key, "node", "label", "n", F.explode(F.slice(order, F.lit(1), F.floor(F.col("n") * ((1 - SIMILARITY) / SIMILARITY) + 1e-6).cast("int") + 1)).alias("token"))


def searched(mixed: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b, lack) of mixed (s, entry, node, n, label) that share an entry, have different labels and could link.

    Entries of more than CELL rows, if they have more blocks than their texts have first words, are split by words.
    """
    key, rows = ["s", "entry"], F.count("*").alias("rows")
    classes = [F.min("label").alias("lo"), F.max("label").alias("hi")]
    full = mixed.groupBy(*key).agg(rows, F.avg("n").alias("words"), *classes).where("lo < hi")
    full = written(full.where(F.col("rows") / CELL > F.greatest(F.lit(1.0), F.col("words") * ((1 - SIMILARITY) / SIMILARITY) + 1)).select(*key, "rows"), "crowded")
    at = mixed.select(*key, "node", "label", "n", F.lit(0).cast("long").alias("token"))
    if full.limit(1).count():
        at = at.join(full, key, "left_anti").unionByName(written(tokened(mixed.select(*key, "node", "label", "n").join(full, key), texts), "tokened"))
    key = [*key, "token"]
    parts = at.groupBy(*key).agg(rows, *classes).where("lo < hi").select(*key, F.ceil(F.col("rows") / CELL).cast("int").alias("blocks"))
    at = at.join(parts, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    at = at.select(*key, "node", "label", "n", "own", other).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    # Of a text's earlier entries only mixed ones are needed.
    own = mixed.groupBy("node").agg(F.collect_list(F.struct("s", "entry")).alias("mixed"))
    before = F.transform(F.filter("mixed", lambda x: x["s"] < F.col("s")), lambda x: x["entry"]).alias("before")
    cells = at.join(nodes.select("node", "marks").join(own, "node"), "node").select(*CELL_ROW[:-1], before)
    pairs = cells.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY).mapInArrow(_search, "a long, b long, lack long")
    return pairs.groupBy("a", "b").agg(F.min("lack").alias("lack"))


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """pairs whose texts are of different classes, with the labels la and lb."""
    for x in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}")), x, "left").withColumn(f"l{x}", F.coalesce(f"l{x}", x))
    return pairs.where("la <> lb")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The linked pairs (a, b) among pairs (a written table); texts (node, text) has every node once.

    Texts of no pair are kept out of the shuffle by a filter of ids.
    """
    some = texts.where(id_filter(pairs.select(F.explode(F.array("a", "b")).alias("id")))(F.col("node")))

    def asked(x: str) -> DataFrame:
        return some.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))

    two = pairs.join(asked("a"), "a").join(asked("b"), "b")
    return two.select("a", "b", "ta", "tb").mapInArrow(_verify, "a long, b long")


def _pairs(at: DataFrame, key: list[str], orders: list[Column]) -> DataFrame:
    """The pairs (a, b) of each row of at with the pivots of its key, one of each order, if labels and lengths allow a new link."""
    told = ["label"] if "label" in at.columns else []
    firsts = [F.min(F.struct(o.alias("o"), F.col("node").alias("pivot"), F.col("n").alias("pn"), *(F.col(x).alias("pl") for x in told))) for o in orders]
    pivots = written(at.groupBy(*key).agg(F.array_distinct(F.array(*firsts)).alias("p"), F.count("*").alias("rows")).where("rows > 1").select(*key, "p"), "pivots")

    def may_link(p: Column) -> Column:
        other = (p["pivot"] != F.col("node")) & near_in_length(F.col("n"), p["pn"])
        return other & (p["pl"] != F.col("label")) if told else other

    pairs = held(at, pivots, key).join(pivots, key).select("node", F.explode(F.filter("p", may_link)).alias("p")).select("node", "p.pivot")
    return pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def held(rows: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """rows without most of those whose key other (a written table) lacks, so that these aren't shuffled for the join that drops them."""
    return rows.where(id_filter(other.select(F.xxhash64(*key).alias("h")))(F.xxhash64(*key)))


def entries_of(nodes: DataFrame, sketches: int = ALL_SKETCHES) -> DataFrame:
    """The columns of nodes with s and entry of the first sketches."""
    own = [c for c in nodes.columns if c not in ("entries", "marks", "h1", "h2")]
    return nodes.select(*own, F.posexplode(F.slice("entries", 1, sketches)).alias("s", "entry")).where("entry <> 0")


def _mixed(nodes: DataFrame, labels: DataFrame, key: list[str], sketches: int = ALL_SKETCHES) -> DataFrame:
    """The rows of entries that hold several classes, with label."""
    named = nodes.select("node", "n", "entries").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    at = entries_of(named, sketches)
    mixed = written(at.groupBy(*key).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select(*key), "mixed-entries")
    return held(at, mixed, key).join(mixed, key)


def _linked(pairs: DataFrame, texts: DataFrame, links: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """links with those found among pairs, and the labels they make."""
    new = written(verified(pairs, texts), "links")
    if not new.limit(1).count():
        return links, labels
    links = links.unionByName(new)
    return links, written(components(links), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and kept (one row of each class) of every row of docs."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = base.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("text", F.lit(1))})
    worded = base.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    # A text's node is its least doc_id; texts without one have a negative number from their hash.
    lost = -2 - F.abs(F.shiftright("h1", 1))
    sole = _sole(docs)
    own = F.col("doc_id") if sole else lost
    nodes = worded.select("h1", "h2", own.alias("node"), "text").mapInArrow(_sketch, "h1 long, h2 long, node long, n long, entries array<long>, marks binary")
    nodes = written(nodes.groupBy("h1", "h2").agg(F.min("node").alias("node"), F.first("n").alias("n"), F.first("entries").alias("entries"), F.first("marks").alias("marks")), "nodes")
    texts = worded.select(own.alias("node"), "text")
    if not sole:
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    key = ["s", "entry"]
    tested = written(_pairs(entries_of(nodes.select("node", "n", "entries"), SKETCHES), key, [F.xxhash64("node", F.pmod("s", F.lit(ORDERS)))]), "pairs")
    links = written(verified(tested, texts), "links")
    labels = written(components(links), "labels")
    # Entries that still hold several classes; written, so that the pivots of a hot one are found by partial aggregation.
    mixed = written(_mixed(nodes, labels, key, SKETCHES).withColumn("length", F.explode(lengths("n"))), "mixed")
    orders = [F.xxhash64("node", F.pmod("s", F.lit(ORDERS)), F.lit(k)) for k in range(1, PIVOTS + 1)]
    more = written(_pairs(mixed, [*key, "length"], orders).join(tested, ["a", "b"], "left_anti"), "pairs")
    links, labels = _linked(more, texts, links, labels)
    tested = tested.unionByName(more)
    # The rest, whole: of any two classes the most alike pair, then all pairs that are still of different classes.
    rest = written(searched(written(_mixed(nodes, labels, key), "mixed"), nodes, texts).join(tested, ["a", "b"], "left_anti"), "pairs")
    now = labelled(rest, labels).groupBy(F.least("la", "lb"), F.greatest("la", "lb")).agg(F.min_by(F.struct("a", "b"), "lack").alias("p"))
    now = written(now.select("p.a", "p.b"), "pairs")
    links, labels = _linked(now, texts, links, labels)
    last = written(labelled(rest.join(now, ["a", "b"], "left_anti"), labels).select("a", "b"), "pairs")
    links, labels = _linked(last, texts, links, labels)
    members = base.select("doc_id", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left").join(labels, "node", "left")
    members = members.select("doc_id", F.coalesce("label", "node").alias("label"), "h1")
    if sole:
        return members.select("doc_id", F.coalesce("label", "doc_id").alias("class_id"), (F.coalesce("label", "doc_id") == F.col("doc_id")).alias("kept"))
    ids = members.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = members.join(ids, "label", "left").select("doc_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"), "label")
    kept = F.col("label").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))
    return out.select("doc_id", "class_id", kept.alias("kept"))


def _sole(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own."""
    n = docs.select("doc_id").where("doc_id is null").limit(1).count()
    return not n and docs.groupBy("doc_id").count().where("count > 1").limit(1).count() == 0


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: the one of least doc_id (text and id alike, any one)."""
    if _sole(docs):
        gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone"))
        return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    # Ids don't tell rows apart: equal rows first become one, then each text stands for its least id.
    names = docs.columns
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    rows = rows.withColumn("h", F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))
    word = F.coalesce(text.cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    once = rows.where(word).withColumn("id", doc_id).dropDuplicates(["id", "h"])
    least = once.groupBy("h").agg(F.min("id").alias("least"))
    texts = once.join(least, "h").where(F.col("id").eqNullSafe(F.col("least"))).withColumn("n", F.shiftright("h", 1))
    classes = near_duplicates(texts.select(F.col("n").alias("doc_id"), text.alias("text"))).where("kept").select(F.col("doc_id").alias("n"))
    return texts.join(classes, "n", "left_semi").select(own).unionByName(rows.where(~word).select(own))
