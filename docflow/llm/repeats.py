"""Suffix-array dedup: maximal repeats from common-prefix interval trees.

Candidate suffixes are those that start at anchors held by several contexts (see anchors.py). They
are dealt by anchor, so all that share a prefix of GRAM bytes meet. There they are sorted into a
suffix array enhanced with the common-prefix lengths of neighbours; a stack scan turns it into the
tree of common-prefix intervals. In every interval the suffixes are ordered by the bytes on their
left, and a second stack scan over the common lengths to the left splits them where left extensions
differ: what comes out are the maximal repeat groups (left-diverse, right-diverse, or at the reach of
the context). For spans (repeat_spans) the occurrences with equal contexts are dealt with by hash
before, and a suffix that a longer group has taken isn't told again; groups() keeps every occurrence
of every group. Repeats longer than a context come as overlapping groups.

Anchors with more than GROUP_MOST suffixes are split first, exactly: by halves of the places that the
anchor can have in a window, then by the further bytes that all windows of a half hold. A half needs
only a part of each context, so suffixes that are equal there are merged again; what is still too
many is halved further. At one place a half is one window, so the splitting ends. See split().

Defined cases: a null text is empty; a row with a null doc_id is returned whole and takes no part;
under one doc_id different texts count in the order of their hashes; repeated rows get the same
answer; an empty table gives no rows; other columns are ignored; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import A_SCHEMA, Spec, lists_of, repeated, scan, union_of, with_lists
from .common import BATCH_ROWS, bounded_batches, id_filter, keyed, pieces, tidy, unique_ids, written

GRAM, GROUP_MOST = 24, 20_000
#: Suffixes that are sorted together.
SORT_ROWS = 20_000

R_SCHEMA = "key long, doc long, th long, a int, back binary, fore binary"
R_NAMES = ["key", "doc", "th", "a", "back", "fore"]


@tidy
def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the requested anchors: those before it, nearest first, and those from it on."""
    for b in pieces(batches, 2):
        text, docs, ths = b.column(2), b.column(0).to_pylist(), b.column(1).to_pylist()
        keys, places, reaches = (lists_of(b.column(i)) for i in (3, 4, 5))
        cols: list[list] = [[] for _ in R_NAMES]
        for i in range(b.num_rows):
            raw = text[i].as_buffer().to_pybytes()
            for k, a, lr in zip(keys[i].tolist(), places[i].tolist(), reaches[i].tolist()):
                back, fore = lr >> 16, lr & 0xFFFF
                for c, v in zip(cols, (k, docs[i], ths[i], a, raw[a - back:a][::-1], raw[a:a + fore])):
                    c.append(v)
                if len(cols[0]) >= BATCH_ROWS:
                    yield _context_batch(cols)
                    cols = [[] for _ in R_NAMES]
        if cols[0]:
            yield _context_batch(cols)


def _context_batch(cols):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=R_NAMES)


def _matrix(col: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows padded with zeros, and their lengths."""
    return np.array(col, dtype=f"S{width}").view(np.uint8).reshape(len(col), width), np.array([len(x) for x in col], np.int64)


def _common(m: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common prefix lengths of rows i and j."""
    differ = m[i] != m[j]
    most = np.minimum(n[i], n[j])
    return np.minimum(np.where(differ.any(1), differ.argmax(1), m.shape[1]), most)


def intervals(lcp: list[int], floor: int) -> Iterator[tuple[int, int, int]]:
    """The nodes (length, first, end) of the common-prefix interval tree with length >= floor, deepest first.

    lcp[i] is the common prefix of entries i and i + 1; a node's entries share `length` symbols and
    neighbours outside share fewer.
    """
    stack: list[tuple[int, int]] = []
    for i, x in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > x:
            length, left = stack.pop()
            yield length, left, i + 1
        if x >= floor and (not stack or stack[-1][0] < x):
            stack.append((x, left))


def group_repeats(back: np.ndarray, n_back: np.ndarray, fore: np.ndarray, n_fore: np.ndarray, rank: np.ndarray, least: int, gram: int, fore_lcp: np.ndarray, members: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """(bytes before the anchor, bytes from it on, occurrences, earliest) of the maximal repeats of one anchor's suffixes.

    members are in suffix-array order; rank orders occurrences by place in the corpus. Inside a node,
    a left-extension group is given with the members that no longer one has taken, and the earliest.
    """
    for length, i, j in intervals(fore_lcp.tolist(), gram):
        need = max(0, least - length)
        node = members[i:j]
        node = node[n_back[node] >= need]
        if len(node) < 2:
            continue
        width = int(n_back[node].max())
        if width == 0:
            e = int(rank[node].argmin())
            yield 0, length, node, int(node[e])
            continue
        as_text = np.ascontiguousarray(back[node][:, :width]).view(f"S{width}")[:, 0]
        node = node[np.lexsort((n_back[node], as_text))]
        left = _common(back, n_back, node[:-1], node[1:])
        taken = np.zeros(len(node), bool)
        for depth, a, b in intervals(left.tolist(), need):  # deepest first
            own = node[a:b]
            e = a + int(rank[own].argmin())
            free = ~taken[a:b]
            free[e - a] = False
            if free.any():
                yield depth, length, np.append(own[free], node[e]), int(node[e])
                taken[a:b] |= free


def _repeats(spec: Spec):
    """Rows sorted by key to the occurrences of maximal repeats; whole keys at a time."""
    width_b, width_f = spec.reach, spec.window

    def solve(cols: list[list]):
        key, doc, th, a = (np.array(c, np.int64) for c in cols[:4])
        back, n_back = _matrix(cols[4], width_b)
        fore, n_fore = _matrix(cols[5], width_f)
        rank = np.empty(len(key), np.int64)
        rank[np.lexsort((a, th, doc))] = np.arange(len(key))
        # The suffix array of the block: by anchor, then by the bytes from it on.
        sa = np.lexsort((n_fore, np.ascontiguousarray(fore).view(f"S{width_f}")[:, 0], key))
        lcp = _common(fore, n_fore, sa[:-1], sa[1:]) if len(sa) > 1 else np.zeros(0, np.int64)
        cut = np.flatnonzero(key[sa][1:] != key[sa][:-1]) + 1
        start, end = np.concatenate([[0], cut]).astype(np.int64), np.append(cut, len(sa)).astype(np.int64)
        gid, who, lo, hi, early = [], [], [], [], []
        two = start[end - start == 2]
        if two.size:  # trees of a single node, all at once
            x, y = sa[two], sa[two + 1]
            swap = rank[x] > rank[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            right, left = lcp[two], _common(back, n_back, x, y)
            hit = (right >= spec.gram) & (right + left >= spec.window)
            x, y, right, left = x[hit], y[hit], right[hit], left[hit]
            gid.append(key[x])
            who.append(y)
            lo.append(a[y] - left)
            hi.append(a[y] + right)
            early.append(x)
        for s, e in zip(start.tolist(), end.tolist()):
            if e - s > 2:
                for depth, length, own, first in group_repeats(back, n_back, fore, n_fore, rank, spec.window, spec.gram, lcp[s:e - 1], sa[s:e]):
                    own = own[own != first]
                    gid.append(key[own])
                    who.append(own)
                    lo.append(a[own] - depth)
                    hi.append(a[own] + length)
                    early.append(np.full(len(own), first))
        if not who:
            return None
        gid, who, lo, hi, early = (np.concatenate(c) for c in (gid, who, lo, hi, early))
        shift = lo - a[who]
        return pa.RecordBatch.from_arrays([
            pa.array(gid), pa.array(doc[who]), pa.array(th[who]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(doc[early]), pa.array((a[early] + shift).astype(np.int32)),
        ], names=["key", "doc", "th", "a", "b", "first_doc", "first_a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in R_NAMES]
        for b in batches:
            for c, v in zip(held, b.columns):
                c += v.to_pylist()
            if len(held[0]) >= SORT_ROWS:
                last, n = held[0][-1], len(held[0])
                while n and held[0][n - 1] == last:
                    n -= 1
                if n:
                    out = solve([c[:n] for c in held])
                    held = [c[n:] for c in held]
                    if out:
                        yield out
        if held[0] and (out := solve(held)):
            yield out

    return tidy(run)


def contexts(base: DataFrame, asked: DataFrame) -> DataFrame:
    """The contexts of asked (key, doc, th, a, b) in the texts of base."""
    joined = with_lists(base.where(id_filter(asked.select("doc"))(F.col("doc_id"))), asked, "inner", "key", "a", "b").select("doc_id", "th", "text", "_key", "_a", "_b")
    return joined.mapInArrow(_contexts, R_SCHEMA)


def _size(c: str) -> Column:
    return F.octet_length(c)


def _halves(rows: DataFrame, window: int) -> DataFrame:
    """Rows (key, lo, hi, back, fore, ...) once for each half [lo, hi) of the places that the anchor has in a window, as far as
    the row has such windows: back and fore cut to what they can hold, key made anew from the bytes that all of them hold."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    half = F.explode(F.array(F.struct(F.col("lo").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("hi").alias("h")))).alias("half")
    rows = rows.select("*", half).drop("lo", "hi").select("*", F.col("half.l").alias("lo"), F.col("half.h").alias("hi")).drop("half")
    rows = rows.where((F.col("lo") < F.col("hi")) & (F.greatest("lo", F.lit(window) - _size("fore")) <= F.least(F.col("hi") - 1, _size("back"))))
    core = F.xxhash64("key", "lo", "hi", F.substring("back", F.lit(1), F.col("lo")), F.substring("fore", F.lit(1), F.lit(window + 1) - F.col("hi")))
    return rows.withColumns({"key": core, "back": F.substring("back", F.lit(1), F.col("hi") - 1), "fore": F.substring("fore", F.lit(1), F.lit(window) - F.col("lo"))})


def _over_full(rows: DataFrame) -> DataFrame | None:
    """The keys of more than GROUP_MOST rows, if any."""
    crowd = written(rows.groupBy("key").count().where(F.col("count") > GROUP_MOST).select("key"), "crowd")
    return crowd if crowd.limit(1).count() else None


def split(rows: DataFrame, spec: Spec) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans (doc, th, a, b), and contexts of which no key has more than GROUP_MOST rows: together they tell all that rows
    (contexts of over-full keys) tell. Of equal contexts all but the earliest are spans and only the earliest goes on."""
    spans, done, place = [], [], F.struct("doc", "th", "a")
    rows = rows.select("*", F.lit(0).alias("lo"), F.lit(spec.reach + 1).alias("hi"))
    while True:
        rows = written(_halves(rows, spec.window), "halves")
        first = rows.groupBy("key", "lo", "hi", "back", "fore").agg(F.min(place).alias("first"))
        later = rows.join(first, ["key", "lo", "hi", "back", "fore"]).where(place > F.col("first"))
        spans.append(later.select("doc", "th", (F.col("a") - _size("back")).alias("a"), (F.col("a") + _size("fore")).alias("b")))
        rows = first.select("key", "first.doc", "first.th", "first.a", "back", "fore", "lo", "hi")
        rows = written(rows.join(rows.groupBy("key").count().where("count > 1").select("key"), "key", "left_semi"), "classes")
        crowd = _over_full(rows)
        if crowd is None:
            return spans, [*done, rows.select(R_NAMES)]
        done.append(rows.join(crowd, "key", "left_anti").select(R_NAMES))
        rows = rows.join(crowd, "key", "left_semi")


def solved(rows: DataFrame, spec: Spec) -> DataFrame:
    """Spans of the repeats among contexts, a key in one task."""
    schema = "key long, doc long, th long, a int, b int, first_doc long, first_a int"
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_repeats(spec), schema).select("doc", "th", "a", "b")


def repeat_spans(base: DataFrame, spec: Spec) -> DataFrame:
    """doc, th, a, b: spans of base (doc_id, text, th) that an earlier place repeats, each at least a window long."""
    bounded_batches(base.sparkSession)
    found = written(repeated(base, spec), "anchors")
    told = found.where("not request").select("doc", "th", "a", "b")
    # Written, so that the texts are shuffled once for the contexts of all keys, over-full ones too.
    rows = written(contexts(base, found.where("request").select("key", "doc", "th", "a", "b")), "contexts")
    crowd = _over_full(rows)
    if crowd is None:
        return told.unionByName(solved(rows, spec))
    more, parts = split(rows.join(crowd, "key", "left_semi"), spec)
    for part in [rows.join(crowd, "key", "left_anti"), *parts]:
        told = told.unionByName(solved(part, spec))
    for part in more:
        told = told.unionByName(part)
    return told


G_SCHEMA = "doc long, th long, a int, id long, depth int, length int"
G_NAMES = ["doc", "th", "a", "id", "depth", "length"]


def _group_batch(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 2 + [pa.int32(), pa.int64()] + [pa.int32()] * 2
    for i in range(0, len(found), BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found[i:i + BATCH_ROWS]), types)], names=G_NAMES)


def _group_of(spec: Spec):
    """A function of a string and its anchor's place: the group's id, or None if no window inside chooses the anchor
    (else all occurrences of the string have it)."""
    own_anchors = scan(spec, every=True)

    def of(u: bytes, depth: int) -> int | None:
        batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([u], pa.binary())], names=["doc_id", "th", "text"])
        if any(depth in b.column(4).to_pylist() for b in own_anchors(iter([batch]))):
            return int.from_bytes(hashlib.blake2b(u, digest_size=8).digest(), "little", signed=True)
        return None

    return of


def _one_window(spec: Spec):
    """Contexts cut to a single window, to their groups."""
    of, known = _group_of(spec), {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for doc, th, a, back, fore in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
                u = back[::-1] + fore, len(back)
                if u not in known:
                    if len(known) > BATCH_ROWS:
                        known.clear()
                    known[u] = of(*u)
                if known[u] is not None:
                    found.append((doc, th, a, known[u], len(back), len(u[0])))
            yield from _group_batch(found)

    return tidy(run)


def _split_whole(rows: DataFrame, spec: Spec) -> tuple[list[DataFrame], list[DataFrame]]:
    """As split(), but every row stays: contexts of which no key has more than GROUP_MOST, and contexts that are one window."""
    done, single = [], []
    rows = rows.select("*", F.lit(0).alias("lo"), F.lit(spec.reach + 1).alias("hi"))
    while True:
        rows = written(_halves(rows, spec.window), "halves")
        crowd = _over_full(rows)
        if crowd is None:
            return [*done, rows.select(R_NAMES)], single
        done.append(rows.join(crowd, "key", "left_anti").select(R_NAMES))
        rows = rows.join(crowd, "key", "left_semi")
        single.append(rows.where("hi - lo = 1").select(R_NAMES))
        rows = rows.where("hi - lo > 1")


def _whole_groups(spec: Spec):
    """Contexts sorted by key, one of each class, to the classes of every maximal repeat group; whole keys at a time."""
    group_of = _group_of(spec)

    def solve(rows: list[tuple]) -> Iterator[tuple]:
        rows = [r for r in rows for _ in range(2)]  # a class of several occurrences is a group by itself
        back, n_back = _matrix([r[4] for r in rows], spec.reach)
        fore, n_fore = _matrix([r[5] for r in rows], spec.window)
        sa = np.lexsort((n_fore, np.ascontiguousarray(fore).view(f"S{spec.window}")[:, 0]))
        place = np.empty(len(sa), np.int64)
        place[sa] = np.arange(len(sa))
        for length, i, j in intervals(_common(fore, n_fore, sa[:-1], sa[1:]).tolist(), spec.gram):
            need = max(0, spec.window - length)
            node = sa[i:j][n_back[sa[i:j]] >= need]
            if len(node) < 2:
                continue
            node = node[np.lexsort((n_back[node], np.ascontiguousarray(back[node]).view(f"S{spec.reach}")[:, 0]))]
            for depth, a, b in intervals(_common(back, n_back, node[:-1], node[1:]).tolist(), need):
                own = node[a:b]
                ends = own[place[own].argmin()], own[place[own].argmax()]
                if _common(fore, n_fore, *(np.array([e]) for e in ends))[0] > length:
                    continue  # they go on together: a deeper node's group
                u = rows[own[0]][4][:depth][::-1] + rows[own[0]][5][:length]
                gid = group_of(u, depth)
                if gid is not None:
                    for r in {rows[k][1:4] for k in own}:
                        yield *r, gid, depth, depth + length

    def out(rows) -> Iterator[pa.RecordBatch]:
        yield from _group_batch(list(solve(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][0] != r[0]:
                    yield from out(held)
                    held = []
                held.append(r)
        if held:
            yield from out(held)

    return tidy(run)


def groups(docs: DataFrame, window: int = 100) -> DataFrame:
    """id, length, doc, th and a (where it starts) of every occurrence of every maximal repeat group of docs.

    A group's occurrences are all places of its string in the corpus. Classes of equal contexts meet as
    one suffix and get their members back by a join; the different contexts of an anchor meet in one task,
    at most GROUP_MOST of them: more are split as for the spans, and give groups of at most a half's reach.
    """
    spec, base = Spec("byte", window, GRAM, within=True), keyed(docs)
    found = written(base.where("doc_id is not null").select("doc_id", "th", "text").distinct().mapInArrow(scan(spec, every=True), A_SCHEMA), "anchors")
    classes = found.groupBy("key", "ctx").agg(F.min(F.struct("doc", "th", "pos", "lr")).alias("x"), F.count("*").alias("n"))
    again = found.groupBy("key").count().where("count > 1").select("key")
    classes = written(classes.join(again, "key").select("key", "ctx", "n", "x.doc", "x.th", F.col("x.pos").alias("a"), F.col("x.lr").alias("b")), "classes")
    texts, crowd = base.dropDuplicates(["doc_id", "th"]), _over_full(classes)
    if crowd is None:
        parts, single = [contexts(texts, classes)], []
    else:
        parts, single = _split_whole(contexts(texts, classes.join(crowd, "key", "left_semi")), spec)
        parts.append(contexts(texts, classes.join(crowd, "key", "left_anti")))
    told = [p.repartition("key").sortWithinPartitions("key").mapInArrow(_whole_groups(spec), G_SCHEMA) for p in parts]
    told = reduce(DataFrame.unionByName, told + [p.mapInArrow(_one_window(spec), G_SCHEMA) for p in single])
    # A class is known by the place of its earliest member, which has one anchor.
    told = told.distinct().join(classes.select("doc", "th", "a", "key", "ctx", "n"), ["doc", "th", "a"]).select("key", "ctx", "n", "id", "depth", "length")
    many = written(told, "groups")
    several = many.groupBy("key", "id", "depth", "length").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    many = many.drop("n").join(several, ["key", "id", "depth", "length"])
    return many.join(found, ["key", "ctx"]).select("id", "length", "doc", "th", (F.col("pos") - F.col("depth")).alias("a")).distinct()


def _cut():
    """Removes the spans' bytes and hashes what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            n_bytes, removed, runs, kept = [], [], [], []
            for t, s, e in zip(b.column(1).to_pylist(), lists_of(b.column(2)), lists_of(b.column(3))):
                raw = t.encode() if t else b""
                n_bytes.append(len(raw))
                gone = m = 0
                if s is not None and len(s):
                    s, e = union_of(s, e)
                    gone, m, parts, at = int((e - s).sum()), len(s), [], 0
                    for x, y in zip(s.tolist(), e.tolist()):
                        parts.append(raw[at:x])
                        at = y
                    raw = b"".join([*parts, raw[at:]])
                removed.append(gone)
                runs.append(m)
                kept.append(raw)
            cols = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return tidy(run)


def with_spans(rows: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, th, ...) with the lists _a and _b of their spans, most rows without any): these are told by a filter of ids and not shuffled."""
    spans = written(spans, "spans")
    has = F.coalesce(id_filter(spans.select("doc"))(F.col("doc_id")), F.lit(False))
    return with_lists(rows.where(has), spans, "left", "a", "b"), rows.where(~has)


def dedup(docs: DataFrame, window: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    base = keyed(docs)
    some, others = with_spans(base, repeat_spans(base, Spec("byte", window, GRAM, within=True)))
    done = some.select("doc_id", "text", "_a", "_b").mapInArrow(_cut(), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    return done.unionByName(others.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256")))


@tidy
def _cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column's texts without the spans of the next two; a character that a span splits goes whole."""
    for b in pieces(batches, 0):
        out = []
        for t, s, e in zip(b.column(0).to_pylist(), lists_of(b.column(1)), lists_of(b.column(2))):
            if s is not None and len(s):
                raw, parts, at = t.encode(), [], 0
                for x, y in zip(*(v.tolist() for v in union_of(s, e))):
                    parts.append(raw[at:x])
                    at = y
                t = "".join(p.decode("utf-8", "ignore") for p in [*parts, raw[at:]])
            out.append(t)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *b.columns[3:]], names=["_cut", *b.schema.names[3:]])


def cut(docs: DataFrame, window: int = 100) -> DataFrame:
    """docs with the repeated bytes cut out of their texts; all rows and columns stay."""
    unique = unique_ids(docs)
    base = keyed(docs, unique)
    spans = repeat_spans(base, Spec("byte", window, GRAM, within=True))
    names = docs.columns
    rows = docs.select(F.col("text").cast("string").alias("_t"), *(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)))
    rows = rows.select("*", F.col(f"_c{names.index('doc_id')}").cast("long").alias("doc_id"), (F.xxhash64(F.coalesce("_t", F.lit(""))) if not unique else F.lit(0).cast("long")).alias("th"))
    some, others = with_spans(rows, spans)
    rest = [f"_c{i}" for i in range(len(names)) if names[i] != "text"]
    kept = ", ".join(f"_c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields) if f.name != "text")
    done = some.select("_t", "_a", "_b", *rest).mapInArrow(_cut_text, f"_cut string, {kept}").unionByName(others.select(F.col("_t").alias("_cut"), *rest))
    return done.select(*(F.col("_cut" if c == "text" else f"_c{i}").alias(c) for i, c in enumerate(names)))
