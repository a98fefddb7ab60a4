"""Near copies among embeddings by p-stable hashing of normalised vectors.

Vectors are brought to length one, so a cosine is a Euclidean distance. A hash function is a random
projection (normal, hence 2-stable), shifted and cut into steps; a table's slot is the values of several
functions. How wide the steps are, how many functions a table has and how many tables there are is found from
the number of vectors and the distances of a bounded sample (SAMPLE rows): as many functions as keep chance
meetings rare (CHANCE a vector and table), then as many tables as leave a pair exactly at the threshold
unmet with probability MISS; nearer pairs are missed far more seldom. At most MOST_TABLES tables: denser data
get fewer functions, so more candidates, not less recall.

What shares a slot is compared exactly, in cells rather than pairs. A cell is vectors within half the link
angle of a centre, so all its members link, whatever their number. In a few rounds vectors join the
centre (the least vec_id of a slot) that they share most slots with, if it is near enough; the others are
cells of their own. Cells that share a slot are compared by centres: by the triangle inequality (with
a margin far over rounding) all their members link, none does, or their members are compared in blocks of
at most MEMBERS. So every pair counts once, a group of thousands of copies is a few cells, and neither pairs
of a slot nor pairs of a group are made as rows. Cells that link are joined to components.

Defined cases: vectors that are null, zero or hold null or non-finite components, vectors of another length than
the most frequent and rows without vec_id link with nothing; of rows that repeat a vec_id the one of least
vector takes part and all get its result; a row without vec_id has no component and is kept; no row gives
none. Labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, in_rows, joined, mix, tidy, written
from .components import components
from .multi_index import usable

SAMPLE, CHANCE, MISS, MOST_TABLES, ROUNDS = 2_000, 0.02, 0.0001, 384, 4
#: Cells of one slot, and members of one cell, that are compared at a time.
CELLS, MEMBERS = 512, 256
#: Radians by which the triangle inequality must decide.
MARGIN = 1e-6


def meeting(distance: np.ndarray, width: float) -> np.ndarray:
    """The probability that two vectors of that distance have one value of a function."""
    r = width / np.maximum(distance, 1e-12)
    tail = np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in r])
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - np.exp(-r * r / 2))


def settings(sample: np.ndarray, n: int, least: float) -> tuple[float, int, int]:
    """Width, functions of a table and tables for n vectors like those of the sample (of length one)."""
    link = math.sqrt(2 - 2 * least)
    apart = np.sqrt(np.maximum(2 - 2 * (sample @ sample.T)[np.triu_indices(len(sample), 1)], 0))
    apart = np.quantile(apart[apart > link], np.linspace(0, 1, 201)) if (apart > link).any() else np.array([math.sqrt(2)])
    best = None
    for width in np.linspace(0.5, 4, 15):
        near, far = float(meeting(np.array([link]), width)[0]), meeting(apart, width)
        for k in range(1, 65):
            tables = math.ceil(math.log(MISS) / math.log1p(-(near**k))) if near < 1 else 1
            if tables > MOST_TABLES and k > 1:
                break
            chance = n * float((far**k).mean())
            cost = tables * (1 + k / 32) * (1 + 50 * max(0.0, chance - CHANCE))
            if best is None or cost < best[0]:
                best = cost, float(width), k, tables
    return best[1:]


def _matrix(col: pa.Array, dtype: str) -> np.ndarray:
    """The vectors of a binary column, one a row, at length one in double precision."""
    if not len(col):
        return np.zeros((0, 1))
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int32, len(col) + 1 + col.offset)[col.offset:]
    x = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(dtype).reshape(len(col), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Tables:
    """Slots of vectors: functions are drawn from a fixed seed, so all executors agree."""

    def __init__(self, size: int, width: float, functions: int, tables: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.shape, self.a = (tables, functions), rng.standard_normal((size, tables * functions)) / width
        self.b = rng.random(tables * functions)
        self.words = rng.integers(1, 1 << 63, (tables, functions), dtype=np.int64).astype(U64) | U64(1)
        self.salt = mix(np.arange(1, tables + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))

    def slots(self, x: np.ndarray) -> np.ndarray:
        steps = np.floor(x @ self.a + self.b).astype(np.int64).astype(U64).reshape(len(x), *self.shape)
        return mix((steps * self.words).sum(2, dtype=U64) ^ self.salt).astype(np.int64)


def _entries(sent, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                slots = tables.slots(_matrix(part.column(1), dtype))
                yield from in_rows(pa.RecordBatch.from_arrays([pa.array(slots.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), slots.shape[1]))], names=["slot", "id"]))

    return run


def _verified(dtype: str, most: float):
    """id, cell, angle of (id, pivot, u, p) whose angle is `most` or less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            angle = np.arccos(np.clip((_matrix(b.column(2), dtype) * _matrix(b.column(3), dtype)).sum(1), -1, 1)) if b.num_rows else np.zeros(0)
            angle[b.column(0).to_numpy() == b.column(1).to_numpy()] = 0
            ok = pa.array(angle <= most)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok), pa.array(angle).filter(ok)], names=["id", "cell", "angle"])

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows dealt anew so that no group (equal long values of the first `keys` columns) is cut; and where groups begin."""
    held: list[pa.RecordBatch] = []

    def joined_up() -> tuple[pa.RecordBatch, np.ndarray]:
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return b, np.flatnonzero(_opens(b, keys))

    for b in batches:
        if not b.num_rows:
            continue
        opens = np.flatnonzero(_opens(b, keys))
        if held and any(held[-1].column(i)[-1].as_py() != b.column(i)[0].as_py() for i in range(keys)):
            yield joined_up()
            held = []
        if len(opens) > 1:
            cut = int(opens[-1])
            held.append(b.slice(0, cut))
            yield joined_up()
            held, b = [], b.slice(cut)
        held.append(b)
    if held:
        yield joined_up()


def _opens(b: pa.RecordBatch, keys: int) -> np.ndarray:
    out = np.zeros(b.num_rows, bool)
    out[0] = True
    for i in range(keys):
        out[1:] |= np.diff(b.column(i).to_numpy()) != 0
    return out


def _pairs(starts: np.ndarray, ends: np.ndarray, cross: np.ndarray, part: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within groups of rows: small groups of one size together, others one by one; of two blocks only pairs across."""
    size = ends - starts
    small = ~cross & (size <= 32)
    for g in np.unique(size[small & (size > 1)]).tolist():
        a, b = np.triu_indices(g, 1)
        own, step = starts[small & (size == g)], max(1, (1 << 15) // len(a))
        for i in range(0, len(own), step):
            yield (own[i:i + step, None] + a).ravel(), (own[i:i + step, None] + b).ravel()
    for i in np.flatnonzero(~small & (size > 1)).tolist():
        s = np.arange(starts[i], ends[i])
        one, two = (s[part[s] == lo[s[0]]], s[part[s] == hi[s[0]]]) if cross[i] else (s, s)
        for k in range(0, len(one), 64):
            a, b = np.meshgrid(one[k:k + 64], two, indexing="ij")
            ok = slice(None) if cross[i] else a < b
            yield a[ok].ravel(), b[ok].ravel()


def _near_cells(dtype: str, link: float):
    """a, b, every of cells in one group of (slot, lo, hi, part, cell, r, u): pairs of which some or every member may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, 3):
            lo, hi, part, cell, r = (t.column(i).to_numpy() for i in range(1, 6))
            x, ends = _matrix(t.column(6), dtype), np.append(starts[1:], t.num_rows)
            for a, b in _pairs(starts, ends, lo[starts] != hi[starts], part, lo, hi):
                angle, reach = np.arccos(np.clip((x[a] * x[b]).sum(1), -1, 1)), r[a] + r[b]
                ok = angle <= link + reach + MARGIN
                a, b, every = cell[a[ok]], cell[b[ok]], (angle + reach <= link - MARGIN)[ok]
                yield from in_rows(pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(every)], names=["a", "b", "every"]))

    return run


def _near_members(dtype: str, least: float):
    """Of blocks of members (a, b, i, j, side, id, u) of two cells: (id, n) links of a member, (a, b) where there is any."""
    names = ["id", "n", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, 4):
            side, ids, x = t.column(4).to_numpy(), t.column(5).to_numpy(), _matrix(t.column(6), dtype)
            out: list[list] = [[], [], [], []]
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
                one, two = s + np.flatnonzero(side[s:e] == 0), s + np.flatnonzero(side[s:e] == 1)
                near = x[one] @ x[two].T >= least
                for own, n in ((one, near.sum(1)), (two, near.sum(0))):
                    some = n > 0
                    out[0] += ids[own[some]].tolist()
                    out[1] += n[some].tolist()
                    out[2] += [None] * int(some.sum())
                    out[3] += [None] * int(some.sum())
                if near.any():
                    for o, v in zip(out, (None, None, t.column(0)[s].as_py(), t.column(1)[s].as_py())):
                        o.append(v)
            yield from in_rows(pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=names))

    return run


def _cells(entries: DataFrame, unit: DataFrame, dtype: str, link: float) -> DataFrame:
    """id, cell and angle of every vector of entries (slot, id)."""
    left, done = entries, None
    p = unit.select(F.col("vec_id").alias("pivot"), F.col("u").alias("p"))
    for _ in range(ROUNDS):
        pivots = left.groupBy("slot").agg(F.min("id").alias("pivot"))
        votes = left.join(pivots, "slot").groupBy("id", "pivot").agg(F.count("*").alias("n"))
        most = votes.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "pivot")).alias("most")).select("id", F.col("most.pivot").alias("pivot"))
        asked = most.join(unit.select(F.col("vec_id").alias("id"), "u"), "id").join(p, "pivot").select("id", "pivot", "u", "p")
        found = written(asked.mapInArrow(tidy(_verified(dtype, link / 2 - MARGIN)), "id long, cell long, angle double"), "cells")
        done = found if done is None else done.unionByName(found)
        left = written(left.join(found.select("id"), "id", "left_anti"), "left")
        if left.isEmpty():
            return done
    return done.unionByName(left.select("id", F.col("id").alias("cell"), F.lit(0.0).alias("angle")).distinct())


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links (other vectors of cosine `least` or more), component_id and kept of every row."""
    dtype = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    raw = "<f" if dtype == "<f4" else "<d"
    ok = usable(vectors)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = len(b.column(1)[0]) * int(dtype[-1]) if b.num_rows else 0
            data = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(raw)
            places = np.arange(b.num_rows + 1, dtype=np.int32) * np.int32(size)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(places), pa.py_buffer(data)])], names=["vec_id", "u"])

    unit = written(ok.mapInArrow(tidy(packed), "vec_id long, u binary"), "vectors")
    n, ids = unit.count(), vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    kept = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if n < 2:
        return kept
    some = unit.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("u").combine_chunks()
    sample, link = _matrix(some, dtype), math.acos(least)
    sent = vectors.sparkSession.sparkContext.broadcast(Tables(sample.shape[1], *settings(sample, n, least)))
    entries = unit.mapInArrow(tidy(_entries(sent, dtype)), "slot long, id long")
    shared = entries.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1").select("slot")
    entries = written(entries.join(shared, "slot"), "entries")
    cells = written(_cells(entries, unit, dtype, link), "cells")
    stats = written(cells.groupBy("cell").agg(F.count("*").alias("size"), F.max("angle").alias("r"), F.min("id").alias("first")), "stats")

    # Cells that share a slot, by their centres.
    within = written(entries.join(cells.select("id", "cell"), "id").select("slot", "cell").distinct(), "slots")
    several = within.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / CELLS)
    rows = within.join(several, "slot").withColumn("part", F.pmod(F.xxhash64("cell"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    centres = stats.select("cell", "r").join(unit.select(F.col("vec_id").alias("cell"), "u"), "cell")
    rows = rows.join(centres, "cell").select("slot", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "cell", "r", "u")
    rows = rows.repartition("slot", "lo", "hi").sortWithinPartitions("slot", "lo", "hi")
    near = rows.mapInArrow(tidy(_near_cells(dtype, link)), "a long, b long, every boolean")
    near = written(near.groupBy("a", "b").agg(F.min("every").alias("every")), "near")

    # Members of cells that the centres don't decide, in blocks.
    open_, size = near.where("not every"), stats.select("cell", F.ceil(F.col("size") / MEMBERS).alias("blocks"))
    for side, block in (("a", "i"), ("b", "j")):
        open_ = open_.join(size.withColumnRenamed("cell", side), side).withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    open_ = written(open_.drop("every"), "open")
    members = joined(cells.select("id", "cell"), size.join(stats.select("cell", "size"), "cell"), ["cell"], F.col("size") > n / 1000)
    members = members.select("id", "cell", F.pmod(F.xxhash64("id"), "blocks").alias("block")).join(unit.withColumnRenamed("vec_id", "id"), "id")
    sides = [open_.join(members.withColumnsRenamed({"cell": c, "block": b}), [c, b]).select("a", "b", "i", "j", F.lit(k).cast("long").alias("side"), "id", "u") for k, (c, b) in enumerate((("a", "i"), ("b", "j")))]
    sides = sides[0].unionByName(sides[1]).repartition("a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j")
    counted = written(sides.mapInArrow(tidy(_near_members(dtype, least)), "id long, n long, a long, b long"), "counted")

    every = near.where("every").select("a", "b")
    labels = components(every.unionByName(counted.where("a is not null").select("a", "b")))
    sizes = stats.select("cell", "size")
    ways = every.unionByName(every.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = ways.join(sizes.withColumnRenamed("cell", "b"), "b").groupBy(F.col("a").alias("cell")).agg(F.sum("size").alias("more"))
    facts = stats.join(more, "cell", "left").join(labels.withColumnRenamed("node", "cell"), "cell", "left").withColumn("label", F.coalesce("label", "cell"))
    firsts = facts.groupBy("label").agg(F.min("first").alias("component"), F.count("*").alias("n_cells"))
    facts = written(joined(facts, firsts, ["label"], F.col("n_cells") > n / 1000), "facts")
    own = counted.where("id is not null").groupBy("id").agg(F.sum("n").alias("own"))
    linked = joined(cells.select("id", "cell"), facts.select("cell", "size", "more", "component"), ["cell"], F.col("size") > n / 1000).join(own, "id", "left")
    linked = linked.select(F.col("id").alias("vec_id"), (F.col("size") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("own", F.lit(0))).cast("long").alias("n_links"), F.col("component").alias("component_id"))
    whole = ids.join(linked, "vec_id", "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return whole.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
