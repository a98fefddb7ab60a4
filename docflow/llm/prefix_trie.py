"""A trie of conversation prefixes by prefix-doubling names.

Turns get dense names by their content, blocks of two, four, eight ... turns by the names of their halves:
a round for every doubling, in which distinct pairs of names are numbered and joined back. A prefix of d
turns is the blocks that the binary digits of d say, so its name is the list of their (at most log d)
names, and conversations whose prefixes of d turns agree in that list share a node. All else follows from
nodes being told by their smallest member: a conversation owns the nodes whose smallest member it is,
a node's subtree is owned by its members, so sums over subtrees are sums over members of what they
own from that depth on, and the parent of a node is where its owner's prefix of one turn less lies.

No texts are shuffled: turns are told by SHA-256. Turns are numbered, and sums run along a conversation, by
range sorts, so that one of any length lies over many tasks. What more than a thousandth of the rows share (at
most a thousand names) is joined by broadcast. Ids that end at a node are joined to strings in their sorted
partitions, so the task that hashes a node's ids reads pieces, not ids.

Defined cases: rows without conv_id take no part; null role or text is empty; null turns come first and
repeated turns in the order of their content's SHA-256, every row being a turn; no row gives no node.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.running import running

from .common import joined, tidy, written

#: Conversations that share a head, and one more than the longest head.
GROUP, HEADS = 5, 9
#: Places that one row of a block is spread over at a time.
SPREAD = 4_096


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and n_bytes of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")).where("conv_id is not null")
    return running(rows, ["conv_id"], [F.asc_nulls_first("turn"), "digest"], {"place": None}).drop("turn")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id and size of every rebuilt conversation; its turns: conv_id, size, place, digest, n_bytes)."""
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    info = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    info = info.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    info = written(info.select("conv_id", "base", "n", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "sizes")
    total = info.agg(F.sum("n")).first()[0] or 0
    heads = own.where(F.col("place") < HEADS - 1).withColumnRenamed("conv_id", "base").join(info.select("conv_id", "base", "h", "size"), "base").where("place < h")
    rest = joined(own.where(F.col("place") >= h), info.select("conv_id", "n", "h", "taken", "size"), ["conv_id"], F.col("n") > total / 1000)
    names = ("conv_id", "size", "place", "digest", "n_bytes")
    rows = heads.select(*names).unionByName(rest.withColumn("place", F.col("place") - F.col("h") + F.col("taken")).select(*names))
    return info.select("conv_id", "size"), written(rows, "rebuilt")


def dense(distinct: DataFrame) -> tuple[DataFrame, int]:
    """(distinct, whose column n counts rows, with `name` from 0 without gaps, written; the sum of n)."""
    kept = written(distinct.withColumn("_at", F.monotonically_increasing_id()), "names")
    parts = sorted(kept.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect())  # a row a partition
    starts = np.cumsum([0, *(r["rows"] for r in parts)]).tolist()
    first = kept.sparkSession.createDataFrame([(r["p"], s) for r, s in zip(parts, starts)], "p long, first long")
    named = kept.join(F.broadcast(first), F.shiftright("_at", 33) == F.col("p")).withColumn("name", F.col("first") + F.col("_at").bitwiseAND((1 << 33) - 1))
    return named.drop("_at", "p", "first"), sum(r["n"] for r in parts)


def blocks(rows: DataFrame) -> list[DataFrame]:
    """conv_id, size, j and name of all aligned blocks of 1, 2, 4, 8 ... turns: block j of level k begins at turn j * 2**k."""
    names, n = dense(rows.groupBy("digest").agg(F.count("*").alias("n")))
    found = rows.select("conv_id", "size", F.col("place").alias("j"), "digest")
    keys, out = ["digest"], []
    while n:
        level = joined(found, names.select(*keys, "n", "name"), keys, F.col("n") > n / 1000)
        out.append(written(level.select("conv_id", "size", "j", "name"), "blocks"))
        odd = F.col("j") % 2 == 1
        found = out[-1].groupBy("conv_id", F.shiftright("j", 1).alias("half")).agg(F.max("size").alias("size"), F.max(F.when(~odd, F.col("name"))).alias("a"), F.max(F.when(odd, F.col("name"))).alias("b"))
        found, keys = found.where("a is not null and b is not null").withColumnRenamed("half", "j"), ["a", "b"]
        names, n = dense(found.groupBy("a", "b").agg(F.count("*").alias("n")))
    return out


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, size, depth, n_bytes (of the last turn) and key of every prefix of a turn or more, written.

    Block j (even) of level k is part of the prefixes that reach its end, but not the end of the next block.
    """
    last = F.least((F.col("j") + 2) * F.col("w") - 1, "size")
    used = None
    for k, level in enumerate(blocks(rows)):
        own = level.where("j % 2 = 0").withColumn("w", F.lit(1 << k).cast("long")).withColumn("last", last)
        own = own.select("*", F.explode(F.sequence((F.col("j") + 1) * F.col("w"), "last", F.lit(SPREAD).cast("long"))).alias("lo"))
        own = own.select("conv_id", "size", F.explode(F.sequence("lo", F.least(F.col("lo") + SPREAD - 1, "last"))).alias("depth"), F.lit(k).alias("k"), "name")
        used = own if used is None else used.unionByName(own)
    ends = rows.select("conv_id", "size", (F.col("place") + 1).alias("depth"), "n_bytes")
    if used is None:
        return ends.withColumn("key", F.array().cast("array<long>"))
    both = used.unionByName(ends, allowMissingColumns=True)
    names = F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "name"))))
    own = both.groupBy("conv_id", "depth").agg(F.max("size").alias("size"), F.max("n_bytes").alias("n_bytes"), F.transform(names, lambda x: x["name"]).alias("key"))
    return written(own, "prefixes")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """owner, depth, first and ids: runs of one node's ids, sorted, as one string."""
    for b in batches:
        owner, depth = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(owner):
            continue
        at = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(depth) != 0)]))
        ids = b.column(2).cast(pa.string()).to_pylist()
        ends = [*at[1:].tolist(), len(ids)]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), b.column(2).take(pa.array(at)), pa.array([",".join(ids[i:j]) for i, j in zip(at.tolist(), ends)], pa.string())], names=["owner", "depth", "first", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """owner, depth and ends_sha256 from sorted pieces; a node's hash is kept open from batch to batch."""
    node, h = None, None
    for b in batches:
        out = []
        for owner, depth, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
            if node == (owner, depth):
                h.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, h.hexdigest()))
            node, h = (owner, depth), hashlib.sha256(ids.encode())
        if out:
            yield _ends(out)
    if node is not None:
        yield _ends([(*node, h.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))], names=["owner", "depth", "ends_sha256"])


def ended(ends: DataFrame) -> DataFrame:
    """owner, depth and the hash of the ids (conv_id) that end there."""
    runs = ends.select("owner", "depth", "conv_id").repartitionByRange("owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id")
    runs = runs.mapInArrow(tidy(_joined_ids), "owner long, depth long, first long, ids string")
    return runs.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first").mapInArrow(tidy(_hashed_ids), "owner long, depth long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    spark = conversations.sparkSession
    out = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    convs, rows = rebuilt(turns(conversations))
    lowest, n_convs = convs.agg(F.min("conv_id"), F.count("*")).first()
    if lowest is None:
        return spark.createDataFrame([], out)
    pre = prefixes(rows)
    named = written(pre.groupBy("depth", "key").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n")), "nodes")
    total = named.agg(F.sum("n")).first()[0] or 0
    of = written(joined(pre, named, ["depth", "key"], F.col("n") > total / 1000).drop("key"), "owners")
    above = of.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    nodes = of.where("conv_id = owner").join(above, ["conv_id", "depth"], "left")
    nodes = nodes.select("owner", "depth", "n", "n_bytes", F.coalesce("parent", F.lit(lowest)).alias("parent"))
    children = nodes.groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, ["owner", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    def when_owned(x: Column) -> Column:
        return F.coalesce(F.when(F.col("conv_id") == F.col("owner"), x), F.lit(0)).cast("long")

    along = of.join(nodes.select(F.col("owner").alias("conv_id"), "depth", "n_children"), ["conv_id", "depth"], "left")
    along = along.select("conv_id", "depth", "owner", when_owned((F.col("n") - 1) * F.col("n_bytes")).alias("saved"), when_owned((F.col("n_children") == 0).cast("long")).alias("leaf"))
    along = running(along, ["conv_id"], [F.desc("depth")], {"saved_below": "saved", "leaves_below": "leaf"})
    sums = along.groupBy("owner", "depth").agg(F.sum(F.col("saved_below") + F.col("saved")).alias("saved_tokens"), F.sum(F.col("leaves_below") + F.col("leaf")).alias("n_leaves"))
    ends = of.where("depth = size").select("owner", "depth", "conv_id").unionByName(convs.where("size = 0").select(F.lit(lowest).alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id"))
    own = nodes.agg(F.count_if(F.col("depth") == 1), F.count_if(F.col("n_children") == 0), F.sum((F.col("n") - 1) * F.col("n_bytes"))).first()
    root = spark.createDataFrame([(lowest, 0, None, n_convs, own[0], max(own[1], 1), own[2] or 0)], out.rpartition(",")[0])
    all_ = nodes.join(sums, ["owner", "depth"]).select(F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")
    hashes = ended(ends).withColumnRenamed("owner", "conv_id")
    whole = all_.unionByName(root).join(hashes, ["conv_id", "depth"], "left")
    return whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).select(*(c.split()[0] for c in out.split(", ")))
