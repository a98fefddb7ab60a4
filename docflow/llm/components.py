"""Connected components of an edge table by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_rows, tidy, written

#: Edges that one task joins by itself (a few MB): rounds over so few would cost more in tasks than in work.
ONE_TASK = 200_000


@tidy
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and label of edges, by union and find; the least node of a component is its root."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            u, v = root(u), root(v)
            up[max(u, v)] = min(u, v)
    if up:
        yield from in_rows(pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([root(x) for x in up], pa.int64())], names=["node", "label"]))


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of edges (a, b).

    Large stars hang a node's greater neighbours on its least one, small stars the lesser ones; in
    logarithmically many rounds every component is one star. Each round is a written table, so it
    survives lost executors; joins on hot nodes are split by adaptive execution. An edge with a null end,
    or from a node to itself, says nothing: its nodes come only by other edges. No edge gives no row.
    At most ONE_TASK edges are joined by one task.
    """
    e = written(edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    if e.count() <= ONE_TASK:
        return e.coalesce(1).mapInArrow(_joined, "node long, label long")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = written(small, "stars")
        mark = tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if mark == last:
            break
        last = mark
    labels = e.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return labels.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
