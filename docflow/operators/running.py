"""Running sums and places over keys of any size, without one task for a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.sources.shared import written


def _changes(col: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; nulls are equal."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), False)
    return np.asarray(pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))))


def running(rows: DataFrame, keys: list[str], order: list[str | Column], sums: dict[str, str | None]) -> DataFrame:
    """rows with a column for each of sums (name: long column, or None): the column's sum over, or the number of, the rows
    before it within keys, by order.

    rows are dealt by ranges of keys and order, summed within a partition, and a partition's sums reach the next by a
    table of at most one row a partition, which is broadcast. So a key of any size lies over many tasks; only rows that
    agree in keys and order stay together. The result is a written table. Null keys are keys of their own; null amounts
    count nothing; rows without any give none. Pass only the columns that are needed.
    """
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    adds = [(F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0)) if c else F.lit(1).cast("long")).alias(f"_add{i}") for i, c in enumerate(sums.values())]
    dealt = dealt.select("*", *adds, F.spark_partition_id().alias("_part"))
    n, at = len(rows.columns), [rows.columns.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, [0] * len(sums)
        for b in batches:
            if not b.num_rows:
                continue
            new, head = np.zeros(b.num_rows, bool), [b.column(i)[0].as_py() for i in at]
            for i in at:
                new[1:] |= _changes(b.column(i))
            new[0] = last is not None and head != last
            first, out = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1)), []
            for i in range(len(sums)):
                add = b.column(n + i).to_numpy()
                total = np.cumsum(add) - add
                out.append(np.where(first >= 0, total - total[first], total + carried[i]))
                carried[i] = int(out[-1][-1] + add[-1])
            last = [b.column(i)[b.num_rows - 1].as_py() for i in at]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.int64()) for x in out)], names=[*b.schema.names, *(f"_before{i}" for i in range(len(sums)))])

    schema = T.StructType([*dealt.schema.fields, *(T.StructField(f"_before{i}", T.LongType()) for i in range(len(sums)))])
    kept = written(dealt.mapInArrow(run, schema), "running")
    parts = kept.groupBy("_part", *(F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys))).agg(*(F.sum(f"_add{i}").alias(f"_sum{i}") for i in range(len(sums))))
    places = Window.partitionBy(*(f"_key{i}" for i in range(len(keys)))).orderBy("_part")
    earlier = places.rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(F.col("_part").alias("_p"), *(f"_key{i}" for i in range(len(keys))), *(F.sum(f"_sum{i}").over(earlier).alias(f"_carry{i}") for i in range(len(sums))), F.lag("_part").over(places).alias("_was")).where("_was is not null")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}"))
    out = kept.join(F.broadcast(carry), same, "left")
    return out.select(*(F.col(f"`{c}`") for c in rows.columns), *((F.col(f"_before{i}") + F.coalesce(f"_carry{i}", F.lit(0))).alias(name) for i, name in enumerate(sums)))
