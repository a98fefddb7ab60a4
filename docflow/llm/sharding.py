"""Vector bin packing of documents into shards, balancing bytes, tokens and rows jointly.

Groups of equal texts are the items and stay whole. A group that weighs more than 1/PIECE of a shard in
any of the three measures is an item of its own; the many smaller groups are gathered by hash into
bundles of whole groups, BUNDLES of geometrically falling size for each range of text sizes, so the
driver packs a number of items that doesn't grow with the data and that differ in their bytes a row.
Only a group that no shard has room for (more than a whole shard in a measure) is split, by the hash
of doc_id, into pieces of 1/PARTS of a shard. Items go, largest first, where the dot product of their
vector with the shard's residual capacity is highest.

Law held: `bytes` (sizes near equal). Defined cases: a null text has size 8 and groups with the empty
ones; a null doc_id hashes like any value; repeated rows are placed each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: A group over 1/PIECE of a shard's capacity is packed on its own; one over a whole shard in pieces of 1/PARTS.
PIECE, PARTS = 64, 8
#: Bundles of small groups in each of LEVELS sizes; each level's bundles are FALL times smaller. Groups of texts whose
#: sizes lie between the same powers of FALL share bundles, at most RANGES kinds.
BUNDLES, LEVELS, FALL, RANGES = 384, 5, 4, 12
#: Rows that are numbered together inside a shard.
SLOT_ROWS = 100_000


def place(weights: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each item (rows: items, columns: measures), by dot product with residual capacity."""
    total = weights.sum(0)
    share = weights / np.where(total > 0, total, 1) * n_shards  # 1: the capacity of one shard
    left = np.ones((n_shards, weights.shape[1]))
    out = np.zeros(len(weights), np.int64)
    for i in np.lexsort((np.arange(len(share)), -share.max(1))):
        out[i] = int((left @ share[i]).argmax())
        left[out[i]] -= share[i]
    return out


def pack(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of docs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"), F.xxhash64(text).alias("group"),
    )
    base = written(base.withColumn("id_hash", F.xxhash64("doc_id")), "sizes")  # no texts: a few bytes a row
    all_ = base.agg(F.count("*"), F.sum("size"), F.sum("tokens")).first()
    n, total, tokens = all_[0], all_[1] or 0, all_[2] or 0
    limit = [max(1.0, x / (n_shards * PIECE)) for x in (total, tokens, n)]
    sums = (F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"))
    # At most 3 * PIECE * n_shards groups weigh so much.
    heavy = base.groupBy("group").agg(*sums).where((F.col("b") > limit[0]) | (F.col("t") > limit[1]) | (F.col("r") > limit[2]))
    # 1: a shard. Equal texts make equal rows, so pieces by rows are pieces by bytes and tokens.
    weight = F.greatest(F.col("b") / (limit[0] * PIECE), F.col("t") / (limit[1] * PIECE), F.col("r") / (limit[2] * PIECE))
    heavy = heavy.select("group", F.when(weight > 1, F.ceil(weight * PARTS)).otherwise(1).cast("int").alias("pieces"))
    # The bundle of a small group: the level by falling shares of the hash's range, then a place in the level.
    spread = F.pmod(F.xxhash64("group", F.lit(1)), F.lit(1 << 40)) / float(1 << 40)
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 1, 0, -1):
        level = F.when(spread >= FALL**-k, F.lit(k - 1)).otherwise(level)
    kind = F.least(F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(float(FALL)))), F.lit(RANGES - 1))
    bundle = ((kind * LEVELS + level) * BUNDLES + F.pmod(F.xxhash64("group", F.lit(2)), F.lit(BUNDLES))).cast("long")
    items = base.join(F.broadcast(heavy), "group", "left").select(
        "doc_id", "size", "text_crc32", "tokens", "id_hash",
        F.when(F.col("pieces").isNull(), F.lit(None).cast("long")).otherwise(F.col("group")).alias("own"),
        F.when(F.col("pieces").isNull(), bundle).otherwise(F.pmod("id_hash", F.col("pieces")).cast("long")).alias("part"),
    )
    weights = items.groupBy("own", "part").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).collect()
    weights.sort(key=lambda r: (r["own"] is not None, r["own"] or 0, r["part"]))
    where = place(np.array([[r["b"], r["t"], r["r"]] for r in weights], float).reshape(-1, 3), n_shards)
    plan = docs.sparkSession.createDataFrame([(r["own"], r["part"], int(s)) for r, s in zip(weights, where)], "own long, part long, shard int")
    placed = items.join(F.broadcast(plan), items["own"].eqNullSafe(plan["own"]) & (items["part"] == plan["part"]))
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "id_hash")
    # Slots: rows of a shard are numbered in spans of about SLOT_ROWS, each after the rows of those before it.
    spans = max(1, -(-n // (n_shards * SLOT_ROWS)))
    placed = written(placed.withColumn("span", F.pmod("id_hash", F.lit(spans))), "placed")
    before = placed.groupBy("shard", "span").agg(F.count("*").alias("m")).withColumn("before", F.coalesce(F.sum("m").over(Window.partitionBy("shard").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.row_number().over(Window.partitionBy("shard", "span").orderBy("id_hash", "doc_id", "text_crc32", "size"))
    return placed.withColumn("number", number).join(before.select("shard", "span", "before"), ["shard", "span"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("number") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
