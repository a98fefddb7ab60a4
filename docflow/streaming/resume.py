"""Incremental rendering: a file stream of segments, committed batch by batch, resumable after a failure.

The streaming checkpoint keeps what has been read; a batch writes to a folder of its own number, so a
batch that is run again overwrites itself and a finished run is never repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def render(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], files_at_once: int = 1, glob: str = "*.parquet") -> None:
    """Renders what is new under source (Parquet files) to out, and returns when all is done."""

    def commit(rows: DataFrame, batch: int) -> None:
        transform(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", glob).parquet(source)
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(commit).start().awaitTermination()


def rendered(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")


def valid_progress(progress: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """Checkpoints (key, segments, bytes, total) that still fit: the chapter's number of segments is unchanged."""
    return progress.join(totals.select(key, F.col("total").alias("_t")), key).where("total = _t").drop("_t")


def rates(progress: DataFrame, done: str, total: str, seconds: str) -> DataFrame:
    """Rate and seconds left by progress rows."""
    rate = F.col(done) / F.when(F.col(seconds) > 0, F.col(seconds))
    return progress.withColumn("rate", rate).withColumn("eta_s", (F.col(total) - F.col(done)) / F.when(F.col("rate") > 0, F.col("rate")))
