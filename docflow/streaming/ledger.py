"""A ledger of rendered segments: what is in it is never rendered again, whatever failed beside it.

A run renders the segments that the ledger lacks and writes what it made as one entry, a folder named after the run.
Spark publishes an entry whole or not at all, and a run of the same name replaces its own entry, so commits are
idempotent. A segment counts as finished only if its text, its place in the chapter and the profile are those it was
rendered with; a chapter of another text starts over where it differs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import audio
from docflow.operators.keys import matched
from docflow.profiles import Profile

PLACE = ("para_no", "seg_no")


def _marked(segments: DataFrame, profile: Profile) -> DataFrame:
    return segments.withColumn("mark", F.xxhash64("seg", "ends_paragraph", F.lit(repr(profile))))


def finished(spark: SparkSession, path: str, segments: DataFrame, keys: list[str], profile: Profile) -> DataFrame | None:
    """The ledger's rows (keys, para_no, seg_no, mark, n_bytes, pcm) of these segments, once each; None if there is no ledger."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    own = [*keys, *PLACE, "mark"]
    rows = spark.read.parquet(path).where("n_bytes is not null")  # null where pcm is, which need not be read for it
    # A segment that two runs have rendered counts once: by the first run's name.
    first = rows.groupBy(*own).agg(F.min("run").alias("run"))
    rows = matched(rows, first, [*own, "run"], "left_semi")
    return matched(rows, _marked(segments, profile).select(*own), own, "left_semi").select(*own, "n_bytes", "pcm")


def render(segments: DataFrame, keys: list[str], profile: Profile, path: str, make_voice: Callable[[], Callable] = audio.Tone, run: str | None = None, tries: int = 20, pause_s: float = 0.0) -> DataFrame:
    """Renders the segments that the ledger at path lacks, as one entry, and returns the run's failures: keys, n_failed, error."""
    spark = segments.sparkSession
    run = run or uuid.uuid4().hex
    todo, done = _marked(segments, profile), finished(spark, path, segments, keys, profile)
    if done is not None:
        todo = matched(todo, done.select(*keys, *PLACE, "mark"), [*keys, *PLACE, "mark"], "left_anti")
    said = audio.synthesise(todo, profile, make_voice, tries, pause_s)
    said.select(*keys, *PLACE, "mark", F.octet_length("pcm").cast("long").alias("n_bytes"), "pcm", "error").write.mode("overwrite").parquet(f"{path}/run={run}")
    entry = spark.read.parquet(f"{path}/run={run}")
    return audio.failed(entry, keys)


def complete(segments: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_segs and n_bytes of the chapters whose segments are all finished."""
    want = segments.groupBy(*keys).agg(F.count("*").alias("n_segs"))
    have = done.groupBy(*keys).agg(F.count("*").alias("n_done"), F.sum("n_bytes").alias("n_bytes"))
    return matched(want, have, keys).where("n_segs = n_done").drop("n_done")
