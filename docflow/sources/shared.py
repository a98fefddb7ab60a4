"""The folder that driver and executors share: tables written there cut the lineage and survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a folder of our own on a local master; an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not spark.sparkContext.getCheckpointDir():
        own = tempfile.mkdtemp(prefix="docflow-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new(spark: SparkSession, name: str) -> str:
    """A path below it that nothing else uses, until sweep()."""
    path, passing_now = f"{folder(spark)}/docflow-{name}-{uuid.uuid4().hex}", _PASSING.get()
    (_MADE if passing_now is None else passing_now).append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """What new() gives inside, to this thread, is deleted at the end; nothing that is needed later may read there."""
    made: list[str] = []
    before = _PASSING.set(made)
    try:
        yield made
    finally:
        _PASSING.reset(before)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> bool:
    """Whether there was something at the path, which is now gone."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def sweep(spark: SparkSession) -> None:
    """Deletes what new() gave to this process; call it when no result that reads there is needed any more."""
    while _MADE:
        delete(spark, _MADE.pop())


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, from a table written in the shared folder."""
    path = new(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
