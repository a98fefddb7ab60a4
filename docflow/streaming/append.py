"""Rendering a stream of segments into growing files, one a chapter, that survive a kill at any moment.

State keeps for every chapter how many segments and bytes are confirmed, and the chapter's total. A batch first cuts the
chapter's file back to the confirmed bytes, so what a killed attempt had written behind them goes; then it appends the
segments that follow, in order, and syncs the file. State is committed with the batch, so a batch that is run again
starts from the same bytes. Segments that come before their turn wait in the state. If the total of a chapter
changes, its text is another one: it starts over. The files lie in a folder that driver and executors share.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from docflow.functions import audio
from docflow.profiles import SAMPLE_RATE, Profile
from docflow.sources.ranges import local

#: What the stream's rows must have, and what comes out.
INPUT, OUTPUT = "chapter string, seq long, total long, seg string, ends_paragraph boolean", "chapter string, segments long, bytes long, total long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Appender(StatefulProcessor):
    def __init__(self, folder: str, profile: Profile, make_voice: Callable[[], Callable]):
        self.folder, self.profile, self.make_voice, self.voice = folder, profile, make_voice, None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.confirmed = handle.getValueState("confirmed", "segments long, bytes long, total long")
        self.waiting = handle.getMapState("waiting", "seq long", "seg string, ends_paragraph boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        segments, size, total = self.confirmed.get() or (0, 0, None)
        path = os.path.join(self.folder, f"{key[0]}.raw")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "r+b" if os.path.exists(path) else "w+b") as f:
            f.truncate(size)
            f.seek(size)
            held = self.waiting.exists()
            for p in rows:
                here: dict[int, tuple] = {}
                for seq, now, seg, last in zip(p["seq"], p["total"], p["seg"], p["ends_paragraph"]):
                    if total != now:  # another text
                        segments, size, total, held, here = 0, 0, int(now), False, {}
                        self.waiting.clear()
                        f.truncate(0)
                        f.seek(0)
                    if seq >= segments:
                        here[int(seq)] = (seg, bool(last))
                while some := self._next(segments, here, held):
                    for x, last in zip(audio.speak_with_retries(self._voice(), [s for s, _ in some]), [e for _, e in some]):
                        size += f.write(audio.pcm_bytes(x) + audio.silence(last, self.profile))
                    segments += len(some)
                for seq, row in here.items():  # only what comes before its turn goes into the state
                    self.waiting.updateValue((seq,), row)
                    held = True
            f.flush()
            os.fsync(f.fileno())
        self.confirmed.update((segments, size, total))
        yield pd.DataFrame([[key[0], segments, size, total]], columns=["chapter", "segments", "bytes", "total"])

    def _next(self, at: int, here: dict[int, tuple], held: bool) -> list[tuple]:
        """A batch of the segments that follow, taken from the rows that are here or, if it holds some, from the state."""
        out = []
        while len(out) < self.profile.batch:
            n = at + len(out)
            if held and self.waiting.containsKey((n,)):
                row = tuple(self.waiting.getValue((n,)))
                self.waiting.removeKey((n,))
                row = here.pop(n, row)  # a row that comes again replaces what waited
            elif n in here:
                row = here.pop(n)
            else:
                break
            out.append(row)
        return out

    def _voice(self) -> Callable:
        self.voice = self.voice or self.make_voice()
        return self.voice

    def close(self) -> None:
        pass


def append(spark: SparkSession, source: str, out: str, checkpoint: str, profile: Profile, make_voice: Callable[[], Callable] = audio.Tone, files_at_once: int = 1) -> None:
    """Appends what is new under source (Parquet files of INPUT) to out/audio, notes the progress in out/progress, and returns when all is done."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        stream = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", files_at_once).parquet(source).where("chapter is not null and seq is not null and total is not null and seg is not null")
        said = stream.groupBy("chapter").transformWithStateInPandas(Appender(os.path.join(local(out), "audio"), profile, make_voice), outputStructType=OUTPUT, outputMode="Update", timeMode="None")

        def note(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{out}/progress/batch={batch}")

        said.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(note).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def progress(spark: SparkSession, out: str) -> DataFrame:
    """chapter, segments, bytes and total as last noted."""
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{out}/progress")
    last = rows.groupBy("chapter").agg(F.max_by(F.struct("segments", "bytes", "total"), "batch").alias("x"))
    return last.select("chapter", "x.*")
