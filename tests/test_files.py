"""Files by byte ranges, paged documents, the encoder, the ledger and the appending stream."""

import json
import os
import random
import struct

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.functions import audio, codec
from docflow.operators import segments
from docflow.profiles import PROFILES
from docflow.sources import books, paged, ranges, shared
from docflow.streaming import append, ledger

PROFILE = PROFILES["bold_single"]


class Counted(paged.FormFeeds):
    """Notes every page that it extracts."""

    def __getitem__(self, page):
        with open(os.path.join(os.path.dirname(self.file.name), "..", "seen"), "a") as f:
            f.write(f"{os.path.basename(self.file.name)} {page}\n")
        text = super().__getitem__(page)
        if text == "bad page":
            raise ValueError("unreadable")
        return text


def extract_badly(path):
    raise OSError("not a document")


def rows_of(spark, parts):
    return spark.createDataFrame(parts, "book string, n int, text string").repartition(4)


def test_texts_in_ranges(spark, tmp_path):
    rng, want = random.Random(0), {}
    parts = [(b, i, rng.choice([None, "", "é", "word " * rng.randint(1, 400)])) for b in ("a", "b", "deep/c") for i in range(50)]
    for b, _, t in parts:
        want.setdefault(b, []).append(t or "")
    at = str(tmp_path / "books")
    ranges.write_texts(rows_of(spark, [*parts, (None, 1, "lost")]), "book", ["n"], "text", at, between="\n--\n")
    assert {b: open(f"{at}/{b}", encoding="utf-8").read() for b in want} == {b: "\n--\n".join(t) for b, t in want.items()}
    ranges.write_texts(rows_of(spark, [("a", 1, "x"), ("a", 2, "y")]), "book", ["n"], "text", at, between="")
    assert os.listdir(at) == ["a"] and open(f"{at}/a").read() == "xy" and os.listdir(tmp_path) == ["books"]


def test_books_are_plain_files_in_folders_of_their_own(spark, tmp_path):
    rows = [("a b", "é\nx\n"), ("c/d: 1%{é}", "two"), (None, None), ("x", "")]
    at = str(tmp_path / "out")
    for path in (at, f"file://{at}"):  # what was there is replaced
        books.write_books(spark.createDataFrame(rows, "`a book` string, text string").repartition(3), "a book", "text", path)
        assert {x for _, _, names in os.walk(at) for x in names} == {"part.txt"}
        assert sorted(map(repr, ((r["a book"], r["text"]) for r in books.read_books(spark, path, "a book").collect()))) == sorted(map(repr, [(k, t or "") for k, t in rows]))
    spark.createDataFrame(rows, "`a book` string, text string").repartition(1).write.partitionBy("a book").text(str(tmp_path / "spark"))
    assert sorted(os.listdir(at)) == sorted(x for x in os.listdir(tmp_path / "spark") if "=" in x)


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    at, key = str(tmp_path / "out"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    books.write_books(spark.range(120).selectExpr("id as k", "'x' as t"), "k", "t", at)
    before = spark.conf.get(key)
    for read in (lambda: books.listing(spark, at, "*.txt"), lambda: books.whole_texts(spark, at), lambda: books.read_books(spark, at, "k")):
        spark.sparkContext.setJobGroup("listing", "")
        first = len(spark.sparkContext.statusTracker().getJobIdsForGroup("listing"))
        assert read().count() == 120 and spark.conf.get(key) == before
        tracker = spark.sparkContext.statusTracker()
        jobs = sorted(tracker.getJobIdsForGroup("listing"))[first:]
        stages = [tracker.getStageInfo(i) for j in jobs for i in tracker.getJobInfo(j).stageIds]
        assert max(x.numTasks for x in stages if x) < 120
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_json_arrays_in_ranges(spark, tmp_path):
    parts = [("a", i, f'"{i}" é') for i in range(40)] + [("b", 1, "one")]
    ranges.write_json_arrays(rows_of(spark, parts), "book", ["n"], ["n", "text"], str(tmp_path / "maps"))
    got = {b: json.load(open(tmp_path / "maps" / b, encoding="utf-8")) for b in ("a", "b")}
    assert got == {"a": [{"n": i, "text": f'"{i}" é'} for i in range(40)], "b": [{"n": 1, "text": "one"}]}


def test_wavs_equal_plain_concatenation(spark, tmp_path):
    rng, parts, want = random.Random(1), [], {}
    for b in range(4):
        for i in range(30):
            parts.append((f"{b}.wav", i, rng.randbytes(2 * rng.randint(0, 3000))))
            want[f"{b}.wav"] = want.get(f"{b}.wav", b"") + parts[-1][2]
    at = str(tmp_path / "audio")
    ranges.write_wavs(spark.createDataFrame(parts, "f string, i int, pcm binary").repartition(6), "f", ["i"], "pcm", at)
    assert {f: open(f"{at}/{f}", "rb").read() for f in os.listdir(at)} == {f: audio.wav_bytes(x) for f, x in want.items()}
    got = ranges.read_ranges(spark, at, row_bytes=1000, part_bytes=5000).where("name = '1.wav'").orderBy("start").collect()
    assert b"".join(bytes(r["data"]) for r in got) == audio.wav_bytes(want["1.wav"]) and max(len(r["data"]) for r in got) == 1000


def test_silence_takes_no_disk(spark, tmp_path):
    parts, want = [], {}
    for b in range(3):
        for i in range(60):
            parts.append((f"{b}.wav", i, b"\1\2" * (100 + i) + bytes(24000) if i % 20 else None if i else bytes(30000)))
            want[f"{b}.wav"] = want.get(f"{b}.wav", b"") + (parts[-1][2] or b"")
    at, made = str(tmp_path / "audio"), lambda: {x for x in os.listdir(ranges.local(shared.folder(spark))) if x.startswith("docflow-")}
    before = made()
    ranges.write_wavs(spark.createDataFrame(parts, "f string, i int, pcm binary").repartition(6), "f", ["i"], "pcm", at)
    assert {f: open(f"{at}/{f}", "rb").read() for f in os.listdir(at)} == {f: audio.wav_bytes(x) for f, x in want.items()}
    assert sum(os.stat(f"{at}/{f}").st_blocks * 512 for f in want) < 0.5 * sum(map(len, want.values()))
    assert made() == before  # tables made on the way are gone


def test_wavs_of_deflated_pcm(spark, tmp_path):
    class Fussy(audio.Steps):
        def __call__(self, texts):
            if "bad" in texts:
                raise ValueError("bad")
            return super().__call__(texts)

    rows = spark.createDataFrame([("a.wav", 0, i, t, i == 2) for i, t in enumerate(["one", "bad", "three"])], "f string, para_no int, seg_no int, seg string, ends_paragraph boolean")
    said, plain = (audio.synthesise(rows, PROFILE, Fussy, deflate=x) for x in (True, False))
    assert sorted(said.select("seg_no", "n_pcm", "error").collect()) == sorted(plain.select("seg_no", F.octet_length("pcm").cast("long"), "error").collect())
    assert said.agg(F.max(F.octet_length("pcm"))).first()[0] < 200
    for at, x, size in (("deflated", said, "n_pcm"), ("plain", plain, None)):
        ranges.write_wavs(x, "f", ["para_no", "seg_no"], "pcm", str(tmp_path / at), size=size)
    assert (tmp_path / "deflated" / "a.wav").read_bytes() == (tmp_path / "plain" / "a.wav").read_bytes()
    with pytest.raises(Exception):
        ranges.write_wavs(said.withColumn("n_pcm", F.col("n_pcm") + 2), "f", ["para_no", "seg_no"], "pcm", str(tmp_path / "wrong"), size="n_pcm")
    assert not (tmp_path / "wrong").exists()


def test_pcm_of_wavs_is_dealt_once(spark, tmp_path, monkeypatch):
    parts, dealt = [(f"{i % 50}.wav", i, b"\1\2" * (1 + i % 7)) for i in range(1000)], []
    rows = spark.createDataFrame(parts, "f string, i int, pcm binary").repartition(6)
    writer = type(rows.write)
    save = writer.save

    def seen(self, *a, **k):
        if self._df.columns == ["name", "start", "total", "data"]:
            dealt.append((self._df._jdf.queryExecution().optimizedPlan().toString(), self._df.rdd.map(lambda r: r["name"]).glom().collect()))
        return save(self, *a, **k)

    monkeypatch.setattr(writer, "save", seen)
    ranges.write_wavs(rows, "f", ["i"], "pcm", str(tmp_path / "audio"))
    (plan, names), = dealt
    assert "Repartition" not in plan and plan.count("Join") == 1  # with the broadcast sums of partitions
    assert sum(sum(a != b for a, b in zip(p, p[1:])) + 1 for p in names if p) <= 50 + 2 * len(names)


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9000)), max_size=6), st.integers(0, 9000))
@settings(max_examples=200, deadline=None)
def test_what_is_no_hole_is_written(runs, start):
    piece = b"".join(bytes(n) if kind else b"\7" * n for kind, n in runs)
    got, block = bytearray(len(piece)), ranges.BLOCK
    for a, b in ranges._spoken(memoryview(piece), start):
        got[a:b] = piece[a:b]
        whole = range(a + -(start + a) % block, b - block + 1, block)
        assert a < b and all(any(piece[x:x + block]) for x in whole)
    assert bytes(got) == piece


def test_headers_of_large_files():
    assert len(audio.wav_header(10)) == audio.WAV_HEADER and len(audio.wav_header(1 << 33)) == audio.RF64_HEADER
    head = audio.wav_header(1 << 33)
    assert head[:4] == b"RF64" and struct.unpack_from("<QQQ", head, 20) == (72 + (1 << 33), 1 << 33, 1 << 32) and head[-8:-4] == b"data"


def test_a_file_with_a_gap_is_not_published(spark, tmp_path):
    at = str(tmp_path / "out")
    ranges.write_ranges(spark.createDataFrame([("a", 0, 3, b"old")], "name string, start long, total long, data binary"), at)
    for bad in ([("a", 0, 9, b"new")], [("a", 0, 3, b"new"), ("a", 3, 4, b"x")], [("../a", 0, 3, b"new")]):
        with pytest.raises(Exception):
            ranges.write_ranges(spark.createDataFrame(bad, "name string, start long, total long, data binary").repartition(2), at)
    assert os.listdir(tmp_path) == ["out"] and open(f"{at}/a").read() == "old"
    with pytest.raises(ValueError):
        ranges.local("s3://bucket/x")


def test_a_file_whose_total_is_wrong_or_missing_is_not_published(spark, tmp_path):
    at, kind = str(tmp_path / "out"), "name string, start long, total long, data binary"
    zeros = bytes(5000)
    ranges.write_ranges(spark.createDataFrame([("a", 0, 10001, b"x"), ("a", 1, None, zeros), ("a", 5001, None, zeros)], kind).repartition(3), at)
    assert open(f"{at}/a", "rb").read() == b"x" + zeros + zeros
    for bad in ([("a", 0, None, b"new")], [("a", 0, 9, b"new"), ("a", 0, None, b"new"), ("a", 3, None, b"new")], [("a", 0, 4, b"ab"), ("a", 4, None, bytes(2))], [("a", 0, 4, b"ab"), ("a", 2, 5, b"cd")]):
        with pytest.raises(Exception):
            ranges.write_ranges(spark.createDataFrame(bad, kind).repartition(2), at)
    assert os.listdir(tmp_path) == ["out"] and os.path.getsize(f"{at}/a") == 10001


def test_many_files_are_few_partitions_and_opened_once(spark, tmp_path, monkeypatch):
    rows = [(f"{i % 300}.raw", i // 300 * 2, 8, b"xy") for i in range(1200)]
    at = str(tmp_path / "many")
    ranges.write_ranges(spark.createDataFrame(rows, "name string, start long, total long, data binary").repartition(8), at)
    got = ranges.read_ranges(spark, at, row_bytes=4)
    assert got.count() == 600 and got.rdd.getNumPartitions() < 20
    monkeypatch.setattr(ranges, "PARTS", 10)
    reader = ranges.RangeReader({"path": at, "row_bytes": "4", "part_bytes": "4"})
    assert len(reader.partitions()) <= 11 and sum(e - s for p in reader.partitions() for _, s, e in p.pieces) == 2400
    dealt = []
    monkeypatch.setattr(type(got.write), "save", lambda self: dealt.append(self._df))
    ranges.write_ranges(spark.createDataFrame(rows, "name string, start long, total long, data binary").repartition(8), at)
    names = dealt[0].rdd.map(lambda r: r["name"]).glom().collect()
    assert sum(sum(a != b for a, b in zip(p, p[1:])) + 1 for p in names if p) < 300 + len(names)


class State:
    """What the appender keeps, in memory; counts what goes into the waiting rows."""

    def __init__(self):
        self.value, self.map, self.puts = None, {}, 0

    def getValueState(self, *a):
        return self

    getMapState = getValueState
    get = lambda self: self.value
    update = lambda self, v: setattr(self, "value", v)
    exists = lambda self: bool(self.map)
    containsKey = lambda self, k: k in self.map
    getValue = lambda self, k: self.map[k]
    removeKey = lambda self, k: self.map.pop(k)
    clear = lambda self: self.map.clear()

    def updateValue(self, k, v):
        self.map[k], self.puts = v, self.puts + 1


def test_only_segments_before_their_turn_go_into_the_state(tmp_path):
    texts = [f"segment {i}" for i in range(40)]
    rows = pd.DataFrame(chapter_rows("one", texts), columns=["chapter", "seq", "total", "seg", "ends_paragraph"])
    state, a = State(), append.Appender(str(tmp_path), PROFILE, audio.Steps)
    a.init(state)
    list(a.handleInputRows(("one",), iter([rows.iloc[[3, 1, 0, 2]], rows.iloc[[6, 5, 20]]]), None))
    assert state.puts == 3 and state.value[0] == 4
    list(a.handleInputRows(("one",), iter([rows.iloc[4:20].sample(frac=1, random_state=1), rows.iloc[21:]]), None))
    assert state.puts == 3 and state.value == (40, len(plain_audio(texts)), 40) and not state.map
    assert (tmp_path / "one.raw").read_bytes() == plain_audio(texts)
    other = pd.DataFrame(chapter_rows("one", ["new", "text"]), columns=rows.columns)
    list(a.handleInputRows(("one",), iter([rows.iloc[:2], other]), None))
    assert (tmp_path / "one.raw").read_bytes() == plain_audio(["new", "text"]) and state.value[0] == 2


def test_only_the_pages_asked_for_are_extracted(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.txt").write_text("\f".join(f"page {i}" for i in range(1, 21)))
    (docs / "b.txt").write_text("one\fbad page\fthree")
    (docs / "empty.txt").write_text("")
    read = lambda: paged.document_pages(spark, str(docs), "*.txt", "tests.test_files:Counted", part_bytes=40)
    asked = read().where("page >= 2 and page < 4")
    assert "Filter " not in asked._jdf.queryExecution().executedPlan().toString()  # none is left above the scan
    got = {(r["path"].split("/")[-1], r["page"], r["text"], r["error"]) for r in asked.collect()}
    assert got == {("a.txt", 2, "page 2", None), ("a.txt", 3, "page 3", None), ("b.txt", 2, None, "ValueError: unreadable"), ("b.txt", 3, "three", None)}
    assert sorted(set((tmp_path / "seen").read_text().split("\n"))) == ["", "a.txt 2", "a.txt 3", "b.txt 2", "b.txt 3"]
    assert read().rdd.getNumPartitions() > 3 and read().count() == 24
    assert sorted(r["page"] for r in read().where("page in (1, 20, 99)").collect()) == [1, 1, 1, 20]
    bad = paged.document_pages(spark, str(docs), "b.txt", "tests.test_files:extract_badly").collect()
    assert [(r["page"], r["error"]) for r in bad] == [(None, "OSError: not a document")]


@given(st.lists(st.integers(-32768, 32767), max_size=60), st.integers(0, 3), st.booleans())
@settings(max_examples=200, deadline=None)
def test_codec_round_trip(samples, smooth, odd):
    x = np.clip(np.cumsum(np.array(samples or [0]), axis=0) if smooth else np.array(samples), -32768, 32767)
    raw = x.astype("<i2").tobytes() * (1 + 40 * smooth) + b"\x07" * odd
    assert codec.LinearRice().decode(codec.LinearRice().encode(raw)) == raw


def test_silence_costs_the_codec_next_to_nothing(monkeypatch):
    raw, blocks = audio.pcm_bytes(audio.Steps()(["some text"])[0]) + audio.silence(True, PROFILE), []
    block, samples = codec._block, codec._samples
    codec.LinearRice().encode(raw)
    monkeypatch.setattr(codec, "_block", lambda x: blocks.append(len(x)) or block(x))
    monkeypatch.setattr(codec, "_samples", lambda c, at, n: blocks.append(n) or samples(c, at, n))
    assert codec.LinearRice().decode(codec.LinearRice().encode(raw)) == raw
    assert blocks == [codec.BLOCK, codec.BLOCK]  # of three blocks only the spoken one is computed, once each way


def test_pcm_is_passed_on_in_pieces_and_deflated_before_it_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(audio, "OUT_BYTES", 100_000)
    rows = spark.createDataFrame([(1, 0, i, "some text", i == 99) for i in range(100)], "k int, para_no int, seg_no int, seg string, ends_paragraph boolean").coalesce(1)
    said = audio.synthesise(rows, PROFILE, audio.Steps)
    # The function as the plan runs it: one batch of 100 rows comes out in several.
    made = []
    monkeypatch.setattr(type(rows), "mapInPandas", lambda self, f, schema: made.append(f) or self)
    audio.synthesise(rows, PROFILE, audio.Steps)
    out = list(made[0](iter([rows.toPandas()])))
    assert len(out) > 4 and max(p["pcm"].map(len).sum() for p in out) < 110_000 and sum(len(p) for p in out) == 100
    assert pd.concat(out)["seg_no"].tolist() == list(range(100)) and b"".join(pd.concat(out)["pcm"]) == plain_audio(["some text"] * 100)
    packed = said.select("seg_no", audio.deflated("pcm").alias("pcm"))
    assert packed.agg(F.max(F.octet_length("pcm"))).first()[0] < 500
    assert audio.inflated(packed, "pcm").exceptAll(said.select("seg_no", "pcm")).count() == 0
    plan = books.audio_files(said, ["k"], ["para_no", "seg_no"])
    assert bytes(plan.first()["wav"]) == audio.wav_bytes(plain_audio(["some text"] * 100))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("FlatMapGroupsInPandas") < text.index("deflated(")


def test_codec_shrinks_a_tone():
    raw = audio.pcm_bytes(audio.Tone()(["a tone of some length" * 20])[0])
    assert len(codec.LinearRice().encode(raw)) < 0.5 * len(raw)


def test_transcoding_keeps_the_source_unless_all_is_sound(spark, tmp_path):
    rows = spark.createDataFrame([(1, audio.pcm_bytes(np.sin(np.arange(9000) / 50))), (2, None), (3, b"")], "`seg no` int, pcm binary")
    rows.write.parquet(str(tmp_path / "pcm"))

    class Lossy(codec.LinearRice):
        def encode(self, pcm):
            return super().encode(pcm[:-2])

    with pytest.raises(Exception):
        codec.transcode(spark, str(tmp_path / "pcm"), str(tmp_path / "bad"), encoder=Lossy)
    assert (tmp_path / "pcm").exists()
    out = codec.transcode(spark, str(tmp_path / "pcm"), str(tmp_path / "coded"))
    assert not (tmp_path / "pcm").exists()
    got = {r["seg no"]: r for r in codec.decoded(out).collect()}
    assert bytes(got[1]["pcm"]) == audio.pcm_bytes(np.sin(np.arange(9000) / 50)) and got[2]["pcm"] is None and bytes(got[3]["pcm"]) == b"" and all(r["sound"] for r in got.values())


def voice_that_notes(folder, fails):
    """A voice that notes what it is asked; texts with `bad` fail as long as the folder has a file of the name in fails."""

    def make():
        def voice(texts):
            with open(f"{folder}/asked", "a") as f:
                f.write("".join(f"{t}\n" for t in texts))
            if any("bad" in t for t in texts) and os.path.exists(f"{folder}/{fails}"):
                raise OSError("no voice")
            return audio.Steps()(texts)

        return voice

    return make


def test_a_failed_chapter_resumes_at_its_missing_segment(spark, tmp_path):
    book = spark.createDataFrame([(1, "Good one. Good two. A bad one. Good three."), (None, "Other.")], "k int, t string")
    segs = segments.segments(book, ["k"], "t", 12)
    (tmp_path / "broken").write_text("")
    at, voice = str(tmp_path / "ledger"), voice_that_notes(tmp_path, "broken")
    bad = ledger.render(segs, ["k"], PROFILE, at, voice, tries=1).collect()
    assert [(r["k"], r["n_failed"]) for r in bad] == [(1, 1)]
    done = ledger.finished(spark, at, segs, ["k"], PROFILE)
    assert [r["k"] for r in ledger.complete(segs, done, ["k"]).collect()] == [None]
    (tmp_path / "broken").unlink()
    (tmp_path / "asked").unlink()
    assert ledger.render(segs, ["k"], PROFILE, at, voice, run="again").count() == 0
    assert (tmp_path / "asked").read_text() == "A bad one.\n"  # the rest isn't rendered again
    ledger.render(segs, ["k"], PROFILE, at, voice, run="again")  # the entry is replaced, not added to
    other = segments.segments(spark.createDataFrame([(1, "Good one. Changed.")], book.schema), ["k"], "t", 12)
    assert [r["seg_no"] for r in ledger.finished(spark, at, other, ["k"], PROFILE).collect()] == [0]  # of a changed text what is unchanged
    assert ledger.finished(spark, at, segs, ["k"], PROFILES["marked"]).count() == 0
    ledger.render(segs, ["k"], PROFILE, at, voice, run="whole")
    done = ledger.finished(spark, at, segs, ["k"], PROFILE)
    assert {r["k"]: r["n_segs"] for r in ledger.complete(segs, done, ["k"]).collect()} == {1: 4, None: 1}


def chapter_rows(name, texts, total=None):
    return [(name, i, total or len(texts), t, i == len(texts) - 1) for i, t in enumerate(texts)]


def plain_audio(texts):
    out = b""
    for i, t in enumerate(texts):
        rest = np.zeros(int(24_000 * (PROFILE.paragraph_s if i == len(texts) - 1 else PROFILE.sentence_s)), np.float32)
        out += audio.pcm_bytes(np.concatenate([audio.Steps()([t])[0], rest]))
    return out


def test_a_killed_batch_leaves_the_same_bytes(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    texts = [f"segment {i}" for i in range(4)] + ["a bad one", "the last one"]
    rows = chapter_rows("one", texts)

    def feed(some):
        spark.createDataFrame(some, append.INPUT).coalesce(1).write.mode("append").parquet(src)

    (tmp_path / "broken").write_text("")
    voice = voice_that_notes(tmp_path, "broken")
    feed([rows[1], rows[0]])
    append.append(spark, src, out, mark, PROFILE, voice)
    confirmed = os.path.getsize(f"{out}/audio/one.raw")
    assert open(f"{out}/audio/one.raw", "rb").read() == plain_audio(texts)[:confirmed]
    feed([rows[3], rows[2], rows[5], rows[4], *chapter_rows("two", ["other"])])
    with pytest.raises(Exception):
        append.append(spark, src, out, mark, PROFILE, voice)
    assert os.path.getsize(f"{out}/audio/one.raw") > confirmed  # what the killed batch left behind
    with open(f"{out}/audio/one.raw", "ab") as f:
        f.write(b"torn bytes")
    (tmp_path / "broken").unlink()
    append.append(spark, src, out, mark, PROFILE, voice)
    assert open(f"{out}/audio/one.raw", "rb").read() == plain_audio(texts) and open(f"{out}/audio/two.raw", "rb").read() == plain_audio(["other"])
    assert {tuple(r) for r in append.progress(spark, out).collect()} == {("one", 6, len(plain_audio(texts)), 6), ("two", 1, len(plain_audio(["other"])), 1)}
    feed(chapter_rows("one", ["another", "text"]))  # the total differs: it starts over
    append.append(spark, src, out, mark, PROFILE, voice)
    assert open(f"{out}/audio/one.raw", "rb").read() == plain_audio(["another", "text"])


def test_shared_folder(spark, tmp_path):
    at = shared.new(spark, "x")
    spark.range(3).write.parquet(at)
    shared.sweep(spark)
    assert not os.path.exists(ranges.local(at)) and not shared.delete(spark, at)

    class Cluster:
        sparkContext = type("Context", (), {"master": "spark://host", "getConf": lambda self: {}})()
        conf = type("Conf", (), {"get": lambda self, *a: None})()

    with pytest.raises(ValueError):  # a cluster's folder must be named
        shared.folder(Cluster())


def test_odd_column_names(spark):
    rows = spark.createDataFrame([(1, 0, 0, "some text", True)], "`book no` int, `para no` int, `seg no` int, seg string, ends_paragraph boolean")
    assert audio.synthesise(rows, PROFILE, audio.Steps).select(F.octet_length("pcm")).first()[0] == len(plain_audio(["some text"]))
