"""The run modes over small books."""

import json

from docflow.__main__ import main
from docflow.functions import audio

BOOK = "front words\n\n## 1. One\n\nFirst sentence. Second one.\n\n## Contents 2. Two\n\nshort\n\n## 2. Two\n\nThird sentence of the book."


def test_modes(spark, tmp_path, capsys):
    (tmp_path / "book.md").write_text(BOOK)
    book, out = str(tmp_path / "book.md"), str(tmp_path / "out")
    assert main([book, out, "--list-chapters"], spark) == 0
    said = [line.split("\t")[1:] for line in capsys.readouterr().out.splitlines()]
    assert said == [["part", "num", "title", "n_words"], ["0", "0", "Introduction", "2"], ["1", "1", "One", "6"], ["3", "2", "Two", "7"]]  # of two with one number, the longer
    assert main([book, out, "--dry-run"], spark) == 0
    assert "audio_hours" in capsys.readouterr().out
    assert main([book, out, "--chapter-number", "9"], spark) == 1
    assert main([book, out, "--chapter", "1"], spark) == 0
    assert [r["file"] for r in spark.read.parquet(f"{out}/finished").collect()] == ["book/001_one.wav"]
    assert main([book, out], spark) == 0  # the finished one is skipped
    rows = {r["part"]: r for r in spark.read.parquet(f"{out}/finished").collect()}
    wavs = {p: (tmp_path / "out" / "chapters" / r["file"]).read_bytes() for p, r in rows.items()}
    assert sorted(rows) == [0, 1, 3] and all(w[:4] == b"RIFF" and len(w) == 44 + rows[p]["n_bytes"] for p, w in wavs.items())
    assert main([book, out, "--merge-only"], spark) == 0
    assert (tmp_path / "out" / "books" / "book.wav").read_bytes() == audio.wav_bytes(b"".join(wavs[p][44:] for p in sorted(wavs)))
    at = 0
    for r in spark.read.parquet(f"{out}/manifest").orderBy("place").collect():
        assert r["start"] == at
        at += rows[r["part"]]["n_bytes"]
    assert spark.read.parquet(f"{out}/failed").count() == 0


def test_kinds_of_books(spark, tmp_path, capsys):
    (tmp_path / "bold.md").write_text("x\n## **INTRODUCTION**\nfirst\n## **“Next”**\nsecond\n## **Photographs**\nlost")
    (tmp_path / "paged.md").write_text("<!--PAGE:1-->Cover<!--PAGE:2-->One [ 3 ] text.<!--PAGE:3-->Two<!--PAGE:3-->Two again.<!--PAGE:4-->end")
    (tmp_path / "paged.json").write_text(json.dumps([{"num": 2, "label": "b", "title": "B", "start_page": 3, "end_page": 4}, {"num": 1, "label": "a", "title": "A", "start_page": 2, "end_page": 2}]))

    def listed(*args):
        assert main([*args, "--list-chapters"], spark) == 0
        return [line.split("\t")[1:] for line in capsys.readouterr().out.splitlines()[1:]]

    out = str(tmp_path / "out")
    assert listed(str(tmp_path / "bold.md"), out, "--profile", "bold_single") == [["1", "0", "INTRODUCTION", "2"], ["2", "1", "“Next”", "2"]]
    assert listed(str(tmp_path / "bold.md"), out, "--profile", "bold_batch")[1] == ["2", "1", "Next", "2"]
    assert listed(str(tmp_path / "paged.md"), out, "--profile", "pages", "--maps", str(tmp_path / "paged.json")) == [["0", "2", "B", "2"], ["1", "1", "A", "2"]]
    assert main([str(tmp_path / "bold.md"), str(tmp_path / "chunks"), "--chunk-tokens", "4", "--overlap", "1"], spark) == 0
    assert "n_chunks" in capsys.readouterr().out and spark.read.json(str(tmp_path / "chunks")).count() > 3
