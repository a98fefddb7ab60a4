"""Hand-written cases: expected values follow from the rules."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.functions import audio, clean, titles
from docflow.operators import chunks, pages, schedule, sections, segments
from docflow.operators.running import running
from docflow.profiles import PROFILES
from docflow.sources import books
from docflow.streaming import resume


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "kind, text, wanted",
    [
        ("basic", "[a](b)", "a"), ("basic", "x`y`z", "xz"), ("basic", "a_b", "ab"), ("basic", "x—y", "x, y"), ("basic", "1920–30", "1920–30"), ("pages", "1920–30", "1920, 30"),
        ("pages", "end.[ 12 ]", "end."), ("basic", "ﬁ…", "fi..."), ("basic", "# T\n\n\n\nx", "T\n\nx"), ("basic", "==> A PICTURE Intentionally Omitted <==x", "x"), ("pages", "a  \tb", "a b"), ("basic", None, None), ("basic", " \n ", ""),
    ],
)
def test_clean(spark, kind, text, wanted):
    assert one(spark, text, lambda c: clean.clean(c, kind)) == wanted


def test_pack(spark):
    rows = spark.createDataFrame([(1, "aaaa. bbb. cccccc. d. eeeeeeeeeeeeeee. f."), (2, None), (3, "")], "k int, t string")
    got = segments.segments(rows, ["k"], "t", 10).orderBy("seg_no").collect()
    assert [r["seg"] for r in got] == ["aaaa. bbb.", "cccccc. d.", "eeeeeeeeeeeeeee.", "f."]
    assert [r["ends_paragraph"] for r in got] == [False, False, False, True]


def test_wrap_keeps_order():
    assert segments.wrap("ab, cdefg hijklm", 10) == ["ab,", "cdefg", "hijklm"]
    assert segments.wrap("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]


@given(st.text(alphabet="ab,;: ", max_size=80), st.integers(3, 20))
@settings(max_examples=200, deadline=None)
def test_wrap_is_whole(text, most):
    out = segments.wrap(text, most)
    assert "".join(out).replace(" ", "") == text.replace(" ", "")
    assert len(text) <= most or all(len(x) <= most for x in out)


def plain_pack(pieces, most):
    out = []
    for p in pieces:
        if out and len(out[-1]) + len(p) + 1 <= most:
            out[-1] += " " + p
        else:
            out.append(p)
    return out


def test_pack_against_plain(spark):
    rng = random.Random(1)
    rows = [(i, [f"{'x' * rng.randint(0, 40)}." for _ in range(rng.choice([1, 2, 30, 3000]))]) for i in range(30)]
    got = segments.segments(spark.createDataFrame([(i, " ".join(p)) for i, p in rows], "k int, t string"), ["k"], "t", 60).collect()
    for i, pieces in rows:
        assert [r["seg"] for r in sorted((r for r in got if r["k"] == i), key=lambda r: r["seg_no"])] == plain_pack(pieces, 60)


def test_long_paragraphs_take_linear_time(spark):
    texts = spark.range(1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(120_000)), lambda i: F.concat(F.lit("A sentence of sixty characters or so, that has the number "), i.cast("string"), F.lit("."))), " ").alias("t"))
    began = time.time()
    n, size = segments.segments(texts, ["id"], "t", 280).agg(F.count("*"), F.sum(F.length("seg"))).first()
    assert n >= 28_000 and time.time() - began < 60  # minutes, were it quadratic


def test_titles(spark):
    assert one(spark, "**NerdsAre**", lambda c: titles.spaced_title(F.translate(c, "*", ""))) == "Nerds Are"
    assert one(spark, "o'neil", titles.title_case) == "O'Neil"
    assert one(spark, "chapter 12 x", titles.chapter_number) == 12
    assert one(spark, "CHAPTER 1\n\n– The Start:\nx", lambda c: titles.page_title(c, F.lit("l"))) == "The Start"
    assert one(spark, "A b!", lambda c: titles.slug(c, F.lit(1234), trimmed=True)) == "1234_a_b"


def test_audio(spark):
    x = spark.createDataFrame([(v,) for v in (-2.0, -0.99999, 0.5, 1.5, float("nan"))], "x double").select(audio.to_pcm16(F.col("x")).alias("p"))
    assert [r["p"] for r in x.collect()] == [-32767, -32766, 16383, 32767, 0]
    calls = []

    def voice(texts):
        calls.append(len(texts))
        if len(texts) > 1 or len(texts[0]) > 6:
            raise MemoryError
        return [np.ones(len(t), np.float32) for t in texts]

    assert [len(a) for a in audio.speak_with_retries(voice, ["abcdef ghi", "ab"], tries=2)] == [9, 2]


def test_sections(spark):
    md = "before\n## 1. One\n\na b\n## 1. One\n\na b c\n## 300. Far\nz"
    rows = spark.createDataFrame([(1, md), (2, "no heading")], "k int, md string")
    s = sections.sections(rows, ["k"], "md", "numbered")
    assert sorted((r["k"], r["num"], r["title"], r["body"]) for r in s.collect()) == [(1, 0, "Introduction", "before"), (1, 1, "One", "a b"), (1, 1, "One", "a b c"), (2, 0, "Introduction", "no heading")]
    assert sorted(r["body"] for r in sections.best_by_key(s, ["k"], "num", "body", "part").collect()) == ["a b c", "before", "no heading"]
    both = sections.best_by_key(sections.sections(spark.createDataFrame([(None, md), (None, None)], "k int, md string"), ["k"], "md", "numbered"), ["k"], "num", "body", "part")
    assert sorted(r["body"] for r in both.collect()) == ["a b c", "before"]
    long = " ".join(["word"] * 29)
    book = spark.createDataFrame([(1, f"front\n# Heading\n{long}\n## Stub\nfew\n### {'x' * 81}\n{long} {long}"), (2, "no heading"), (3, f"# Two words\n{long[5:]}"), (4, f"# One\n{long[5:]}"), (5, "")], "k int, md string")
    assert sorted((r["k"], r["num"], r["title"], r["body"][:9]) for r in sections.sections(book, ["k"], "md", "any", whole="Book").collect()) == [(1, 0, "Introduction", "front"), (1, 1, "Heading", "word word"), (2, 0, "Book", "no headin"), (3, 0, "Two words", "word word")]
    bold = spark.createDataFrame([(2, "no heading"), (3, "x\n## **Notes**\ny"), (1, "x\n## **A**\nx\n## **12**\ny\n## **Notes**\nz\n## **B**\nw")], "k int, md string")
    assert sorted((r["k"], r["num"], r["title"], r["body"]) for r in sections.sections(bold, ["k"], "md", "bold").collect()) == [(1, 0, "A", "x\n## **12**\ny\n## **Notes**\nz"), (1, 1, "B", "w"), (2, 0, "Introduction", "no heading")]
    curly = spark.createDataFrame([(1, "## **“A”**\nx\n## **“Notes”**\ny")], "k int, md string")
    assert [r["title"] for r in sections.sections(curly, ["k"], "md", "bold", marks=titles.CURLY).collect()] == ["A"]
    assert [r["title"] for r in sections.sections(curly, ["k"], "md", "bold").orderBy("num").collect()] == ["“A”", "“Notes”"]


def test_numbers_beyond_an_int(spark):
    rows = spark.createDataFrame([(1, "## 99999999999. X\na\n## 2. Y\nb")], "k int, md string")
    assert [(r["num"], r["title"]) for r in sections.sections(rows, ["k"], "md", "numbered").collect()] == [(2, "Y")]
    assert one(spark, "CHAPTER 99999999999", titles.chapter_number) == 0
    marked = spark.createDataFrame([(1, "<!--PAGE:99999999999-->x<!--PAGE:2-->y")], "k int, md string")
    assert [(r["page"], r["text"]) for r in pages.split_marked(marked, ["k"], "md").collect()] == [(None, "x"), (2, "y")]


def test_running_titles_and_footers_go(spark):
    rows = spark.createDataFrame([(1, "# Hackers & Painters\n# Nerds\nbody one\n# ***\n# Nerds\nbody two\n## Other"), (2, "no heading"), (3, "# A")], "k int, md string")
    got = sections.without_lines(rows, ["k"], "md", sections.elected_titles(rows, ["k"], "md"))
    assert {r["k"]: r["body"] for r in got.collect()} == {1: "body one\nbody two\n## Other", 2: "no heading", 3: ""}


def test_marked_book(spark):
    md = "x\n## _Note to readers_\nnote\n## Contents\nlist\n## Preface\npreface\n## _Chapter 1_\n## _WhyNerds_\none\n# Why Nerds\n## _Chapter 2_\ntwo\n## Notes\nend"
    rows = spark.createDataFrame([(1, md), (2, "## Preface\np\n## _Chapter 3_\nc")], "k int, md string")
    got = {(r["k"], r["num"], r["title"], r["body"]) for r in sections.sections(rows, ["k"], "md", "marked").collect()}
    assert got == {(1, 0, "Preface", "note\n\npreface"), (1, 1, "Why Nerds", "one"), (1, 2, "Chapter 2", "two"), (2, 3, "Chapter 3", "c")}


def test_numbered_over_spans(spark):
    rows = spark.createDataFrame([(k, i) for k in (1, 2) for i in (5, 70_000, 140_000, -3, 70_001)] + [(1, None)], "k int, i long")
    got = {(r["k"], r["i"]): r["n"] for r in schedule.numbered(rows, ["k"], ["i"], "n").collect()}
    assert got == {(1, None): 0} | {(1, x): n + 1 for n, x in enumerate([-3, 5, 70_000, 70_001, 140_000])} | {(2, x): n for n, x in enumerate([-3, 5, 70_000, 70_001, 140_000])}


def test_bad_texts_don_t_end_a_chapter(spark):
    def make():
        def voice(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [np.zeros(len(t), np.float32) for t in texts]

        return voice

    rows = spark.createDataFrame([(1, 0, 0, "good", False), (1, 0, 1, "bad", True), (2, 0, 0, "fine", True)], "k int, para_no int, seg_no int, seg string, ends_paragraph boolean").coalesce(1)
    said = audio.synthesise(rows, PROFILES["numbered_a"], make, tries=2)
    assert {(r["seg"], r["pcm"] is None, r["error"]) for r in said.collect()} == {("good", False, None), ("bad", True, "RuntimeError: the voice failed"), ("fine", False, None)}
    assert [(r["k"], r["n_failed"]) for r in audio.failed(said, ["k"]).collect()] == [(1, 1)]
    assert [r["k"] for r in books.audio_files(said, ["k"], ["para_no", "seg_no"]).collect()] == [2]


def test_first_input(spark, tmp_path):
    for name in ("b.txt", "a.txt", "usual.txt"):
        (tmp_path / name).write_text("x")
    first = lambda **k: (books.first_input(spark, str(tmp_path), "*.txt", **k) or "none").split("/")[-1]
    assert [first(), first(default="usual.txt"), first(default="absent.txt"), first(named="x"), books.first_input(spark, str(tmp_path), "*.md")] == ["a.txt", "usual.txt", "a.txt", "x", None]


def test_html(spark):
    page = "<html><script>x</script><h2>Title &amp; more</h2><p>One<br>two</p><!-- c --><div>three</div></html>"
    assert one(spark, page, books.html_to_markdown) == "## Title & more\n\nOne\ntwo\n\nthree"


def test_html_references(spark):
    page = "<title>cut &amp;&amp</title><p>&copy; &ampx; &#233;&#xe9; &amp;quot; &nosuch; &amp</p>\xa0"
    assert one(spark, page, books.html_to_markdown) == "cut &&amp\n\n© &ampx; éé &quot; &nosuch; &amp\n\n\xa0"


def test_overlap_of_chunks():
    class Words:
        exact = True
        weights, most, count = staticmethod(lambda ps: [len(p.split()) for p in ps]), staticmethod(lambda n: n), staticmethod(lambda t: len(t.split()))

    text = " ".join(f"w{i}" for i in range(200))
    got = chunks.split_tokens(text, 30, 10, Words)
    for a, b in zip(got, got[1:]):
        assert b.split()[:10] == a.split()[-10:]


def test_null_keys_are_a_key(spark):
    """No row of a null key is lost, and no text is emptied, by any operator."""
    rows = spark.createDataFrame([(None, i) for i in (3, 1, 2)] + [(1, 5), (1, None)], "k int, i long")
    assert sorted((str(r["k"]), str(r["i"]), r["n"]) for r in schedule.numbered(rows, ["k"], ["i"], "n").collect()) == [("1", "5", 1), ("1", "None", 0), ("None", "1", 0), ("None", "2", 1), ("None", "3", 2)]
    assert schedule.dealt(rows, ["k"], ["i"], 2).count() == schedule.batched(rows, ["k"], ["i"], 2).count() == 5
    assert schedule.nth_chapter(rows, ["k"], ["i"], 2).collect() == [(None, 3)]
    md = spark.createDataFrame([(None, "# A\nx\n# A\ny"), (1, "# B\nz")], "k int, md string")
    heads = sections.elected_titles(md, ["k"], "md")
    assert {r["k"]: r["body"] for r in sections.without_lines(md, ["k"], "md", heads).collect()} == {None: "x\ny", 1: "z"}
    assert {r["k"]: r["h1"] for r in sections.carried_headings(md, ["k"], "md").collect()} == {None: "A", 1: "B"}
    book = spark.createDataFrame([(None, "## _Chapter 1_\n## _One_\ntext")], "k int, md string")
    assert [tuple(r) for r in sections.sections(book, ["k"], "md", "marked").select("k", "num", "title", "body").collect()] == [(None, 1, "One", "text")]
    p = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), (None, None, "lost")], "book string, page int, text string")
    ch = spark.createDataFrame([(None, 1, 2)], "book string, start_page int, end_page int")
    assert [r["body"] for r in pages.chapters_from_pages(ch, p, ["book"]).collect()] == ["xy"]
    segs = segments.segments(spark.createDataFrame([(None, "One. Two.")], "k int, t string"), ["k"], "t", 5)
    assert [r["seg"] for r in segs.orderBy("seg_no").collect()] == ["One.", "Two."]
    assert [r["n_segs"] for r in schedule.dry_run(segs, ["k"]).collect()] == [2]
    assert [r["text"] for r in chunks.chunks(md, "k", "md").orderBy("text").collect()] == ["# A\nx", "# A\ny", "# B\nz"]


def test_running_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, *range(500)]), i, rng.choice([None, 1, 7])) for i in range(3000)]
    got = running(spark.createDataFrame(rows, "k string, x long, i long, n long").repartition(7), ["k"], ["x", F.desc("i")], {"before": "n", "place": None}).collect()
    sums, places = Counter(), Counter()
    want = {}
    for k, x, i, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[2])):
        want[i] = (sums[k], places[k])
        sums[k] += n or 0
        places[k] += 1
    assert {r["i"]: (r["before"], r["place"]) for r in got} == want
    assert running(spark.createDataFrame([], "k int, i int"), ["k"], ["i"], {"place": None}).collect() == []
    assert sorted(r["place"] for r in running(spark.range(1000).repartition(5), [], [F.desc("id")], {"place": None}).collect()) == list(range(1000))


def plain_split(text, size, overlap, counter, separators=chunks.SEPARATORS):
    """The chunker's rule, with sums taken anew at every step."""
    if counter.count(text) <= size:
        return [text] if text.strip() else []
    sep = next(s for s in separators if s == "" or s in text)
    weaker = separators[separators.index(sep) + 1:]
    pieces = [p for p in (list(text) if sep == "" else [p + sep for p in text.split(sep)[:-1]] + [text.split(sep)[-1]]) if p]
    weigh, most, back = (lambda ps: sum(counter.weights(ps))), counter.most(size), counter.most(overlap)
    out, held, fresh = [], [], 0
    for piece in pieces:
        if weigh([piece]) > most and weaker:
            out += ["".join(held)] * bool(fresh) + plain_split(piece, size, overlap, counter, weaker)
            held, fresh = [], 0
            continue
        if fresh and weigh([*held, piece]) > most:
            out.append("".join(held))
            while held and (weigh(held) > back or weigh([*held, piece]) > most):
                held.pop(0)
            fresh = 0
        held.append(piece)
        fresh += 1
    out += ["".join(held)] * bool(fresh)
    return [x.strip() for x in out if x.strip()]


@given(st.text(alphabet="ab .\n;é", max_size=300), st.integers(1, 12), st.integers(0, 6))
@settings(max_examples=150, deadline=None)
def test_split_against_plain(text, size, overlap):
    assert chunks.split_tokens(text, size, overlap) == plain_split(text, size, overlap, chunks.QUARTER)


def bpe_counter():
    tokenizers = pytest.importorskip("public_tokenizers")
    return chunks.BpeCounter(tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


def test_split_by_exact_tokens():
    counter, rng = bpe_counter(), random.Random(4)
    words = ["alpha", "beta,", "gamma.", "delta;", "epsilon\n\n", "zeta?", "internationalisation", "12345"]
    for _ in range(20):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 300)))
        got = chunks.split_tokens(text, 40, 10, counter)
        assert got == plain_split(text, 40, 10, counter) and all(counter.count(x) <= 40 for x in got)
    began = time.time()
    got = chunks.split_tokens(" ".join(rng.choice(words) for _ in range(160_000)), 800, 120, counter)  # over a megabyte
    assert time.time() - began < 30 and all(counter.count(x) <= 800 for x in got)
    assert "".join(chunks.split_tokens("x" * 5000, 50, 0, counter)) == "x" * 5000


def test_headings_reset(spark):
    rows = spark.createDataFrame([(1, "# A\nx\n## B\ny\n# C\nz")], "k int, md string")
    assert [(r["h1"], r["h2"]) for r in sections.carried_headings(rows, ["k"], "md").orderBy("sec_no").collect()] == [("A", None), ("A", "B"), ("C", None)]


def test_between(spark):
    assert one(spark, "a INTRO b END c", lambda c: sections.between(c, "INTRO", "END")) == "INTRO b "
    assert one(spark, "a b", lambda c: sections.between(c, "INTRO", "END")) == "a b"


def test_pages(spark):
    p = spark.createDataFrame([("b", 1, "x"), ("b", 2, "y"), ("b", 3, None)], "book string, page int, text string")
    ch = spark.createDataFrame([("b", 1, 2), ("b", 3, 2), ("b", 3, 3)], "book string, start_page int, end_page int")
    got = {(r["start_page"], r["end_page"]): r["body"] for r in pages.chapters_from_pages(ch, p, ["book"]).collect()}
    assert got == {(1, 2): "xy", (3, 2): "", (3, 3): ""}
    toc = spark.createDataFrame([("b", i, t, pg, 99) for i, (t, pg) in enumerate([("Cover", 1), ("Preface", 3), ("CHAPTER 1", 5), ("Index", 90)])], "book string, ord int, title string, page int, last_page int")
    m = pages.chapter_map(toc, ["book"], "last_page", "PREFACE", "INDEX").orderBy("start_page").collect()
    assert [(r["num"], r["start_page"], r["end_page"]) for r in m] == [(-2, 3, 4), (1, 5, 89)]


def test_chunks():
    text = "\n\n".join(f"Paragraph {i} has some words." for i in range(40))
    got = chunks.split_tokens(text, 50, 10)
    assert all(len(x) // 4 <= 50 for x in got) and all(any(f"Paragraph {i} " in x for x in got) for i in range(40))
    assert chunks.split_tokens("", 50, 10) == [] and max(map(len, chunks.split_tokens("x" * 1000, 50, 0))) <= 203


def test_schedule(spark):
    rows = spark.createDataFrame([(1, i) for i in range(5)], "k int, i int")
    assert [r["bucket"] for r in schedule.dealt(rows, ["k"], ["i"], 2).orderBy("i").collect()] == [0, 1, 0, 1, 0]
    assert schedule.progress(rows, rows.where("i < 2"), "i").first()["n_left"] == 3


def test_resume_after_failure(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    for i in range(3):
        spark.createDataFrame([(i, "One. Two.")], "k int, t string").coalesce(1).write.mode("append").parquet(src)
    seen = []

    def fails(rows):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("lost")
        return rows

    with pytest.raises(Exception):
        resume.render(spark, src, "k int, t string", out, mark, fails)
    resume.render(spark, src, "k int, t string", out, mark, lambda r: r)
    resume.render(spark, src, "k int, t string", out, mark, lambda r: r)
    assert sorted(r["k"] for r in resume.rendered(spark, out).collect()) == [0, 1, 2]


def test_profiles():
    assert len(PROFILES) == 7 and PROFILES["pages"].wrap_long
