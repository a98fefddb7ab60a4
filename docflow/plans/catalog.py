"""The library's queries over the test tables, and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import audio, clean, codec, titles
from docflow.operators import chunks, pages, schedule, sections, segments
from docflow.operators.running import running
from docflow.profiles import PROFILES
from docflow.sources import books, paged, ranges, shared
from docflow.streaming import append, ledger, resume

P = PROFILES
Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _paragraphs(s, d):
    return books.table(s, d, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


WS = "chr(32) || chr(9) || chr(10) || chr(13)"


def _segments_sql(most, source="(SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents)"):
    return rf"""
    WITH para AS (SELECT doc_id, unnest(string_split(t, chr(10) || chr(10))) AS para, generate_subscripts(string_split(t, chr(10) || chr(10)), 1) - 1 AS para_no FROM {source}),
    sent AS (SELECT doc_id, para_no, list_filter(list_transform(string_split(regexp_replace(para, '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: trim(x, {WS})), lambda x: x <> '') AS ss FROM para WHERE trim(para, {WS}) <> ''),
    acc AS (SELECT doc_id, para_no, list_reduce(list_transform(ss, lambda x: {{'done': []::VARCHAR[], 'open': x}}), lambda a, x: CASE WHEN length(a.open) + length(x.open) + 1 > {most} AND a.open <> '' THEN {{'done': list_append(a.done, a.open), 'open': x.open}} ELSE {{'done': a.done, 'open': CASE WHEN a.open = '' THEN x.open ELSE a.open || ' ' || x.open END}} END) AS r FROM sent WHERE len(ss) > 0),
    segs AS (SELECT doc_id, para_no, list_append(r.done, r.open) AS segs FROM acc)
    SELECT doc_id, para_no::INT AS para_no, (generate_subscripts(segs, 1) - 1)::INT AS seg_no, unnest(segs) AS seg, generate_subscripts(segs, 1) = len(segs) AS ends_paragraph FROM segs
    """


@query(_segments_sql(280))
def segments_280(s, d):
    return segments.segments(_paragraphs(s, d), ["doc_id"], "text", 280)


@query(_segments_sql(180))
def segments_180(s, d):
    return segments.segments(_paragraphs(s, d), ["doc_id"], "text", 180)


@query()
def hard_wrap(s, d):
    return segments.segments(_paragraphs(s, d), ["doc_id"], "text", 200, wrap_long=True)


_DIRTY = "(SELECT doc_id, '" + books.DIRT.replace("'", "''") + "' || text || ' ' || chr(10) || ' ' AS text FROM documents)"


#: The cleaning rules as SQL. The patterns, which must be these for right results.
_RULES_SQL = {
    "picture": r"regexp_replace({}, '==>.*?intentionally omitted.*?<==', '', 'gi')",
    "link": r"regexp_replace({}, '\[([^\]]+)\]\([^)]*\)', '\1', 'g')",
    "code": r"regexp_replace({}, '`[^`]*`', '', 'g')",
    "header": r"regexp_replace({}, '(?m)^#{{1,6}}\s*', '', 'g')",
    "emphasis": r"replace(replace({}, '*', ''), '_', '')",
    "em_dash": r"replace({}, '—', ', ')",
    "dashes": r"replace(replace({}, '—', ', '), '–', ', ')",
    "apostrophes": "replace(replace({}, '‘', chr(39)), '’', chr(39))",
    "quotes": r"""translate({}, '“”', '""')""",
    "newlines": r"regexp_replace({}, '\n{{3,}}', chr(10) || chr(10), 'g')",
    "strip": r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')",
    "page_mark": r"regexp_replace({}, '<!--PAGE:\d+-->', '', 'g')",
    "caption": r"regexp_replace({}, '(?ms)^_\*\*.*?\((?:Courtesy|Cou\w*)[^)]*\)_\s*$', '', 'g')",
    "page_picture": r"regexp_replace({}, '\*{{0,2}}==>.*?intentionally omitted.*?<==\*{{0,2}}', '', 'g')",
    "credit": r"regexp_replace({}, '\((?:Courtesy of|Photo by)[^)]*\)', '', 'g')",
    "endnote": r"regexp_replace({}, '\[\s*\d{{1,3}}\s*\]', '', 'g')",
    "spaces": r"regexp_replace({}, '[ \t]{{2,}}', ' ', 'g')",
    # NFKC of what the decorated documents hold: a ligature, an ellipsis, and letters that compose.
    "nfkc": "nfc_normalize(replace(replace({}, 'ﬁ', 'fi'), '…', '...'))",
}
_CHAINS = {
    "basic": "picture link code header emphasis em_dash apostrophes quotes nfkc newlines strip".split(),
    "pages": "page_mark caption page_picture credit endnote link code header emphasis dashes apostrophes quotes nfkc spaces newlines strip".split(),
}


def _rule_sql(x, name):
    return _RULES_SQL[name].format(x)


def _rule_query(name):
    def f(s, d):
        return books.dirty(s, d).select("doc_id", clean.rule(F.col("text"), name).alias("text"))

    f.__name__ = f"clean_{name}"
    query(f"SELECT doc_id, {_rule_sql('text', name)} AS text FROM {_DIRTY}")(f)


for _n in dict.fromkeys(n for n, p, _ in (*clean.BASIC, *clean.PAGES) if p is not None):
    _rule_query(_n)


def _cleaned_sql(x, kind, normalise=False):
    for name in _CHAINS[kind]:
        if normalise or name != "nfkc":
            x = _rule_sql(x, name)
    return x


def _chain_sql(kind, normalise=False):
    return f"SELECT doc_id, {_cleaned_sql('text', kind, normalise)} AS text FROM {_DIRTY}"


@query(_chain_sql("basic"))
def clean_basic(s, d):
    return books.dirty(s, d).select("doc_id", clean.clean(F.col("text"), "basic", normalise=False).alias("text"))


@query(_chain_sql("pages"))
def clean_pages(s, d):
    return books.dirty(s, d).select("doc_id", clean.clean(F.col("text"), "pages", normalise=False).alias("text"))


@query(_chain_sql("pages", True))
def nfkc(s, d):
    return books.dirty(s, d).select("doc_id", clean.clean(F.col("text"), "pages").alias("text"))


_MD = "(SELECT conv_id, string_agg('## **' || turn || '. ' || role || '**' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS md FROM conversations GROUP BY conv_id)"
_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _sliced_sql(pattern, where="TRUE", md=_MD):
    return rf"""
    WITH ls AS (SELECT conv_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS line_no FROM {md}),
    op AS (SELECT *, regexp_matches(line, '^{pattern}$') AS headed, headed AND {where} AS opens FROM ls),
    pt AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY line_no) AS part FROM op),
    hd AS (SELECT conv_id, bool_or(headed) AS headed FROM op GROUP BY conv_id),
    parts AS (SELECT conv_id, part::INT AS part, any_value(hd.headed) AS headed, max(line) FILTER (opens) AS head, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT opens), '') AS raw FROM pt JOIN hd USING (conv_id) GROUP BY conv_id, part)
    """


_NUM = r"##\s+.*?\b(\d+)\.\s+(.+?)[\*_]*\s*"
def _secs_sql(pattern, md=_MD):
    """Numbered sections of md."""
    return _sliced_sql(pattern, md=md) + f"""
    , secs AS (SELECT conv_id, part, CASE WHEN head IS NULL THEN 0 ELSE regexp_extract(head, '^{pattern}$', 1)::INT END AS num, CASE WHEN head IS NULL THEN 'Introduction' ELSE {_TRIM.format(f"translate(regexp_extract(head, '^{pattern}$', 2), '*_`#', '')")} END AS title, head, {_TRIM.format('raw')} AS body FROM parts),
    numbered AS (SELECT * FROM secs WHERE (body <> '' OR num > 0) AND num <= 200)
"""


_NUMBERED_SQL = _secs_sql(_NUM)
_WORDS = r"len(regexp_extract_all({}, '\S+'))"


@query(_NUMBERED_SQL + "SELECT * FROM numbered")
def sections_numbered(s, d):
    return sections.sections(books.book_markdown(s, d), ["conv_id"], "md", "numbered")


@query(_NUMBERED_SQL + f", r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY {_WORDS.format('body')} DESC, conv_id, part) AS b FROM numbered) SELECT conv_id, part, num, title, head, body FROM r WHERE b = 1")
def best_section_per_key(s, d):
    rows = sections_numbered(s, d).withColumn("place", F.struct("conv_id", "part"))
    return sections.best_by_key(rows, [], "title", "body", "place").drop("place")


_ANY = r"#{1,3}\s+(.+)"
_BOLD_NUM = r"##\s+\*\*(\d{1,2})\s+(.+?)\*\*\s*"
_BOLD = r"## \*\*(.+?)\*\*\s*"


@query(_secs_sql(_BOLD_NUM).replace(". ' || role", " ' || role") + "SELECT * FROM numbered")
def sections_bold_numbered(s, d):
    return sections.sections(books.book_markdown(s, d, " "), ["conv_id"], "md", "bold_numbered")


def _any_sql(md=_MD):
    """Sections under any heading: text before the first one, and titled ones of 30 words with their heading's."""
    return _sliced_sql(_ANY, md=md) + rf"""
    , t AS (SELECT conv_id, part, head, CASE WHEN head IS NULL THEN 'Introduction' ELSE coalesce({_TRIM.format(f"translate(regexp_extract(head, '^{_ANY}$', 1), '*_`#', '')")}, '') END AS title, {_TRIM.format('raw')} AS body FROM parts),
    w AS (SELECT *, head || chr(10) || chr(10) || body AS text FROM t)
    SELECT conv_id, part, (row_number() OVER (PARTITION BY conv_id ORDER BY part) - 1)::INT AS num, title, head, body FROM w
    WHERE CASE WHEN head IS NULL THEN body <> '' ELSE length(title) BETWEEN 1 AND 80 AND {_WORDS.format(_cleaned_sql('text', 'basic'))} >= 30 END"""


@query(_any_sql())
def sections_any_heading(s, d):
    return sections.sections(books.book_markdown(s, d), ["conv_id"], "md", "any")


def _bold_sql(marks, md=_MD):
    """Sections under bold headings that open a chapter; a book without a bold heading is one section."""
    title = f"trim(translate(regexp_extract({{}}, '^{_BOLD}$', 1), '{marks}', ''))"
    t = title.format("line")
    back = "('Photographs', 'Acknowledgments', 'About the Authors', 'Notes', 'Bibliography', 'Index', 'Contents', 'CLICK HERE TO SIGN UP', 'Thank you for downloading this Simon & Schuster ebook.')"
    return _sliced_sql(_BOLD, rf"NOT (starts_with({t}, '—') OR starts_with({t}, '-')) AND NOT regexp_matches({t}, '^\d+$') AND {t} NOT IN {back}", md) + rf"""
    , t AS (SELECT conv_id, part, headed, head, CASE WHEN head IS NULL THEN 'Introduction' ELSE {title.format('head')} END AS title, {_TRIM.format('raw')} AS body FROM parts)
    SELECT conv_id, part, (row_number() OVER (PARTITION BY conv_id ORDER BY part) - 1)::INT AS num, title, head, body FROM t WHERE head IS NOT NULL OR (NOT headed AND body <> '')"""


@query(_bold_sql('*_`#"'))
def sections_bold(s, d):
    return sections.sections(books.book_markdown(s, d), ["conv_id"], "md", "bold")


#: Books of four kinds: without headings, with text before the first one, with doubled numbers, with curly quotes and back matter.
_MIXED = """(SELECT conv_id, string_agg(CASE WHEN conv_id % 4 = 0 OR (conv_id % 4 = 1 AND turn = 0) THEN '' WHEN conv_id % 4 = 3 AND turn = 2 THEN '## **Notes**' || chr(10) || chr(10)
    ELSE '## **' || CASE WHEN conv_id % 4 = 2 THEN turn // 2 ELSE turn END || '. “' || role || '”**' || chr(10) || chr(10) END || text, chr(10) || chr(10) ORDER BY turn) AS md FROM conversations GROUP BY conv_id)"""
_MIXED_SQL = _secs_sql(_NUM, _MIXED)


@query(_MIXED_SQL + "SELECT * FROM numbered")
def sections_mixed_numbered(s, d):
    return sections.sections(books.mixed_markdown(s, d), ["conv_id"], "md", "numbered")


@query(_MIXED_SQL + f", r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, num ORDER BY {_WORDS.format('body')} DESC, part) AS b FROM numbered) SELECT conv_id, part, num, title, head, body FROM r WHERE b = 1")
def best_section_per_number(s, d):
    return sections.best_by_key(sections_mixed_numbered(s, d), ["conv_id"], "num", "body", "part")


@query(_any_sql(_MIXED))
def sections_mixed_any(s, d):
    return sections.sections(books.mixed_markdown(s, d), ["conv_id"], "md", "any")


@query(_bold_sql('*_`#"', _MIXED))
def sections_mixed_bold(s, d):
    return sections.sections(books.mixed_markdown(s, d), ["conv_id"], "md", "bold")


@query(_bold_sql('*_`#“”‘’"', _MIXED))
def sections_bold_curly(s, d):
    return sections.sections(books.mixed_markdown(s, d), ["conv_id"], "md", "bold", marks=titles.CURLY)


@query(_sliced_sql("#{1,3} .*") + rf"""
    , lv AS (SELECT *, coalesce(length(regexp_extract(head, '^(#{{1,3}}) ', 1)), 0) AS level, regexp_replace(head, '^#{{1,3}} +| +$', '', 'g') AS name FROM parts),
    h AS (SELECT conv_id, part AS sec_no, {_TRIM.format("CASE WHEN head IS NULL THEN raw ELSE head || chr(10) || raw END")} AS content, last_value(CASE WHEN level = 2 THEN name END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY part) AS h2 FROM lv)
    SELECT conv_id, sec_no, content, NULL::VARCHAR AS h1, h2, NULL::VARCHAR AS h3 FROM h WHERE content <> ''""")
def heading_carry(s, d):
    return sections.carried_headings(books.book_markdown(s, d), ["conv_id"], "md")


@query(f"""
    WITH ls AS (SELECT conv_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS line_no FROM {_MD}),
    hs AS (SELECT *, regexp_replace(line, '^#{{1,6}}[ \\t]*|[ \\t]*$', '', 'g') AS raw FROM ls WHERE regexp_matches(line, '^#{{1,6}}[ \\t]*\\S')),
    ks AS (SELECT *, regexp_replace(lower(translate(raw, '*_`#', '')), '[^a-z0-9]', '', 'g') AS key FROM hs),
    ns AS (SELECT *, count(*) OVER (PARTITION BY conv_id, key) AS n, min(line_no) OVER (PARTITION BY conv_id, key) AS f, length(raw) - length(replace(raw, ' ', '')) AS sp FROM ks WHERE key NOT IN ('', 'hackerspainters')),
    b AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, f, sp DESC, line_no) AS b FROM ns)
    SELECT conv_id, {_TRIM.format("regexp_replace(translate(regexp_replace(raw, '([a-z])([A-Z])', '" + chr(92) + "1 " + chr(92) + "2', 'g'), '_*', ''), '" + chr(92) + "s+', ' ', 'g')")} AS title, line_no::INT AS line_no, key FROM b WHERE b = 1""")
def title_election(s, d):
    return sections.elected_titles(books.book_markdown(s, d), ["conv_id"], "md")


#: Books with a footer on every page, headings without a letter, and a title told in two forms.
_FOOTED = "(SELECT conv_id, '# Hackers & Painters' || chr(10) || '# TwoForms' || chr(10) || replace(md, chr(10) || chr(10), chr(10) || '# ***' || chr(10) || '### Two Forms' || chr(10) || '# _Hackers & Painters_' || chr(10)) AS md FROM " + _MD + ")"


def _footed(s, d):
    breaks = F.lit("\n# ***\n### Two Forms\n# _Hackers & Painters_\n")
    return books.book_markdown(s, d).select("conv_id", F.concat(F.lit("# Hackers & Painters\n# TwoForms\n"), F.replace("md", F.lit("\n\n"), breaks)).alias("md"))


@query(rf"""
    WITH ls AS (SELECT conv_id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS line_no FROM {_FOOTED}),
    ks AS (SELECT *, CASE WHEN regexp_matches(line, '^#.') THEN regexp_replace(lower(line), '[^a-z0-9]', '', 'g') END AS key FROM ls),
    n AS (SELECT conv_id, key, count(*) AS n, min(line_no) AS f FROM ks WHERE key NOT IN ('', 'hackerspainters') GROUP BY ALL),
    best AS (SELECT conv_id, arg_min(key, (-n, f)) AS best FROM n GROUP BY conv_id)
    SELECT conv_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (key IS NULL OR (key NOT IN ('', 'hackerspainters') AND key <> best)), '') AS body FROM ks LEFT JOIN best USING (conv_id) GROUP BY conv_id""")
def title_election_body(s, d):
    md = _footed(s, d)
    return sections.without_lines(md, ["conv_id"], "md", sections.elected_titles(md, ["conv_id"], "md"))


def _marked_book(s, d):
    """A conversation as a marked book: its first turn the note, its second the preface, then chapters, the last one's end among the notes."""
    turn = F.col("turn")
    head = F.when(turn == 0, "# Cover\n\n## _Note to readers_\n").when(turn == 1, "## Contents\nlist\n## Preface\n").otherwise(F.concat(F.lit("## _Chapter "), (turn - 1).cast("string"), F.lit("_\n## **TheTurn**\n## The Turn\n# Hackers & Painters\n")))
    turns = books.table(s, d, "conversations").select("conv_id", "turn", F.concat(head, F.col("text")).alias("t"))
    md = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"]), "\n")
    return turns.groupBy("conv_id").agg(F.concat(md, F.lit("\n## Notes\nall notes")).alias("md"))


@query(rf"""
    WITH c AS (SELECT conv_id, turn, {_TRIM.format('text')} AS text, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations)
    SELECT conv_id, (turn - 1)::INT AS part, (turn - 1)::INT AS num, 'The Turn' AS title, NULL::VARCHAR AS head, text AS body FROM c WHERE turn > 1
    UNION ALL
    SELECT conv_id, 0, 0, 'Preface', NULL, {_TRIM.format("string_agg(raw, chr(10) || chr(10) ORDER BY turn)")} FROM (SELECT conv_id, turn, text AS raw FROM conversations WHERE turn < 2) GROUP BY conv_id HAVING count(*) = 2""")
def marked_sections(s, d):
    return sections.sections(_marked_book(s, d), ["conv_id"], "md", "marked")


@query(rf"""SELECT conv_id, CASE WHEN strpos(md, '## **1.') > 0 THEN split_part(substr(md, strpos(md, '## **1.')), '## **3.', 1) ELSE split_part(md, '## **3.', 1) END AS body FROM {_MD}""")
def text_cut(s, d):
    return books.book_markdown(s, d).select("conv_id", sections.between(F.col("md"), r"## \*\*1\.", r"## \*\*3\.").alias("body"))


_PAGES = "(SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INT AS page, text FROM documents)"
_MAP = f"""
    WITH p AS {_PAGES}, toc AS (SELECT source, ((page - 1) // 10)::INT AS ord, page, max(last) OVER (PARTITION BY source) AS last_page FROM (SELECT *, max(page) OVER (PARTITION BY source) AS last FROM p) WHERE page % 10 = 1),
    m AS (SELECT source, CASE WHEN ord < 2 THEN ord - count(*) OVER (PARTITION BY source) ELSE ord - 1 END::INT AS num, CASE WHEN ord < 2 THEN 'Front ' || ord ELSE 'CHAPTER ' || (ord - 1) END AS label, page AS start_page, coalesce(lead(page) OVER (PARTITION BY source ORDER BY ord) - 1, last_page)::INT AS end_page FROM toc)
"""


@query(_MAP + "SELECT * FROM m")
def chapter_map(s, d):
    return pages.chapter_map(books.book_toc(s, d), ["source"], "last_page")


@query(_MAP + "SELECT m.source, start_page, end_page, coalesce(string_agg(p.text, '' ORDER BY p.page), '') AS body FROM m LEFT JOIN p ON p.source = m.source AND p.page BETWEEN start_page AND end_page GROUP BY ALL")
def chapters_from_pages(s, d):
    return pages.chapters_from_pages(chapter_map(s, d), books.book_pages(s, d), ["source"])


@query(_MAP + "SELECT source, min(start_page) AS first_page, max(end_page) AS last_page FROM m GROUP BY source")
def page_span(s, d):
    return chapter_map(s, d).groupBy("source").agg(F.min("start_page").alias("first_page"), F.max("end_page").alias("last_page"))


@query(f"SELECT source, page, chr(10) || chr(10) || text || CASE WHEN page % 2 = 1 AND lead(page) OVER (PARTITION BY source ORDER BY page) IS NOT NULL THEN chr(10) || chr(10) ELSE '' END AS text FROM {_PAGES}")
def marked_pages(s, d):
    """Marked pages, two to a row, cut again at their markers; a whole book never is one row."""
    p = books.book_pages(s, d).select("source", "page", pages.marked(F.col("page"), F.col("text")).alias("t"))
    sheet = p.groupBy("source", F.floor((F.col("page") - 1) / 2).alias("sheet")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "t"))), lambda x: x["t"]), "").alias("md"))
    return pages.split_marked(sheet, ["source"], "md")


@query(_MAP + """
    , o AS (SELECT *, ((start_page - 1) // 10)::INT AS ord FROM m),
    r AS (SELECT *, coalesce(min(ord) FILTER (label = 'Front 1') OVER (PARTITION BY source), 0) AS a, coalesce(min(ord) FILTER (label = 'CHAPTER 2') OVER (PARTITION BY source), 1000000) AS z FROM o)
    SELECT source, CASE WHEN ord < 2 THEN ord - a - count(*) OVER (PARTITION BY source) ELSE ord - 1 END::INT AS num, label, start_page, end_page FROM r WHERE ord >= a AND ord < z""")
def toc_slice(s, d):
    """The map from the second front part to before the second chapter."""
    return pages.chapter_map(books.book_toc(s, d), ["source"], "last_page", "FRONT 1", "CHAPTER 2")


@query(_MAP + "SELECT * FROM m WHERE num = 2")
def chapter_of_number(s, d):
    return schedule.chapter_numbered(chapter_map(s, d), 2)


@query(_MAP + "SELECT * FROM m WHERE start_page = 31")
def chapter_at_place(s, d):
    return schedule.nth_chapter(chapter_map(s, d), ["source"], ["start_page"], 3)


_HEAD = "trim(text, " + WS + ")"


@query(rf"""
    WITH x AS (SELECT doc_id, '**' || regexp_replace({_HEAD}, '\n', ' ', 'g') || '**' AS t FROM documents)
    SELECT doc_id, {_TRIM.format("translate(t, '*_`#', '')")} AS title, regexp_replace(lower(translate(t, '*_`#', '')), '[^a-z0-9]', '', 'g') AS key, printf('%03d', (doc_id % 2000)::INT) || '_' || regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g') AS slug,
      substr(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), 1, 40) AS slug_40, printf('%03d', (doc_id % 2000)::INT) || '_' || trim(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), '_') AS slug_trimmed, printf('doc-%05d', doc_id) AS chunk_id FROM x""")
def slugs(s, d):
    x = books.table(s, d, "documents").select("doc_id", F.concat(F.lit("**"), F.regexp_replace(F.btrim("text", F.lit(" \t\n\r")), "\n", " "), F.lit("**")).alias("t"))
    n = (F.col("doc_id") % 2000).cast("int")
    return x.select("doc_id", titles.strip_title(F.col("t")).alias("title"), titles.heading_key(F.col("t")).alias("key"), titles.slug(F.col("t"), n).alias("slug"), titles.slug(F.col("t"), length=40).alias("slug_40"), titles.slug(F.col("t"), n, trimmed=True).alias("slug_trimmed"), titles.chunk_id(F.lit("doc"), F.col("doc_id")).alias("chunk_id"))


@query(r"""SELECT doc_id, (length(text) // 4)::BIGINT AS n_tokens, len(regexp_extract_all(text, '\S+'))::INT AS n_words, (length(text) - length(replace(text, ' ', '')))::INT AS n_spaces, regexp_replace(text, '([a-z])([A-Z])', '\1 \2', 'g') AS spaced FROM documents""")
def text_counts(s, d):
    t = F.col("text")
    return books.table(s, d, "documents").select("doc_id", titles.rough_tokens(t).cast("long").alias("n_tokens"), titles.word_count(t).alias("n_words"), titles.space_count(t).cast("int").alias("n_spaces"), titles.camel_split(t).alias("spaced"))


@query(_MAP + r"SELECT source, num, label, CASE WHEN num > 0 THEN label || '. ' || 'Part' || '.' ELSE 'Part.' END AS spoken, coalesce(try_cast(regexp_extract(label, '(?i)^CHAPTER\s+(\d+)', 1) AS INT), 0) AS chapter_no FROM m")
def spoken_headers(s, d):
    m = chapter_map(s, d)
    return m.select("source", "num", "label", titles.spoken_header(F.col("num"), F.col("label"), F.lit("Part")).alias("spoken"), titles.chapter_number(F.col("label")).alias("chapter_no"))


@query(_MAP + rf"""
    , o AS (SELECT m.source, num, label, list_filter(list_transform(string_split(label || chr(10) || p.text, chr(10)), lambda x: {_TRIM.format('x')}), lambda x: x <> '') AS ls FROM m JOIN p ON p.source = m.source AND p.page = m.start_page)
    SELECT source, num, CASE WHEN label LIKE 'CHAPTER%' AND len(ls) > 1 THEN trim(ls[2], ' -–—:') WHEN label LIKE 'CHAPTER%' THEN 'Chapter' || substr(label, 8) ELSE label END AS title FROM o""")
def page_titles(s, d):
    m, p = chapter_map(s, d), books.book_pages(s, d)
    opening = m.join(p, (m["source"] == p["source"]) & (m["start_page"] == p["page"])).select(m["source"], "num", "label", F.concat_ws("\n", "label", "text").alias("text"))
    return opening.select("source", "num", titles.page_title(F.col("text"), F.col("label")).alias("title"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_chapters(s, d):
    return schedule.pending(books.table(s, d, "documents").select("doc_id", "source"), books.table(s, d, "labels"), "doc_id")


@query("SELECT count(*) FILTER (l.doc_id IS NOT NULL) AS n_done, count(*) FILTER (l.doc_id IS NULL) AS n_left FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def progress(s, d):
    return schedule.progress(books.table(s, d, "documents"), books.table(s, d, "labels"), "doc_id")


@query("SELECT source, doc_id, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 3)::INT AS bucket FROM documents")
def buckets(s, d):
    return schedule.dealt(books.table(s, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 3)


@query("SELECT source, doc_id, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8)::INT AS batch FROM documents")
def batches(s, d):
    return schedule.batched(books.table(s, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 8)


@query(f"WITH x AS ({_segments_sql(280)}) SELECT doc_id, count(*) AS n_segs, sum(length(seg))::BIGINT AS n_chars FROM x GROUP BY doc_id")
def dry_run_report(s, d):
    return schedule.dry_run(segments_280(s, d), ["doc_id"])


@query(f"WITH x AS ({_segments_sql(280)}), t AS (SELECT count(*) AS n_segs, sum(length(seg))::BIGINT AS n_chars FROM x) SELECT n_segs, n_chars, round(n_chars / 11.0 / 3600, 6)::DOUBLE AS hours_1, round(n_chars / 22.0 / 3600, 6)::DOUBLE AS hours_2, round(n_chars / 33.0 / 3600, 6)::DOUBLE AS hours_3, round(n_chars / 14.0 / 3600, 6)::DOUBLE AS audio_hours, round(n_chars / 14.0 * 8000 / 1e9, 6)::DOUBLE AS audio_gb FROM t")
def dry_run_totals(s, d):
    return schedule.estimates(dry_run_report(s, d))


@query(_NUMBERED_SQL + r"SELECT conv_id, part, len(regexp_extract_all(body, '\S+'))::INT AS n_words FROM numbered")
def section_words(s, d):
    return schedule.word_report(sections_numbered(s, d), ["conv_id", "part"], "body")


@query("SELECT count(*) AS n_chunks, round(coalesce(avg(length(text) // 4), 0), 6)::DOUBLE AS avg_tokens, min(length(text) // 4)::BIGINT AS min_tokens, max(length(text) // 4)::BIGINT AS max_tokens FROM documents")
def chunk_stats(s, d):
    return chunks.chunk_stats(books.table(s, d, "documents").select(titles.rough_tokens(F.col("text")).alias("n")), "n")


@query()
def token_chunks(s, d):
    return chunks.chunks(books.book_markdown(s, d), "conv_id", "md", 200, 30).select("id", "text", "n_tokens", F.to_json("headers").alias("headers"), "source")


@query()
def exact_token_chunks(s, d):
    """Chunks by the exact tokens of a public byte-pair encoding."""
    import public_tokenizers

    counter = chunks.BpeCounter(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return chunks.chunks(books.book_markdown(s, d), "conv_id", "md", 200, 30, counter).select("id", "text", "n_tokens", F.to_json("headers").alias("headers"), "source")


@query(f"WITH x AS ({_segments_sql(280)}) SELECT doc_id, para_no, seg_no, CASE WHEN ends_paragraph THEN 13200 ELSE 3600 END::INT AS n_samples FROM x")
def silence_samples(s, d):
    return segments_280(s, d).select("doc_id", "para_no", "seg_no", audio.silence_samples(F.col("ends_paragraph"), P["numbered_a"]).alias("n_samples"))


@query("SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, trunc(greatest(least(unnest(embedding)::DOUBLE * 4, 1.0), -1.0) * 32767)::SMALLINT AS pcm FROM embeddings")
def pcm16(s, d):
    x = books.table(s, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x"))
    return x.select("vec_id", F.col("i").cast("long").alias("i"), audio.to_pcm16(F.col("x").cast("double") * 4).alias("pcm"))


#: Segments of books as a voice of steps says them: samples of a segment, the silence behind it, and how many samples come before it.
_SAID = _segments_sql(180, f"(SELECT conv_id AS doc_id, md AS t FROM {_MD})").replace("SELECT doc_id, para_no::INT AS para_no", ", x AS (SELECT doc_id AS conv_id, para_no::INT AS para_no") + """),
    y AS (SELECT conv_id, length(seg) AS n, 4 * length(seg) + CASE WHEN ends_paragraph THEN 12000 ELSE 2880 END AS size, para_no, seg_no FROM x),
    z AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY para_no, seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM y),
    k AS (SELECT conv_id, before + i AS pos, (i + 1) * (17 + 2 * n) % 4001 - 2000 AS k FROM (SELECT *, unnest(range(4 * n)) AS i FROM z)),
    sums AS (SELECT conv_id, sum((k - sign(k)) * (1 + pos % 1009))::BIGINT AS sample_sum FROM k GROUP BY conv_id),
    sizes AS (SELECT conv_id, count(*) AS n_segs, (2 * sum(size))::BIGINT AS n_pcm FROM y GROUP BY conv_id)
"""


def _book_segments(s, d):
    return segments.segments(books.book_markdown(s, d), ["conv_id"], "md", 180)


def _said(s, d):
    """The segments of books with their PCM, stored."""
    return shared.written(audio.synthesise(_book_segments(s, d), P["bold_single"], audio.Steps), "said")


@query(_SAID + "SELECT conv_id, n_pcm + 44 AS n_bytes, sample_sum FROM sizes JOIN sums USING (conv_id)")
def synthesis(s, d):
    """Books as WAV files, a row each."""
    wav = books.audio_files(_said(s, d), ["conv_id"], ["para_no", "seg_no"])
    return wav.select("conv_id", F.octet_length("wav").cast("long").alias("n_bytes"), audio.sample_sum(F.expr("substring(wav, 45)"), F.lit(0)).alias("sample_sum"))


def _samples_of_files(rows, header):
    """conv_id, n_bytes and sample_sum of audio files read in ranges; `header` bytes come before the samples."""
    body = F.when(F.col("start") == 0, F.expr(f"substring(data, {header + 1})")).otherwise(F.col("data"))
    first = F.greatest(F.col("start") - header, F.lit(0)) / 2
    got = rows.select(F.regexp_extract("name", r"(\d+)", 1).cast("long").alias("conv_id"), F.octet_length("data").cast("long").alias("n"), audio.sample_sum(body, first.cast("long")).alias("s"))
    return got.groupBy("conv_id").agg(F.sum("n").alias("n_bytes"), F.sum("s").alias("sample_sum"))


@query(_SAID + "SELECT conv_id, n_pcm + 44 AS n_bytes, sample_sum FROM sizes JOIN sums USING (conv_id)")
def merged_audio(s, d):
    """Books' WAV files, each written by many tasks at the offsets of its segments, read back in ranges."""
    at = shared.new(s, "merged")
    said = audio.synthesise(_book_segments(s, d), P["bold_single"], audio.Steps, deflate=True)
    ranges.write_wavs(said.withColumn("file", F.concat(F.col("conv_id").cast("string"), F.lit(".wav"))), "file", ["para_no", "seg_no"], "pcm", at, size="n_pcm")
    return _samples_of_files(ranges.read_ranges(s, at, row_bytes=1 << 16, part_bytes=1 << 20), 44)


@query(_SAID + "SELECT conv_id, n_pcm AS n_bytes, sample_sum FROM sizes JOIN sums USING (conv_id)")
def appended_audio(s, d):
    """A stream of segments appended to a file for every book, some before their turn."""
    at = shared.new(s, "append")
    segs = shared.written(_book_segments(s, d), "segments").select(F.col("conv_id").cast("string").alias("chapter"), "para_no", "seg_no", "seg", "ends_paragraph")
    whole = running(segs.select("chapter", "para_no", "seg_no"), ["chapter"], ["para_no", "seg_no"], {"seq": None})
    totals = segs.groupBy("chapter").agg(F.count("*").alias("total"))
    rows = segs.join(whole, ["chapter", "para_no", "seg_no"]).join(totals, "chapter")
    rows.select("chapter", "seq", "total", "seg", "ends_paragraph").write.parquet(f"{at}/in")
    append.append(s, f"{at}/in", f"{at}/out", f"{at}/checkpoint", P["bold_single"], audio.Steps, files_at_once=64)
    return _samples_of_files(ranges.read_ranges(s, f"{at}/out/audio", row_bytes=1 << 16), 0)


@query(_SAID + "SELECT conv_id, n_segs, n_pcm AS n_bytes FROM sizes")
def ledger_of_books(s, d):
    """Books rendered by a ledger in two runs, of which the second has nothing left to do."""
    at, segs = shared.new(s, "ledger"), shared.written(_book_segments(s, d), "segments")
    for run in ("first", "second"):
        ledger.render(segs, ["conv_id"], P["bold_single"], at, audio.Steps, run)
    done = ledger.finished(s, at, segs, ["conv_id"], P["bold_single"])
    return ledger.complete(segs, done, ["conv_id"])


@query(_SAID + "SELECT conv_id, n_segs, n_pcm AS n_bytes, sample_sum, TRUE AS sound FROM sizes JOIN sums USING (conv_id)")
def transcoded_audio(s, d):
    """Books' segments encoded without loss, the originals deleted after a verified round trip, and decoded."""
    at = shared.new(s, "coded")
    said = _said(s, d).select("conv_id", "para_no", "seg_no", (F.octet_length("pcm") / 2).cast("long").alias("n"), audio.deflated("pcm").alias("pcm"))
    places = running(shared.written(said, "parts"), ["conv_id"], ["para_no", "seg_no"], {"before": "n"})
    audio.inflated(places.select("conv_id", "before", "pcm"), "pcm").write.option("compression", "zstd").parquet(f"{at}/pcm")
    got = codec.decoded(codec.transcode(s, f"{at}/pcm", f"{at}/coded"))
    return got.groupBy("conv_id").agg(F.count("*").alias("n_segs"), F.sum("n_bytes").alias("n_bytes"), F.sum(audio.sample_sum("pcm", "before")).alias("sample_sum"), F.bool_and("sound").alias("sound"))


@query("SELECT source AS name, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents WHERE source LIKE 'src1%')")
def voices(s, d):
    """The voices of a catalogue that have a prefix, and how many: sources stand for voices."""
    return books.voices(books.table(s, d, "documents"), "source", "src1")


@query("SELECT r_name, name FROM region, (SELECT DISTINCT role AS name FROM conversations)")
def voice_samples(s, d):
    return books.samples(books.table(s, d, "region").select("r_name"), books.voices(books.table(s, d, "conversations"), "role").select("name"))


@query(f"SELECT conv_id, md AS text FROM {_MD}")
def books_round_trip(s, d):
    """A text file for every book, read back whole."""
    at = shared.new(s, "books")
    books.write_books(books.book_markdown(s, d), "conv_id", "md", at)
    return books.read_books(s, at, "conv_id").select(F.col("conv_id").cast("long").alias("conv_id"), "text")


@query("SELECT DISTINCT conv_id, 'conv_id=' || conv_id AS folder FROM conversations")
def listed_books(s, d):
    """The folders of the books' files, found without reading them."""
    at = shared.new(s, "books")
    books.write_books(books.book_markdown(s, d), "conv_id", "md", at)
    name = F.element_at(F.split("path", "/"), -2)
    return books.listing(s, at, "*.txt").select(F.regexp_extract(name, r"(\d+)", 1).cast("long").alias("conv_id"), name.alias("folder")).distinct()


@query(f"SELECT conv_id, md AS text FROM {_MD}")
def whole_files(s, d):
    at = shared.new(s, "books")
    books.write_books(books.book_markdown(s, d), "conv_id", "md", at)
    return books.whole_texts(s, at).select(F.regexp_extract("path", r"conv_id=(\d+)", 1).cast("long").alias("conv_id"), F.regexp_replace("text", r"\n\z", "").alias("text"))


@query(_MAP + "SELECT source, (row_number() OVER (PARTITION BY source ORDER BY start_page) - 1)::INT AS place, num, label, label AS title, start_page, end_page FROM m")
def chapter_map_round_trip(s, d):
    """Every book's chapter map as a JSON array, written in ranges and read back."""
    at, m = shared.new(s, "map"), shared.written(chapter_map(s, d), "map")
    ranges.write_json_arrays(m.withColumn("title", F.col("label")), "source", ["start_page"], ["num", "label", "title", "start_page", "end_page"], at)
    return books.map_files(s, at).withColumn("source", F.element_at(F.split("path", "/"), -1)).drop("path")


@query(f"SELECT source, octet_length(encode(string_agg(text, chr(10) || chr(10) ORDER BY page)))::BIGINT AS n_bytes, md5(string_agg(text, chr(10) || chr(10) ORDER BY page)) AS hash FROM {_PAGES} GROUP BY source")
def books_in_ranges(s, d):
    """Books as text files, each written by many tasks; no book is a row before it is read whole."""
    at = shared.new(s, "texts")
    ranges.write_texts(shared.written(books.book_pages(s, d), "pages"), "source", ["page"], "text", at)
    name = F.element_at(F.split("path", "/"), -1)
    return books.whole_texts(s, at).select(name.alias("source"), F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("hash"))


@query("SELECT printf('doc-%05d', doc_id) AS id, text, (length(text) // 4)::INT AS n_tokens, source FROM documents")
def chunks_round_trip(s, d):
    """Chunks as JSON lines, read back; a column that isn't asked for isn't parsed."""
    at, docs = shared.new(s, "chunks"), books.table(s, d, "documents")
    books.write_chunks(docs.select(titles.chunk_id(F.lit("doc"), F.col("doc_id")).alias("id"), "text", titles.rough_tokens(F.col("text")).cast("int").alias("n_tokens"), F.create_map(F.lit("h1"), F.col("lang")).alias("headers"), "source"), at)
    return books.chunk_files(s, at, "id string, text string, n_tokens int, source string")


@query(f"WITH p AS {_PAGES} SELECT source, page, text FROM p WHERE page BETWEEN 3 AND 6")
def pages_of_range(s, d):
    """Books written as files of pages; the pages 3 to 6 of each read back, and no other extracted."""
    at = shared.new(s, "paged")
    ranges.write_texts(shared.written(books.book_pages(s, d), "pages"), "source", ["page"], "text", at, between="\f")
    got = paged.document_pages(s, at).where("page between 3 and 6")
    return got.select(F.element_at(F.split("path", "/"), -1).alias("source"), "page", "text")


@query(f"SELECT conv_id, md AS merged FROM {_MD}")
def merged_books(s, d):
    """Parts of a book, by path, as one text again."""
    turns = books.table(s, d, "conversations")
    t = F.concat(F.lit("## **"), F.col("turn").cast("string"), F.lit(". "), F.col("role"), F.lit("**\n\n"), F.col("text"))
    return books.merged(turns.select("conv_id", F.format_string("%05d.md", "turn").alias("path"), t.alias("t")), ["conv_id"], "path", "t")


@query("SELECT conv_id, printf('%05d.wav', turn) AS path, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS place, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM conversations")
def merge_manifest(s, d):
    parts = books.table(s, d, "conversations").select("conv_id", F.format_string("%05d.wav", "turn").alias("path"), F.length("text").alias("n"))
    return books.manifest(parts, ["conv_id"], "path", "n")


@query("SELECT doc_id, doc_id % 7 AS segments, n_chars AS total FROM documents WHERE doc_id % 3 <> 0")
def checkpoints_that_fit(s, d):
    docs = books.table(s, d, "documents")
    noted = docs.select("doc_id", (F.col("doc_id") % 7).alias("segments"), F.col("n_chars").alias("total"))
    now = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("total"))
    return resume.valid_progress(noted, now, "doc_id")


@query("SELECT doc_id, done, n_chars, seconds, CASE WHEN seconds > 0 THEN done / seconds END AS rate, CASE WHEN seconds > 0 AND done > 0 THEN (n_chars - done) / (done / seconds) END AS eta_s FROM (SELECT doc_id, doc_id % 50 AS done, n_chars, doc_id % 5 AS seconds FROM documents)")
def render_rates(s, d):
    x = books.table(s, d, "documents").select("doc_id", (F.col("doc_id") % 50).alias("done"), "n_chars", (F.col("doc_id") % 5).alias("seconds"))
    return resume.rates(x, "done", "n_chars", "seconds")


@query("SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN n_chars / 14.0::DOUBLE / (doc_id % 5) END AS factor FROM documents")
def real_time_factors(s, d):
    return books.table(s, d, "documents").select("doc_id", schedule.real_time_factor(F.col("n_chars") / F.lit(14.0), F.col("doc_id") % 5).alias("factor"))


@query("SELECT doc_id, 'out/' || lower(source) || '_' || doc_id || '.mp4' AS mp4, 'out/' || lower(source) || '_' || doc_id || '.wav' AS wav, 'out/' || lower(source) || '_' || doc_id || '.raw' AS raw, 'out/' || lower(source) || '_' || doc_id || '.idx' AS idx FROM documents")
def output_paths(s, d):
    name = F.concat(F.lower("source"), F.lit("_"), F.col("doc_id").cast("string"))
    return books.table(s, d, "documents").select("doc_id", *titles.output_paths(name, "out"))


def _html_sql(x):
    x = rf"regexp_replace({x}, '(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->', '', 'g')"
    for n in range(1, 7):
        x = f"regexp_replace({x}, '(?i)<h{n}[^>]*>', chr(10) || chr(10) || '{'#' * n} ', 'g')"
    x = rf"regexp_replace({x}, '(?i)<br\s*/?>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '(?i)</h[1-6]>|</?p\b[^>]*>|</?div\b[^>]*>|</?li\b[^>]*>', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for entity, to in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):  # those that the pages have
        x = f"replace({x}, '{entity}', '{to}')"
    return _TRIM.format(rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"SELECT page_id, {_html_sql('html')} AS md FROM pages")
def html_pages(s, d):
    return books.extracted_pages(books.table(s, d, "pages"))


@query(_segments_sql(280, "(SELECT doc_id, text AS t FROM documents)"))
def resumed(s, d):
    """A stream of documents rendered to segments, batch by batch."""
    at = shared.new(s, "stream")
    source, out = f"{d}/documents.parquet", f"{at}/out"
    schema = s.read.parquet(source).schema.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    # A stream reads a folder; a table that is one file is picked out of the folder that holds it.
    folder, glob = (d, "documents.parquet") if books.listing(s, source, "documents.parquet").limit(1).count() else (source, "*.parquet")
    resume.render(s, folder, schema, out, f"{at}/checkpoint", lambda x: segments.segments(x, ["doc_id"], "text", 280), files_at_once=64, glob=glob)
    return resume.rendered(s, out)


def queries():
    return dict(Q)


def oracle_sql():
    return dict(SQL)
