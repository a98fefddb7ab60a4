"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

import docflow.plans.catalog as catalog

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{D}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.Q))
def test_query(spark, duck, name):
    df = catalog.Q[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    if name not in catalog.SQL:
        assert got
        return
    rel = duck.sql(catalog.SQL[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(catalog.Q) <= set(e.queries())


@pytest.mark.parametrize("name, exact", [("token_chunks", False), ("exact_token_chunks", True)])
def test_chunks_of_books(spark, name, exact):
    """The chunk queries against the plain splitter over every book's header sections."""
    from docflow.operators import chunks, sections
    from docflow.sources import books
    from tests.test_operators import bpe_counter, plain_split

    counter = bpe_counter() if exact else chunks.QUARTER
    want = []
    heads = sections.carried_headings(books.book_markdown(spark, D), ["conv_id"], "md").orderBy("conv_id", "sec_no").collect()
    for k in sorted({r["conv_id"] for r in heads}):
        own = [t for r in heads if r["conv_id"] == k for t in plain_split(r["content"], 200, 30, counter)]
        want += [(f"{k}-{i:05d}", t, counter.count(t), str(k)) for i, t in enumerate(own)]
    got = catalog.Q[name](spark, D).select("id", "text", "n_tokens", "source").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
