"""Every registered query over the smallest tables against its SQL in DuckDB; rows only where there is none."""

import math
import os

import pytest

from plumbline.plans import core, fixtures, quality, urls  # noqa: F401 - they register their queries
from plumbline.plans.registry import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((repr(tuple(plain(x) for x in r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()))
    if name in SQL:
        rel = duck.sql(SQL[name])
        assert sorted(rel.columns) == cols
        quoted = ", ".join(f'"{c}"' for c in cols)
        want = duck.sql(f"SELECT {quoted} FROM ({SQL[name]}) q").fetchall()
        assert rows == sorted(repr(tuple(plain(x) for x in r)) for r in want)


def test_title_and_h1_of_odd_pages(spark, tmp_path):
    """Character references other than the SQL's three, attributes, inner tags, comments, kinds of white space, pages without headings, empty and null ones."""
    import duckdb

    odd = [
        "a &quot;b&quot; &#39;c&#39; &nbsp;", "and&amp;&amp", "&amp;lt; &amp;amp;amp; &lt;b&gt;", " \u00a0\u3000x \u2003y\u200a ", "\t x\r\n ", " &lt; ", "", "   ", "two  blanks\nand a line", "\u200bz\ufeff", "\U0001f600 ä",
        "a <b>b</b>", "a <!-- b --> c", "</title><title>second</title>", "a</h1><h1>b",
    ]
    pages = [f"<html><head><title>{x}</title></head><body><h1>{x}</h1><h1>last</h1></body></html>" for x in odd]
    pages += ["<TITLE>x</TITLE><H1>y</H1>", "<title lang=en>x</title><h1 class='a'>y</h1>", "<!-- <title>x</title> --><title>y</title><script>'<h1>z</h1>'</script>", "<title>x</h1><h1>y</title>", "<title>open", "no headings", "", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(f"SELECT page_id, title, h1 FROM ({SQL['html_title_h1']}) q ORDER BY page_id").fetchall()
    got = QUERIES["html_title_h1"](spark, str(tmp_path)).select("page_id", "title", "h1").orderBy("page_id").collect()
    assert len(want) == len(pages)
    assert [tuple(r) for r in got] == want


def test_entry_point_without_the_corpus_folder(tmp_path):
    """The entry module imports when the folder of corpus operators and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/plumbline", tmp_path / "plumbline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
