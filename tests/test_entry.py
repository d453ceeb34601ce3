"""Driver contract: entry runs, every query has a callable, SQL twins agree at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

TABLES = ["orders", "lineitem", "events", "pages"]
SAMPLE = ["xpath_match", "html_nodes", "register_channels", "robots_rules", "crawl_reach",
          "headers_map", "live_hits"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["channel", "doc_id", "xpath"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_sql_twin_agrees(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted(tuple(str(r[cols.index(c)]) for c in order) for r in cur.fetchall())
    got = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
    assert got == want
