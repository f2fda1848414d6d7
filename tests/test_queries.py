"""Every base query against its DuckDB equivalent."""

import os

import duckdb
import pandas as pd
import pytest

from recordloom import queries as Q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def rows(frame):
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{float(v):.9g}"
        return str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, sf, duck, name):
    got = Q.queries()[name](spark, sf).toPandas()
    sql = Q.oracle_sql().get(name)
    if sql:
        assert rows(got) == rows(duck.execute(sql).fetchdf())
    else:
        assert len(got)


def test_entry_and_guard(spark):
    import __spark_entry__ as E

    assert E.entry(spark).count() == 150
    assert set(Q.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True)
    assert said.returncode == 0, said.stderr[-500:]
