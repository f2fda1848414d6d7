"""The operators that SQL can express, against it; all queries of the subpackage run on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from recordloom.llm import queries as Q


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple("" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", Q.queries())
def test_query(spark, sf, name):
    got = Q.queries()[name](spark, sf).toPandas()
    if name not in Q.oracle_sql():
        assert len(got)
        return
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert rows(got) == rows(con.execute(Q.oracle_sql()[name]).fetchdf())
