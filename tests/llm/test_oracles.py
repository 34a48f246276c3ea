"""Every llm query with SQL against DuckDB on the small tables."""
import duckdb
import pytest
from panelkit.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels".split()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    cols = [d[0] for d in want.description]
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(cols, want.fetchall())
