"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from fairlead.llm import queries

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    assert got and got == plain(c.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall())
