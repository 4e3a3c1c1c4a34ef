"""Each query of the training-data operators with SQL gives DuckDB's rows."""

import duckdb
import pytest

from ambula.llm import queries

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{DIR}/{table}.parquet'")
    theirs = con.sql(queries.ORACLE_SQL[name]).to_arrow_table()
    mine = queries.QUERIES[name](spark, DIR)
    assert sorted(mine.columns) == sorted(theirs.column_names)
    columns = sorted(mine.columns)
    assert sorted(map(tuple, mine.select(*columns).collect()), key=repr) == sorted((tuple(r[c] for c in columns) for r in theirs.to_pylist()), key=repr)
