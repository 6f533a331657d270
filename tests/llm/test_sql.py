"""The queries that SQL can express against their SQL, on whole tables."""

import duckdb
import pytest

from millrace.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    expected = con.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert rows and sorted(rows, key=repr) == sorted(con.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({ORACLES[name]})").fetchall(), key=repr)
