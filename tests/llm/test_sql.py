"""Each query of this subpackage that has comparison SQL against that SQL, over whole tables."""

import duckdb
import pytest

from tagloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    ours = QUERIES[name](spark, SMALL)
    names = sorted(ours.columns)
    theirs = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name].strip().rstrip(';')})").fetchall()
    plain = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert plain(ours.select(*names).collect()) == plain(theirs)
