"""Queries with SQL, held against it on the small tables, and the driver's entry."""

from pathlib import Path

import __spark_entry__ as entry
import duckdb
import pytest
from palaver.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in Path(SF).glob("*.parquet"):
        con.execute(f"create view {t.stem} as select * from '{t}'")
    got = queries.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(cols)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want))


def test_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
