"""Queries with SQL against it on whole tables, and the columns the queries promise."""

import duckdb
import pytest

from plantloom.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF).toArrow()
    want = con.sql(ORACLE[name]).to_arrow_table()
    got, want = got.select(sorted(got.column_names)), want.select(sorted(want.column_names))
    assert [str(f.type) for f in got.schema] == [str(f.type) for f in want.schema]
    assert got.num_rows == want.num_rows
    for one, two in (("got", "want"), ("want", "got")):
        assert con.sql(f"FROM {one} EXCEPT ALL FROM {two}").limit(3).fetchall() == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
