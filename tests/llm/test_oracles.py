"""Queries against their SQL on whole tables."""

import duckdb
import pytest

from annoflow.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLE_SQL[name]).fetchdf()
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns

    def rows(df):
        return sorted(map(tuple, df[columns].astype(str).itertuples(index=False, name=None)))

    assert rows(got) == rows(want)
