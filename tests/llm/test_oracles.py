"""Every registered query against its own SQL, all columns, as the driver compares them."""

import duckdb
import pytest
from sprout.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ["documents", "labels", "benchmark", "embeddings"]


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, res = LLM_QUERIES[name](spark, SF), con.sql(LLM_ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(res.columns)
    at = [res.columns.index(c) for c in columns]
    assert sorted(map(tuple, df.select(*[f"`{c}`" for c in columns]).collect())) == sorted(
        tuple(r[k] for k in at) for r in res.fetchall())
