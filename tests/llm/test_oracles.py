"""The operators' SQL on DuckDB against their queries, over whole tables."""

import duckdb
import pytest

from pricelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
KEYS = ["doc_id", "item_id", "rank", "conv_id", "depth"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name]).fetchdf()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    order = lambda df: df[columns].sort_values([k for k in KEYS if k in columns]).reset_index(drop=True)
    assert order(want).convert_dtypes().equals(order(got).convert_dtypes())
