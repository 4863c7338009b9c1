"""The subpackage's registered queries: names, and SQL held against them."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from paylake.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = E.queries()[key](spark, SF)
    res = con.sql(E.oracle_sql()[key])
    columns, rows = res.columns, res.fetchall()
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, rows)
