"""The registered queries against their SQL, on the smallest tables.

A one-hot table has a column per category found in the data. SQL has to name its columns, so those
queries are compared at the scale from which on every place occurs.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
QUERIES = contract.queries()
# tests/check_oracles.py compares every query at any scale; streams have tests of their own.
STREAMS = {n for n in QUERIES if n.startswith("stream_")}
LARGER = {
    "one_hot", "training_features", "request_feature_vector", "feature_model_round_trip", "drift_all_columns"
}
LARGER_SF = "/root/testdata/sf0.01"


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["traffic_level", "r2", "mae", "rmse", "mape", "n"]
    assert {r["traffic_level"] for r in df.collect()} == {"Low", "Medium", "High"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL and n not in STREAMS])
def test_query_equals_its_sql(spark, name):
    sf_dir = LARGER_SF if name in LARGER else SF
    assert compare(spark, connect(sf_dir), name, QUERIES[name], SQL[name], sf_dir) == ""
