from __future__ import annotations

import pytest
from check_oracles import compare, connect

from waymeter.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), name, queries.registered()[name], queries.statements()[name], SF) == ""


def test_one_query_for_each_operator():
    assert [int(n.split("_")[0][2:]) for n in queries.registered()] == list(range(1, 14))
