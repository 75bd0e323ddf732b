"""The registered queries that SQL can express, against DuckDB over the same tables."""

import pytest
from oracle import compare

from coursemart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SF), queries.ORACLE[name], SF)
    assert ok, message


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
