"""The registered queries over the sample tables."""

import pytest

import __spark_entry__ as contract
from parity import difference, oracle_connection
from starlane.llm.queries import ORACLE, QUERIES


def test_the_entry_registers_every_operator():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, samples, name):
    got = QUERIES[name](spark, samples).toArrow()
    assert difference(got, oracle_connection(samples).sql(ORACLE[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", sorted(set(contract.queries()) & ({"pipeline"} | set(QUERIES)) - set(ORACLE)))
def test_query_returns_rows(spark, samples, name):
    assert contract.queries()[name](spark, samples).count() > 0
