"""Every query with an oracle gives the oracle's rows, names and types."""

import pytest
from tests.conftest import MEDIUM
from tests.parity import duckdb_rows, open_tables, spark_rows
from txnrisk.llm.registry import llm_oracles, llm_queries


def test_there_is_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in llm_queries()]
    assert numbers == list(range(1, 14))
    assert set(llm_oracles()) == {"op2_mixing", "op12_source_divergence", "op13_warc"}


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_oracle(spark, name):
    connection = open_tables(MEDIUM)
    expected_types, expected = duckdb_rows(connection, llm_oracles()[name])
    connection.close()
    types, rows = spark_rows(llm_queries()[name](spark, MEDIUM))
    assert types == expected_types
    assert rows == expected and rows
