import duckdb
import pytest

from checks import compare
from workwindow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_oracle(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    con: duckdb.DuckDBPyConnection = compare.oracle_connection(SF_DIR)
    assert compare.differences(spark, con, SF_DIR, name) == ""
