import pytest

from pyspark.sql import functions as F

from checks import fixtures
from checks.compare import differences, oracle_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_oracle(spark, oracle, name):
    assert differences(spark, oracle, SF_DIR, name) == ""


@pytest.mark.parametrize(
    ("table", "total", "operational", "workable"),
    [
        ("classified_events", 868, 298, {"base": 196, "conservative": 88, "optimistic": 293}),
        ("classified_lineitem", 5915, 1991, {"base": 1597, "conservative": 861, "optimistic": 1832}),
    ],
)
def test_fixture_counts(spark, table, total, operational, workable):
    hourly = getattr(fixtures, table)(spark, SF_DIR)
    rows = hourly.groupBy("scenario_id").agg(
        F.count("*").alias("n"),
        F.count_if("is_operational").alias("op"),
        F.count_if("is_workable").alias("wk"),
    )
    found = {r.scenario_id: (r.n, r.op, r.wk) for r in rows.collect()}
    assert found == {s: (total, operational, wk) for s, wk in workable.items()}
