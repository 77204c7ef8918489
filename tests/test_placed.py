import re
import uuid

import pytest
from pyspark.sql import functions as F

from tests.support import STANDARD_3, config, hours, truth
from workwindow.operators import streaks, weather
from workwindow.operators.classify import classify_packed
from workwindow.plans.placed import write_placed
from workwindow.rules.runwide import RuleSet


@pytest.fixture(scope="module")
def packed(spark):
    n = 24 * 70
    values = {"temperature": [20 + i % 23 for i in range(n)], "wind_speed": [i % 29 for i in range(n)]}
    table = truth(spark, hours(n), timezone="America/Denver", precipitation=0.5, **values)
    sites = spark.createDataFrame([("a",), ("b",), ("c",)], "site_id string")
    return classify_packed(sites.crossJoin(table), RuleSet.from_config(config("America/Denver", **STANDARD_3)))


@pytest.fixture(scope="module")
def placed(packed):
    return write_placed(packed, f"hours_{uuid.uuid4().hex}", 4)


def above_scan(df, capsys) -> list[str]:
    """Operators of the plan from the first aggregation down to the scan."""
    capsys.readouterr()
    df.explain()
    names = re.findall(r"^[\s:+\-|*()\d]*(\w+)", capsys.readouterr().out, re.M)
    return names[: names.index("FileScan") + 1]


def test_steps_and_value_counts_are_made_where_the_hours_lie(placed, capsys):
    for made in (streaks.operational_steps(placed), weather.value_counts(placed, ["temperature", "wind_speed"])):
        plan = above_scan(made, capsys)
        assert "HashAggregate" in plan and "Exchange" not in plan, plan


def test_placed_hours_give_the_same_results(packed, placed):
    for make in (
        streaks.operational_runs,
        streaks.timestep_hours,
        lambda h: weather.weather_stats_monthly(h, ["temperature", "wind_speed"]),
        lambda h: weather.weather_stats_yearly(h, ["wind_speed"]),
    ):
        want, got = make(packed), make(placed)
        assert want.columns == got.columns
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_hours_without_site_are_not_placed(packed):
    damaged = packed.withColumn("site_id", F.when(F.hour("time_utc") != 3, F.col("site_id")))
    with pytest.raises(Exception, match="site_id must not be null"):
        write_placed(damaged, f"hours_{uuid.uuid4().hex}", 2)
