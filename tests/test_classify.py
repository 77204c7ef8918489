from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.support import MONDAY, STANDARD_3, config, hours, truth, window
from workwindow.operators.classify import (
    classify,
    evaluate_thresholds,
    evaluation_summary,
    operational_mask,
    with_local_clock,
)
from workwindow.operators.summary import summary_run
from workwindow.rules.runwide import RuleSet


def _classified(spark, cfg, times, timezone="UTC", **values):
    return classify(truth(spark, times, timezone, **values), RuleSet.from_config(cfg))


def _column(df, name):
    return [r[0] for r in df.orderBy("time_utc").select(name).collect()]


def test_weekly_override_shortens_friday(spark):
    friday = {4: {"start_time": "09:00", "end_time": "12:00"}}
    cfg = config(operational_window=window(weekly_overrides=friday))
    row = summary_run(_classified(spark, cfg, hours(168), temperature=10)).first()
    assert (row.total_hours, row.operational_hours, row.workable_hours) == (168, 51, 51)


def test_excluded_weekday_stays_excluded(spark):
    ow = window(
        calendar_model="custom",
        weekdays=[0],
        weekly_overrides={1: {"start_time": "00:00", "end_time": "23:00"}},
    )
    cfg = config(operational_window=ow)
    row = summary_run(_classified(spark, cfg, hours(48), temperature=10)).first()
    assert row.operational_hours == 8


def test_seconds_do_not_matter_for_the_window(spark):
    times = [datetime(2024, 1, 1, 16, 59, 59), datetime(2024, 1, 1, 17, 0, 0)]
    rules = RuleSet.from_config(config())
    assert _column(operational_mask(truth(spark, times), rules), "is_operational") == [True, False]


def test_bounds_are_inclusive(spark):
    cfg = config(
        weather_thresholds={"base": {"temperature": {"min": 0, "max": 40}}},
        operational_window=window("00:00", "23:59"),
    )
    df = _classified(spark, cfg, hours(4), temperature=[0.0, 40.0, -0.1, 40.1])
    assert _column(df, "workable_flag") == [True, True, False, False]


@pytest.mark.parametrize("missing", [float("nan"), None])
def test_missing_value_fails_any_bound(spark, missing):
    cfg = config(
        weather_thresholds={"base": {"temperature": {"min": 0}}},
        operational_window=window("00:00", "23:59"),
    )
    df = _classified(spark, cfg, hours(2), temperature=[missing, 10.0])
    assert _column(df, "workable_flag") == [False, True]
    assert _column(df, "limiting_param") == ["temperature", None]


def test_missing_value_passes_without_bounds(spark):
    cfg = config(weather_thresholds={"base": {}}, operational_window=window("00:00", "23:59"))
    assert _column(_classified(spark, cfg, hours(1), temperature=[None]), "workable_flag") == [True]


def test_first_failing_parameter_limits(spark):
    limits = {"temperature": {"max": 10}, "wind_speed": {"max": 10}}
    cfg = config(
        required_parameters=["temperature", "wind_speed"],
        weather_thresholds={"base": limits},
        operational_window=window("00:00", "23:59"),
    )
    df = _classified(spark, cfg, hours(3), temperature=[20, 5, 5], wind_speed=[20, 20, 5])
    assert _column(df, "limiting_param") == ["temperature", "wind_speed", None]


def test_thresholds_outside_required_parameters_are_ignored(spark):
    cfg = config(weather_thresholds={"base": {"wind_speed": {"max": 1}}})
    row = summary_run(_classified(spark, cfg, hours(24), temperature=5, wind_speed=99)).first()
    assert row.workable_hours == row.operational_hours == 8


def test_scenarios_differ(spark):
    cfg = config(
        scenario_mode="standard_3",
        required_parameters=["wind_speed"],
        weather_thresholds={
            s: {"wind_speed": {"max": m}}
            for s, m in (("base", 20), ("conservative", 10), ("optimistic", 30))
        },
    )
    start = datetime(2024, 1, 2)
    df = _classified(spark, cfg, hours(24, start), "America/Denver", wind_speed=15)
    found = {
        r.scenario_id: (r.operational_hours, r.workable_hours) for r in summary_run(df).collect()
    }
    assert found == {"base": (8, 8), "conservative": (8, 0), "optimistic": (8, 8)}


def test_classified_columns_in_order(spark):
    df = _classified(spark, config(), hours(1), temperature=1)
    assert df.columns == [
        "time_utc",
        "time_local",
        "temperature",
        "scenario_id",
        "operational_flag",
        "workable_flag",
        "loss_flag",
        "limiting_param",
        "is_operational",
        "is_workable",
    ]


def test_repeated_wall_hour_in_autumn_counts_twice(spark):
    times = [datetime(2024, 11, 3, 7), datetime(2024, 11, 3, 8)]
    df = truth(spark, times, "America/Denver", temperature=1)
    assert [t.hour for t in _column(df, "time_local")] == [1, 1]


def test_skipped_wall_hour_in_spring(spark):
    times = [datetime(2024, 3, 10, 8), datetime(2024, 3, 10, 9)]
    df = truth(spark, times, "America/Denver", temperature=1)
    assert [t.hour for t in _column(df, "time_local")] == [1, 3]


def test_zone_may_come_from_a_column(spark):
    rows = [("a", "UTC", MONDAY), ("b", "Asia/Kolkata", MONDAY)]
    df = spark.createDataFrame(rows, "site_id string, tz string, time_utc timestamp_ntz")
    local = with_local_clock(df, F.col("tz")).orderBy("site_id").select("time_local").collect()
    assert [r[0] for r in local] == [MONDAY, datetime(2024, 1, 1, 5, 30)]


def test_evaluation_reports_every_hour(spark):
    cfg = config(
        required_parameters=["temperature", "rain"],
        weather_thresholds={"base": {"temperature": {"max": 10}}},
    )
    rules = RuleSet.from_config(cfg)
    masked = operational_mask(truth(spark, hours(1), temperature=20, rain=None or 0), rules)
    row = evaluate_thresholds(masked, rules).first()
    assert (row.ok_temperature, row.ok_rain, row.all_ok, row.is_workable) == (
        False,
        True,
        False,
        False,
    )
    assert row.limiting_param == "temperature" and not row.is_operational


def test_missing_columns_are_errors(spark):
    rules = RuleSet.from_config(config())
    with pytest.raises(ValueError, match="temperature"):
        classify(truth(spark, hours(1), rain=0), rules)
    with pytest.raises(ValueError, match="time_local"):
        operational_mask(spark.range(1), rules)


def test_evaluation_summary_is_in_percent(spark):
    cfg = config(**STANDARD_3)
    df = _classified(spark, cfg, hours(24), temperature=38, wind_speed=18, precipitation=1.5)
    rows = {r.scenario_id: r for r in evaluation_summary(df).collect()}
    assert rows["base"].workable_pct_of_operational == 100.0
    assert rows["conservative"].workable_pct_of_operational == 0.0
    assert rows["base"].workable_pct_of_total == pytest.approx(100 / 3)


def test_classification_needs_no_shuffle_and_no_python(spark):
    df = _classified(spark, config(**STANDARD_3), hours(2), temperature=1, wind_speed=1, precipitation=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
