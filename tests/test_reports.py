from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.support import STANDARD_3, config, hours, truth
from workwindow.functions.calendar import with_calendar
from workwindow.session import stage
from workwindow.operators import curves, loss, pivots, stats, summary, weather
from workwindow.operators.classify import classify
from workwindow.operators.counts import clock_cube, count_cubes, day_cube
from workwindow.rules.runwide import RuleSet


@pytest.fixture(scope="module")
def edge_month(spark):
    """72 UTC hours seen from Denver: seven of them fall into the previous year."""
    cfg = config("America/Denver")
    return classify(
        truth(spark, hours(72), "America/Denver", temperature=10), RuleSet.from_config(cfg)
    ).cache()


@pytest.fixture(scope="module")
def two_weeks(spark):
    values = {"temperature": 38, "wind_speed": 18, "precipitation": 1.5}
    rules = RuleSet.from_config(config(**STANDARD_3))
    return classify(truth(spark, hours(336), **values), rules).cache()


def test_edge_month(edge_month):
    rows = {(r.year, r.month): r for r in summary.summary_monthly(edge_month).collect()}
    december, january = rows[2023, 12], rows[2024, 1]
    assert (december.total_hours, december.operational_hours) == (7, 0)
    assert december.workable_pct_of_operational_hours == 0.0
    assert (january.total_hours, january.operational_hours, january.workable_hours) == (65, 24, 24)
    assert stats.stats_monthly_workable_rate_dist(edge_month).first().n_months == 1


def test_month_without_operational_hours_has_no_rate(edge_month):
    rates = {(r.year, r.month): r.workable_rate for r in stats.monthly_rate(edge_month).collect()}
    assert rates == {(2023, 12): None, (2024, 1): 1.0}
    cells = pivots.pivot_month_x_hour_workable_rate(edge_month).filter("month = 12").collect()
    assert {c.workable_pct_of_operational_hours for c in cells} == {None}


@pytest.mark.parametrize("report", [summary.summary_monthly, summary.summary_yearly])
def test_hours_add_up(two_weeks, report):
    for r in report(two_weeks).collect():
        assert r.workable_hours + r.weather_lost_hours == r.operational_hours
        assert r.schedule_lost_hours + r.operational_hours == r.total_hours


def test_looser_limits_never_lose_hours(two_weeks):
    wk = {r.scenario_id: r.workable_hours for r in summary.summary_run(two_weeks).collect()}
    assert wk == {"base": 112, "conservative": 0, "optimistic": 112}


def test_losses_name_the_first_failing_parameter(two_weeks):
    for report in (loss.loss_by_param_monthly, loss.loss_by_param_yearly):
        (row,) = report(two_weeks).collect()
        assert (row.scenario_id, row.param, row.hours_lost) == ("conservative", "temperature", 112)
        assert row.pct_of_weather_lost_hours == row.pct_of_operational_hours == 1.0


def test_lost_hours_without_a_name_are_unknown(two_weeks):
    anonymous = two_weeks.withColumn("limiting_param", F.lit(None).cast("string"))
    assert {r.param for r in loss.loss_by_param_yearly(anonymous).collect()} == {"unknown"}
    with pytest.raises(ValueError):
        loss.loss_by_param_yearly(two_weeks.drop("limiting_param"))


def test_null_flags_count_as_false(two_weeks):
    nothing = two_weeks.withColumn("is_operational", F.lit(None).cast("boolean"))
    assert {r.operational_hours for r in summary.summary_run(nothing).collect()} == {0}


def test_summaries_take_the_workable_flag_as_given_but_curves_do_not(two_weeks):
    always = two_weeks.withColumn("is_workable", F.lit(True))
    base = F.col("scenario_id") == "base"
    assert summary.summary_run(always).filter(base).first().workable_hours == 336
    last = curves.curves_cumulative_daily(always).filter(base).orderBy(F.desc("date_local")).first()
    assert last.workable_hours_cum == 112 and last.date_local == date(2024, 1, 14)


def test_cumulative_curve_runs_over_the_whole_period(two_weeks):
    rows = (
        curves.curves_cumulative_daily(two_weeks)
        .filter("scenario_id = 'conservative'")
        .orderBy("date_local")
        .collect()
    )
    assert [r.weather_lost_hours_cum for r in rows] == [8 * (i + 1) for i in range(14)]
    assert rows[-1].schedule_lost_hours_cum == 224


def test_reliability_curve_points(two_weeks):
    points = curves.curve_reliability_monthly(two_weeks).collect()
    assert len(points) == 33
    for p in points:
        assert p.fraction_of_months_meeting_threshold == (0.0 if p.scenario_id == "conservative" else 1.0)
    (own,) = curves.curve_reliability_monthly(two_weeks.filter("scenario_id='base'"), [0.3]).collect()
    assert own.threshold_workable_pct == 0.3


def test_reliability_targets(two_weeks):
    rows = {r.scenario_id: r for r in stats.reliability_targets_monthly(two_weeks).collect()}
    assert rows["base"].share_months_ge_90 == 1.0 and rows["base"].p80_monthly_workable_rate == 1.0
    assert rows["conservative"].share_months_ge_50 == 0.0


def test_without_scenarios_there_is_one_series(two_weeks):
    single = two_weeks.filter("scenario_id = 'base'").drop("scenario_id")
    assert "scenario_id" not in summary.summary_run(single).columns
    assert summary.summary_run(single).first().operational_hours == 112
    assert stats.reliability_targets_monthly(single).count() == 1


def test_cubes_give_the_same_reports(two_weeks):
    cubes = count_cubes(two_weeks).cache()
    pairs = [
        (day_cube(cubes), f)
        for f in (
            summary.summary_run,
            summary.summary_monthly,
            summary.summary_yearly,
            loss.loss_by_param_monthly,
            curves.curves_cumulative_daily,
            stats.reliability_targets_monthly,
        )
    ] + [
        (clock_cube(cubes), f)
        for f in (
            pivots.pivot_month_x_hour_workable_rate,
            pivots.pivot_month_x_weekday_workable_rate,
            pivots.pivot_weekday_x_hour_workable_rate,
        )
    ]
    for cube, report in pairs:
        assert sorted(report(cube).collect()) == sorted(report(two_weeks).collect())


def test_calendar_fields(spark):
    df = with_calendar(truth(spark, hours(1)), add_season=True)
    row = df.first()
    assert (row.year, row.month, row.day, row.weekday, row.hour) == (2024, 1, 1, 0, 0)
    assert (row.week_of_year, row.season, row.date_local) == (1, "DJF", date(2024, 1, 1))
    with pytest.raises(ValueError):
        with_calendar(spark.createDataFrame([("x",)], "time_local string"))


def test_weather_contexts_overlap(two_weeks):
    rows = weather.weather_stats_monthly(two_weeks, ["temperature"]).collect()
    found = {(r.scenario_id, r.context): r.n_hours for r in rows}
    assert found["base", "all"] == 336
    assert found["base", "operational"] == found["base", "workable"] == 112
    assert ("base", "blocked_operational") not in found
    assert found["conservative", "blocked_operational"] == 112
    assert {r["std"] for r in rows} == {0.0}


def test_weather_of_a_large_steady_reading(spark):
    n = 24 * 31
    reading = [1013.3 + 0.001 * (i % 2) for i in range(n)]
    df = classify(
        truth(spark, hours(n), temperature=1, surface_pressure=reading),
        RuleSet.from_config(config()),
    )
    row = weather.weather_stats_yearly(df, ["surface_pressure"]).filter("context='all'").first()
    assert row["std"] == pytest.approx(0.0005 * (n / (n - 1)) ** 0.5, rel=1e-6)
    assert row["mean"] == pytest.approx(1013.3005, abs=1e-9)


def test_weather_with_missing_values(spark):
    values = [1.0, float("nan"), None, 4.0] * 6
    df = classify(truth(spark, hours(24), temperature=values), RuleSet.from_config(config()))
    row = weather.weather_stats_monthly(df, ["temperature"]).filter("context = 'all'").first()
    assert (row.n_hours, row.missing_rate, row["min"], row["max"]) == (24, 0.5, 1.0, 4.0)
    assert row["mean"] == 2.5 and row.p50 == 2.5
    mean = pivots.pivot_month_x_hour_param_mean_operational(df, ["temperature"])
    assert mean.agg(F.sum("n_hours")).first()[0] == 8
    with pytest.raises(ValueError):
        weather.weather_stats_monthly(df, ["rain"])


def test_context_without_a_reading_still_has_a_row(spark):
    cfg = config(weather_thresholds={"base": {}})
    df = classify(truth(spark, hours(24), temperature=[None] * 24), RuleSet.from_config(cfg))
    row = weather.weather_stats_monthly(df, ["temperature"]).filter("context='all'").first()
    assert (row.n_hours, row.missing_rate, row["mean"], row.p50) == (24, 1.0, None, None)


def test_quantiles_match_the_built_in_ones(spark):
    values = [float(v) for v in (3, 1, 1, 1, 8, 2, 2, 9, 4, 4, 4, 7)] * 2
    df = classify(truth(spark, hours(24), temperature=values), RuleSet.from_config(config()))
    row = weather.weather_stats_monthly(df, ["temperature"]).filter("context = 'all'").first()
    for name, level in weather.QUANTILES.items():
        want = df.agg(F.percentile("temperature", F.lit(level))).first()[0]
        assert row[name] == pytest.approx(want)


def test_both_weather_tables_read_one_written_state(spark, two_weeks, tmp_path, capsys):
    two_weeks.write.parquet(f"{tmp_path}/hours")
    hourly = spark.read.parquet(f"{tmp_path}/hours")
    state = stage(weather.value_counts(hourly, ["temperature"]), "state")
    capsys.readouterr()
    for op in (weather.weather_stats_monthly, weather.weather_stats_yearly):
        table = op(state, ["temperature"])
        table.explain("formatted")
        plan = capsys.readouterr().out
        assert plan.count("Scan parquet") == 2 and "/hours" not in plan  # in the tree and in its details
        want = op(hourly, ["temperature"])
        assert table.exceptAll(want).isEmpty() and want.exceptAll(table).isEmpty()
