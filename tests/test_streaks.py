import random
from datetime import datetime, timedelta
from statistics import median

import pytest

from tests.support import MONDAY, STANDARD_3, config, hours, truth
from workwindow.operators import previews, streaks
from workwindow.operators.classify import classify
from workwindow.rules.runwide import RuleSet

SCHEMA = (
    "site_id string, time_utc timestamp_ntz, scenario_id string, "
    "operational_flag boolean, workable_flag boolean"
)


def _brute_force(rows):
    """Runs by walking each site's operational rows in (scenario, time, flag) order."""
    out = []
    for site in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == site and r[3]]
        times = sorted({r[1] for r in own})
        gaps = [(b - a).total_seconds() / 3600 for a, b in zip(times, times[1:])]
        step = median(gaps) if gaps else 1.0
        number, previous = 0, None
        for _, t, scenario, _, flag in sorted(own, key=lambda r: (r[2], r[1], bool(r[4]))):
            flag = bool(flag)
            same = previous is not None and previous[0] == scenario and previous[2] == flag
            if not same or (t - previous[1]).total_seconds() / 3600 > 1.5 * step:
                number += 1
                out.append([site, scenario, number, t, t, 0, flag])
            out[-1][4], out[-1][5] = t, out[-1][5] + 1
            previous = (scenario, t, flag)
        for run in out:
            if run[0] == site:
                run[5] = run[5] * step
    return sorted(tuple(r) for r in out)


def _found(spark, rows):
    runs = streaks.operational_runs(spark.createDataFrame(rows, SCHEMA))
    columns = ["site_id", "scenario_id", "streak_id", "start_ts", "end_ts", "duration_hours", "workable"]
    return sorted(tuple(r) for r in runs.select(*columns).collect())


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(spark, seed):
    """Gaps, repeats, null flags and several months, so runs cross the month cuts."""
    rng = random.Random(seed)
    rows = []
    for site in ("a", "b"):
        t = datetime(2023, 12, 28)
        for _ in range(300):
            t += timedelta(hours=rng.choice([1, 1, 1, 1, 2, 17, 400 if seed % 2 else 1]))
            for scenario in ("base", "tight"):
                for _ in range(rng.choice([1, 1, 1, 2])):
                    flag = rng.choice([True, True, True, False, None])
                    rows.append((site, t, scenario, rng.random() < 0.9, flag))
    rng.shuffle(rows)
    assert _found(spark, rows) == _brute_force(rows)


def test_one_run_over_many_months(spark):
    rows = [("a", MONDAY + timedelta(hours=i), "base", True, False) for i in range(24 * 100)]
    assert _found(spark, rows) == [
        ("a", "base", 1, MONDAY, rows[-1][1], 2400.0, False),
    ]


def test_two_weeks_of_blocked_days(spark):
    values = {"temperature": 38, "wind_speed": 18, "precipitation": 1.5}
    rules = RuleSet.from_config(config(**STANDARD_3))
    classified = classify(truth(spark, hours(336), **values), rules)
    runs = streaks.operational_runs(classified).cache()
    assert streaks.timestep_hours(classified).first().timestep_hours == 1.0
    (row,) = streaks.streaks_summary(runs).collect()
    assert row.scenario_id == "conservative"
    assert (row.n_blocked_streaks, row.longest_blocked_hours) == (14, 8.0)
    assert (row.p50_blocked_hours, row.p90_blocked_hours) == (8.0, 8.0)
    assert (row.count_blocked_ge_6h, row.count_blocked_ge_12h, row.count_blocked_ge_24h) == (14, 0, 0)
    assert (row.n_workable_streaks, row.longest_workable_hours) == (0, 0.0)
    ids = [r.streak_id for r in runs.orderBy("scenario_id", "start_ts").collect()]
    assert ids == list(range(1, 43))


def test_shared_timestamps_of_scenarios(spark):
    times = [datetime(2024, 1, 1, 16), datetime(2024, 1, 1, 17)]
    rows = [("a", t, s, True, False) for s in ("base", "optimistic") for t in times]
    found = _found(spark, rows)
    assert [(r[1], r[2], r[5]) for r in found] == [("base", 1, 2.0), ("optimistic", 2, 2.0)]


def test_single_hour_lasts_one_hour(spark):
    assert _found(spark, [("a", MONDAY, "base", True, True)])[0][5] == 1.0


def test_one_hour_a_day_is_one_long_run(spark):
    rows = [("a", MONDAY + timedelta(days=i), "base", True, False) for i in range(10)]
    (run,) = _found(spark, rows)
    assert run[5] == 240.0


def test_flags_fall_back_and_series_are_optional(spark):
    rows = [(t, True, False) for t in hours(3)]
    df = spark.createDataFrame(rows, "time_utc timestamp_ntz, is_operational boolean, is_workable boolean")
    (run,) = streaks.operational_runs(df).collect()
    assert (run.scenario_id, run.duration_hours) == ("baseline", 3.0)
    assert "site_id" not in run.asDict()
    with pytest.raises(ValueError):
        streaks.operational_runs(df.drop("is_workable"))


def test_no_operational_hours_give_no_runs(spark):
    assert _found(spark, [("a", MONDAY, "base", False, False)]) == []


def test_top_streaks_are_ordered(spark):
    rows = [("a", t, "base", True, i % 5 == 0) for i, t in enumerate(hours(60))]
    runs = streaks.operational_runs(spark.createDataFrame(rows, SCHEMA))
    top = streaks.top_blocked_streaks(runs, 3).collect()
    assert [r.duration_hours for r in top] == [4.0, 4.0, 4.0]
    assert [r.streak_id for r in top] == [2, 4, 6]


def test_hours_are_scanned_once_for_runs(spark, tmp_path):
    """Both readers of the steps and of the piece runs share one exchange each."""
    path = str(tmp_path / "hours")
    rows = [("a", t, "base", True, i % 5 == 0) for i, t in enumerate(hours(2000))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    runs = streaks.operational_runs(spark.read.parquet(path))
    runs.collect()
    final = runs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2


def test_time_step_of_jittered_times(spark):
    """The median over all gaps of a site, whatever month they lie in or lead to."""
    rng = random.Random(8)
    rows, medians = [], {}
    for site in ("a", "b"):
        times = sorted({MONDAY + timedelta(seconds=3600 * i + rng.randrange(1200)) for i in range(1700)})
        gaps = [(y - x).total_seconds() / 3600 for x, y in zip(times, times[1:])]
        medians[site] = median(gaps)
        rows += [(site, t, s, True, False) for t in times for s in ("base", "storm")]
    rng.shuffle(rows)
    hourly = spark.createDataFrame(rows, SCHEMA)
    found = {r.site_id: r.timestep_hours for r in streaks.timestep_hours(hourly).collect()}
    assert found == {s: pytest.approx(m, abs=1e-9) for s, m in medians.items()}


def test_gaps_of_pieces_make_the_histogram_of_a_site(spark):
    times = [datetime(2024, 1, 31, 22), datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 1), datetime(2024, 4, 1, 1)]
    steps = streaks.operational_steps(spark.createDataFrame([("a", t, "base", True, True) for t in times], SCHEMA))
    found = {r.gap: r.n for r in streaks.gap_histogram(steps).collect()}
    assert found == {None: 1, 1.0: 1, 2.0: 1, 60 * 24.0: 1}


def test_top_rows_of_every_site_are_limited_before_the_shuffle(spark, capsys):
    rows = [(s, t, "base", True, i % 5 == 0) for s in "abc" for i, t in enumerate(hours(60))]
    runs = streaks.operational_runs(spark.createDataFrame(rows, SCHEMA))
    top = previews.top_blocked_streaks_by_site(runs, 2)
    found = [(r.site_id, r.duration_hours, r.streak_id) for r in top.orderBy("site_id", "streak_id").collect()]
    assert found == [(s, 4.0, i) for s in "abc" for i in (2, 4)]
    top.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out
    alone = previews.top_blocked_streaks_by_site(runs.filter("site_id = 'a'").drop("site_id"), 3)
    assert [r.streak_id for r in alone.collect()] == [2, 4, 6]
