import json
from datetime import datetime

import pytest

from tests.support import config, hours
from workwindow.plans.pipeline import run_landed, run_parquet
from workwindow.rules.fixed import SOURCE_FIELD
from workwindow.sources.landed import (
    landed_violations,
    parse_landed,
    read_landed,
    response_schema,
    split_landed,
    truth_from_landed,
)
from workwindow.sources.truth import analysis_years, in_years, read_truth

PARAMS = ["temperature", "wind_speed"]


def _land(folder, site, hourly):
    target = folder / f"site_id={site}"
    target.mkdir(parents=True, exist_ok=True)
    (target / "response.json").write_text(json.dumps({"latitude": 1.5, "hourly": hourly}, indent=1))


def _hourly(n, **changes):
    times = [t.strftime("%Y-%m-%dT%H:%M") for t in hours(n)]
    fields = {"time": times, "temperature_2m": [1.0] * n, "wind_speed_10m": [None, *[2] * (n - 1)]}
    return {k: v for k, v in {**fields, **changes}.items() if v is not ...}


def test_seventeen_parameters():
    assert len(SOURCE_FIELD) == 17
    with pytest.raises(ValueError, match="pollen"):
        response_schema(["pollen"])


def test_landed_files_become_hours(spark, tmp_path):
    _land(tmp_path, "a", _hourly(3))
    _land(tmp_path, "b", _hourly(2))
    responses = read_landed(spark, str(tmp_path), PARAMS)
    assert landed_violations(responses, PARAMS).count() == 0
    rows = truth_from_landed(responses, PARAMS, "America/Denver").orderBy("site_id", "time_utc").collect()
    assert [r.site_id for r in rows] == ["a", "a", "a", "b", "b"]
    assert rows[0].time_local == datetime(2023, 12, 31, 17) and rows[0].wind_speed is None
    assert rows[1].asDict() == {
        "site_id": "a",
        "time_utc": datetime(2024, 1, 1, 1),
        "time_local": datetime(2023, 12, 31, 18),
        "temperature": 1.0,
        "wind_speed": 2.0,
    }


def test_faulty_responses_are_found(spark, tmp_path):
    _land(tmp_path, "block", None)
    _land(tmp_path, "field", _hourly(2, temperature_2m=...))
    _land(tmp_path, "good", _hourly(2))
    _land(tmp_path, "length", _hourly(3, wind_speed_10m=[1.0]))
    _land(tmp_path, "time", _hourly(2, time=[]))
    responses = read_landed(spark, str(tmp_path), PARAMS)
    found = {
        (r.site_id, r.problem, r.field, r.detail)
        for r in landed_violations(responses, PARAMS).collect()
    }
    assert found == {
        ("block", "missing_block", "hourly", ""),
        ("field", "missing_field", "temperature_2m", ""),
        ("length", "length_mismatch", "wind_speed_10m", "1 vs 3"),
        ("time", "missing_time", "time", ""),
    }
    kept = truth_from_landed(responses, PARAMS, "UTC", strict=False).collect()
    assert {r.site_id for r in kept} == {"good"} and len(kept) == 2
    with pytest.raises(Exception, match="faulty weather response"):
        truth_from_landed(responses, PARAMS, "UTC").collect()


def test_years():
    assert analysis_years({"analysis_end_year": 2024, "historic_years": 3}) == (2022, 2024)
    with pytest.raises(ValueError):
        analysis_years({"analysis_end_year": 2024, "historic_years": 0})


@pytest.fixture(scope="module")
def parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("truth") / "hourly")
    rows = [("a", t, float(i % 7), float("nan")) for i, t in enumerate(hours(48, datetime(2023, 12, 31)))]
    spark.createDataFrame(
        rows, "site_id string, time_utc timestamp_ntz, temperature double, wind_speed double"
    ).write.parquet(path)
    return path


def test_year_range_and_columns_reach_the_scan(spark, parquet):
    df = read_truth(spark, parquet, ["temperature"], "UTC", (2024, 2024))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time_utc" in plan and "LessThan(time_utc" in plan
    assert "wind_speed" not in plan.split("ReadSchema")[1]
    assert df.count() == 24


def test_nan_is_missing(spark, parquet):
    df = read_truth(spark, parquet, ["wind_speed"], "UTC")
    assert df.filter("wind_speed IS NULL").count() == 48


def test_year_bounds(spark, parquet):
    assert in_years(spark.read.parquet(parquet), 2023, 2023).count() == 24


def test_runs_from_parquet_and_from_landed_files_agree(spark, parquet, tmp_path):
    period = {"analysis_end_year": 2024, "historic_years": 1}
    cfg = config()
    cfg["project"] = {**cfg["project"], "analysis_period": period}
    times = hours(24, datetime(2024, 1, 1))
    _land(
        tmp_path,
        "a",
        {
            "time": [t.strftime("%Y-%m-%dT%H:%M") for t in times],
            "temperature_2m": [float((i + 24) % 7) for i in range(24)],
        },
    )
    one = run_parquet(spark, parquet, cfg).tables["summary_run"].collect()
    two = run_landed(spark, str(tmp_path), cfg).tables["summary_run"].collect()
    assert one == two and one[0].total_hours == 24


def test_landed_documents_are_split_in_one_read(spark, tmp_path, capsys):
    sound = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, null]}}'
    short = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5]}}'
    rows = [("a", sound), ("b", short), ("c", "{}"), ("d", '{"hourly": {"time": []}}'), ("e", None), ("f", "no"), ("g", '{"hourly": {"time": ["2024-01-01T00:00"]}}')]
    spark.createDataFrame(rows, "site_id string, doc string").write.parquet(f"{tmp_path}/in")
    responses = parse_landed(spark.read.parquet(f"{tmp_path}/in"), "doc", ["temperature"])
    truth, problems = split_landed(responses, ["temperature"], "UTC")
    for result in (truth, problems):
        result.explain("formatted")
        assert f"{tmp_path}/in" not in capsys.readouterr().out
    assert [(r.site_id, r.time_utc.hour, r.temperature) for r in truth.orderBy("time_utc").collect()] == [("a", 0, 1.5), ("a", 1, None)]
    assert sorted((r.site_id, r.problem, r.field, r.detail) for r in problems.collect()) == [
        ("b", "length_mismatch", "temperature_2m", "1 vs 2"),
        ("c", "missing_block", "hourly", ""),
        ("d", "missing_time", "time", ""),
        ("e", "missing_block", "hourly", ""),
        ("f", "missing_block", "hourly", ""),
        ("g", "missing_field", "temperature_2m", ""),
    ]
