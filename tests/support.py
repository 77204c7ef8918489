"""Small hourly tables and configurations for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from workwindow.operators.classify import with_local_clock

MONDAY = datetime(2024, 1, 1)


def config(timezone: str = "UTC", **changes) -> dict:
    base = {
        "project": {"location": {"timezone": timezone}},
        "scenario_mode": "base_only",
        "required_parameters": ["temperature"],
        "weather_thresholds": {"base": {"temperature": {"min": -100, "max": 100}}},
        "operational_window": window(),
    }
    return {**base, **changes}


def window(start: str = "09:00", end: str = "17:00", **more) -> dict:
    return {"time_bounds": {"start_time": start, "end_time": end}, **more}


def hours(n: int, start: datetime = MONDAY) -> list[datetime]:
    return [start + timedelta(hours=i) for i in range(n)]


def truth(
    spark: SparkSession, times: list[datetime], timezone: str = "UTC", **values
) -> DataFrame:
    """Hourly table without site; a parameter is one number or one per hour."""
    names = list(values)
    columns = [v if isinstance(v, list) else [v] * len(times) for v in values.values()]
    rows = [
        (t, *(None if x is None else float(x) for x in xs)) for t, *xs in zip(times, *columns)
    ]
    schema = ", ".join(["time_utc timestamp_ntz", *(f"{p} double" for p in names)])
    return with_local_clock(spark.createDataFrame(rows, schema), timezone)


STANDARD_3 = {
    "scenario_mode": "standard_3",
    "required_parameters": ["temperature", "wind_speed", "precipitation"],
    "weather_thresholds": {
        scenario: {
            "temperature": {"max": t},
            "wind_speed": {"max": w},
            "precipitation": {"max": p},
        }
        for scenario, t, w, p in (
            ("base", 40, 20, 2.0),
            ("conservative", 35, 15, 1.0),
            ("optimistic", 45, 25, 3.0),
        )
    },
}
