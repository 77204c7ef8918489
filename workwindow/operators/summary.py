"""Run, monthly and yearly summaries, and the run digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workwindow.functions.expr import present, ratio_or_zero
from workwindow.operators.counts import add_up, as_counts


def _metrics() -> dict[str, Column]:
    total, op, wk = F.col("n_hours"), F.col("n_operational"), F.col("n_workable")
    return {
        "total_hours": total,
        "operational_hours": op,
        "workable_hours": wk,
        "schedule_lost_hours": total - op,
        "weather_lost_hours": op - wk,
        "operational_pct_of_total_hours": ratio_or_zero(op, total),
        "workable_pct_of_total_hours": ratio_or_zero(wk, total),
        "workable_pct_of_operational_hours": ratio_or_zero(wk, op),
        "weather_lost_pct_of_operational_hours": ratio_or_zero(op - wk, op),
        "schedule_lost_pct_of_total_hours": ratio_or_zero(total - op, total),
    }


def summary_run(hourly: DataFrame, **columns: str) -> DataFrame:
    """Ten metrics per scenario over the whole run; ``scenario_id`` comes last."""
    summed = add_up(as_counts(hourly, **columns))
    return summed.select(
        *present(summed, ["site_id"]),
        *(c.alias(name) for name, c in _metrics().items()),
        *present(summed, ["scenario_id"]),
    )


def _summary_by(hourly: DataFrame, dims: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    summed = add_up(as_counts(hourly, **columns), *dims)
    return summed.select(
        *present(summed, ("site_id", "scenario_id", *dims)),
        *(c.alias(name) for name, c in _metrics().items()),
    )


def summary_monthly(hourly: DataFrame, **columns: str) -> DataFrame:
    return _summary_by(hourly, ("year", "month"), columns)


def summary_yearly(hourly: DataFrame, **columns: str) -> DataFrame:
    return _summary_by(hourly, ("year",), columns)


def run_digest(run: DataFrame) -> DataFrame:
    """Headline hours and percentages of a run summary."""

    def percent(part: str, whole: str) -> Column:
        return ratio_or_zero(F.col(part), F.col(whole)) * 100.0

    return run.select(
        *present(run, ("site_id", "scenario_id")),
        "workable_hours",
        "operational_hours",
        "schedule_lost_hours",
        "weather_lost_hours",
        percent("workable_hours", "operational_hours").alias("workable_pct_op"),
        percent("weather_lost_hours", "operational_hours").alias("weather_lost_pct_op"),
        percent("schedule_lost_hours", "total_hours").alias("schedule_lost_pct_total"),
        percent("operational_hours", "total_hours").alias("operational_pct_total"),
    )
