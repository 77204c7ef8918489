"""All report tables of a run, their metadata, checks and the writer."""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from workwindow.functions.expr import present
from workwindow.operators import curves, loss, pivots, stats, streaks, summary, weather
from workwindow.operators.counts import clock_cube, count_cubes, day_cube
from workwindow.plans.contracts import (
    check_hourly,
    check_tables,
    fraction_columns,
    null_counts,
    outside_counts,
    reject_empty,
    reject_keys,
    reject_outside,
)
from workwindow.session import at_once, stage


SORT_ORDER = (
    "site_id",
    "year",
    "month",
    "weekday",
    "hour",
    "date_local",
    "threshold_workable_pct",
    "context",
    "param",
    "streak_id",
)


@dataclass(frozen=True)
class Bundle:
    meta: DataFrame
    tables: Mapping[str, DataFrame]
    #: Counts taken while the hourly table was read: hours without keys, repeated hours.
    missing_keys: Mapping[str, int] = field(default_factory=dict)
    repeated_hours: int = 0

    def write(self, path: str, refuse_repeats: bool = False) -> str:
        """Write to a new folder below ``path``, check, then publish; returns that folder.

        One Parquet folder per table, partitioned by scenario where there is one.
        Rebalancing lets adaptive execution cut the output into files of even
        size, also where one scenario or site dominates. Fractions are checked
        while the rows pass by; independent tables are written side by side. Only
        a run that passes is named in ``path/_current``, so what was published
        before stays whole until then, and no row of it can survive among new ones.
        Hours without a key are refused, repeated ones if asked: both were counted in
        passing when the bundle was built.
        """
        reject_keys(self.missing_keys, self.repeated_hours if refuse_repeats else 0)
        root = path.rstrip("/")
        path = f"{root}/run-{uuid.uuid4().hex}"
        watches = {name: Observation(name) for name, t in self.tables.items() if fraction_columns(t)}

        def save(name: str, table: DataFrame) -> None:
            split = present(table, ["scenario_id"])
            order = [*split, *present(table, SORT_ORDER)]
            if name in watches:
                table = table.observe(watches[name], *outside_counts(table))
            even = table.hint("rebalance", *split)
            even = even.sortWithinPartitions(*order) if order else even
            even.write.mode("errorifexists").partitionBy(*split).parquet(f"{path}/{name}")

        named = {**self.tables, "run_meta": self.meta}
        at_once([functools.partial(save, name, table) for name, table in named.items()])
        reject_outside({name: watch.get for name, watch in watches.items()})
        spark = self.meta.sparkSession
        current = spark.range(1).select(F.lit(path).alias("folder"), F.array(*map(F.lit, sorted(named))).alias("tables"))
        current.coalesce(1).write.mode("overwrite").parquet(f"{root}/_current")
        return path


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the run that was published last, by name (``run_meta`` among them)."""
    current = spark.read.parquet(f"{path.rstrip('/')}/_current").first()
    return {name: spark.read.parquet(f"{current.folder}/{name}") for name in current.tables}


def required_tables(weather: bool, curves_: bool, visual: bool, stats_: bool) -> list[str]:
    """Names that a bundle with these flags must hold."""
    names = ["summary_run", "summary_monthly", "summary_yearly"]
    names += ["loss_by_param_monthly", "loss_by_param_yearly"]
    names += [f"streaks_{x}_operational" for x in ("nonworkable", "workable", "summary")]
    names += ["weather_stats_monthly", "weather_stats_yearly"] * weather
    names += ["curves_cumulative_daily", "curve_reliability_monthly"] * curves_
    names += [f"pivot_{x}_workable_rate" for x in ("month_x_hour", "month_x_weekday", "weekday_x_hour")] * visual
    names += ["stats_monthly_workable_rate_dist", "reliability_targets_monthly"] * stats_
    return names


def run_meta(rows: DataFrame, config: Mapping[str, Any], run_id: str) -> DataFrame:
    """One row of run metadata; ``rows`` has the number of hourly rows as ``rows_hourly``."""
    project = config.get("project") or {}
    location, period = project.get("location") or {}, project.get("analysis_period") or {}
    canonical = json.dumps(config, sort_keys=True, default=str)
    start = period.get("start_date", period.get("period_start", ""))
    end = period.get("end_date", period.get("period_end", ""))
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at_utc"),
        F.lit(str(location.get("name", ""))).alias("location_name"),
        F.lit(str(location.get("timezone", ""))).alias("timezone"),
        F.lit(str(start)).alias("period_start_utc"),
        F.lit(str(end)).alias("period_end_utc"),
        F.array(*(F.lit(str(p)) for p in config.get("required_parameters") or [])).alias(
            "parameters"
        ),
        F.lit(json.dumps(config.get("weather_thresholds") or {}, sort_keys=True)).alias(
            "thresholds"
        ),
        F.substring(F.sha2(F.lit(canonical), 256), 1, 16).alias("config_hash"),
        "rows_hourly",
    )


def build_bundle(
    hourly: DataFrame,
    config: Mapping[str, Any],
    run_id: str = "run",
    packed: DataFrame | None = None,
    include_weather_stats: bool = False,
    include_curves: bool = True,
    include_visual: bool = True,
    include_stats: bool = True,
    weather_params: Sequence[str] | None = None,
    visual_params_for_mean: Sequence[str] | None = None,
    validate: bool = True,
    **columns: str,
) -> Bundle:
    """Report tables of a classified hourly table.

    The hourly table is scanned once for both count cubes, once for the runs and once
    for the value counts of both weather tables; these are written to shared storage, and
    all tables but the parameter means read them. ``validate`` refuses a bundle that lacks a table its flags ask for;
    values are checked once, while they are written. ``columns`` may rename ``time_local_col``, ``operational_col``,
    ``workable_col`` and ``limiting_col``. ``packed``, the same hours in packed
    form, makes streaks and weather statistics shuffle less.
    """
    params = list(config.get("required_parameters") or [])
    params = list(weather_params) if weather_params is not None else params
    check_hourly(hourly, params if include_weather_stats else None, rows=False)
    if include_weather_stats and not params:
        raise ValueError("weather statistics need weather parameters")

    dense = hourly if packed is None else packed
    keys, repeats = Observation("keys"), Observation("repeats")
    watched = hourly.observe(keys, *null_counts(hourly))
    jobs = [
        lambda: stage(count_cubes(watched, **columns), "cubes", ("grain",)),
        lambda: stage(streaks.operational_runs(dense, repeats), "runs"),
    ]
    if include_weather_stats:
        jobs.append(lambda: stage(weather.value_counts(dense, params, **columns), "values"))
    cubes, runs, *values = at_once(jobs)
    # a first row of the hours may take all their exchanges, one of the cubes is there
    reject_empty(cubes)
    values = values[0] if values else None
    has_limits = columns.get("limiting_col", "limiting_param") in hourly.columns
    wanted = dict(curves_=include_curves, visual=include_visual, stats_=include_stats)
    tables = tables_of(cubes, runs, values, params, losses=has_limits, **wanted)
    if include_visual and visual_params_for_mean:
        tables["pivot_month_x_hour_param_mean_operational"] = (
            pivots.pivot_month_x_hour_param_mean_operational(
                hourly,
                list(visual_params_for_mean),
                **{k: v for k, v in columns.items() if k in ("time_local_col", "operational_col")},
            )
        )
    if validate:
        check_tables(tables, required_tables(include_weather_stats, **wanted), values=False)
    # without any run there is nothing that could have been counted
    repeated = 0 if runs.isEmpty() else repeats.get["repeated"]
    return Bundle(run_meta(hours_in(cubes), config, run_id), tables, keys.get, repeated)


def hours_in(cubes: DataFrame) -> DataFrame:
    return day_cube(cubes).agg(F.coalesce(F.sum("n_hours"), F.lit(0)).alias("rows_hourly"))


def tables_of(
    cubes: DataFrame,
    runs: DataFrame,
    values: DataFrame | None,
    params: Sequence[str],
    losses: bool = True,
    curves_: bool = True,
    visual: bool = True,
    stats_: bool = True,
) -> dict[str, DataFrame]:
    """Report tables from additive states: count cubes, runs and, with weather, value counts."""
    days, clock = day_cube(cubes), clock_cube(cubes)
    tables = {
        "summary_run": summary.summary_run(days),
        "summary_monthly": summary.summary_monthly(days),
        "summary_yearly": summary.summary_yearly(days),
    }
    if losses:
        tables["loss_by_param_monthly"] = loss.loss_by_param_monthly(days)
        tables["loss_by_param_yearly"] = loss.loss_by_param_yearly(days)
    if values is not None:
        tables["weather_stats_monthly"] = weather.weather_stats_monthly(values, params)
        tables["weather_stats_yearly"] = weather.weather_stats_yearly(values, params)
    if curves_:
        tables["curves_cumulative_daily"] = curves.curves_cumulative_daily(days)
        tables["curve_reliability_monthly"] = curves.curve_reliability_monthly(days)
    if visual:
        tables["pivot_month_x_hour_workable_rate"] = pivots.pivot_month_x_hour_workable_rate(clock)
        tables["pivot_month_x_weekday_workable_rate"] = pivots.pivot_month_x_weekday_workable_rate(clock)
        tables["pivot_weekday_x_hour_workable_rate"] = pivots.pivot_weekday_x_hour_workable_rate(clock)
    if stats_:
        tables["stats_monthly_workable_rate_dist"] = stats.stats_monthly_workable_rate_dist(days)
        tables["reliability_targets_monthly"] = stats.reliability_targets_monthly(days)
    tables["streaks_nonworkable_operational"] = streaks.streaks_nonworkable(runs)
    tables["streaks_workable_operational"] = streaks.streaks_workable(runs)
    tables["streaks_summary_operational"] = streaks.streaks_summary(runs)
    return tables
