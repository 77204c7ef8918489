"""Flat heat-map tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.functions.expr import flag, known, ratio_or_null
from workwindow.operators.counts import add_up, as_counts, keys_of


def workable_rate_pivot(hourly: DataFrame, dims: Sequence[str], **columns: str) -> DataFrame:
    """Workable share of operational hours per cell, years pooled; NULL without such hours."""
    summed = add_up(as_counts(hourly, **columns), *dims)
    return summed.select(
        *keys_of(summed),
        *dims,
        F.col("n_hours").alias("total_hours"),
        F.col("n_operational").alias("operational_hours"),
        ratio_or_null(F.col("n_productive"), F.col("n_operational")).alias(
            "workable_pct_of_operational_hours"
        ),
    )


def pivot_month_x_hour_workable_rate(hourly: DataFrame, **columns: str) -> DataFrame:
    return workable_rate_pivot(hourly, ("month", "hour"), **columns)


def pivot_month_x_weekday_workable_rate(hourly: DataFrame, **columns: str) -> DataFrame:
    return workable_rate_pivot(hourly, ("month", "weekday"), **columns)


def pivot_weekday_x_hour_workable_rate(hourly: DataFrame, **columns: str) -> DataFrame:
    return workable_rate_pivot(hourly, ("weekday", "hour"), **columns)


def pivot_month_x_hour_param_mean_operational(
    hourly: DataFrame,
    params: Sequence[str],
    time_local_col: str = "time_local",
    operational_col: str = "is_operational",
) -> DataFrame:
    """Mean of each parameter by month and hour over operational hours.

    All parameters are aggregated side by side and turned into rows afterwards,
    so the shuffle carries one row per cell instead of one per hour and parameter.
    """
    missing = [p for p in params if p not in hourly.columns]
    if missing:
        raise ValueError(f"missing weather parameter columns: {missing}")
    keys = keys_of(hourly)
    t = F.col(time_local_col)
    measured = hourly.filter(flag(F.col(operational_col))).select(
        *keys,
        F.month(t).alias("month"),
        F.hour(t).alias("hour"),
        *(known(F.col(p)).alias(p) for p in params),
    )
    cells = measured.groupBy(*keys, "month", "hour").agg(
        F.count("*").alias("n_hours"),
        *(F.count(p).alias(f"_n_{p}") for p in params),
        *(F.avg(p).alias(f"_mean_{p}") for p in params),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(p).alias("param"),
                F.col("n_hours"),
                (1.0 - ratio_or_null(F.col(f"_n_{p}"), F.col("n_hours"))).alias("missing_rate"),
                F.col(f"_mean_{p}").alias("mean"),
            )
            for p in params
        )
    )
    return cells.select(*keys, "month", "hour", F.inline(rows))
