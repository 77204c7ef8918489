"""Monthly workable-rate distribution and reliability targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workwindow.functions.expr import ratio_or_null
from workwindow.operators.counts import add_up, as_counts, keys_of


def monthly_rate(hourly: DataFrame, **columns: str) -> DataFrame:
    """Workable share of operational hours per month; NULL where nothing was operational."""
    summed = add_up(as_counts(hourly, **columns), "year", "month")
    rate = ratio_or_null(F.col("n_productive"), F.col("n_operational"))
    return summed.select(*keys_of(summed), "year", "month", rate.alias("workable_rate"))


def _label(fraction: float) -> str:
    return f"{round(fraction * 100):02d}"


def stats_monthly_workable_rate_dist(
    hourly: DataFrame,
    quantiles: Sequence[float] = (0.10, 0.25, 0.50, 0.75, 0.90),
    **columns: str,
) -> DataFrame:
    """Distribution of the monthly rate, with the population standard deviation."""
    rates = monthly_rate(hourly, **columns)
    rate = F.col("workable_rate")
    figures: dict[str, Column] = {
        "n_months": F.count(rate),
        "mean_workable_rate": F.avg(rate),
        "std_workable_rate": F.stddev_pop(rate),
        "min_workable_rate": F.min(rate),
        "max_workable_rate": F.max(rate),
    }
    for q in quantiles:
        figures[f"p{_label(q)}_workable_rate"] = F.percentile(rate, float(q))
    return rates.groupBy(*keys_of(rates)).agg(*(c.alias(n) for n, c in figures.items()))


def reliability_targets_monthly(
    hourly: DataFrame,
    share_thresholds: Sequence[float] = (0.50, 0.60, 0.70, 0.80, 0.90),
    p_targets: Sequence[float] = (0.50, 0.80, 0.90),
    **columns: str,
) -> DataFrame:
    """Share of months at or above fixed rates, and planning percentiles of the rate."""
    rates = monthly_rate(hourly, **columns)
    rate = F.col("workable_rate")
    figures: dict[str, Column] = {"n_months": F.count(rate)}
    for t in share_thresholds:
        figures[f"share_months_ge_{round(t * 100)}"] = F.avg((rate >= float(t)).cast("double"))
    for p in p_targets:
        figures[f"p{round(p * 100)}_monthly_workable_rate"] = F.percentile(rate, float(p))
    return rates.groupBy(*keys_of(rates)).agg(*(c.alias(n) for n, c in figures.items()))
