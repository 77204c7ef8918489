"""Cumulative daily curves and the monthly reliability curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workwindow.operators.counts import add_up, as_counts, keys_of
from workwindow.operators.stats import monthly_rate

# Default exceedance thresholds.
RELIABILITY_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)


def curves_cumulative_daily(hourly: DataFrame, **columns: str) -> DataFrame:
    """Hours per local day and their running totals over the whole run.

    The window runs over daily sums, so a series costs one row per calendar day
    however many hourly rows stand behind it.
    """
    counts = as_counts(hourly, **columns)
    keys = keys_of(counts)
    total, op, good = F.col("n_hours"), F.col("n_operational"), F.col("n_productive")
    kinds = {
        "operational": op,
        "workable": good,
        "weather_lost": op - good,
        "schedule_lost": total - op,
    }
    daily = add_up(counts, "date_local").select(
        *keys, "date_local", *(c.alias(f"{kind}_hours_daily") for kind, c in kinds.items())
    )
    to_date = (
        Window.partitionBy(*keys)
        .orderBy("date_local")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumns(
        {f"{kind}_hours_cum": F.sum(f"{kind}_hours_daily").over(to_date) for kind in kinds}
    )


def curve_reliability_monthly(
    hourly: DataFrame, thresholds: Sequence[float] | None = None, **columns: str
) -> DataFrame:
    """Share of months whose workable rate reaches each threshold."""
    levels = [float(t) for t in (RELIABILITY_THRESHOLDS if thresholds is None else thresholds)]
    rates = monthly_rate(hourly, **columns)
    keys = keys_of(rates)
    reached = {
        f"_t{i}": F.avg((F.col("workable_rate") >= t).cast("double")) for i, t in enumerate(levels)
    }
    per_series = rates.groupBy(*keys).agg(
        F.count("workable_rate").alias("n_months"),
        *(share.alias(name) for name, share in reached.items()),
    )
    points = F.array(
        *(
            F.struct(
                F.lit(t).alias("threshold_workable_pct"),
                F.col(name).alias("fraction_of_months_meeting_threshold"),
            )
            for t, name in zip(levels, reached)
        )
    )
    return per_series.select(*keys, F.inline(points), "n_months")
