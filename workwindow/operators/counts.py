"""Additive hour counts, the common base of summaries, losses, curves and heat maps.

An hourly classified table becomes a *counts frame*: four 0/1 measures plus the
calendar fields. All count reports are sums over such a frame, so they run the
same on the hourly rows and on the pre-aggregated cubes below, which are about
24 times (daily) or, per ten years, 40 times (clock) smaller than the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.functions.expr import UNKNOWN_PARAM, flag, present
from workwindow.operators.classify import KEYS

MEASURES = ("n_hours", "n_operational", "n_workable", "n_productive")
DAY_GRAIN = ("date_local", "blocked_by")
CLOCK_GRAIN = ("month", "weekday", "hour")


def as_counts(
    hourly: DataFrame,
    time_local_col: str = "time_local",
    operational_col: str = "is_operational",
    workable_col: str = "is_workable",
    limiting_col: str = "limiting_param",
    also: Sequence[str] = (),
) -> DataFrame:
    """Counts frame of an hourly classified table; a counts frame passes unchanged.

    ``n_workable`` counts the workable flag as given and ``n_productive`` only
    where the hour is operational too. ``blocked_by`` is NULL on hours that are
    not weather-lost. Columns named by ``also`` are kept.
    """
    if all(m in hourly.columns for m in MEASURES):
        return hourly
    needed = (time_local_col, operational_col, workable_col)
    missing = [c for c in needed if c not in hourly.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    op, wk = flag(F.col(operational_col)), flag(F.col(workable_col))
    named = F.col(limiting_col) if limiting_col in hourly.columns else F.lit(None)
    blocked_by = F.when(
        op & ~wk, F.coalesce(named.cast("string"), F.lit(UNKNOWN_PARAM))
    )
    t = F.col(time_local_col)
    return hourly.select(
        *present(hourly, KEYS),
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.to_date(t).alias("date_local"),
        F.weekday(t).alias("weekday"),
        F.hour(t).alias("hour"),
        blocked_by.alias("blocked_by"),
        F.lit(1).cast("bigint").alias("n_hours"),
        op.cast("bigint").alias("n_operational"),
        wk.cast("bigint").alias("n_workable"),
        (op & wk).cast("bigint").alias("n_productive"),
        *also,
    )


def keys_of(df: DataFrame) -> list[str]:
    return present(df, KEYS)


def add_up(counts: DataFrame, *dims: str) -> DataFrame:
    """Sum the measures per site, scenario and ``dims``."""
    return counts.groupBy(*keys_of(counts), *dims).agg(
        *(F.sum(m).alias(m) for m in MEASURES)
    )


def count_cubes(hourly: DataFrame, also: Sequence[str] = (), **columns: str) -> DataFrame:
    """Both cubes in one scan and one shuffle; ``grain`` is ``day`` or ``clock``. They are
    apart for all values of the columns named by ``also``, and may be added up."""
    counts = as_counts(hourly, also=also, **columns)
    keys = [*keys_of(counts), *also]
    day, clock = [*keys, *DAY_GRAIN], [*keys, *CLOCK_GRAIN]
    dims = [*keys, *DAY_GRAIN, *CLOCK_GRAIN]
    grouped = counts.groupingSets([[F.col(c) for c in day], [F.col(c) for c in clock]], *dims)
    is_clock = F.grouping("date_local") == 1
    return grouped.agg(
        F.when(is_clock, "clock").otherwise("day").alias("grain"),
        *(F.sum(m).alias(m) for m in MEASURES),
    )


def day_cube(cubes: DataFrame) -> DataFrame:
    """Counts per local day and blocking parameter."""
    d = F.col("date_local")
    return (
        cubes.filter(F.col("grain") == "day")
        .select(*keys_of(cubes), *DAY_GRAIN, *MEASURES)
        .withColumns({"year": F.year(d), "month": F.month(d), "weekday": F.weekday(d)})
    )


def clock_cube(cubes: DataFrame) -> DataFrame:
    """Counts per month, weekday and hour, years pooled."""
    return cubes.filter(F.col("grain") == "clock").select(
        *keys_of(cubes), *CLOCK_GRAIN, *MEASURES
    )
