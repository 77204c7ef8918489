"""Weather-lost hours by limiting parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workwindow.functions.expr import ratio_or_zero
from workwindow.operators.counts import add_up, as_counts, keys_of


def _loss_by(hourly: DataFrame, period: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    limiting = columns.get("limiting_col", "limiting_param")
    if not {limiting, "blocked_by"} & set(hourly.columns):
        raise ValueError(f"missing column {limiting!r}")
    counts = as_counts(hourly, **columns)
    keys = keys_of(counts)
    # Hours that are not lost keep a NULL parameter: they complete the
    # denominators inside the window and drop out after it, so no join is needed.
    summed = add_up(counts, *period, "blocked_by").withColumn(
        "hours_lost", F.col("n_operational") - F.col("n_productive")
    )
    whole = Window.partitionBy(*keys, *period)
    return (
        summed.withColumns(
            {
                "_operational": F.sum("n_operational").over(whole),
                "_lost": F.sum("hours_lost").over(whole),
            }
        )
        .filter(F.col("blocked_by").isNotNull())
        .select(
            *keys,
            *period,
            F.col("blocked_by").alias("param"),
            "hours_lost",
            ratio_or_zero(F.col("hours_lost"), F.col("_lost")).alias("pct_of_weather_lost_hours"),
            ratio_or_zero(F.col("hours_lost"), F.col("_operational")).alias(
                "pct_of_operational_hours"
            ),
        )
    )


def loss_by_param_monthly(hourly: DataFrame, **columns: str) -> DataFrame:
    return _loss_by(hourly, ("year", "month"), columns)


def loss_by_param_yearly(hourly: DataFrame, **columns: str) -> DataFrame:
    return _loss_by(hourly, ("year",), columns)
