"""Hourly truth tables from Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.functions.expr import known, present
from workwindow.operators.classify import KEYS, with_local_clock
from workwindow.rules.fixed import SOURCE_FIELD


def analysis_years(period: Mapping[str, Any]) -> tuple[int, int]:
    """First and last year of a period given by its end year and its length."""
    last, count = int(period["analysis_end_year"]), int(period["historic_years"])
    if count < 1:
        raise ValueError("historic_years must be at least 1")
    return last - count + 1, last


def in_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Whole UTC years; a plain range on ``time_utc``, so it reaches the Parquet scan."""
    t = F.col("time_utc")
    start, end = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (first, last + 1))
    return df.filter((t >= start) & (t < end))


def clean(df: DataFrame) -> DataFrame:
    """Measurements as doubles with NaN turned into NULL."""
    return df.withColumns({p: known(F.col(p)) for p in present(df, SOURCE_FIELD)})


def read_truth(
    spark: SparkSession,
    path: str,
    params: list[str],
    timezone: Column | str,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Hourly Parquet (``site_id``, UTC ``time_utc``, parameters) with the local clock added.

    Only the requested parameters are read.
    """
    unknown = [p for p in params if p not in SOURCE_FIELD]
    if unknown:
        raise ValueError(f"unsupported parameters: {unknown}")
    hourly = spark.read.parquet(path)
    hourly = hourly if years is None else in_years(hourly, *years)
    narrow = hourly.select(*present(hourly, KEYS), "time_utc", *params)
    return with_local_clock(clean(narrow), timezone)
