"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_PARAM = "unknown"


def flag(c: Column) -> Column:
    """A boolean that is never null; missing counts as false."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def known(c: Column) -> Column:
    """A measurement with NaN turned into NULL."""
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def hours_between(earlier: Column, later: Column) -> Column:
    """Elapsed hours between two zone-free timestamps, independent of the session zone."""
    seconds = (later - earlier).cast("interval second").cast("decimal(20,6)")
    return seconds.cast("double") / F.lit(3600.0)


def hhmm_to_minutes(c: Column) -> Column:
    """``HH:MM`` text to minute of day; NULL when it is not of that form."""
    return F.substring(c, 1, 2).try_cast("int") * 60 + F.substring(c, 4, 2).try_cast("int")


def minute_of_day(local_time: Column) -> Column:
    return F.hour(local_time) * 60 + F.minute(local_time)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in the order given."""
    return [name for name in names if name in df.columns]
