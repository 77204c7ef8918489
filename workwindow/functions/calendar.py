"""Calendar fields of the local clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_clock(time_utc: Column, timezone: Column | str) -> Column:
    """Wall-clock time of a UTC timestamp; the zone may be a name or a per-row column."""
    zone = F.lit(timezone) if isinstance(timezone, str) else timezone
    return F.convert_timezone(F.lit("UTC"), zone, time_utc)


def season(month: Column) -> Column:
    """Meteorological season of a month number."""
    return (
        F.when(month.isin(12, 1, 2), "DJF")
        .when(month.isin(3, 4, 5), "MAM")
        .when(month.isin(6, 7, 8), "JJA")
        .when(month.isin(9, 10, 11), "SON")
    )


def with_calendar(
    df: DataFrame, time_local_col: str = "time_local", add_season: bool = False
) -> DataFrame:
    """Add year, month, day, date_local, weekday (Monday = 0), hour and ISO week."""
    if time_local_col not in df.columns:
        raise ValueError(f"missing column {time_local_col!r}")
    if not df.schema[time_local_col].dataType.typeName().startswith("timestamp"):
        raise ValueError(f"{time_local_col!r} must be a timestamp")
    t = F.col(time_local_col)
    fields = {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "date_local": F.to_date(t),
        "weekday": F.weekday(t),
        "hour": F.hour(t),
        "week_of_year": F.weekofyear(t),
    }
    if add_season:
        fields["season"] = season(F.month(t))
    return df.withColumns(fields)
