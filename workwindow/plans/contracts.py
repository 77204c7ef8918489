"""Input and output contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workwindow.session import at_once

# Columns every hourly table must have.
HOURLY_COLUMNS = ("time_utc", "time_local", "is_operational", "is_workable", "limiting_param")
FRACTION_MARKS = ("_pct_", "pct_of_", "share_months_ge_", "fraction_of_")


class ContractError(ValueError):
    """A table does not have the shape or the value range it promises."""


def check_hourly(
    hourly: DataFrame, weather_params: Sequence[str] | None = None, rows: bool = True
) -> None:
    """Reject an hourly table without its columns, types or, with ``rows``, rows; without it nothing runs."""
    missing = [c for c in HOURLY_COLUMNS if c not in hourly.columns]
    if missing:
        raise ContractError(f"hourly table lacks columns {missing}")
    for name in ("time_local", "time_utc"):
        if not hourly.schema[name].dataType.typeName().startswith("timestamp"):
            raise ContractError(f"{name} must be a timestamp")
    absent = [p for p in weather_params or () if p not in hourly.columns]
    if absent:
        raise ContractError(f"hourly table lacks weather parameters {absent}")
    if rows:
        reject_empty(hourly)


def reject_empty(table: DataFrame) -> None:
    """Fail when a table that has rows wherever the hourly table has some is empty."""
    if table.isEmpty():
        raise ContractError("hourly table is empty")


def null_counts(hourly: DataFrame) -> list[Column]:
    """For each key and time column, how many hours lack it."""
    keys = [c for c in ("site_id", "scenario_id", "time_utc", "time_local") if c in hourly.columns]
    return [F.count_if(F.col(c).isNull()).alias(c) for c in keys]


def reject_keys(missing: Mapping[str, int], repeated: int = 0) -> None:
    """Fail when any hour lacked a key or, as counted, repeated another."""
    bad = [f"{column} missing in {n} hours" for column, n in missing.items() if n]
    bad += [f"{repeated} repeated hours"] if repeated else []
    if bad:
        raise ContractError("keys of the hourly table: " + "; ".join(bad))


def key_violations(hourly: DataFrame) -> DataFrame:
    """How many hours lack a key or a time: (column_name, n_null), columns without any left out."""
    counts = hourly.agg(*null_counts(hourly))
    return counts.unpivot([], counts.columns, "column_name", "n_null").filter("n_null > 0")


def fraction_columns(table: DataFrame) -> list[str]:
    """Columns that promise values in [0, 1]."""
    return [
        c for c in table.columns if c.endswith("_rate") or any(m in c for m in FRACTION_MARKS)
    ]


def outside_counts(table: DataFrame) -> list[Column]:
    """For each fraction column, how many values lie outside [0, 1]; nulls are ignored."""
    return [
        F.count_if((F.col(c) < 0) | (F.col(c) > 1)).alias(c) for c in fraction_columns(table)
    ]


def rate_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values outside [0, 1] per table and fraction column."""
    parts = [
        table.agg(*outside_counts(table))
        .unpivot([], fraction_columns(table), "column_name", "n_outside")
        .select(F.lit(name).alias("table_name"), "column_name", "n_outside")
        for name, table in tables.items()
        if fraction_columns(table)
    ]
    return reduce(DataFrame.unionByName, parts)


def reject_outside(counts: Mapping[str, Mapping[str, int]]) -> None:
    """Fail when any fraction was found outside [0, 1]."""
    bad = [f"{t}.{c}: {n}" for t, found in counts.items() for c, n in found.items() if n]
    if bad:
        raise ContractError("values outside [0, 1]: " + "; ".join(bad))


def check_tables(
    tables: Mapping[str, DataFrame], require: Sequence[str], values: bool = True
) -> None:
    """Reject a bundle with absent tables or, with ``values``, with fractions outside [0, 1].

    One row per table comes back to the driver; without ``values`` nothing runs.
    """
    absent = [name for name in require if name not in tables]
    if absent:
        raise ContractError(f"bundle lacks tables {absent}")
    if not values:
        return
    checked = {name: table for name, table in tables.items() if fraction_columns(table)}
    counts = at_once([lambda t=t: t.agg(*outside_counts(t)).first() for t in checked.values()])
    reject_outside({name: row.asDict() for name, row in zip(checked, counts)})
