"""The first rows of every group, by a group limit that applies before the shuffle too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workwindow.functions.expr import present
from workwindow.operators.counts import keys_of
from workwindow.operators.streaks import streaks_nonworkable


def leading_rows(table: DataFrame, per: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The ``n`` first rows in ``order`` of each group of ``per`` (of the whole table without)."""
    if not per:
        return table.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return table.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def _sites(table: DataFrame) -> list[str]:
    return present(table, ["site_id"])


def top_blocked_streaks_by_site(runs: DataFrame, n: int = 10) -> DataFrame:
    """The longest blocked runs of every site, ties broken by scenario and id."""
    blocked = streaks_nonworkable(runs)
    return leading_rows(blocked, _sites(runs), [F.desc("duration_hours"), *keys_of(runs), "streak_id"], n)


def monthly_preview_by_site(monthly: DataFrame, n: int = 6) -> DataFrame:
    """The first months of every site, scenario by scenario."""
    return leading_rows(monthly, _sites(monthly), [*present(monthly, ["scenario_id"]), "year", "month"], n)


def loss_preview_by_site(losses: DataFrame, n: int = 10) -> DataFrame:
    """Of every site the first months' losses, most lost hours first."""
    order = [*present(losses, ["scenario_id"]), "year", "month", F.desc("hours_lost"), "param"]
    return leading_rows(losses, _sites(losses), order, n)
