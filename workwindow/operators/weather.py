"""Weather statistics per period, context and parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workwindow.functions.expr import known, present, ratio_or_null
from workwindow.operators.classify import KEYS, scenario_states

# Reported quantiles and contexts.
QUANTILES = {"p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
CONTEXTS = ("all", "operational", "workable", "blocked_operational")


STATE = ("param", "value", "states", "n")


def value_counts(
    hourly: DataFrame, params: Sequence[str], also: Sequence[str] = (), **columns: str
) -> DataFrame:
    """How often each value occurs per site, month and combination of scenario states.

    Combined on the map side, so repeated hours weigh nothing. This is the state that
    both statistics are made of: a year is its months, and counts of different hours are
    put together by ``merged_counts``. Columns named by ``also`` are kept apart, and so are
    the months by which hours are placed (``plans.placed``), which saves the exchange.
    """
    also = [*also, *(c for c in ("_month",) if c in hourly.columns and c not in also)]
    missing = [p for p in params if p not in hourly.columns]
    if missing:
        raise ValueError(f"missing weather parameter columns: {missing}")
    t = F.col(columns.get("time_local_col", "time_local"))
    flags = {c: columns[c] for c in ("operational_col", "workable_col") if c in columns}
    ids = [*present(hourly, ["site_id"]), *also, "year", "month", "states"]
    wide = hourly.select(
        *present(hourly, ["site_id"]),
        *also,
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        scenario_states(hourly, **flags).alias("states"),
        *(known(F.col(p)).alias(p) for p in params),
    )
    each = F.array(*(F.struct(F.lit(p).alias("param"), F.col(p).alias("value")) for p in params))
    long = wide.select(*ids, F.inline(each))
    return long.groupBy(*ids, "param", "value").agg(F.count("*").alias("n"))


def merged_counts(counts: DataFrame) -> DataFrame:
    """Value counts of several sets of hours, united, as those of all the hours."""
    return counts.groupBy(*(c for c in counts.columns if c != "n")).agg(F.sum("n").alias("n"))


def _in_contexts(counts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Repeat each value for every context it belongs to, and there for every scenario.

    An hour with several scenarios is operational in all or none of them, and all hours of
    a site have the same scenarios. So its part
    of the contexts "all" and "operational" is counted once, without scenario, and given
    to ``scenarios`` at the end.
    """
    named = "scenario_id" in counts.schema["states"].dataType.elementType.names
    scenario = lambda s: s.scenario_id if named else F.lit(None).cast("string")
    member = lambda s, name: F.struct(scenario(s).alias("scenario_id"), name.alias("context"))
    first, shared = F.col("states")[0], F.lit(None).cast("string")
    whole = [F.struct(shared.alias("scenario_id"), F.lit(c).alias("context")) for c in CONTEXTS[:2]]
    outcome = lambda s: member(s, F.when(s.wk, CONTEXTS[2]).otherwise(CONTEXTS[3]))
    members = F.when(
        first.op, F.concat(F.array(*whole), F.transform("states", outcome))
    ).otherwise(F.array(whole[0]))
    scenarios = F.transform("states", scenario).alias("scenarios")
    return counts.select(*dims, scenarios, "value", "n", F.inline_outer(members))


def _moments() -> dict[str, Column]:
    """Weighted moments around ``center``, the least value.

    Without the shift, squares of large readings would cancel in the deviation.
    """
    n, value = F.col("n"), F.col("value")
    off = value - F.col("_center")
    return {
        "n_hours": F.sum(n),
        "n_known": F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)),
        "off": F.sum(n * off),
        "off2": F.sum(n * off * off),
        "min": F.min(value),
        "max": F.max(value),
    }


def _figures(counts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Moments and exact quantiles of every group, whatever its size.

    One exchange places all values of a site, period and parameter; contexts and
    scenarios multiply them only after it. Ranks inside a group are running counts over
    its sorted values, which can spill.
    """
    groups = [*dims, "scenarios", "scenario_id", "context"]
    placed = counts.repartition(*dims)
    if "month" not in dims:  # a year's counts are those of its months, put together in place
        placed = placed.groupBy(*dims, "states", "value").agg(F.sum("n").alias("n"))
    members = _in_contexts(placed, dims)
    group = Window.partitionBy(*groups)
    so_far = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known_n = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    ranked = members.withColumns(
        {
            "_upto": F.sum(known_n).over(so_far),
            "_center": F.min("value").over(so_far),
            "_last": F.sum(known_n).over(group) - 1,
        }
    )

    def ranks(i: int, p: float) -> list[Column]:
        at = F.col("_last") * F.lit(float(p))
        ends = {"low": F.floor(at), "high": F.ceil(at)}
        return [
            F.min(F.when(F.col("_upto") > rank, F.col("value"))).alias(f"_{end}{i}")
            for end, rank in ends.items()
        ]

    levels = list(QUANTILES.values())
    picked = ranked.groupBy(*groups).agg(
        *(c.alias(name) for name, c in _moments().items()),
        *(c for i, p in enumerate(levels) for c in ranks(i, p)),
    )

    def between(i: int, p: float) -> Column:
        at = (F.col("n_known") - 1) * F.lit(float(p))
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return low + (at - F.floor(at)) * (high - low)

    return picked.withColumn("quantiles", F.array(*(between(i, p) for i, p in enumerate(levels))))


def _weather_stats(
    hourly: DataFrame,
    params: Sequence[str],
    period: Sequence[str],
    columns: dict[str, str],
) -> DataFrame:
    if set(STATE) <= set(hourly.columns):
        counts = hourly.filter(F.col("param").isin(*params))
    else:
        counts = value_counts(hourly, params, **columns)
    named = "scenario_id" in counts.schema["states"].dataType.elementType.names
    dims = [*present(hourly, ["site_id"]), *period, "param"]
    figures = _figures(counts, dims)
    if named:
        # what holds for all scenarios is given to each
        each = F.when(F.col("scenario_id").isNull(), F.col("scenarios")).otherwise(F.array("scenario_id"))
        figures = figures.withColumn("scenario_id", F.explode(each))
    known_hours, off = F.col("n_known"), F.col("off")
    spread = F.greatest(F.col("off2") - F.try_divide(off * off, known_hours), F.lit(0.0))
    return figures.select(
        *present(hourly, ["site_id"]),
        *(["scenario_id"] if named else []),
        *period,
        "context",
        "param",
        "n_hours",
        (1.0 - ratio_or_null(known_hours, F.col("n_hours"))).alias("missing_rate"),
        (F.col("min") + F.try_divide(off, known_hours)).alias("mean"),
        F.sqrt(F.when(known_hours > 1, F.try_divide(spread, known_hours - 1))).alias("std"),
        "min",
        *(F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(QUANTILES)),
        "max",
    )


def weather_stats_monthly(
    hourly: DataFrame, params: Sequence[str], **columns: str
) -> DataFrame:
    """Count, missing rate, mean, sample deviation, extremes and exact quantiles per month.

    ``hourly`` may be packed, have one row per scenario, or be the ``value_counts`` of either.
    """
    return _weather_stats(hourly, params, ("year", "month"), columns)


def weather_stats_yearly(hourly: DataFrame, params: Sequence[str], **columns: str) -> DataFrame:
    return _weather_stats(hourly, params, ("year",), columns)
