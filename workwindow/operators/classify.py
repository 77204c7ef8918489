"""Row classification: operational window, weather limits, scenario fan-out.

Every function here is a narrow projection over the hourly table. The run-wide
form compiles the rules to literals and emits all scenarios from a single scan;
the per-site form joins one packed rule row per site.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workwindow.functions.calendar import local_clock
from workwindow.functions.expr import flag, known, minute_of_day, present, ratio_or_zero
from workwindow.rules.bysite import rule_dictionary, scenario_limits, site_map
from workwindow.rules.fixed import SOURCE_FIELD
from workwindow.rules.runwide import Bounds, DayWindow, RuleSet

KEYS = ("site_id", "scenario_id")


def operational_test(local_time: Column, week: Sequence[DayWindow]) -> Column:
    """Is the local time inside its weekday's working hours?

    Weekdays with the same hours share one test, so an ordinary week compiles to
    a single range comparison.
    """
    days_by_hours: dict[tuple[int, int], list[int]] = {}
    for day, window in enumerate(week):
        if window.allowed:
            days_by_hours.setdefault((window.start_min, window.end_min), []).append(day)
    minute = minute_of_day(local_time)
    tests = []
    for (start, end), days in days_by_hours.items():
        in_hours = (minute >= start) & (minute < end)
        tests.append(in_hours if len(days) == 7 else F.weekday(local_time).isin(days) & in_hours)
    return flag(reduce(or_, tests, F.lit(False)))


def within_bounds(value: Column, bounds: Bounds) -> Column | None:
    """Inclusive bound test where a missing value fails; None when nothing is bounded."""
    low, high = bounds
    tests = [value >= low] if low is not None else []
    tests += [value <= high] if high is not None else []
    return flag(reduce(and_, tests)) if tests else None


def _limit_tests(rules: RuleSet, scenario: str) -> dict[str, Column]:
    tests = {p: within_bounds(known(F.col(p)), rules.bounds(scenario, p)) for p in rules.required}
    return {p: test for p, test in tests.items() if test is not None}


def _first_failing(tests: dict[str, Column]) -> Column:
    failing = [F.when(~ok, F.lit(p)) for p, ok in tests.items()]
    return F.coalesce(*failing) if failing else F.lit(None).cast("string")


def _require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def with_local_clock(truth: DataFrame, timezone: Column | str) -> DataFrame:
    """Add ``time_local`` next to ``time_utc``."""
    _require_columns(truth, ["time_utc"])
    rest = [c for c in truth.columns if c not in ("time_utc", "time_local", *KEYS)]
    clock = local_clock(F.col("time_utc"), timezone).alias("time_local")
    return truth.select(*present(truth, KEYS), "time_utc", clock, *rest)


def operational_mask(
    df: DataFrame, rules: RuleSet, time_col: str = "time_local", out_col: str = "is_operational"
) -> DataFrame:
    """Add the working-hours flag; weekday overrides replace that day's hours."""
    _require_columns(df, [time_col])
    return df.withColumn(out_col, operational_test(F.col(time_col), rules.week))


def evaluate_thresholds(
    df: DataFrame, rules: RuleSet, scenario: str = "base", operational_col: str = "is_operational"
) -> DataFrame:
    """Add ``ok_<param>`` per required parameter, ``all_ok``, ``is_workable``, ``limiting_param``.

    Here ``limiting_param`` names the first failing parameter of any hour,
    whether or not the hour is operational.
    """
    _require_columns(df, [operational_col, *rules.required])
    tests = _limit_tests(rules, scenario)
    all_ok = reduce(and_, tests.values(), F.lit(True))
    return df.withColumns(
        {
            **{f"ok_{p}": tests.get(p, F.lit(True)) for p in rules.required},
            "all_ok": all_ok,
            "is_workable": flag(F.col(operational_col)) & all_ok,
            "limiting_param": _first_failing(tests),
        }
    )


VERDICTS = "verdicts"


def _flags(operational: Column, failing: Column) -> dict[str, Column]:
    """Flags of an hour in one scenario, from its first failing parameter."""
    lost = operational & failing.isNotNull()
    workable = operational & failing.isNull()
    return {
        "operational_flag": operational,
        "workable_flag": workable,
        "loss_flag": lost,
        "limiting_param": F.when(lost, failing),
        "is_operational": operational,
        "is_workable": workable,
    }


def _judged(
    truth: DataFrame, rules: RuleSet, scenarios: Sequence[str] | None, time_local_col: str
) -> tuple[DataFrame, Column]:
    """The table with its operational flag, and one verdict per scenario.

    Each limit is tested once, into a column of its own; the verdict array only
    names the first failing parameter. That keeps the generated code small enough
    for the JIT compiler also with ten scenarios.
    """
    _require_columns(truth, ["time_utc", time_local_col, *rules.required])
    wanted = list(scenarios or rules.scenarios)
    tested = {f"_failing{i}": _first_failing(_limit_tests(rules, s)) for i, s in enumerate(wanted)}
    tested["operational_flag"] = operational_test(F.col(time_local_col), rules.week)
    verdicts = F.array(
        *(
            F.struct(F.lit(s).alias("scenario_id"), F.col(f"_failing{i}").alias("failing"))
            for i, s in enumerate(wanted)
        )
    )
    return truth.withColumns(tested), verdicts


def _spread(judged: DataFrame, kept: Sequence[str], verdicts: Column) -> DataFrame:
    # no array of verdicts is empty; "outer" keeps Spark from testing that by computing it twice
    rows = judged.select(*kept, F.col("operational_flag").alias("_op"), F.inline_outer(verdicts))
    flags = _flags(F.col("_op"), F.col("failing"))
    return rows.select(*kept, "scenario_id", *(c.alias(name) for name, c in flags.items()))


def classify(
    truth: DataFrame,
    rules: RuleSet,
    scenarios: Sequence[str] | None = None,
    time_local_col: str = "time_local",
) -> DataFrame:
    """One row per hour and scenario, from a single scan of the hourly truth table.

    Workable hours are always operational; ``limiting_param`` is set on lost
    hours only.
    """
    judged, verdicts = _judged(truth, rules, scenarios, time_local_col)
    return _spread(judged, [c for c in truth.columns if c != "scenario_id"], verdicts)


def classify_packed(
    truth: DataFrame,
    rules: RuleSet,
    scenarios: Sequence[str] | None = None,
    time_local_col: str = "time_local",
) -> DataFrame:
    """The hourly truth table with all scenarios of an hour in one ``verdicts`` array.

    Statistics and streaks take this form as it is: what they shuffle then does
    not grow with the number of scenarios. A verdict names the first failing
    parameter, or NULL when all limits hold, whether or not the hour is
    operational.
    """
    judged, verdicts = _judged(truth, rules, scenarios, time_local_col)
    kept = [c for c in truth.columns if c != "scenario_id"]
    return judged.select(*kept, "operational_flag", verdicts.alias(VERDICTS))


def unpack(packed: DataFrame) -> DataFrame:
    """One row per hour and scenario from a packed table."""
    kept = [c for c in packed.columns if c not in (VERDICTS, "operational_flag")]
    return _spread(packed, kept, F.col(VERDICTS))


def _by_rule_set(
    truth: DataFrame, packed_rules: DataFrame, measured: Sequence[str], only_ruled: bool
) -> tuple[DataFrame, list[str]]:
    """Hours with the ``_rule_id`` and the local clock of their site, and the columns kept."""
    _require_columns(truth, ["site_id", "time_utc"])
    base = [c for c in truth.columns if c not in ("time_local", "scenario_id")]
    at = base.index("time_utc") + 1
    sites = site_map(packed_rules, measured).select(
        "site_id", F.col("rule_id").alias("_rule_id"), F.col("timezone").alias("_timezone"), F.col("trouble").alias("_trouble")
    )
    no_rules = F.concat(F.lit("no rules for site "), F.coalesce("site_id", F.lit("NULL")))
    trouble = F.coalesce("_trouble", F.when(F.col("_rule_id").isNull(), no_rules))
    checked = F.when(trouble.isNotNull(), F.raise_error(trouble)).otherwise(F.col("_rule_id"))
    local = local_clock(F.col("time_utc"), F.col("_timezone")).alias("time_local")
    hours = truth.join(sites, "site_id", "inner" if only_ruled else "left")
    kept = [*base[:at], "time_local", *base[at:]]
    return hours.select(*base[:at], local, *base[at:], checked.alias("_rule_id")), kept


def _in_week(week: Column) -> Column:
    t = F.col("time_local")
    today, minute = F.element_at(week, F.weekday(t) + 1), minute_of_day(t)
    return flag(today.allowed & (minute >= today.start_min) & (minute < today.end_min))


def _fails(value: Column, low: Column, high: Column) -> Column:
    return (low.isNotNull() & ~flag(value >= low)) | (high.isNotNull() & ~flag(value <= high))


def classify_packed_by_site_rules(
    truth: DataFrame, packed_rules: DataFrame, only_ruled: bool = False
) -> DataFrame:
    """Packed classification where every site brings its own scenarios, limits and hours.

    ``packed_rules`` (see :func:`workwindow.rules.bysite.packed_rules`) holds one
    row per site. Hours get the narrow site map first, then the dictionary of distinct
    rule sets; neither join adds rows. No broadcast is forced: both tables grow with the
    sites, and their measured sizes decide the strategy. An hour's measurements become
    an array once, read by place.

    Nothing is judged by doubtful rules: a site without rules, with two rows of
    rules, with broken rules or with a required parameter that the table lacks
    fails the run. ``bysite.split_sites`` tells such sites apart beforehand; with
    ``only_ruled``, hours of sites without rules are left out instead.
    """
    measured = present(truth, SOURCE_FIELD)
    hours, kept = _by_rule_set(truth, packed_rules, measured, only_ruled)
    sets = rule_dictionary(packed_rules, measured)
    joined = hours.join(sets.select(*(F.col(c).alias(f"_{c}") for c in sets.columns)), "_rule_id", "left")
    values = F.array(*(known(F.col(p)) for p in measured)).cast("array<double>")
    judged = joined.withColumns(
        {
            "operational_flag": _in_week(F.col("_week")),
            "_values": F.transform("_at", lambda i: F.get(values, i)),
        }
    )

    def verdict(scenario: Column) -> Column:
        failing = F.zip_with("_values", scenario.limits, lambda v, limit: _fails(v, limit.low, limit.high))
        first = F.array_position(failing, True).cast("int") - 1
        return F.struct(scenario.scenario_id.alias("scenario_id"), F.get("_params", first).alias("failing"))

    return judged.select(*kept, "operational_flag", F.transform("_scenarios", verdict).alias(VERDICTS))


def classify_by_site_rules(
    truth: DataFrame, packed_rules: DataFrame, only_ruled: bool = False
) -> DataFrame:
    """The same with one row per hour and scenario.

    The dictionary is joined by scenario with each limit in a column of its own, so the
    tests are plain comparisons: the first failing parameter is the one of least rank.
    """
    measured = present(truth, SOURCE_FIELD)
    hours, kept = _by_rule_set(truth, packed_rules, measured, only_ruled)
    sets = scenario_limits(rule_dictionary(packed_rules, measured), measured)
    joined = hours.join(sets.select(*(F.col(c).alias(f"_{c}") for c in sets.columns)), "_rule_id", "left")
    ranks = [
        F.when(_fails(known(F.col(p)), F.col(f"_low_{p}"), F.col(f"_high_{p}")), F.col(f"_rank_{p}"))
        for p in measured
    ]
    first = F.least(*ranks, F.lit(None).cast("int"), F.lit(None).cast("int"))
    judged = joined.withColumns({"_op": _in_week(F.col("_week")), "_failing": F.get("_params", first - 1)})
    flags = _flags(F.col("_op"), F.col("_failing"))
    return judged.select(*kept, F.col("_scenario_id").alias("scenario_id"), *(c.alias(name) for name, c in flags.items()))


def scenario_states(
    hourly: DataFrame, operational_col: str = "is_operational", workable_col: str = "is_workable"
) -> Column:
    """Array of (scenario_id, op, wk) of a row, for packed and for unpacked hourly tables."""
    if VERDICTS in hourly.columns:
        return F.transform(
            VERDICTS,
            lambda v: F.struct(
                v.scenario_id.alias("scenario_id"),
                F.col("operational_flag").alias("op"),
                (F.col("operational_flag") & v.failing.isNull()).alias("wk"),
            ),
        )
    return F.array(
        F.struct(
            *present(hourly, ["scenario_id"]),
            flag(F.col(operational_col)).alias("op"),
            flag(F.col(workable_col)).alias("wk"),
        )
    )


def evaluation_summary(
    classified: DataFrame,
    operational_col: str = "is_operational",
    workable_col: str = "is_workable",
) -> DataFrame:
    """Counts per scenario with shares of operational and of total hours in percent."""
    total, op, wk = F.col("total_hours"), F.col("operational_hours"), F.col("workable_hours")
    counted = classified.groupBy(*present(classified, KEYS)).agg(
        F.count("*").alias("total_hours"),
        F.count_if(flag(F.col(operational_col))).alias("operational_hours"),
        F.count_if(flag(F.col(workable_col))).alias("workable_hours"),
    )
    return counted.withColumns(
        {
            "workable_pct_of_operational": ratio_or_zero(wk, op) * 100.0,
            "workable_pct_of_total": ratio_or_zero(wk, total) * 100.0,
        }
    )
