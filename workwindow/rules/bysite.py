"""Rules kept as data: one configuration row per site.

Everything is a row-local expression over the configuration table, so expansion,
packing and checking scale with the number of sites and never shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workwindow.functions.expr import hhmm_to_minutes
from workwindow.rules.fixed import (
    BASE_ONLY,
    CALENDAR_MODELS,
    HHMM_PATTERN,
    MAX_SCENARIOS,
    SCENARIO_ID_PATTERN,
    SCENARIO_MODES,
    SOURCE_FIELD,
    STANDARD_3,
    TIME_REFERENCES,
)

_BOUNDS = "STRUCT<start: STRING, end: STRING, start_time: STRING, end_time: STRING>"

# Limits stay text so that a non-numeric limit can be reported instead of lost.
CONFIG_SCHEMA = f"""
    site_id STRING,
    timezone STRING,
    scenario_mode STRING,
    custom_scenarios ARRAY<STRING>,
    required_parameters ARRAY<STRING>,
    weather_thresholds MAP<STRING, MAP<STRING, STRUCT<min: STRING, max: STRING>>>,
    calendar_model STRING,
    weekdays ARRAY<INT>,
    custom_weekdays ARRAY<INT>,
    time_bounds {_BOUNDS},
    weekly_overrides MAP<STRING, {_BOUNDS}>
"""


def _strings(values: Iterable[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _or_empty(name: str, element: str = "string") -> Column:
    return F.coalesce(F.col(name), F.array().cast(f"array<{element}>"))


def _entries(name: str) -> Column:
    """Entries of a map column, none when the map is missing."""
    return F.coalesce(F.map_entries(F.col(name)), F.array())


def _mode() -> Column:
    mode = F.trim(F.coalesce(F.col("scenario_mode"), F.lit("")))
    return F.when(mode == "", F.lit("base_only")).otherwise(mode)


def _declared_scenarios() -> Column:
    """Ordered ids without blanks or repeats."""
    plus = _mode() == "standard_3_plus"
    ids = F.when(plus | (_mode() == "standard_3"), _strings(STANDARD_3)).otherwise(
        _strings(BASE_ONLY)
    )
    custom = F.when(plus, F.transform(_or_empty("custom_scenarios"), lambda s: F.trim(s))).otherwise(
        F.array().cast("array<string>")
    )
    named = F.filter(F.concat(ids, custom), lambda s: s.isNotNull() & (s != ""))
    return F.array_distinct(named)


def scenario_ids() -> Column:
    return _declared_scenarios()


def scenario_rules(config: DataFrame) -> DataFrame:
    """One row per site and scenario, numbered in order."""
    return config.select(
        "site_id", F.posexplode(scenario_ids()).alias("ordinal", "scenario_id")
    ).select("site_id", "scenario_id", "ordinal")


def threshold_rules(config: DataFrame) -> DataFrame:
    """One row per site, scenario and limited parameter; ``ordinal`` 0 = not required."""
    blocks = config.select(
        "site_id",
        _or_empty("required_parameters").alias("required"),
        F.explode(_entries("weather_thresholds")).alias("block"),
    )
    limits = blocks.select(
        "site_id",
        "required",
        F.trim("block.key").alias("scenario_id"),
        F.explode(F.map_entries("block.value")).alias("limit"),
    )
    param = F.trim("limit.key")
    return limits.select(
        "site_id",
        "scenario_id",
        param.alias("param"),
        F.col("limit.value.min").try_cast("double").alias("min"),
        F.col("limit.value.max").try_cast("double").alias("max"),
        F.array_position("required", param).cast("int").alias("ordinal"),
    ).filter((F.col("scenario_id") != "") & (F.col("param") != ""))


def _custom_days() -> Column:
    return F.coalesce("weekdays", "custom_weekdays", F.array().cast("array<int>"))


def _allowed_days() -> Column:
    calendar = F.coalesce(F.col("calendar_model"), F.lit("all_days"))
    return (
        F.when(calendar == "custom", _custom_days())
        .when(calendar == "mon_fri", F.sequence(F.lit(0), F.lit(4)))
        .otherwise(F.sequence(F.lit(0), F.lit(6)))
    )


def _day_window(day: Column) -> Column:
    # the key as a number, as the checks read it; the last of several wins
    entries = F.filter(_entries("weekly_overrides"), lambda e: e["key"].try_cast("int") == day)
    override = F.try_element_at(entries, F.lit(-1))["value"]

    def minutes(side: str) -> Column:
        return hhmm_to_minutes(F.coalesce(override[side], F.col(f"time_bounds.{side}")))

    return F.struct(
        F.array_contains(_allowed_days(), day).alias("allowed"),
        minutes("start_time").alias("start_min"),
        minutes("end_time").alias("end_min"),
    )


def week() -> Column:
    """Seven day windows, Monday first."""
    return F.transform(F.sequence(F.lit(0), F.lit(6)), _day_window)


def window_rules(config: DataFrame) -> DataFrame:
    """Exactly seven rows per site: base hours with the weekday overrides merged in."""
    days = config.select("site_id", F.posexplode(week()).alias("weekday", "day"))
    return days.select("site_id", "weekday", "day.*")


def _named(entries: Column, name: Column) -> Column:
    """Value of the last entry with that key, blanks around keys ignored."""
    return F.try_element_at(F.filter(entries, lambda e: F.trim(e["key"]) == name), F.lit(-1))[
        "value"
    ]


def packed_rules(config: DataFrame) -> DataFrame:
    """One row per site with everything that the rule dictionary is made of.

    Each scenario lists its limits in the order of the required parameters.
    """
    required = F.filter(
        F.transform(_or_empty("required_parameters"), lambda p: F.trim(p)), lambda p: p != ""
    )

    def limits(scenario: Column) -> Column:
        block = F.map_entries(_named(_entries("weather_thresholds"), scenario))

        def limit(param: Column) -> Column:
            bounds = _named(block, param)
            return F.struct(
                param.alias("param"),
                bounds["min"].try_cast("double").alias("min"),
                bounds["max"].try_cast("double").alias("max"),
            )

        return F.transform(required, limit)

    scenarios = F.transform(
        scenario_ids(), lambda s: F.struct(s.alias("scenario_id"), limits(s).alias("limits"))
    )
    return config.select(
        "site_id",
        F.coalesce("timezone", F.lit("UTC")).alias("timezone"),
        scenarios.alias("scenarios"),
        week().alias("week"),
        F.transform(
            F.concat(_rule_findings(), _window_findings()),
            lambda x: F.concat_ws(" ", x["rule"], x["key"], x["detail"]),
        ).alias("problems"),
    )


def site_map(packed: DataFrame, measured: Sequence[str]) -> DataFrame:
    """One row per site: (site_id, rule_id, timezone, trouble).

    ``rule_id`` is the hash of the site's rule set, its scenarios with their limits and
    its week; ``trouble`` says why the site must not be judged, or is NULL. ``measured``
    names the parameters that the hourly table has.
    """
    needed = F.flatten(F.transform("scenarios", lambda s: F.transform(s.limits, lambda x: x.param)))
    unmeasured = F.array_except(needed, F.array(*map(F.lit, measured)).cast("array<string>"))
    per_row = packed.select("site_id", rule_id().alias("rule_id"), "timezone", "problems", unmeasured.alias("unmeasured"))
    sites = per_row.groupBy("site_id").agg(
        F.count("*").alias("copies"), *(F.max(c).alias(c) for c in per_row.columns if c != "site_id")
    )
    site = F.coalesce("site_id", F.lit("NULL"))
    said = lambda what, names, sep: F.concat(F.lit(what), site, F.lit(": "), F.array_join(names, sep))
    trouble = (
        F.when(F.col("copies") > 1, F.concat(F.lit("several rules for site "), site))
        .when(F.size("problems") > 0, said("broken rules of site ", "problems", "; "))
        .when(F.size("unmeasured") > 0, said("no measurements for site ", "unmeasured", ", "))
    )
    return sites.select("site_id", "rule_id", "timezone", trouble.alias("trouble"))


def rule_id() -> Column:
    return F.sha2(F.to_json(F.struct("scenarios", "week")), 256)


def rule_dictionary(packed: DataFrame, measured: Sequence[str]) -> DataFrame:
    """One row per distinct rule set, however many sites share it.

    ``params`` are the required parameters in order and ``at`` where each stands in
    ``measured``; the limits of a scenario are aligned with both.
    """
    sets = packed.groupBy(rule_id().alias("rule_id")).agg(
        F.max("scenarios").alias("scenarios"), F.max("week").alias("week")
    )
    columns = F.array(*map(F.lit, measured)).cast("array<string>")
    params = F.transform(F.col("scenarios")[0].limits, lambda x: x.param)

    def aligned(scenario: Column) -> Column:
        limits = F.transform(scenario.limits, lambda x: F.struct(x["min"].alias("low"), x["max"].alias("high")))
        return F.struct(scenario.scenario_id.alias("scenario_id"), limits.alias("limits"))

    return sets.select(
        "rule_id",
        "week",
        params.alias("params"),
        F.transform(params, lambda p: (F.array_position(columns, p) - 1).cast("int")).alias("at"),
        F.transform("scenarios", aligned).alias("scenarios"),
    )


def scenario_limits(dictionary: DataFrame, measured: Sequence[str]) -> DataFrame:
    """The dictionary by scenario, every limit a column of its own.

    ``low_<param>``, ``high_<param>`` and ``rank_<param>``, its place among the required
    parameters, are NULL where a parameter is not limited or not required.
    """
    rows = dictionary.select("rule_id", "week", "params", F.inline("scenarios"))
    columns = []
    for p in measured:
        place = F.nullif(F.array_position("params", p), F.lit(0)).cast("int")
        limit = F.get("limits", place - 1)
        columns += [place.alias(f"rank_{p}"), limit.low.alias(f"low_{p}"), limit.high.alias(f"high_{p}")]
    return rows.select("rule_id", "week", "params", "scenario_id", *columns)


def split_sites(config: DataFrame, measured: Sequence[str]) -> DataFrame:
    """Each configuration with how often its site is listed (``copies``) and all that speaks
    against using it (``findings``), parameters that the hourly table lacks included.

    One pass for both sides of the split: ``copies = 1`` without findings is usable.
    """
    columns = F.array(*map(F.lit, measured)).cast("array<string>")
    required = F.transform(_or_empty("required_parameters"), lambda p: F.trim(p))
    lacking = F.array_except(F.filter(required, lambda p: F.array_contains(_strings(SOURCE_FIELD), p)), columns)
    twice = _when("site_listed_twice", F.col("copies") > 1, F.lit(""), F.col("copies"))
    return config.withColumn("copies", F.count("*").over(Window.partitionBy("site_id"))).withColumn(
        "findings",
        F.concat(_rule_findings(), _window_findings(), _each("parameter_not_measured", lacking), twice),
    )


def sites_set_aside(config: DataFrame) -> DataFrame:
    """Sites that cannot be classified, and why: (site_id, rule, key, detail).

    Those with broken rules, and those listed more than once.
    """
    broken = _report(config, [_rule_findings(), _window_findings()])
    twice = config.groupBy("site_id").agg(F.count("*").alias("n")).filter("n > 1")
    return broken.unionByName(
        twice.select(
            "site_id",
            F.lit("site_listed_twice").alias("rule"),
            F.lit("").alias("key"),
            F.col("n").cast("string").alias("detail"),
        )
    )


def usable_sites(config: DataFrame) -> DataFrame:
    """The configurations that are left when ``sites_set_aside`` are taken away.

    Repeats are counted first, in one pass: checked before that, each rule would be moved
    into whatever makes the configurations and would parse them again, in the few tasks
    that read them.
    """
    row = F.struct(*(c for c in config.columns if c != "site_id")).alias("_row")
    sites = config.filter("site_id IS NOT NULL").groupBy("site_id").agg(F.count("*").alias("_n"), F.first(row).alias("_row"))
    once = sites.filter("_n = 1").select("site_id", "_row.*")
    return once.filter(F.size(F.concat(_rule_findings(), _window_findings())) == 0).select(config.columns)


def _finding(rule: str, key: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.coalesce(key.cast("string"), F.lit("")).alias("key"),
        F.coalesce(detail.cast("string"), F.lit("")).alias("detail"),
    )


def _each(rule: str, items: Column, detail: Column | None = None) -> Column:
    """One finding per array element."""
    text = F.lit("") if detail is None else detail
    return F.transform(items, lambda item: _finding(rule, item, text))


def _when(rule: str, broken: Column, key: Column, detail: Column) -> Column:
    """A finding if the condition holds, else nothing."""
    return F.array_compact(F.array(F.when(broken, _finding(rule, key, detail))))


def _report(config: DataFrame, findings: list[Column]) -> DataFrame:
    return config.select("site_id", F.inline(F.concat(*findings)))


def rule_violations(config: DataFrame) -> DataFrame:
    """Broken scenario and threshold rules: (site_id, rule, key, detail), none if all is well."""
    return _report(config, [_rule_findings()])


def _rule_findings() -> Column:
    """Names are checked without the blanks around them, blank ones not at all, as they are used."""
    required = F.filter(
        F.transform(_or_empty("required_parameters"), lambda p: F.trim(p)), lambda p: p != ""
    )
    supported = _strings(SOURCE_FIELD)
    declared = _declared_scenarios()
    custom = _or_empty("custom_scenarios")
    named_blocks = F.filter(_entries("weather_thresholds"), lambda e: F.trim(e["key"]) != "")
    blocks = F.transform(named_blocks, lambda e: F.trim(e["key"]))
    misnamed = lambda s: ~s.rlike(SCENARIO_ID_PATTERN)
    limits = F.flatten(
        F.transform(
            named_blocks,
            lambda block: F.transform(
                F.filter(
                    F.coalesce(F.map_entries(block["value"]), F.array()),
                    lambda limit: F.trim(limit["key"]) != "",
                ),
                lambda limit: F.struct(
                    F.concat_ws(".", F.trim(block["key"]), F.trim(limit["key"])).alias("key"),
                    F.trim(limit["key"]).alias("param"),
                    limit["value"]["min"].alias("min"),
                    limit["value"]["max"].alias("max"),
                ),
            ),
        )
    )

    def each_limit(rule: str, broken, detail) -> Column:
        return F.transform(
            F.filter(limits, broken), lambda x: _finding(rule, x["key"], detail(x))
        )

    def not_numeric(side: str):
        return lambda x: x[side].isNotNull() & x[side].try_cast("double").isNull()

    return F.concat(
        *[
            _when("required_parameters_empty", F.size(required) == 0, F.lit(""), F.lit("")),
            _each("parameter_unsupported", F.array_except(required, supported)),
            _when(
                "scenario_mode_unknown",
                ~_mode().isin(*SCENARIO_MODES),
                F.col("scenario_mode"),
                F.lit(""),
            ),
            _when(
                "custom_scenarios_not_allowed",
                (_mode() != "standard_3_plus") & (F.size(custom) > 0),
                F.col("scenario_mode"),
                F.size(custom),
            ),
            _each(
                "custom_scenario_blank",
                F.filter(custom, lambda s: F.trim(F.coalesce(s, F.lit(""))) == ""),
            ),
            _each("scenario_id_invalid", F.filter(declared, misnamed)),
            _when(
                "too_many_scenarios",
                F.size(declared) > MAX_SCENARIOS,
                F.lit(""),
                F.size(declared),
            ),
            _each("threshold_block_unknown", F.array_except(blocks, declared)),
            _each("threshold_block_id_invalid", F.filter(blocks, misnamed)),
            each_limit(
                "threshold_parameter_unsupported",
                lambda x: ~F.array_contains(supported, x["param"]),
                lambda x: x["param"],
            ),
            each_limit("threshold_min_not_numeric", not_numeric("min"), lambda x: x["min"]),
            each_limit("threshold_max_not_numeric", not_numeric("max"), lambda x: x["max"]),
            each_limit(
                "threshold_min_above_max",
                lambda x: F.coalesce(
                    x["min"].try_cast("double") > x["max"].try_cast("double"), F.lit(False)
                ),
                lambda x: F.concat_ws(">", x["min"], x["max"]),
            ),
        ],
    )


def _valid_hhmm(text: Column) -> Column:
    hour = F.substring(text, 1, 2).try_cast("int")
    minute = F.substring(text, 4, 2).try_cast("int")
    valid = text.rlike(HHMM_PATTERN) & (hour <= 23) & (minute <= 59)
    return F.coalesce(valid, F.lit(False))


def _bounds_findings(bounds: Column, prefix: str, key: Column, own_times: Column) -> list[Column]:
    """Checks shared by base bounds and overrides.

    ``own_times`` holds the times given in place; ``bounds`` the effective ones.
    """
    start, end = bounds["start"], bounds["end"]
    fixed_start, fixed_end = start == "fixed_time", end == "fixed_time"
    start_ok, end_ok = _valid_hhmm(own_times["start_time"]), _valid_hhmm(own_times["end_time"])
    backwards = hhmm_to_minutes(own_times["end_time"]) <= hhmm_to_minutes(own_times["start_time"])
    sun = start.isin("sunrise") | end.isin("sunset")
    return [
        _when(f"{prefix}_start_unknown", ~start.isin(*TIME_REFERENCES), key, start),
        _when(f"{prefix}_end_unknown", ~end.isin(*TIME_REFERENCES), key, end),
        _when(f"{prefix}_start_is_sunset", start == "sunset", key, start),
        _when(f"{prefix}_end_is_sunrise", end == "sunrise", key, end),
        _when(f"{prefix}_sun_event_not_computed", sun, key, F.concat_ws("-", start, end)),
        _when(
            f"{prefix}_start_time_invalid", fixed_start & ~start_ok, key, own_times["start_time"]
        ),
        _when(f"{prefix}_end_time_invalid", fixed_end & ~end_ok, key, own_times["end_time"]),
        _when(
            f"{prefix}_not_same_day",
            fixed_start & fixed_end & start_ok & end_ok & backwards,
            key,
            F.concat_ws("-", own_times["start_time"], own_times["end_time"]),
        ),
    ]


def window_violations(config: DataFrame) -> DataFrame:
    """Broken operational-window rules: (site_id, rule, key, detail)."""
    return _report(config, [_window_findings()])


def _window_findings() -> Column:
    calendar = F.col("calendar_model")
    days = _custom_days()
    custom = calendar == "custom"
    base = F.struct(
        F.coalesce("time_bounds.start", F.lit("fixed_time")).alias("start"),
        F.coalesce("time_bounds.end", F.lit("fixed_time")).alias("end"),
    )

    def override_findings(entry: Column) -> Column:
        given = entry["value"]
        effective = F.struct(
            F.coalesce(given["start"], base["start"]).alias("start"),
            F.coalesce(given["end"], base["end"]).alias("end"),
        )
        day = entry["key"].try_cast("int")
        off_week = F.coalesce((day < 0) | (day > 6), F.lit(True))
        return F.concat(
            _when("override_weekday_invalid", off_week, entry["key"], F.lit("")),
            *_bounds_findings(effective, "override", entry["key"], given),
        )

    return F.concat(
        *[
            _when(
                "calendar_model_unknown",
                ~F.coalesce(calendar, F.lit("all_days")).isin(*CALENDAR_MODELS),
                calendar,
                F.lit(""),
            ),
            _when("weekdays_empty", custom & (F.size(days) == 0), calendar, F.lit("")),
            _each(
                "weekday_out_of_range",
                F.filter(days, lambda d: custom & ((d < 0) | (d > 6))).cast("array<string>"),
            ),
            *_bounds_findings(base, "bounds", F.lit(""), F.col("time_bounds")),
            F.flatten(F.transform(_entries("weekly_overrides"), override_findings)),
        ],
    )
