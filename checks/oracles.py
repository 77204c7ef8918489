"""Oracle SQL: the plain, single-node statement of what each query must return."""

from __future__ import annotations

import json
from typing import NamedTuple

from checks import fixtures as fx

# Stated here once more, not taken from the code under test.
RELIABILITY_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)
QUANTILES = {"p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
SOURCE_FIELD = {"wind_speed": "wind_speed_10m", "precipitation": "precipitation"}


class Day(NamedTuple):
    allowed: bool
    start_min: int
    end_min: int


class Stated(NamedTuple):
    """What a fixture's configuration means: limits as (min, max), hours as minutes."""

    limits: dict[str, dict[str, tuple]]
    week: list[Day]
    scenarios: tuple = ("base", "conservative", "optimistic")
    required: tuple = ("temperature", "wind_speed", "precipitation")

    def bounds(self, scenario: str, param: str) -> tuple:
        return self.limits[scenario][param]


def _at_most(temperature, wind, rain) -> dict:
    return {"temperature": (None, temperature), "wind_speed": (None, wind), "precipitation": (None, rain)}


def _cold(temperature, wind, rain) -> dict:
    return {"temperature": (temperature, None), "wind_speed": (None, wind), "precipitation": (None, rain)}


NINE_TO_FIVE = [Day(True, 540, 1020)] * 7
EVENTS_FACTS = Stated(
    {"base": _at_most(100, 90, 7), "conservative": _at_most(60, 70, 5), "optimistic": _at_most(200, 98, 9)},
    NINE_TO_FIVE,
)
LINEITEM_FACTS = Stated(
    {"base": _cold(0.01, 45, 0.09), "conservative": _cold(0.02, 35, 0.07), "optimistic": _cold(0.01, 49, 0.1)},
    NINE_TO_FIVE,
)
OVERRIDE_FACTS = EVENTS_FACTS._replace(
    week=[*NINE_TO_FIVE[:4], Day(True, 540, 720), NINE_TO_FIVE[5], Day(True, 390, 1215)]
)
WEEKDAYS_FACTS = EVENTS_FACTS._replace(week=[Day(d in (0, 2, 4, 5), 540, 1020) for d in range(7)])

LOCAL = f"(time_utc AT TIME ZONE 'UTC') AT TIME ZONE '{fx.ZONE}'"
MEASURED = ", ".join(fx.PARAMS)

TRUTH_EVENTS = f"""
truth AS (SELECT *, {LOCAL} AS time_local FROM (
  SELECT event_type AS site_id, date_trunc('hour', ts) AS time_utc,
    arg_min(value, event_id) AS temperature,
    arg_min(CAST(json_extract(props, '$.k') AS DOUBLE), event_id) AS wind_speed,
    arg_min(CAST(json_extract(props, '$.k') AS DOUBLE) % 10, event_id) AS precipitation
  FROM events GROUP BY ALL))"""

LINEITEM_HOURS = """
  SELECT CAST({site} AS VARCHAR) AS site_id,
    l_shipdate + to_hours(l_orderkey % 24) AS time_utc,
    nullif(min(l_tax), 0) AS temperature, min(l_quantity) AS wind_speed,
    min(l_discount) AS precipitation
  FROM lineitem GROUP BY ALL"""

TRUTH_LINEITEM = f"""
truth AS (SELECT *, {LOCAL} AS time_local FROM ({LINEITEM_HOURS.format(site="l_suppkey % 4")}))"""

MINUTE = "(hour(time_local) * 60 + minute(time_local))"
WEEKDAY = "(isodow(time_local) - 1)"


def _mask(rules) -> str:
    days = [
        f"({WEEKDAY} = {d} AND {MINUTE} >= {w.start_min} AND {MINUTE} < {w.end_min})"
        for d, w in enumerate(rules.week)
        if w.allowed
    ]
    return "(" + " OR ".join(days) + ")"


def _ok(rules, scenario: str, param: str) -> str:
    low, high = rules.bounds(scenario, param)
    tests = [f"{param} >= {low}"] if low is not None else []
    tests += [f"{param} <= {high}"] if high is not None else []
    return f"coalesce({' AND '.join(tests)}, false)" if tests else "true"


def _limiting(rules, scenario: str) -> str:
    cases = " ".join(f"WHEN NOT {_ok(rules, scenario, p)} THEN '{p}'" for p in rules.required)
    return f"CASE {cases} END"


def _classified(truth: str, rules, scenarios=None) -> str:
    parts = []
    for s in scenarios or rules.scenarios:
        all_ok = " AND ".join(_ok(rules, s, p) for p in rules.required)
        parts.append(
            f"SELECT *, '{s}' AS scenario_id, {_mask(rules)} AS op, {all_ok} AS good, "
            f"{_limiting(rules, s)} AS failing FROM truth"
        )
    return f"""WITH {truth},
stacked AS ({" UNION ALL ".join(parts)}),
c AS (SELECT site_id, time_utc, time_local, {MEASURED}, scenario_id,
  op AS operational_flag, op AND good AS workable_flag, op AND NOT good AS loss_flag,
  CASE WHEN op AND NOT good THEN coalesce(failing, 'unknown') END AS limiting_param,
  op AS is_operational, op AND good AS is_workable,
  year(time_local) AS year, month(time_local) AS month, {WEEKDAY} AS weekday,
  hour(time_local) AS hour, CAST(time_local AS DATE) AS date_local
  FROM stacked)"""


EVENTS = _classified(TRUTH_EVENTS, EVENTS_FACTS)
LINEITEM = _classified(TRUTH_LINEITEM, LINEITEM_FACTS)
K = "site_id, scenario_id"
TIMES = "site_id, CAST(time_utc AS VARCHAR) AS time_utc, CAST(time_local AS VARCHAR) AS time_local"
FLAGS = "operational_flag, workable_flag, loss_flag, limiting_param"

HOURS = """count(*) AS total_hours,
  count(*) FILTER (is_operational) AS operational_hours,
  count(*) FILTER (is_workable) AS workable_hours"""


def _share(part: str, whole: str, scale: str = "") -> str:
    return f"round(coalesce({scale}({part}) / nullif({whole}, 0), 0.0), 6)"


METRICS = f"""total_hours, operational_hours, workable_hours,
  total_hours - operational_hours AS schedule_lost_hours,
  operational_hours - workable_hours AS weather_lost_hours,
  {_share("operational_hours", "total_hours")} AS operational_pct_of_total_hours,
  {_share("workable_hours", "total_hours")} AS workable_pct_of_total_hours,
  {_share("workable_hours", "operational_hours")} AS workable_pct_of_operational_hours,
  {_share("operational_hours - workable_hours", "operational_hours")}
    AS weather_lost_pct_of_operational_hours,
  {_share("total_hours - operational_hours", "total_hours")} AS schedule_lost_pct_of_total_hours"""


def _summary(base: str, *dims: str) -> str:
    keys = ", ".join([K, *dims])
    return f"{base} SELECT {keys}, {METRICS} FROM (SELECT {keys}, {HOURS} FROM c GROUP BY ALL)"


def _loss(*dims: str, base: str = LINEITEM) -> str:
    keys = ", ".join([K, *dims])
    on = " AND ".join(f"l.{k.strip()} = d.{k.strip()}" for k in keys.split(","))
    cols = ", ".join(f"l.{k.strip()}" for k in keys.split(","))
    return f"""{base},
lost AS (SELECT {keys}, limiting_param AS param, count(*) AS hours_lost
  FROM c WHERE loss_flag GROUP BY ALL),
den AS (SELECT {keys}, count(*) FILTER (is_operational) AS op, count(*) FILTER (loss_flag) AS wl
  FROM c GROUP BY ALL)
SELECT {cols}, param, hours_lost, {_share("hours_lost", "wl")} AS pct_of_weather_lost_hours,
  {_share("hours_lost", "op")} AS pct_of_operational_hours
FROM lost l JOIN den d ON {on}"""


def _weather(*dims: str) -> str:
    keys = ", ".join([K, *dims])
    levels = "[" + ", ".join(str(q) for q in QUANTILES.values()) + "]"
    picks = ", ".join(f"round(q[{i + 1}], 6) AS {name}" for i, name in enumerate(QUANTILES))
    return f"""{LINEITEM},
long AS (UNPIVOT (SELECT {keys}, is_operational, is_workable,
    coalesce(temperature, 'NaN') AS temperature, wind_speed, precipitation FROM c)
  ON {MEASURED} INTO NAME param VALUE v),
ctx AS (
  SELECT *, 'all' AS context FROM long
  UNION ALL SELECT *, 'operational' FROM long WHERE is_operational
  UNION ALL SELECT *, 'workable' FROM long WHERE is_workable
  UNION ALL SELECT *, 'blocked_operational' FROM long WHERE is_operational AND NOT is_workable),
clean AS (SELECT * REPLACE (CASE WHEN NOT isnan(v) THEN v END AS v) FROM ctx),
agg AS (SELECT {keys}, context, param, count(*) AS n_hours, count(v) AS n_known, avg(v) AS m,
    stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi, quantile_cont(v, {levels}) AS q
  FROM clean GROUP BY ALL)
SELECT {keys}, context, param, n_hours, round(1 - n_known / n_hours, 6) AS missing_rate,
  round(m + 1e-9, 6) AS mean, round(sd + 1e-9, 6) AS std, round(lo, 6) AS min, {picks}, round(hi, 6) AS max
FROM agg"""


RATES = f"""{LINEITEM},
rates AS (SELECT {K}, year, month,
  count(*) FILTER (is_operational AND is_workable)
    / nullif(count(*) FILTER (is_operational), 0) AS r FROM c GROUP BY ALL)"""


def _reliability() -> str:
    levels = ", ".join(str(t) for t in RELIABILITY_THRESHOLDS)
    return f"""{RATES}
SELECT {K}, t AS threshold_workable_pct,
  round(avg(CASE WHEN r >= t THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END), 6)
    AS fraction_of_months_meeting_threshold,
  count(r) AS n_months
FROM rates, (SELECT unnest([{levels}]::DOUBLE[]) AS t) GROUP BY ALL"""


def _distribution() -> str:
    quantiles = ", ".join(
        f"round(quantile_cont(r, {q / 100}), 6) AS p{q}_workable_rate" for q in (10, 25, 50, 75, 90)
    )
    return f"""{RATES}
SELECT {K}, count(r) AS n_months, round(avg(r), 6) AS mean_workable_rate,
  round(stddev_pop(r), 6) AS std_workable_rate, round(min(r), 6) AS min_workable_rate,
  round(max(r), 6) AS max_workable_rate, {quantiles}
FROM rates GROUP BY ALL"""


def _targets() -> str:
    shares = ", ".join(
        f"round(avg(CASE WHEN r >= {t / 100} THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END), 6)"
        f" AS share_months_ge_{t}"
        for t in (50, 60, 70, 80, 90)
    )
    planned = ", ".join(
        f"round(quantile_cont(r, {p / 100}), 6) AS p{p}_monthly_workable_rate" for p in (50, 80, 90)
    )
    return f"{RATES} SELECT {K}, count(r) AS n_months, {shares}, {planned} FROM rates GROUP BY ALL"


def _pivot(*dims: str) -> str:
    keys = ", ".join([K, *dims])
    return f"""{LINEITEM}
SELECT {keys}, count(*) AS total_hours, count(*) FILTER (is_operational) AS operational_hours,
  round(count(*) FILTER (is_operational AND is_workable)
    / nullif(count(*) FILTER (is_operational), 0), 6) AS workable_pct_of_operational_hours
FROM c GROUP BY ALL"""


def _param_mean() -> str:
    parts = [
        f"SELECT {K}, month, hour, '{p}' AS param, count(*) AS n_hours, "
        f"round(1 - count({p}) / count(*), 6) AS missing_rate, round(avg({p}) + 1e-9, 6) AS mean "
        "FROM c WHERE is_operational GROUP BY ALL"
        for p in fx.PARAMS
    ]
    return f"{LINEITEM} {' UNION ALL '.join(parts)}"


def _curves() -> str:
    kinds = {
        "operational": "is_operational",
        "workable": "is_operational AND is_workable",
        "weather_lost": "is_operational AND NOT is_workable",
        "schedule_lost": "NOT is_operational",
    }
    daily = ", ".join(f"count(*) FILTER ({t}) AS {k}_hours_daily" for k, t in kinds.items())
    total = ", ".join(
        f"CAST(sum({k}_hours_daily) OVER w AS BIGINT) AS {k}_hours_cum" for k in kinds
    )
    return f"""{LINEITEM},
daily AS (SELECT {K}, date_local, {daily} FROM c GROUP BY ALL)
SELECT * REPLACE (CAST(date_local AS VARCHAR) AS date_local), {total} FROM daily
WINDOW w AS (PARTITION BY {K} ORDER BY date_local)"""


STEP = """
ts AS (SELECT DISTINCT site_id, time_utc FROM c WHERE operational_flag),
gaps AS (SELECT site_id, epoch(time_utc - lag(time_utc) OVER (
  PARTITION BY site_id ORDER BY time_utc)) / 3600.0 AS gap FROM ts),
step AS (SELECT site_id, coalesce(median(gap), 1.0) AS h FROM gaps GROUP BY ALL)"""

STREAKS = f"""{STEP},
seq AS (SELECT c.site_id, scenario_id, time_utc, workable_flag AS wk, h,
    lag(workable_flag) OVER s AS prev_wk,
    epoch(time_utc - lag(time_utc) OVER s) / 3600.0 AS dt
  FROM c JOIN step USING (site_id) WHERE operational_flag
  WINDOW s AS (PARTITION BY c.site_id, scenario_id ORDER BY time_utc)),
marked AS (SELECT *, CAST(sum(CASE WHEN prev_wk IS NULL OR prev_wk <> wk OR dt > 1.5 * h
    THEN 1 ELSE 0 END) OVER (PARTITION BY site_id ORDER BY scenario_id, time_utc
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak_id FROM seq),
runs AS (SELECT {K}, streak_id, min(time_utc) AS start_ts, max(time_utc) AS end_ts,
    count(*) * any_value(h) AS hours, any_value(wk) AS wk FROM marked GROUP BY ALL)"""


def _streaks(base: str, workable: bool, tail: str = "") -> str:
    return f"""{base},{STREAKS}
SELECT {K}, streak_id, CAST(start_ts AS VARCHAR) AS start_ts, CAST(end_ts AS VARCHAR) AS end_ts,
  round(hours, 6) AS duration_hours FROM runs WHERE {"wk" if workable else "NOT wk"} {tail}"""


def _streaks_summary(base: str) -> str:
    return f"""{base},{STREAKS}
SELECT {K}, count(*) FILTER (NOT wk) AS n_blocked_streaks,
  round(max(hours) FILTER (NOT wk), 6) AS longest_blocked_hours,
  round(quantile_cont(hours, 0.5) FILTER (NOT wk), 6) AS p50_blocked_hours,
  round(quantile_cont(hours, 0.9) FILTER (NOT wk), 6) AS p90_blocked_hours,
  count(*) FILTER (NOT wk AND hours >= 6) AS count_blocked_ge_6h,
  count(*) FILTER (NOT wk AND hours >= 12) AS count_blocked_ge_12h,
  count(*) FILTER (NOT wk AND hours >= 24) AS count_blocked_ge_24h,
  count(*) FILTER (wk) AS n_workable_streaks,
  round(coalesce(max(hours) FILTER (wk), 0.0), 6) AS longest_workable_hours,
  round(coalesce(quantile_cont(hours, 0.5) FILTER (wk), 0.0), 6) AS p50_workable_hours,
  round(coalesce(quantile_cont(hours, 0.9) FILTER (wk), 0.0), 6) AS p90_workable_hours
FROM runs GROUP BY ALL HAVING count(*) FILTER (NOT wk) > 0"""


def _percent(part: str, whole: str) -> str:
    return _share(part, whole, "100.0 * ")


CALENDAR = f"""year(time_local) AS year, month(time_local) AS month, day(time_local) AS day,
  CAST(CAST(time_local AS DATE) AS VARCHAR) AS date_local, {WEEKDAY} AS weekday,
  hour(time_local) AS hour, week(time_local) AS week_of_year"""

# Per-site rules of fixtures.supplier_config, as plain relations.
SITES = """
site AS (SELECT CAST(s_suppkey AS VARCHAR) AS site_id, s_suppkey % 2 = 0 AS with_temperature,
  CASE s_nationkey % 4 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Denver'
    WHEN 2 THEN 'Europe/Berlin' ELSE 'Asia/Kolkata' END AS timezone,
  CASE s_suppkey % 3 WHEN 0 THEN ['base'] WHEN 1 THEN ['base', 'conservative', 'optimistic']
    ELSE ['base', 'conservative', 'optimistic', 'night', 'c' || s_nationkey] END AS scenarios,
  CASE s_suppkey % 4 WHEN 0 THEN [0, 1, 2, 3, 5] WHEN 1 THEN [0, 1, 2, 3, 4]
    ELSE [0, 1, 2, 3, 4, 5, 6] END AS days,
  40 + s_nationkey % 10 AS wind_max, (6 + s_nationkey % 3) * 60 + 30 AS start_min
  FROM supplier)"""

SITE_CLASSIFIED = f"""WITH {SITES},
hours AS ({LINEITEM_HOURS.format(site="l_suppkey")}),
truth AS (SELECT *, timezone(timezone, time_utc AT TIME ZONE 'UTC') AS time_local
  FROM hours JOIN site USING (site_id)),
named AS (SELECT *, unnest(scenarios) AS scenario_id FROM truth),
judged AS (SELECT *,
  list_contains(days, {WEEKDAY}) AND CASE WHEN {WEEKDAY} = 4
    THEN {MINUTE} >= 480 AND {MINUTE} < 720
    ELSE {MINUTE} >= start_min AND {MINUTE} < 1020 END AS op,
  CASE WHEN with_temperature AND scenario_id = 'base' AND NOT coalesce(temperature >= 0.01, false)
      THEN 'temperature'
    WHEN scenario_id = 'base' AND NOT wind_speed <= wind_max THEN 'wind_speed'
    WHEN scenario_id = 'conservative' AND NOT (wind_speed >= 2 AND wind_speed <= 30)
      THEN 'wind_speed'
    WHEN scenario_id = 'base' AND NOT precipitation <= 0.09 THEN 'precipitation'
    WHEN scenario_id = 'night' AND NOT precipitation <= 0.05 THEN 'precipitation' END AS failing
  FROM named),
c AS (SELECT *, op AS operational_flag, op AND failing IS NULL AS workable_flag,
  op AND failing IS NOT NULL AS loss_flag, CASE WHEN op THEN failing END AS limiting_param,
  op AS is_operational, op AND failing IS NULL AS is_workable FROM judged)"""

# What fixtures.mixed_supplier_config leaves, and why the others are set aside.
MIXED_CLASSIFIED = SITE_CLASSIFIED.replace("FROM supplier)", "FROM supplier WHERE s_suppkey % 7 > 3)")
SET_ASIDE = f"""WITH hours AS ({LINEITEM_HOURS.format(site="l_suppkey")}),
counted AS (SELECT site_id, count(*) AS n FROM hours GROUP BY site_id),
site AS (SELECT CAST(s_suppkey AS VARCHAR) AS site_id, s_suppkey % 7 AS kind FROM supplier)
SELECT coalesce(s.site_id, c.site_id) AS site_id,
  CASE kind WHEN 0 THEN 'calendar_model_unknown' WHEN 1 THEN 'site_listed_twice'
    WHEN 3 THEN 'parameter_not_measured' ELSE 'site_without_rules' END AS rule,
  CASE kind WHEN 0 THEN 'weekends' WHEN 3 THEN 'rain' ELSE '' END AS key,
  CASE kind WHEN 1 THEN '2' ELSE '' END AS detail, coalesce(n, 0) AS n_hours
FROM site s FULL JOIN counted c ON s.site_id = c.site_id
WHERE kind IN (0, 1, 3) OR (kind IS NULL OR kind = 2) AND n > 0"""

# Faults planted by fixtures.customer_config.
CUSTOMERS = """
cust AS (SELECT CAST(c_custkey AS VARCHAR) AS site_id, c_custkey AS k,
  c_nationkey AS n, CASE c_custkey % 5 WHEN 0 THEN 'standard_3_plus' WHEN 1 THEN 'standard_9'
    ELSE 'base_only' END AS mode,
  CASE WHEN c_custkey % 3 = 0 THEN 'storm' ELSE 'conservative' END AS block,
  CASE WHEN c_custkey % 6 = 0 THEN 'pollen' ELSE 'rain' END AS param
  FROM customer)"""


def _findings(rows: list[tuple[str, str, str, str]]) -> str:
    """(rule, key, detail, condition) over ``cust``."""
    return " UNION ALL ".join(
        f"SELECT site_id, '{rule}' AS rule, {key} AS key, {detail} AS detail "
        f"FROM cust WHERE {condition}"
        for rule, key, detail, condition in rows
    )


RULE_FINDINGS = [
    ("required_parameters_empty", "''", "''", "k % 4 = 0"),
    ("parameter_unsupported", "'humidity'", "''", "k % 4 = 1"),
    ("scenario_mode_unknown", "mode", "''", "k % 5 = 1"),
    ("scenario_id_invalid", "'extra one'", "''", "k % 5 = 0"),
    ("scenario_id_invalid", "'x%s'", "''", "k % 5 = 0"),
    ("threshold_block_unknown", "block", "''", "k % 3 = 0 OR k % 5 <> 0"),
    (
        "threshold_parameter_unsupported",
        "block || '.' || param",
        "param",
        "param = 'pollen'",
    ),
    ("threshold_max_not_numeric", "block || '.' || param", "'high'", "k % 8 = 0"),
    (
        "threshold_min_above_max",
        "'base.wind_speed'",
        "CAST(n AS VARCHAR) || '>12'",
        "n > 12",
    ),
]

# Faults planted by fixtures.part_config, one kind for each remainder by nine.
RARE_FINDINGS = [
    ("custom_scenario_blank", "''", "''", "k % 9 = 0"),
    ("custom_scenarios_not_allowed", "'base_only'", "'1'", "k % 9 = 1"),
    ("scenario_id_invalid", "'bad id'", "''", "k % 9 = 2"),
    ("threshold_block_id_invalid", "'bad id'", "''", "k % 9 = 2"),
    ("threshold_min_not_numeric", "'base.wind_speed'", "'low' || k", "k % 9 = 3"),
    ("too_many_scenarios", "''", "'11'", "k % 9 = 4"),
    ("bounds_end_unknown", "''", "'dusk'", "k % 9 = 5"),
    ("override_end_unknown", "'3'", "'dusk'", "k % 9 = 5"),
    ("override_start_unknown", "'3'", "'dawn'", "k % 9 = 6"),
    ("override_start_time_invalid", "'3'", "'7:00'", "k % 9 = 7"),
    ("override_end_time_invalid", "'3'", "'25:00'", "k % 9 = 8"),
]

START = "CASE k % 10 WHEN 0 THEN 'sunset' WHEN 1 THEN 'noon' ELSE 'fixed_time' END"
END = "CASE k % 11 WHEN 0 THEN 'sunrise' WHEN 1 THEN 'sunset' ELSE 'fixed_time' END"
START_TIME = "CASE k % 12 WHEN 0 THEN '9:00' WHEN 1 THEN '24:00' ELSE '09:00' END"
END_TIME = "CASE k % 13 WHEN 0 THEN '17:60' WHEN 1 THEN '08:59' ELSE '17:00' END"
DAY = "CAST(k % 9 AS VARCHAR)"
OVERRIDE_END = "'0' || (n % 10) || ':00'"

# Overrides inherit the base references and carry valid times of their own.
WINDOW_FINDINGS = [
    ("calendar_model_unknown", "'weekends'", "''", "k % 7 = 0"),
    ("weekdays_empty", "'custom'", "''", "k % 7 = 1 AND k % 9 = 0"),
    ("weekday_out_of_range", "'7'", "''", "k % 7 = 1 AND k % 9 = 1"),
    ("weekday_out_of_range", "'-1'", "''", "k % 7 = 1 AND k % 9 = 1"),
    ("override_weekday_invalid", DAY, "''", "k % 9 > 6"),
    ("bounds_start_time_invalid", "''", START_TIME, f"{START} = 'fixed_time' AND k % 12 < 2"),
    ("bounds_end_time_invalid", "''", END_TIME, f"{END} = 'fixed_time' AND k % 13 = 0"),
    (
        "bounds_not_same_day",
        "''",
        f"{START_TIME} || '-' || {END_TIME}",
        f"{START} = 'fixed_time' AND {END} = 'fixed_time' AND k % 12 > 1 AND k % 13 = 1",
    ),
    (
        "override_not_same_day",
        DAY,
        f"'08:00-' || {OVERRIDE_END}",
        f"{START} = 'fixed_time' AND {END} = 'fixed_time' AND n % 10 <= 8",
    ),
]
for _where, _key in (("bounds", "''"), ("override", DAY)):
    WINDOW_FINDINGS += [
        (f"{_where}_start_unknown", _key, "'noon'", "k % 10 = 1"),
        (f"{_where}_start_is_sunset", _key, "'sunset'", "k % 10 = 0"),
        (f"{_where}_end_is_sunrise", _key, "'sunrise'", "k % 11 = 0"),
        (f"{_where}_sun_event_not_computed", _key, f"{START} || '-sunset'", "k % 11 = 1"),
    ]

CONTRACT_TABLES = {
    "summary_monthly": [
        "operational_pct_of_total_hours",
        "workable_pct_of_total_hours",
        "workable_pct_of_operational_hours",
        "weather_lost_pct_of_operational_hours",
        "schedule_lost_pct_of_total_hours",
    ],
    "loss_by_param_monthly": ["pct_of_weather_lost_hours", "pct_of_operational_hours"],
    "pivot_month_x_hour_workable_rate": ["workable_pct_of_operational_hours"],
    "reliability_targets_monthly": [
        *(f"share_months_ge_{t}" for t in (50, 60, 70, 80, 90)),
        *(f"p{p}_monthly_workable_rate" for p in (50, 80, 90)),
    ],
}


def _contract() -> str:
    bodies = {
        "summary_monthly": _summary(LINEITEM, "year", "month"),
        "loss_by_param_monthly": _loss("year", "month"),
        "pivot_month_x_hour_workable_rate": _pivot("month", "hour"),
        "reliability_targets_monthly": _targets(),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} < 0 OR {c} > 1) AS n_outside FROM ({bodies[name]})"
        for name, columns in CONTRACT_TABLES.items()
        for c in columns
    )


def _landed_findings() -> str:
    wind, rain = SOURCE_FIELD["wind_speed"], SOURCE_FIELD["precipitation"]
    return f"""WITH {TRUTH_EVENTS},
docs AS (SELECT site_id, CAST(time_utc AS DATE) AS d, count(*) AS n FROM truth GROUP BY ALL)
SELECT site_id, CAST(d AS VARCHAR) AS day, 'length_mismatch' AS problem, '{wind}' AS field,
  CAST(n - 1 AS VARCHAR) || ' vs ' || CAST(n AS VARCHAR) AS detail FROM docs WHERE day(d) % 3 = 0
UNION ALL SELECT site_id, CAST(d AS VARCHAR), 'missing_field', '{rain}', '' FROM docs
WHERE day(d) % 5 = 0
UNION ALL SELECT site_id, CAST(d AS VARCHAR), 'missing_block', 'hourly', '' FROM docs
WHERE day(d) IN (7, 13)
UNION ALL SELECT site_id, CAST(d AS VARCHAR), 'missing_time', 'time', '' FROM docs
WHERE day(d) = 11"""


def _mask_query(rules: Stated) -> str:
    return f"WITH {TRUTH_EVENTS} SELECT {TIMES}, {_mask(rules)} AS is_operational FROM truth"


def _threshold_eval() -> str:
    rules, s = LINEITEM_FACTS, "conservative"
    oks = ", ".join(f"{_ok(rules, s, p)} AS ok_{p}" for p in fx.PARAMS)
    every = " AND ".join(_ok(rules, s, p) for p in fx.PARAMS)
    rounded = ", ".join(f"round({p}, 6) AS {p}" for p in fx.PARAMS)
    return f"""WITH {TRUTH_LINEITEM}
SELECT site_id, CAST(time_utc AS VARCHAR) AS time_utc, {rounded}, {oks}, {every} AS all_ok,
  {_mask(rules)} AND {every} AS is_workable FROM truth"""


def _meta() -> str:
    canonical = json.dumps(fx.LINEITEM_CONFIG, sort_keys=True, default=str)
    limits = json.dumps(fx.LINEITEM_CONFIG["weather_thresholds"], sort_keys=True)
    return f"""{LINEITEM}
SELECT 'run' AS run_id, 'fixture' AS location_name, '{fx.ZONE}' AS timezone,
  '' AS period_start_utc, '' AS period_end_utc, '{",".join(fx.PARAMS)}' AS parameters,
  '{limits}' AS thresholds, left(sha256('{canonical}'), 16) AS config_hash,
  count(*) AS rows_hourly FROM c"""


def _cubes() -> str:
    body = f"""SELECT {K}, weekday, count(*) AS n_hours,
  count(*) FILTER (is_operational) AS n_operational, count(*) FILTER (is_workable) AS n_workable,
  count(*) FILTER (is_operational AND is_workable) AS n_productive"""
    return f"""{LINEITEM} {body}, 'day' AS cube FROM c GROUP BY ALL
UNION ALL {body}, 'clock' AS cube FROM c GROUP BY ALL"""


def _ordered(sql: str, order: str, limit: int) -> str:
    return f"SELECT * FROM ({sql}) ORDER BY {order} LIMIT {limit}"


PARAM_VALUES = ", ".join(f"round({p}, 6) AS {p}" for p in fx.PARAMS)
SITE_LIMITS = f"""WITH {SITES}
SELECT site_id, x.scenario_id, x.param, CAST(x.low AS DOUBLE) AS min,
  CAST(coalesce(x.high, CASE WHEN x.scenario_id = 'base' AND x.param = 'wind_speed'
    THEN wind_max END) AS DOUBLE) AS max,
  CASE x.param WHEN 'temperature' THEN CASE WHEN with_temperature THEN 1 ELSE 0 END
    WHEN 'wind_speed' THEN CASE WHEN with_temperature THEN 2 ELSE 1 END
    ELSE CASE WHEN with_temperature THEN 3 ELSE 2 END END AS ordinal
FROM site, (VALUES ('base', 'temperature', 0.01, NULL), ('base', 'wind_speed', NULL, NULL),
  ('base', 'precipitation', NULL, 0.09), ('conservative', 'wind_speed', 2, 30),
  ('night', 'precipitation', NULL, 0.05), ('night', 'temperature', NULL, NULL))
  AS x(scenario_id, param, low, high)"""

ORACLES: dict[str, str] = {
    "classify_base": f"""{_classified(TRUTH_EVENTS, EVENTS_FACTS, ["base"])}
SELECT {TIMES}, {PARAM_VALUES}, scenario_id, {FLAGS} FROM c""",
    "classify_all_scenarios": f"{EVENTS} SELECT {TIMES}, scenario_id, {FLAGS} FROM c",
    "classify_site_rules": f"{SITE_CLASSIFIED} SELECT {TIMES}, scenario_id, {FLAGS} FROM c",
    "summary_site_rules": _summary(SITE_CLASSIFIED),
    "site_run_summary": _summary(MIXED_CLASSIFIED),
    "site_run_loss": _loss(
        "year", base=MIXED_CLASSIFIED.replace("c AS (SELECT *,", "c AS (SELECT *, year(time_local) AS year,")
    ),
    "site_run_set_aside": SET_ASIDE,
    "time_features": f"WITH {TRUTH_EVENTS} SELECT {TIMES}, {CALENDAR} FROM truth",
    "time_features_season": f"""WITH {TRUTH_LINEITEM}
SELECT site_id, year(time_local) AS year, month(time_local) AS month,
  CASE WHEN month(time_local) IN (12, 1, 2) THEN 'DJF' WHEN month(time_local) IN (3, 4, 5)
    THEN 'MAM' WHEN month(time_local) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season,
  count(*) AS n_hours, count(DISTINCT week(time_local)) AS n_weeks FROM truth GROUP BY ALL""",
    "operational_mask": _mask_query(EVENTS_FACTS),
    "operational_mask_override": _mask_query(OVERRIDE_FACTS),
    "operational_mask_custom_weekdays": _mask_query(WEEKDAYS_FACTS),
    "threshold_eval": _threshold_eval(),
    "limiting_param": f"""WITH {TRUTH_LINEITEM}
SELECT site_id, CAST(time_utc AS VARCHAR) AS time_utc, {_mask(LINEITEM_FACTS)} AS is_operational,
  {_limiting(LINEITEM_FACTS, "base")} AS limiting_param FROM truth""",
    "evaluation_summary": f"""{EVENTS}
SELECT {K}, total_hours, operational_hours, workable_hours,
  {_percent("workable_hours", "operational_hours")} AS workable_pct_of_operational,
  {_percent("workable_hours", "total_hours")} AS workable_pct_of_total
FROM (SELECT {K}, {HOURS} FROM c GROUP BY ALL)""",
    "summary_run": _summary(EVENTS),
    "run_digest": f"""{EVENTS}
SELECT {K}, workable_hours, operational_hours,
  total_hours - operational_hours AS schedule_lost_hours,
  operational_hours - workable_hours AS weather_lost_hours,
  {_percent("workable_hours", "operational_hours")} AS workable_pct_op,
  {_percent("operational_hours - workable_hours", "operational_hours")} AS weather_lost_pct_op,
  {_percent("total_hours - operational_hours", "total_hours")} AS schedule_lost_pct_total,
  {_percent("operational_hours", "total_hours")} AS operational_pct_total
FROM (SELECT {K}, {HOURS} FROM c GROUP BY ALL)""",
    "summary_monthly": _summary(LINEITEM, "year", "month"),
    "summary_yearly": _summary(LINEITEM, "year"),
    "loss_by_param_monthly": _loss("year", "month"),
    "loss_by_param_yearly": _loss("year"),
    "weather_stats_monthly": _weather("year", "month"),
    "weather_stats_yearly": _weather("year"),
    "weather_stats_yearly_unpacked": _weather("year"),
    "weather_stats_merged": f"SELECT * FROM ({_weather('year', 'month')}) "
    f"UNION ALL BY NAME SELECT *, 0 AS month FROM ({_weather('year')})",
    "curves_cumulative_daily": _curves(),
    "monthly_rate": f"{RATES} SELECT {K}, year, month, round(r, 6) AS workable_rate FROM rates",
    "curve_reliability_monthly": _reliability(),
    "stats_monthly_workable_rate_dist": _distribution(),
    "reliability_targets_monthly": _targets(),
    "pivot_month_x_hour": _pivot("month", "hour"),
    "pivot_month_x_weekday": _pivot("month", "weekday"),
    "pivot_weekday_x_hour": _pivot("weekday", "hour"),
    "pivot_month_x_hour_param_mean": _param_mean(),
    "bundle_cubes": _cubes(),
    "timestep_hours": f"{EVENTS},{STEP} SELECT site_id, round(h, 6) AS timestep_hours FROM step",
    "streaks_nonworkable": _streaks(EVENTS, workable=False),
    "streaks_workable": _streaks(EVENTS, workable=True),
    "streaks_nonworkable_years": _streaks(LINEITEM, workable=False),
    "streaks_summary": _streaks_summary(EVENTS),
    "streaks_summary_years": _streaks_summary(LINEITEM),
    "top_blocked_streaks": _streaks(
        EVENTS,
        workable=False,
        tail="ORDER BY hours DESC, site_id, scenario_id, streak_id LIMIT 10",
    ),
    "monthly_preview": _ordered(
        _summary(LINEITEM, "year", "month"), "scenario_id, site_id, year, month", 6
    ),
    "loss_preview": _ordered(
        _loss("year", "month"),
        "scenario_id, site_id, year, month, hours_lost DESC, param",
        10,
    ),
    "hourly_preview": _ordered(
        f"{EVENTS} SELECT {TIMES}, scenario_id, {FLAGS} FROM c",
        "scenario_id, site_id, time_utc",
        5,
    ),
    "rate_contract_violations": _contract(),
    "run_meta": _meta(),
    "truth_in_years": f"""WITH {TRUTH_LINEITEM} SELECT {TIMES}, {PARAM_VALUES} FROM truth
WHERE time_utc >= TIMESTAMP '1997-01-01' AND time_utc < TIMESTAMP '1999-01-01'""",
    "scenario_rules": f"""WITH {SITES}
SELECT site_id, unnest(scenarios) AS scenario_id,
  unnest(range(len(scenarios))) AS ordinal FROM site""",
    "threshold_rules": SITE_LIMITS,
    "window_rules": f"""WITH {SITES}
SELECT site_id, weekday, list_contains(days, weekday) AS allowed,
  CASE WHEN weekday = 4 THEN 480 ELSE start_min END AS start_min,
  CASE WHEN weekday = 4 THEN 720 ELSE 1020 END AS end_min
FROM site, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS weekday)""",
    "rule_violations": f"WITH {CUSTOMERS} {_findings(RULE_FINDINGS)}",
    "window_violations": f"WITH {CUSTOMERS} {_findings(WINDOW_FINDINGS)}",
    "rare_violations": "WITH cust AS (SELECT CAST(p_partkey AS VARCHAR) AS site_id, p_partkey AS k FROM part) "
    + _findings(RARE_FINDINGS),
    "sites_set_aside": f"""WITH {CUSTOMERS},
broken AS (SELECT *, CAST(site_id AS BIGINT) % 8 = 0 AS twice FROM (
  {_findings(RULE_FINDINGS)} UNION ALL {_findings(WINDOW_FINDINGS)}))
SELECT site_id, rule, key, detail FROM broken
UNION ALL SELECT site_id, rule, key, detail FROM broken WHERE twice
UNION ALL SELECT site_id, 'site_listed_twice', '', '2' FROM cust WHERE k % 8 = 0
UNION ALL SELECT 's' || s_suppkey, 'site_listed_twice', '', '2' FROM supplier WHERE s_suppkey % 8 = 0""",
    "usable_sites": f"""WITH {CUSTOMERS},
broken AS ({_findings(RULE_FINDINGS)} UNION ALL {_findings(WINDOW_FINDINGS)})
SELECT site_id, mode AS scenario_mode FROM cust
WHERE k % 8 <> 0 AND site_id NOT IN (SELECT site_id FROM broken)
UNION ALL SELECT 's' || s_suppkey,
  CASE s_suppkey % 3 WHEN 0 THEN 'base_only' WHEN 1 THEN 'standard_3' ELSE 'standard_3_plus' END
FROM supplier WHERE s_suppkey % 4 = 0 AND s_suppkey % 8 <> 0""",
    "hourly_key_violations": f"""WITH {TRUTH_EVENTS}
SELECT * FROM (
  SELECT 'site_id' AS column_name, count(*) FILTER (hour(time_utc) % 5 = 0) AS n_null FROM truth
  UNION ALL SELECT 'time_local', count(*) FILTER (hour(time_utc) % 7 = 0) FROM truth)
WHERE n_null > 0""",
    "landed_json_truth": f"WITH {TRUTH_EVENTS} SELECT {TIMES}, {PARAM_VALUES} FROM truth",
    "landed_json_violations": _landed_findings(),
    "landed_quarantine_rows": f"WITH {TRUTH_EVENTS} SELECT {TIMES}, {PARAM_VALUES} FROM truth "
    "WHERE day(time_utc) % 3 <> 0 AND day(time_utc) % 5 <> 0 AND day(time_utc) NOT IN (7, 11, 13)",
    "landed_quarantine_problems": _landed_findings(),
    "top_blocked_streaks_by_site": _streaks(
        LINEITEM,
        False,
        "QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY hours DESC, scenario_id, streak_id) <= 10",
    ),
    "monthly_preview_by_site": f"SELECT * FROM ({_summary(LINEITEM, 'year', 'month')}) "
    "QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY scenario_id, year, month) <= 6",
    "loss_preview_by_site": f"SELECT * FROM ({_loss('year', 'month')}) QUALIFY row_number() OVER "
    "(PARTITION BY site_id ORDER BY scenario_id, year, month, hours_lost DESC, param) <= 10",
}

# All tables of a bundle; every file is in order.
_BUNDLE = {
    "summary_run": _summary(LINEITEM),
    "streaks_nonworkable_operational": ORACLES["streaks_nonworkable_years"],
    "streaks_workable_operational": _streaks(LINEITEM, workable=True),
    "streaks_summary_operational": ORACLES["streaks_summary_years"],
    "pivot_month_x_hour_workable_rate": ORACLES["pivot_month_x_hour"],
    "pivot_month_x_weekday_workable_rate": ORACLES["pivot_month_x_weekday"],
    "pivot_weekday_x_hour_workable_rate": ORACLES["pivot_weekday_x_hour"],
    "pivot_month_x_hour_param_mean_operational": ORACLES["pivot_month_x_hour_param_mean"],
    "run_meta": "SELECT 1",
}
for _name in (
    "summary_monthly",
    "summary_yearly",
    "loss_by_param_monthly",
    "loss_by_param_yearly",
    "weather_stats_monthly",
    "weather_stats_yearly",
    "curves_cumulative_daily",
    "curve_reliability_monthly",
    "stats_monthly_workable_rate_dist",
    "reliability_targets_monthly",
):
    _BUNDLE[_name] = ORACLES[_name]
ORACLES["bundle_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, 0 AS n_out_of_order FROM ({sql})" for name, sql in _BUNDLE.items()
)
ORACLES["streaks_summary_placed"] = ORACLES["streaks_summary_years"]
ORACLES["weather_stats_placed"] = ORACLES["weather_stats_monthly"]
ORACLES["incremental_summary"] = ORACLES["summary_monthly"]
ORACLES["incremental_streaks"] = ORACLES["streaks_summary_years"]
ORACLES["incremental_pieces"] = f"""WITH {TRUTH_LINEITEM}
SELECT site_id, year(time_utc) * 12 + month(time_utc) AS month_number, count(*) AS n_hours,
  year(time_utc) >= 1998 OR (site_id = '1' AND year(time_utc) = 1996 AND month(time_utc) = 5) AS renewed
FROM truth GROUP BY site_id, year(time_utc), month(time_utc)"""
