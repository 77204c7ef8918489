"""Rules that hold for a whole run.

At most ten scenarios and seventeen parameters, so they are compiled into
Column literals: classification then needs neither a join nor a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from workwindow.rules.fixed import (
    BASE_ONLY,
    MAX_SCENARIOS,
    SCENARIO_ID_PATTERN,
    SCENARIO_MODES,
    SOURCE_FIELD,
    STANDARD_3,
)

Bounds = tuple[float | None, float | None]


@dataclass(frozen=True)
class DayWindow:
    """Working hours of one weekday: minutes of day, start inclusive, end exclusive."""

    allowed: bool
    start_min: int
    end_min: int


@dataclass(frozen=True)
class RuleSet:
    scenarios: tuple[str, ...]
    required: tuple[str, ...]
    limits: Mapping[str, Mapping[str, Bounds]]
    week: tuple[DayWindow, ...]
    timezone: str = "UTC"
    config: Mapping[str, Any] = field(default_factory=dict, compare=False)

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> RuleSet:
        required = tuple(
            str(p) for p in _listed(config.get("required_parameters")) if str(p).strip()
        )
        unknown = [p for p in required if p not in SOURCE_FIELD]
        if unknown:
            raise ValueError(f"unsupported parameters: {unknown}")
        scenarios = expand_scenarios(config.get("scenario_mode"), config.get("custom_scenarios"))
        if len(scenarios) > MAX_SCENARIOS:
            raise ValueError(f"{len(scenarios)} scenarios; at most {MAX_SCENARIOS} are allowed")
        limits = threshold_limits(config.get("weather_thresholds"))
        location = (config.get("project") or {}).get("location") or {}
        return cls(
            scenarios=scenarios,
            required=required,
            limits={**{s: {} for s in scenarios}, **limits},
            week=week_windows(config.get("operational_window") or {}),
            timezone=str(location.get("timezone") or "UTC"),
            config=dict(config),
        )

    def bounds(self, scenario: str, param: str) -> Bounds:
        """(min, max) of a parameter in a scenario; an absent rule is no constraint."""
        return self.limits.get(scenario, {}).get(param, (None, None))

    def scenario_table(self, spark: SparkSession) -> DataFrame:
        rows = [(s, i) for i, s in enumerate(self.scenarios)]
        return spark.createDataFrame(rows, "scenario_id string, ordinal int")

    def threshold_table(self, spark: SparkSession) -> DataFrame:
        order = {p: i + 1 for i, p in enumerate(self.required)}
        rows = [
            (scenario, param, low, high, order.get(param, 0))
            for scenario, block in self.limits.items()
            for param, (low, high) in block.items()
        ]
        return spark.createDataFrame(
            rows, "scenario_id string, param string, min double, max double, ordinal int"
        )

    def window_table(self, spark: SparkSession) -> DataFrame:
        rows = [(d, w.allowed, w.start_min, w.end_min) for d, w in enumerate(self.week)]
        return spark.createDataFrame(
            rows, "weekday int, allowed boolean, start_min int, end_min int"
        )


def _listed(value: Any) -> list[Any]:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def expand_scenarios(mode: Any, custom: Any = None) -> tuple[str, ...]:
    """Ordered scenario ids of a mode, without blanks or repeats."""
    mode = mode.strip() if isinstance(mode, str) else ""
    ids: list[str] = list(STANDARD_3 if mode in ("standard_3", "standard_3_plus") else BASE_ONLY)
    if mode == "standard_3_plus":
        ids += [str(c).strip() for c in _listed(custom)]
    return tuple(dict.fromkeys(i for i in ids if i))


def config_findings(config: Mapping[str, Any]) -> list[str]:
    """What is wrong with the scenarios and limits of a configuration; empty if all is well.

    Ids and names are checked without the blanks around them, as they are used.
    """
    mode = config.get("scenario_mode")
    mode = mode.strip() if isinstance(mode, str) else "" if mode is None else str(mode)
    custom = [str(c if c is not None else "").strip() for c in _listed(config.get("custom_scenarios"))]
    required = [str(p).strip() for p in _listed(config.get("required_parameters"))]
    required = [p for p in required if p]
    declared = expand_scenarios(mode, custom)
    found = [] if required else ["required_parameters_empty"]
    found += [f"parameter_unsupported: {p}" for p in required if p not in SOURCE_FIELD]
    if mode and mode not in SCENARIO_MODES:
        found.append(f"scenario_mode_unknown: {mode}")
    if custom and mode != "standard_3_plus":
        found.append(f"custom_scenarios_not_allowed: {mode or 'base_only'}")
    found += ["custom_scenario_blank" for c in custom if not c]
    found += [f"scenario_id_invalid: {s}" for s in declared if not re.search(SCENARIO_ID_PATTERN, s)]
    if len(declared) > MAX_SCENARIOS:
        found.append(f"too_many_scenarios: {len(declared)}")
    blocks = config.get("weather_thresholds") or {}
    for name, block in blocks.items() if isinstance(blocks, Mapping) else ():
        name = str(name if name is not None else "").strip()
        if not name:
            continue
        if name not in declared:
            found.append(f"threshold_block_unknown: {name}")
        if not re.search(SCENARIO_ID_PATTERN, name):
            found.append(f"threshold_block_id_invalid: {name}")
        for param, limit in block.items() if isinstance(block, Mapping) else ():
            param = str(param if param is not None else "").strip()
            if not param:
                continue
            if param not in SOURCE_FIELD:
                found.append(f"threshold_parameter_unsupported: {name}.{param}")
            sides = [limit.get(s) for s in ("min", "max")] if isinstance(limit, Mapping) else []
            numeric = [isinstance(v, (int, float)) and not isinstance(v, bool) for v in sides]
            found += [
                f"threshold_{s}_not_numeric: {name}.{param}"
                for s, v, ok in zip(("min", "max"), sides, numeric)
                if v is not None and not ok
            ]
            if sides and all(numeric) and sides[0] > sides[1]:
                found.append(f"threshold_min_above_max: {name}.{param}")
    return found


def checked_rules(config: Mapping[str, Any]) -> RuleSet:
    """The rules of a configuration, refused before any work if something is wrong."""
    if findings := config_findings(config):
        raise ValueError("configuration refused: " + "; ".join(findings))
    return RuleSet.from_config(config)


def threshold_limits(thresholds: Any) -> dict[str, dict[str, Bounds]]:
    """Scenario-first thresholds as ``{scenario: {param: (min, max)}}``."""
    if thresholds is None:
        return {}
    if not isinstance(thresholds, Mapping):
        raise TypeError("weather_thresholds must map scenario ids to parameter limits")

    def cleaned(block: Any) -> dict[str, Any]:
        pairs = block.items() if isinstance(block, Mapping) else ()
        return {str(k).strip(): v for k, v in pairs if k is not None and str(k).strip()}

    def number(limits: Any, side: str) -> float | None:
        value = limits.get(side) if isinstance(limits, Mapping) else None
        return float(value) if isinstance(value, (int, float)) else None

    return {
        scenario: {p: (number(b, "min"), number(b, "max")) for p, b in cleaned(block).items()}
        for scenario, block in cleaned(thresholds).items()
    }


def _fixed_window(bounds: Mapping[str, Any], what: str) -> tuple[int, int]:
    references = {bounds.get("start", "fixed_time"), bounds.get("end", "fixed_time")}
    if references != {"fixed_time"}:
        raise NotImplementedError(f"{what}: only fixed_time to fixed_time windows are computed")
    minutes = []
    for side in ("start_time", "end_time"):
        text = bounds.get(side)
        if not text:
            raise ValueError(f"{what}: {side} is required")
        minutes.append(int(text[:2]) * 60 + int(text[3:]))
    start_min, end_min = minutes
    if end_min <= start_min:
        raise ValueError(f"{what}: end must be after start (same-day window)")
    return start_min, end_min


def week_windows(window: Mapping[str, Any]) -> tuple[DayWindow, ...]:
    """Seven day windows, Monday first: base hours with the weekday overrides merged in."""
    base = {"start": "fixed_time", "end": "fixed_time", **(window.get("time_bounds") or {})}
    hours = dict.fromkeys(range(7), _fixed_window(base, "time_bounds"))
    overrides = window.get("weekly_overrides") or {}
    if not isinstance(overrides, Mapping):
        raise ValueError("weekly_overrides must map weekdays to bounds")
    for key, override in overrides.items():
        day = int(key)
        if day not in hours or not isinstance(override, Mapping):
            raise ValueError(f"weekly_overrides[{key}] must be bounds for a weekday 0..6")
        hours[day] = _fixed_window({**base, **override}, f"weekly_overrides[{key}]")
    allowed = allowed_weekdays(window)
    return tuple(DayWindow(day in allowed, *hours[day]) for day in range(7))


def allowed_weekdays(window: Mapping[str, Any]) -> frozenset[int]:
    calendar = window.get("calendar_model", "all_days")
    if calendar == "custom":
        days = window.get("weekdays", window.get("custom_weekdays"))
        return frozenset(int(d) for d in _listed(days))
    if calendar == "mon_fri":
        return frozenset(range(5))
    return frozenset(range(7))
