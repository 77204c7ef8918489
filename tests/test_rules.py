import pytest

from tests.support import config, window
from workwindow.rules.runwide import (
    RuleSet,
    checked_rules,
    config_findings,
    expand_scenarios,
    threshold_limits,
    week_windows,
)


def test_scenario_modes():
    assert expand_scenarios("base_only") == ("base",)
    assert expand_scenarios(None) == ("base",)
    assert expand_scenarios("something_else") == ("base",)
    assert expand_scenarios("standard_3") == ("base", "conservative", "optimistic")
    assert expand_scenarios("standard_3_plus", ["night", " base ", "", "night"]) == (
        "base",
        "conservative",
        "optimistic",
        "night",
    )
    assert expand_scenarios("standard_3", ["ignored"]) == ("base", "conservative", "optimistic")


def test_more_than_ten_scenarios_are_refused():
    many = config(scenario_mode="standard_3_plus", custom_scenarios=[f"s{i}" for i in range(12)])
    assert len(expand_scenarios("standard_3_plus", many["custom_scenarios"])) == 15
    with pytest.raises(ValueError, match="15 scenarios"):
        RuleSet.from_config(many)


@pytest.mark.parametrize(
    ("changes", "finding"),
    [
        ({"required_parameters": [" "]}, "required_parameters_empty"),
        ({"required_parameters": ["humidity"]}, "parameter_unsupported: humidity"),
        ({"scenario_mode": "standard3"}, "scenario_mode_unknown: standard3"),
        ({"custom_scenarios": ["x"]}, "custom_scenarios_not_allowed"),
        ({"scenario_mode": "standard_3_plus", "custom_scenarios": [""]}, "custom_scenario_blank"),
        ({"scenario_mode": "standard_3_plus", "custom_scenarios": ["a b"]}, "scenario_id_invalid: a b"),
        ({"weather_thresholds": {"storm": {}}}, "threshold_block_unknown: storm"),
        ({"weather_thresholds": {"base": {"pollen": {"max": 1}}}}, "threshold_parameter_unsupported"),
        ({"weather_thresholds": {"base": {"rain": {"max": "12"}}}}, "threshold_max_not_numeric"),
        ({"weather_thresholds": {"base": {"rain": {"min": "low"}}}}, "threshold_min_not_numeric"),
        ({"weather_thresholds": {"base": {"rain": {"min": 3, "max": 2}}}}, "threshold_min_above_max"),
    ],
)
def test_a_run_refuses_broken_rules(changes, finding):
    with pytest.raises(ValueError, match=finding):
        checked_rules(config(**changes))


def test_blanks_around_names_are_no_finding():
    assert config_findings(config(weather_thresholds={" base ": {" rain ": {"max": 1}, "": {}}, "": {}})) == []


def test_thresholds_drop_blank_keys_and_non_maps():
    limits = threshold_limits(
        {" base ": {"wind_speed": {"max": 3}, "": {"max": 1}, "rain": 5}, "": {}, "night": None}
    )
    assert limits == {"base": {"wind_speed": (None, 3.0), "rain": (None, None)}, "night": {}}
    assert threshold_limits(None) == {}
    with pytest.raises(TypeError):
        threshold_limits([1])


def test_non_numeric_bound_is_no_bound():
    assert threshold_limits({"base": {"rain": {"min": "low", "max": 2}}}) == {
        "base": {"rain": (None, 2.0)}
    }


def test_window_across_midnight_is_refused():
    with pytest.raises(ValueError, match="same-day window"):
        week_windows(window("22:00", "06:00"))


def test_sun_windows_are_refused():
    bounds = {"start": "sunrise", "end": "fixed_time", "end_time": "17:00"}
    with pytest.raises(NotImplementedError):
        week_windows({"time_bounds": bounds})


def test_overrides_keep_missing_sides_from_the_base():
    week = week_windows(window(weekly_overrides={4: {"end_time": "12:00"}}))
    assert (week[4].start_min, week[4].end_min) == (540, 720)
    assert (week[3].start_min, week[3].end_min) == (540, 1020)


@pytest.mark.parametrize("key", ["7", "-1"])
def test_override_outside_the_week_is_refused(key):
    with pytest.raises(ValueError):
        week_windows(window(weekly_overrides={key: {"end_time": "12:00"}}))


def test_calendars():
    def allowed(**more):
        return [w.allowed for w in week_windows(window(**more))]

    assert allowed() == [True] * 7
    assert allowed(calendar_model="mon_fri") == [True] * 5 + [False] * 2
    assert allowed(calendar_model="custom", weekdays=[6]) == [False] * 6 + [True]
    assert allowed(calendar_model="custom", custom_weekdays=["1"]) == [False, True] + [False] * 5


def test_unsupported_parameter_is_refused():
    with pytest.raises(ValueError, match="humidity"):
        RuleSet.from_config(config(required_parameters=["humidity"]))


def test_rule_tables(spark):
    rules = RuleSet.from_config(config(calendar_model="custom"))
    assert [tuple(r) for r in rules.scenario_table(spark).collect()] == [("base", 0)]
    assert [tuple(r) for r in rules.threshold_table(spark).collect()] == [
        ("base", "temperature", -100.0, 100.0, 1)
    ]
    assert rules.window_table(spark).count() == 7
