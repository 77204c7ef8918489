import pytest
from pyspark.sql import functions as F

from tests.support import hours, truth
from workwindow.operators.classify import classify_by_site_rules, classify_packed_by_site_rules, unpack
from workwindow.plans.bundle import read_bundle
from workwindow.plans.contracts import ContractError
from workwindow.plans.pipeline import run_by_site
from workwindow.rules import bysite


def site(**changes):
    row = {
        "site_id": "a",
        "timezone": "UTC",
        "scenario_mode": "base_only",
        "custom_scenarios": [],
        "required_parameters": ["temperature"],
        "weather_thresholds": {"base": {"temperature": {"min": None, "max": "30"}}},
        "calendar_model": "all_days",
        "weekdays": None,
        "custom_weekdays": None,
        "time_bounds": {"start_time": "09:00", "end_time": "17:00"},
        "weekly_overrides": {},
    }
    return {**row, **changes}


@pytest.fixture(scope="module")
def hourly(spark):
    return truth(spark, hours(48), temperature=20.0).withColumn("site_id", F.lit("a"))


def judged(spark, hourly, *sites):
    config = spark.createDataFrame(list(sites), bysite.CONFIG_SCHEMA)
    return classify_by_site_rules(hourly, bysite.packed_rules(config))


def test_sound_rules(spark, hourly):
    assert judged(spark, hourly, site()).filter("is_workable").count() == 16


@pytest.mark.parametrize(
    ("changes", "finding"),
    [
        ({"weather_thresholds": {"base": {"temperature": {"max": "high"}}}}, "threshold_max_not_numeric"),
        ({"time_bounds": {"start": "sunrise", "start_time": "09:00", "end_time": "17:00"}}, "sun_event"),
        ({"time_bounds": {"start_time": "22:00", "end_time": "06:00"}}, "not_same_day"),
        ({"scenario_mode": "standard3"}, "scenario_mode_unknown"),
        ({"weekly_overrides": {"7": {"start_time": "08:00", "end_time": "09:00"}}}, "override_weekday_invalid"),
        (
            {"scenario_mode": "standard_3_plus", "custom_scenarios": [f"s{i}" for i in range(12)]},
            "too_many_scenarios",
        ),
        ({"required_parameters": ["temperature", "rain"]}, "no measurements"),
    ],
)
def test_broken_rules_fail_the_run(spark, hourly, changes, finding):
    with pytest.raises(Exception, match=finding):
        judged(spark, hourly, site(**changes)).collect()


def test_sites_without_or_with_two_rules_fail_the_run(spark, hourly):
    with pytest.raises(Exception, match="no rules for site a"):
        judged(spark, hourly, site(site_id="b")).collect()
    with pytest.raises(Exception, match="several rules for site a"):
        judged(spark, hourly, site(), site()).collect()


def test_set_aside_and_usable_sites(spark):
    rows = [site(), site(site_id="b", scenario_mode="x"), site(site_id="c"), site(site_id="c")]
    config = spark.createDataFrame(rows, bysite.CONFIG_SCHEMA)
    aside = {(r.site_id, r.rule) for r in bysite.sites_set_aside(config).collect()}
    assert aside == {("b", "scenario_mode_unknown"), ("c", "site_listed_twice")}
    assert [r.site_id for r in bysite.usable_sites(config).collect()] == ["a"]


def test_usable_sites_read_each_configuration_once(spark, capsys):
    documents = spark.createDataFrame([(f"s{i}", "{}") for i in range(9)], "site_id string, doc string")
    config = documents.select("site_id", F.from_json("doc", bysite.CONFIG_SCHEMA).alias("c")).select(
        "site_id", *(f"c.{n}" for n in site() if n != "site_id")
    )
    config.explain("extended")
    parsed = capsys.readouterr().out.partition("== Physical Plan ==")[2].count("from_json(")
    bysite.usable_sites(config).explain("extended")
    assert capsys.readouterr().out.partition("== Physical Plan ==")[2].count("from_json(") <= parsed


def test_usable_sites_need_a_site_listed_once(spark):
    rows = [site(), site(site_id=None), site(site_id="c"), site(site_id="c", scenario_mode="x"), site(site_id="d")]
    config = spark.createDataFrame(rows, bysite.CONFIG_SCHEMA)
    found = bysite.usable_sites(config)
    assert found.schema == config.schema
    assert sorted(found.collect()) == sorted(config.filter("site_id IN ('a', 'd')").collect())


def test_blanks_around_names_are_no_finding(spark):
    blocks = {" base ": {" temperature ": {"min": None, "max": "30"}}}
    config = spark.createDataFrame(
        [site(weather_thresholds=blocks, required_parameters=["temperature", " "])], bysite.CONFIG_SCHEMA
    )
    assert bysite.rule_violations(config).count() == 0


def test_override_keys_are_numbers_and_weekdays_have_an_alias(spark, hourly):
    zero = site(weekly_overrides={"00": {"start_time": "09:00", "end_time": "10:00"}})
    assert judged(spark, hourly, zero).filter("is_operational").count() == 1 + 8
    custom = site(calendar_model="custom", custom_weekdays=[1])
    assert judged(spark, hourly, custom).filter("is_operational").count() == 8


def many_sites(spark, n=12):
    """Three rule sets over n sites, with limits on two parameters in either order."""
    wind = {"wind_speed": {"min": "1", "max": "9"}, "temperature": {"max": "30"}}
    sets = [
        {},
        {"required_parameters": ["wind_speed", "temperature"], "weather_thresholds": {"base": wind}},
        {
            "scenario_mode": "standard_3",
            "required_parameters": ["temperature", "wind_speed"],
            "weather_thresholds": {"base": wind, "optimistic": {"wind_speed": {"max": "50"}}},
        },
    ]
    zones = ["UTC", "Asia/Kolkata"]
    rows = [site(site_id=f"s{i}", timezone=zones[i % 2], **sets[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, bysite.CONFIG_SCHEMA)


def measured_sites(spark, n=12):
    hour = truth(spark, hours(30), temperature=20.0)
    values = {
        "temperature": F.when(F.hour("time_utc") % 5 != 0, F.hour("time_utc") * 2.0),
        "wind_speed": F.when(F.hour("time_utc") % 7 == 0, F.lit(float("nan"))).otherwise(F.hour("time_utc") / 2),
    }
    sites = spark.range(n).select(F.concat(F.lit("s"), F.col("id")).alias("site_id"))
    return hour.withColumns(values).crossJoin(sites)


def test_one_dictionary_row_for_each_rule_set(spark):
    packed = bysite.packed_rules(many_sites(spark))
    dictionary = bysite.rule_dictionary(packed, ["wind_speed", "temperature"])
    rows = dictionary.collect()
    assert len(rows) == 3
    both = {tuple(r["params"]): r["at"] for r in rows}
    assert both[("wind_speed", "temperature")] == [0, 1] and both[("temperature", "wind_speed")] == [1, 0]
    sites = bysite.site_map(packed, ["wind_speed", "temperature"])
    assert sites.count() == 12 and sites.select("rule_id").distinct().count() == 3
    by_scenario = bysite.scenario_limits(dictionary, ["wind_speed", "temperature"])
    assert by_scenario.count() == 1 + 1 + 3


def test_packed_and_flat_classification_agree(spark):
    rules, hourly = bysite.packed_rules(many_sites(spark)), measured_sites(spark)
    flat = classify_by_site_rules(hourly, rules)
    packed = unpack(classify_packed_by_site_rules(hourly, rules))
    assert flat.columns == packed.columns
    assert flat.exceptAll(packed).isEmpty() and packed.exceptAll(flat).isEmpty()
    assert flat.count() == 30 * (4 + 4 + 12)
    lost = {r.limiting_param for r in flat.filter("loss_flag").select("limiting_param").distinct().collect()}
    assert lost == {"wind_speed", "temperature"}


def test_no_map_is_built_for_an_hour(spark, capsys):
    rules, hourly = bysite.packed_rules(many_sites(spark)), measured_sites(spark)
    for plan in (classify_by_site_rules(hourly, rules), classify_packed_by_site_rules(hourly, rules)):
        plan.explain("formatted")
        # what an error says is a map of its own
        assert "map(" not in capsys.readouterr().out.replace("map(errorMessage", "")


def test_run_by_site_reports_all_but_the_sites_set_aside(spark, tmp_path):
    broken = [site(site_id="s1", scenario_mode="x"), site(site_id="s2"), site(site_id="s2")]
    broken += [site(site_id="s3", required_parameters=["temperature", "rain"]), site(site_id="gone", scenario_mode="x")]
    others = many_sites(spark).filter(~F.col("site_id").isin("s1", "s2", "s3", "s4"))
    configs = others.unionByName(spark.createDataFrame(broken, bysite.CONFIG_SCHEMA))
    bundle = run_by_site(measured_sites(spark), configs, {"location": {"name": "many"}}, include_weather_stats=True)
    bundle.write(str(tmp_path))
    tables = read_bundle(spark, str(tmp_path))
    aside = {(r.site_id, r.rule, r.key): r.n_hours for r in tables["sites_set_aside"].collect()}
    assert aside == {
        ("s1", "scenario_mode_unknown", "x"): 30,
        ("s2", "site_listed_twice", ""): 30,
        ("s3", "parameter_not_measured", "rain"): 30,
        ("s4", "site_without_rules", ""): 30,
        ("gone", "scenario_mode_unknown", "x"): 0,
    }
    judged = tables["summary_run"].select("site_id").distinct().collect()
    assert {r.site_id for r in judged} == {f"s{i}" for i in (0, 5, 6, 7, 8, 9, 10, 11)}
    meta = tables["run_meta"].first()
    assert meta.location_name == "many" and sorted(meta.parameters) == ["temperature", "wind_speed"]
    assert tables["summary_run"].agg(F.sum("total_hours")).first()[0] == meta.rows_hourly


def test_a_run_by_site_makes_the_hours_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(value):
        made.add(1)
        return value

    hour = measured_sites(spark).withColumn("temperature", counted("temperature"))
    bundle = run_by_site(hour, many_sites(spark))
    assert bundle.tables["summary_run"].count() > 0
    assert bundle.tables["sites_set_aside"].count() == 0
    assert made.value == 30 * 12


def test_a_run_by_site_without_hours_is_refused(spark):
    with pytest.raises(ContractError, match="empty"):
        run_by_site(measured_sites(spark).filter("false"), many_sites(spark))
