import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tests.support import STANDARD_3, config, hours, truth
from workwindow.operators.classify import classify, classify_packed, unpack
from workwindow.operators import streaks
from workwindow.plans.bundle import Bundle, build_bundle, read_bundle
from workwindow.plans.contracts import (
    ContractError,
    check_hourly,
    check_tables,
    key_violations,
    rate_violations,
)
from workwindow.rules.runwide import RuleSet
from workwindow.session import shared_dir, stage

PARAMS = ["temperature", "wind_speed", "precipitation"]
CORE = {
    "summary_run",
    "summary_monthly",
    "summary_yearly",
    "loss_by_param_monthly",
    "loss_by_param_yearly",
}
CURVES = {"curves_cumulative_daily", "curve_reliability_monthly"}
PIVOTS = {
    "pivot_month_x_hour_workable_rate",
    "pivot_month_x_weekday_workable_rate",
    "pivot_weekday_x_hour_workable_rate",
}
STATS = {"stats_monthly_workable_rate_dist", "reliability_targets_monthly"}
STREAKS = {
    "streaks_nonworkable_operational",
    "streaks_workable_operational",
    "streaks_summary_operational",
}


@pytest.fixture(scope="module")
def cfg():
    return config(**STANDARD_3)


@pytest.fixture(scope="module")
def hourly(spark, cfg):
    wind = [15.0 + i % 12 for i in range(336)]
    values = {"temperature": 30, "wind_speed": wind, "precipitation": 0.5}
    sites = spark.createDataFrame([("a",), ("b",)], "site_id string")
    many = sites.crossJoin(truth(spark, hours(336), **values))
    return classify(many, RuleSet.from_config(cfg)).cache()


@pytest.fixture(scope="module")
def bundle(hourly, cfg):
    return build_bundle(
        hourly, cfg, include_weather_stats=True, visual_params_for_mean=["wind_speed"]
    )


def settled(table):
    """Sorted rows without the last bits that depend on summation order."""
    doubles = [f.name for f in table.schema.fields if f.dataType.typeName() == "double"]
    rounded = table.withColumns({c: F.round(c, 9) for c in doubles})
    return sorted(map(str, rounded.collect()))


def test_all_tables_are_there(bundle):
    extra = {
        "weather_stats_monthly",
        "weather_stats_yearly",
        "pivot_month_x_hour_param_mean_operational",
    }
    assert set(bundle.tables) == CORE | CURVES | PIVOTS | STATS | STREAKS | extra


def test_tables_cover_all_scenarios_and_sites(bundle, cfg):
    for name in CORE | STATS:
        table = bundle.tables[name]
        seen = {(r.site_id, r.scenario_id) for r in table.select("site_id", "scenario_id").collect()}
        if not name.startswith("loss"):
            assert len(seen) == 6, name


def test_column_order(bundle):
    t = bundle.tables
    assert t["summary_run"].columns[-1] == "scenario_id"
    assert t["summary_monthly"].columns[:4] == ["site_id", "scenario_id", "year", "month"]
    assert t["weather_stats_yearly"].columns == [
        *("site_id", "scenario_id", "year", "context", "param", "n_hours", "missing_rate"),
        *("mean", "std", "min", "p05", "p10", "p25", "p50", "p75", "p90", "p95", "max"),
    ]
    assert t["streaks_workable_operational"].columns == [
        "site_id", "scenario_id", "streak_id", "start_ts", "end_ts", "duration_hours",
    ]
    assert t["stats_monthly_workable_rate_dist"].columns[2:] == [
        "n_months",
        *(f"{m}_workable_rate" for m in ("mean", "std", "min", "max", "p10", "p25", "p50", "p75", "p90")),
    ]


def test_include_flags(hourly, cfg):
    small = build_bundle(
        hourly.drop("limiting_param").withColumn("limiting_param", F.lit("wind_speed")),
        cfg,
        include_curves=False,
        include_visual=False,
        include_stats=False,
    )
    assert set(small.tables) == CORE | STREAKS


def test_one_site_gives_the_same_numbers(hourly, cfg, bundle):
    alone = build_bundle(hourly.filter("site_id = 'a'").drop("site_id"), cfg)
    for name, table in alone.tables.items():
        both = bundle.tables[name].filter("site_id = 'a'").drop("site_id")
        assert settled(table) == settled(both), name


def test_meta(bundle, cfg):
    row = bundle.meta.first()
    payload = json.dumps(cfg, sort_keys=True, default=str).encode()
    assert row.config_hash == hashlib.sha256(payload).hexdigest()[:16]
    assert (row.run_id, row.rows_hourly, row.timezone) == ("run", 2 * 336 * 3, "UTC")
    assert list(row.parameters) == PARAMS and row.generated_at_utc.endswith("Z")


def test_written_tables_read_back(spark, bundle, tmp_path):
    bundle.write(str(tmp_path))
    published = read_bundle(spark, str(tmp_path))
    for name, table in bundle.tables.items():
        assert settled(published[name].select(*table.columns)) == settled(table), name
    assert published["run_meta"].count() == 1


def test_a_rerun_leaves_nothing_of_the_run_before(spark, bundle, tmp_path):
    run = bundle.tables["summary_run"]
    Bundle(bundle.meta, {"summary_run": run}).write(str(tmp_path))
    Bundle(bundle.meta, {"summary_run": run.filter("scenario_id = 'base'")}).write(str(tmp_path))
    seen = read_bundle(spark, str(tmp_path))["summary_run"].select("scenario_id").distinct()
    assert [r.scenario_id for r in seen.collect()] == ["base"]


def test_a_bad_run_is_not_published(spark, bundle, tmp_path):
    good = spark.createDataFrame([(0.5,)], "workable_rate double")
    bad = spark.createDataFrame([(7.0,)], "workable_rate double")
    Bundle(bundle.meta, {"rates": good}).write(str(tmp_path))
    with pytest.raises(ContractError):
        Bundle(bundle.meta, {"rates": bad}).write(str(tmp_path))
    assert [r[0] for r in read_bundle(spark, str(tmp_path))["rates"].collect()] == [0.5]


def test_written_files_keep_the_order_of_a_table(spark, bundle, tmp_path):
    folder = bundle.write(str(tmp_path))
    frame = spark.read.parquet(f"{folder}/summary_monthly").coalesce(1).toPandas()
    for _, rows in frame.groupby("scenario_id"):
        keys = list(zip(rows.site_id, rows.year, rows.month))
        assert keys == sorted(keys)


def test_rows_without_keys_are_reported_and_refused(spark, hourly):
    damaged = hourly.withColumn("site_id", F.when(F.hour("time_utc") != 3, F.col("site_id")))
    found = {r.column_name: r.n_null for r in key_violations(damaged).collect()}
    assert found == {"site_id": hourly.filter(F.hour("time_utc") == 3).count()}
    with pytest.raises(Exception, match="site_id must not be null"):
        streaks.operational_runs(damaged.withColumn("operational_flag", F.lit(True))).count()


def test_writing_checks_fractions(spark, bundle, tmp_path):
    bad = spark.createDataFrame([("base", 1.5)], "scenario_id string, workable_rate double")
    with pytest.raises(ContractError, match="rates.workable_rate: 1"):
        Bundle(meta=bundle.meta, tables={"rates": bad}).write(str(tmp_path))


def test_packed_hours_give_the_same_bundle(hourly, cfg, bundle):
    truth_columns = ["site_id", "time_utc", "time_local", *PARAMS]
    hours_only = hourly.filter("scenario_id = 'base'").select(*truth_columns)
    rules = RuleSet.from_config(cfg)
    packed = classify_packed(hours_only, rules)
    again = build_bundle(
        classify(hours_only, rules),
        cfg,
        packed=packed,
        include_weather_stats=True,
        validate=False,
    )
    assert sorted(map(str, unpack(packed).collect())) == sorted(
        map(str, hourly.select(*unpack(packed).columns).collect())
    )
    for name in ("weather_stats_monthly", "weather_stats_yearly", *STREAKS):
        assert settled(again.tables[name]) == settled(bundle.tables[name]), name


def test_input_contract(spark, hourly):
    check_hourly(hourly, PARAMS)
    with pytest.raises(ContractError, match="limiting_param"):
        check_hourly(hourly.drop("limiting_param"))
    with pytest.raises(ContractError, match="timestamp"):
        check_hourly(hourly.withColumn("time_local", F.lit("x")))
    with pytest.raises(ContractError, match="visibility"):
        check_hourly(hourly, ["visibility"])
    with pytest.raises(ContractError, match="empty"):
        check_hourly(hourly.filter("false"))


def test_output_contract(spark):
    good = spark.createDataFrame([(0.5,), (None,), (1.0,)], "workable_rate double")
    bad = spark.createDataFrame([(1.5,), (-0.1,), (0.2,)], "pct_of_operational_hours double")
    check_tables({"t": good}, ["t"])
    counted = {(r.table_name, r.n_outside) for r in rate_violations({"g": good, "b": bad}).collect()}
    assert counted == {("g", 0), ("b", 2)}
    with pytest.raises(ContractError, match="b.pct_of_operational_hours: 2"):
        check_tables({"b": bad}, [])
    with pytest.raises(ContractError, match="summary_run"):
        check_tables({"t": good}, ["summary_run"])


def test_staging_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    assert shared_dir(spark) == (configured or own.get()).rstrip("/")
    assert stage(spark.range(3), "three").count() == 3


def test_hours_without_a_key_are_refused_when_published(spark, hourly, cfg, tmp_path):
    """Counted while the cubes were made: writing refuses before it reads or writes anything."""
    hourly.withColumn("time_local", F.when(F.hour("time_utc") != 3, F.col("time_local"))).write.parquet(f"{tmp_path}/in")
    built = build_bundle(spark.read.parquet(f"{tmp_path}/in"), cfg)
    n = hourly.filter(F.hour("time_utc") == 3).count()
    assert dict(built.missing_keys) == {"site_id": 0, "scenario_id": 0, "time_utc": 0, "time_local": n}
    with pytest.raises(ContractError, match=f"time_local missing in {n} hours"):
        built.write(f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_repeated_hours_are_counted_and_refused_if_asked(hourly, cfg, tmp_path):
    once = hourly.filter("scenario_id = 'base'")
    twice = once.unionByName(once.filter(F.hour("time_utc") == 20))
    built = build_bundle(twice, cfg)
    n = once.filter((F.hour("time_utc") == 20) & F.col("is_operational")).count()
    assert built.repeated_hours == n
    if n:
        with pytest.raises(ContractError, match=f"{n} repeated hours"):
            built.write(str(tmp_path), refuse_repeats=True)
    assert build_bundle(once, cfg).repeated_hours == 0
    noon = once.unionByName(once.filter(F.hour("time_utc") == 12))
    built = build_bundle(noon, cfg)
    assert built.repeated_hours == 2 * 14
    with pytest.raises(ContractError, match="28 repeated hours"):
        built.write(str(tmp_path), refuse_repeats=True)
    built.write(str(tmp_path))


def test_hours_outside_the_window_make_a_bundle_without_runs(hourly, cfg):
    night = hourly.filter(F.hour("time_utc") == 3)
    built = build_bundle(night, cfg)
    assert built.repeated_hours == 0 and built.tables["streaks_workable_operational"].count() == 0
