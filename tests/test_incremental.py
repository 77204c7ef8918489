from pyspark.sql import functions as F

from tests.support import STANDARD_3, config, hours, truth
from workwindow.operators.classify import classify, classify_packed
from workwindow.plans.bundle import build_bundle
from workwindow.plans.incremental import read_manifest, refresh
from workwindow.rules.runwide import RuleSet


def many_months(spark):
    n = 24 * 100
    values = {"temperature": [20 + i % 23 for i in range(n)], "wind_speed": [i % 29 for i in range(n)]}
    table = truth(spark, hours(n), timezone="America/Denver", precipitation=0.5, **values)
    sites = spark.createDataFrame([("a",), ("b",)], "site_id string")
    return sites.crossJoin(table)


def full(hourly, cfg):
    rules = RuleSet.from_config(cfg)
    packed = classify_packed(hourly, rules)
    return build_bundle(classify(hourly, rules), cfg, packed=packed, include_weather_stats=True)


def settled(df):
    rounded = [F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema]
    return sorted(map(str, df.select(*sorted(rounded, key=str)).collect()))


def test_a_changed_month_is_made_anew_and_all_else_kept(spark, tmp_path):
    cfg, path = config("America/Denver", **STANDARD_3), str(tmp_path)
    now = many_months(spark)
    changed = (F.col("site_id") == "a") & (F.month("time_utc") == 2)
    before = now.withColumn("wind_speed", F.when(changed, F.col("wind_speed") + 7).otherwise(F.col("wind_speed")))
    before = before.filter("site_id <> 'b' OR month(time_utc) < 4")
    refresh(before, cfg, path)
    first = {(r.site_id, r._month): r.part for r in read_manifest(spark, path).collect()}
    assert len(first) == 4 + 3 and len(set(first.values())) == 1

    bundle = refresh(now, cfg, path)
    second = {(r.site_id, r._month): r.part for r in read_manifest(spark, path).collect()}
    again = {piece for piece, part in second.items() if first.get(piece) != part}
    assert len(second) == 8 and again == {("a", 2024 * 12 + 2), ("b", 2024 * 12 + 4)}
    new = spark.read.parquet(f"{path}/{second['a', 2024 * 12 + 2]}/cubes")
    assert {tuple(r) for r in new.select("site_id", "_month").distinct().collect()} == again

    want = full(now, cfg)
    assert set(bundle.tables) == set(want.tables)
    for name, table in want.tables.items():
        assert settled(bundle.tables[name]) == settled(table), name

    # nothing new: nothing is written but the manifest; a month less leaves the reports
    same = refresh(now, cfg, path)
    assert {(r.site_id, r._month): r.part for r in read_manifest(spark, path).collect()} == second
    assert settled(same.tables["summary_monthly"]) == settled(want.tables["summary_monthly"])
    less = refresh(now.filter("month(time_utc) > 1"), cfg, path)
    want = full(now.filter("month(time_utc) > 1"), cfg)
    for name in ("summary_run", "streaks_workable_operational", "weather_stats_yearly"):
        assert settled(less.tables[name]) == settled(want.tables[name]), name


def test_new_rules_make_all_pieces_anew(spark, tmp_path):
    hourly, path = many_months(spark), str(tmp_path)
    refresh(hourly, config("America/Denver", **STANDARD_3), path)
    parts = {r.part for r in read_manifest(spark, path).collect()}
    refresh(hourly, config("America/Denver"), path)
    assert parts.isdisjoint(r.part for r in read_manifest(spark, path).collect())
