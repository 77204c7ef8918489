"""Registered queries: each reads the given tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import fixtures as fx
from workwindow.functions.calendar import with_calendar
from workwindow.operators import curves, loss, pivots, previews, stats, streaks, summary, weather
from workwindow.operators.classify import (
    classify,
    classify_by_site_rules,
    evaluate_thresholds,
    evaluation_summary,
    operational_mask,
)
from workwindow.operators.counts import as_counts, clock_cube, count_cubes, day_cube
from workwindow.plans.bundle import SORT_ORDER, Bundle, build_bundle, read_bundle, run_meta
from workwindow.plans.incremental import read_manifest, refresh
from workwindow.plans.pipeline import run_by_site
from workwindow.plans.placed import write_placed
from workwindow.plans.contracts import key_violations, rate_violations
from workwindow.rules import bysite
from workwindow.rules.runwide import RuleSet
from workwindow.session import shared_dir, stage
from workwindow.sources.landed import landed_violations, parse_landed, split_landed, truth_from_landed
from workwindow.sources.truth import in_years

Query = Callable[[SparkSession, str], DataFrame]
FLAGS = ["operational_flag", "workable_flag", "loss_flag", "limiting_param"]


def portable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, dates and times as text, so engines compare exactly.

    A sum of measurements depends on its order in the last bits; the nudge keeps
    means that lie halfway between two roundings on one side.
    """
    out = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "double":
            nudge = 1e-9 if field.name in ("mean", "std") else 0.0
            out[field.name] = F.round(F.col(field.name) + nudge, 6)
        elif kind in ("date", "timestamp_ntz"):
            out[field.name] = F.col(field.name).cast("string")
    return df.withColumns(out) if out else df


def _events(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(op(fx.classified_events(spark, sf_dir)))


def _lineitem(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(op(fx.classified_lineitem(spark, sf_dir)))


def _packed(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(op(fx.packed_lineitem(spark, sf_dir)))


def _rows(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("site_id", "time_utc", "time_local", *extra)


def classify_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    only = classify(fx.truth_events(spark, sf_dir), fx.EVENTS_RULES, scenarios=["base"])
    return portable(_rows(only, *fx.PARAMS, "scenario_id", *FLAGS))


def classify_all_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(_rows(fx.classified_events(spark, sf_dir), "scenario_id", *FLAGS))


def classify_site_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = bysite.packed_rules(fx.sound_supplier_config(spark, sf_dir))
    classified = classify_by_site_rules(fx.truth_suppliers(spark, sf_dir), rules)
    return portable(_rows(classified, "scenario_id", *FLAGS))


def summary_site_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = bysite.packed_rules(fx.sound_supplier_config(spark, sf_dir))
    classified = classify_by_site_rules(fx.truth_suppliers(spark, sf_dir), rules)
    return portable(summary.summary_run(classified))


def _site_run(table: str) -> Query:
    """One table of a whole run by site."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        truth = fx.truth_suppliers(spark, sf_dir)
        return portable(run_by_site(truth, fx.mixed_supplier_config(spark, sf_dir)).tables[table])

    return query


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_calendar(fx.truth_events(spark, sf_dir).select("site_id", "time_utc", "time_local"))
    return portable(df)


def time_features_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_calendar(fx.truth_lineitem(spark, sf_dir), add_season=True)
    return df.groupBy("site_id", "year", "month", "season").agg(
        F.count("*").alias("n_hours"), F.count_distinct("week_of_year").alias("n_weeks")
    )


def _mask(config: dict) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        masked = operational_mask(fx.truth_events(spark, sf_dir), RuleSet.from_config(config))
        return portable(_rows(masked, "is_operational"))

    return query


def threshold_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = operational_mask(fx.truth_lineitem(spark, sf_dir), fx.LINEITEM_RULES)
    out = evaluate_thresholds(masked, fx.LINEITEM_RULES, "conservative")
    checks = [f"ok_{p}" for p in fx.PARAMS]
    return portable(
        out.select("site_id", "time_utc", *fx.PARAMS, *checks, "all_ok", "is_workable")
    )


def limiting_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = operational_mask(fx.truth_lineitem(spark, sf_dir), fx.LINEITEM_RULES)
    out = evaluate_thresholds(masked, fx.LINEITEM_RULES, "base")
    return portable(out.select("site_id", "time_utc", "is_operational", "limiting_param"))


def bundle_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly weekday totals from the day cube next to those from the clock cube."""
    cubes = count_cubes(fx.classified_lineitem(spark, sf_dir))
    measures = ("n_hours", "n_operational", "n_workable", "n_productive")
    sums = [F.sum(m).alias(m) for m in measures]
    by = ("site_id", "scenario_id", "weekday")
    parts = [
        cube.groupBy(*by).agg(*sums).withColumn("cube", F.lit(name))
        for name, cube in (("day", day_cube(cubes)), ("clock", clock_cube(cubes)))
    ]
    return parts[0].unionByName(parts[1])


def rate_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = fx.classified_lineitem(spark, sf_dir)
    tables = {
        "summary_monthly": summary.summary_monthly(hourly),
        "loss_by_param_monthly": loss.loss_by_param_monthly(hourly),
        "pivot_month_x_hour_workable_rate": pivots.pivot_month_x_hour_workable_rate(hourly),
        "reliability_targets_monthly": stats.reliability_targets_monthly(hourly),
    }
    return rate_violations(tables)


def _placed(op: Callable[[DataFrame], DataFrame]) -> Query:
    """Over hours written bucketed by site and month."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"hours_{uuid.uuid4().hex}"
        return portable(op(write_placed(fx.packed_lineitem(spark, sf_dir), name, 8)))

    return query


def weather_stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both statistics from one written table of value counts, made in two halves; month 0 is the year."""
    packed = fx.packed_lineitem(spark, sf_dir)
    early = F.dayofmonth("time_utc") < 11
    halves = [weather.value_counts(packed.filter(test), fx.PARAMS) for test in (early, ~early)]
    counts = stage(weather.merged_counts(halves[0].unionByName(halves[1])), "merged-counts")
    monthly = weather.weather_stats_monthly(counts, fx.PARAMS)
    yearly = weather.weather_stats_yearly(counts, fx.PARAMS)
    return portable(monthly.unionByName(yearly.withColumn("month", F.lit(0))))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/workwindow/{name}-{uuid.uuid4().hex}"


def bundle_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle of all tables, written, published and read again: rows of each table, and how
    many of them do not follow the one before in their file."""
    hourly, path = fx.classified_lineitem(spark, sf_dir), _folder(spark, "bundle")
    bundle = build_bundle(
        hourly,
        fx.LINEITEM_CONFIG,
        packed=fx.packed_lineitem(spark, sf_dir),
        include_weather_stats=True,
        visual_params_for_mean=fx.PARAMS,
    )
    bundle.write(path)
    counted = []
    for name, table in sorted(read_bundle(spark, path).items()):
        order = [c for c in SORT_ORDER if c in table.columns]
        placed = table.select(
            F.struct(*order) if order else F.lit(None).alias("key"),
            F.input_file_name().alias("file"),
            F.monotonically_increasing_id().alias("place"),
        ).toDF("key", "file", "place")
        before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
        late = placed.select(F.coalesce(F.col("key") < before, F.lit(False)).alias("late"))
        counted.append(
            late.agg(F.count("*").alias("n_rows"), F.count_if("late").alias("n_out_of_order")).select(
                F.lit(name).alias("table_name"), "n_rows", "n_out_of_order"
            )
        )
    return reduce(DataFrame.unionByName, counted)


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[Bundle, DataFrame]:
    """A bundle after a change of one site's month and a year that came later; and its pieces."""
    truth, path = stage(fx.truth_lineitem(spark, sf_dir), "truth"), _folder(spark, "incremental")
    t = F.col("time_utc")
    moved = (F.col("site_id") == "1") & (F.year(t) == 1996) & (F.month(t) == 5)
    before = truth.withColumn("wind_speed", F.col("wind_speed") + F.when(moved, 5.0).otherwise(0.0))
    refresh(before.filter(F.year(t) < 1998), fx.LINEITEM_CONFIG, path)
    old = F.lit(read_manifest(spark, path).first().part)
    bundle = refresh(truth, fx.LINEITEM_CONFIG, path)
    pieces = read_manifest(spark, path)
    return bundle, pieces.select("site_id", "_month", "n_hours", (F.col("part") != old).alias("renewed"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = as_counts(fx.classified_lineitem(spark, sf_dir)).agg(
        F.sum("n_hours").alias("rows_hourly")
    )
    out = run_meta(rows, fx.LINEITEM_CONFIG, "run")
    return out.withColumn("parameters", F.concat_ws(",", "parameters")).drop("generated_at_utc")


def hourly_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(fx.classified_events(spark, sf_dir), "scenario_id", *FLAGS)
    return portable(rows.orderBy("scenario_id", "site_id", "time_utc").limit(5))


def monthly_preview(hourly: DataFrame) -> DataFrame:
    return summary.summary_monthly(hourly).orderBy("scenario_id", "site_id", "year", "month").limit(6)


def loss_preview(hourly: DataFrame) -> DataFrame:
    order = ("scenario_id", "site_id", "year", "month", F.desc("hours_lost"), "param")
    return loss.loss_by_param_monthly(hourly).orderBy(*order).limit(10)


def truth_in_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = in_years(fx.truth_lineitem(spark, sf_dir), 1997, 1998)
    return portable(truth.select("site_id", "time_utc", "time_local", *fx.PARAMS))


def landed_json_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = parse_landed(fx.landed_documents(spark, sf_dir), "document", fx.PARAMS)
    truth = truth_from_landed(responses.drop("day"), fx.PARAMS, fx.ZONE)
    return portable(_rows(truth, *fx.PARAMS))


def landed_json_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.landed_documents(spark, sf_dir, faulty=True)
    return portable(landed_violations(parse_landed(documents, "document", fx.PARAMS), fx.PARAMS))


def _quarantine(side: int) -> Query:
    """Rows of the sound or problems of the faulty documents, from one read of all."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = fx.landed_documents(spark, sf_dir, faulty=True)
        both = split_landed(parse_landed(documents, "document", fx.PARAMS), fx.PARAMS, fx.ZONE)
        return portable(both[side] if side else _rows(both[0], *fx.PARAMS))

    return query


def _runs(op: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda hourly: op(streaks.operational_runs(hourly))


QUERIES: dict[str, Query] = {
    "classify_base": classify_base,
    "classify_all_scenarios": classify_all_scenarios,
    "classify_site_rules": classify_site_rules,
    "summary_site_rules": summary_site_rules,
    "site_run_summary": _site_run("summary_run"),
    "site_run_loss": _site_run("loss_by_param_yearly"),
    "site_run_set_aside": _site_run("sites_set_aside"),
    "time_features": time_features,
    "time_features_season": time_features_season,
    "operational_mask": _mask(fx.EVENTS_CONFIG),
    "operational_mask_override": _mask(fx.OVERRIDE_CONFIG),
    "operational_mask_custom_weekdays": _mask(fx.WEEKDAYS_CONFIG),
    "threshold_eval": threshold_eval,
    "limiting_param": limiting_param,
    "evaluation_summary": _events(evaluation_summary),
    "summary_run": _events(summary.summary_run),
    "run_digest": _events(lambda h: summary.run_digest(summary.summary_run(h))),
    "summary_monthly": _lineitem(summary.summary_monthly),
    "summary_yearly": _lineitem(summary.summary_yearly),
    "loss_by_param_monthly": _lineitem(loss.loss_by_param_monthly),
    "loss_by_param_yearly": _lineitem(loss.loss_by_param_yearly),
    "weather_stats_monthly": _packed(lambda h: weather.weather_stats_monthly(h, fx.PARAMS)),
    "weather_stats_yearly": _packed(lambda h: weather.weather_stats_yearly(h, fx.PARAMS)),
    "weather_stats_yearly_unpacked": _lineitem(
        lambda h: weather.weather_stats_yearly(h, fx.PARAMS)
    ),
    "weather_stats_merged": weather_stats_merged,
    "curves_cumulative_daily": _lineitem(curves.curves_cumulative_daily),
    "monthly_rate": _lineitem(stats.monthly_rate),
    "curve_reliability_monthly": _lineitem(curves.curve_reliability_monthly),
    "stats_monthly_workable_rate_dist": _lineitem(stats.stats_monthly_workable_rate_dist),
    "reliability_targets_monthly": _lineitem(stats.reliability_targets_monthly),
    "pivot_month_x_hour": _lineitem(pivots.pivot_month_x_hour_workable_rate),
    "pivot_month_x_weekday": _lineitem(pivots.pivot_month_x_weekday_workable_rate),
    "pivot_weekday_x_hour": _lineitem(pivots.pivot_weekday_x_hour_workable_rate),
    "pivot_month_x_hour_param_mean": _lineitem(
        lambda h: pivots.pivot_month_x_hour_param_mean_operational(h, fx.PARAMS)
    ),
    "bundle_cubes": bundle_cubes,
    "timestep_hours": _events(streaks.timestep_hours),
    "streaks_nonworkable": _events(_runs(streaks.streaks_nonworkable)),
    "streaks_workable": _events(_runs(streaks.streaks_workable)),
    "streaks_nonworkable_years": _packed(_runs(streaks.streaks_nonworkable)),
    "streaks_summary": _events(_runs(streaks.streaks_summary)),
    "streaks_summary_years": _packed(_runs(streaks.streaks_summary)),
    "streaks_summary_placed": _placed(_runs(streaks.streaks_summary)),
    "weather_stats_placed": _placed(lambda h: weather.weather_stats_monthly(h, fx.PARAMS)),
    "top_blocked_streaks": _events(_runs(streaks.top_blocked_streaks)),
    "monthly_preview": _lineitem(monthly_preview),
    "loss_preview": _lineitem(loss_preview),
    "hourly_preview": hourly_preview,
    "rate_contract_violations": rate_contract_violations,
    "run_meta": meta,
    "bundle_tables": bundle_tables,
    "incremental_pieces": lambda s, d: _refreshed(s, d)[1].withColumnRenamed("_month", "month_number"),
    "incremental_summary": lambda s, d: portable(_refreshed(s, d)[0].tables["summary_monthly"]),
    "incremental_streaks": lambda s, d: portable(_refreshed(s, d)[0].tables["streaks_summary_operational"]),
    "truth_in_years": truth_in_years,
    "scenario_rules": lambda s, d: bysite.scenario_rules(fx.supplier_config(s, d)),
    "threshold_rules": lambda s, d: portable(bysite.threshold_rules(fx.supplier_config(s, d))),
    "window_rules": lambda s, d: bysite.window_rules(fx.supplier_config(s, d)),
    "rule_violations": lambda s, d: bysite.rule_violations(fx.customer_config(s, d)),
    "rare_violations": lambda s, d: bysite.rule_violations(fx.part_config(s, d)).unionByName(
        bysite.window_violations(fx.part_config(s, d))
    ),
    "sites_set_aside": lambda s, d: bysite.sites_set_aside(fx.customers_some_twice(s, d)),
    "usable_sites": lambda s, d: bysite.usable_sites(fx.customers_some_twice(s, d)).select(
        "site_id", "scenario_mode"
    ),
    "hourly_key_violations": lambda s, d: key_violations(fx.damaged_hourly(s, d)),
    "window_violations": lambda s, d: bysite.window_violations(fx.customer_config(s, d)),
    "landed_json_truth": landed_json_truth,
    "landed_json_violations": landed_json_violations,
    "landed_quarantine_rows": _quarantine(0),
    "landed_quarantine_problems": _quarantine(1),
    "top_blocked_streaks_by_site": _packed(_runs(previews.top_blocked_streaks_by_site)),
    "monthly_preview_by_site": _lineitem(lambda h: previews.monthly_preview_by_site(summary.summary_monthly(h))),
    "loss_preview_by_site": _lineitem(lambda h: previews.loss_preview_by_site(loss.loss_by_param_monthly(h))),
}
