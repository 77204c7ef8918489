"""Time the headline operators: one JSON line on standard output.

The hourly truth table is derived from the driver's lineitem table once, written
as Parquet and not timed, as a run would find it; every query starts from that
scan. Each figure is the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from checks import fixtures as fx
from checks.local import local_session
from workwindow.operators import curves, loss, pivots, stats, streaks, summary, weather
from workwindow.operators.classify import classify, classify_by_site_rules, classify_packed, evaluation_summary
from workwindow.plans.bundle import build_bundle
from workwindow.plans.placed import write_placed
from workwindow.rules import bysite
from workwindow.session import stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None]) -> float:
    samples = []
    for run in range(RUNS + 1):
        start = time.perf_counter()
        action()
        if run:
            samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


def main() -> None:
    spark = local_session()
    truth = stage(fx.truth_lineitem(spark, SF_DIR), "bench-truth")
    rules, params = fx.LINEITEM_RULES, fx.PARAMS
    hourly = classify(truth, rules)
    packed = classify_packed(truth, rules)
    placed = write_placed(packed, "bench_hours", int(os.environ.get("BENCH_CPUS", "8")))
    many = stage(fx.truth_suppliers(spark, SF_DIR), "bench-suppliers")
    site_rules = stage(bysite.packed_rules(fx.sound_supplier_config(spark, SF_DIR)), "bench-rules")
    by_site = classify_by_site_rules(many, site_rules)

    def write_bundle() -> None:
        bundle = build_bundle(
            hourly,
            fx.LINEITEM_CONFIG,
            packed=packed,
            include_weather_stats=True,
            visual_params_for_mean=params,
        )
        bundle.write(tempfile.mkdtemp(prefix="bench-bundle-"))

    plans = {
        "classify": lambda: hourly,
        "classify_site_rules": lambda: by_site,
        "summary_site_rules": lambda: summary.summary_run(by_site),
        "evaluation_summary": lambda: evaluation_summary(hourly),
        "summary_run": lambda: summary.summary_run(hourly),
        "summary_monthly": lambda: summary.summary_monthly(hourly),
        "summary_yearly": lambda: summary.summary_yearly(hourly),
        "loss_by_param_monthly": lambda: loss.loss_by_param_monthly(hourly),
        "curves_cumulative_daily": lambda: curves.curves_cumulative_daily(hourly),
        "curve_reliability_monthly": lambda: curves.curve_reliability_monthly(hourly),
        "reliability_targets_monthly": lambda: stats.reliability_targets_monthly(hourly),
        "pivot_month_x_hour": lambda: pivots.pivot_month_x_hour_workable_rate(hourly),
        "pivot_month_x_hour_param_mean": (
            lambda: pivots.pivot_month_x_hour_param_mean_operational(hourly, params)
        ),
        "weather_stats_monthly": lambda: weather.weather_stats_monthly(packed, params),
        "streaks_summary_placed": lambda: streaks.streaks_summary(streaks.operational_runs(placed)),
        "streaks_summary": lambda: streaks.streaks_summary(streaks.operational_runs(packed)),
    }
    queries = {name: timed(lambda plan=plan: consume(plan())) for name, plan in plans.items()}
    queries["bundle_write"] = timed(write_bundle)
    print(
        json.dumps(
            {
                "metric": "median warm seconds, sum over headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "truth_rows": truth.count(),
                "cpus": os.environ.get("BENCH_CPUS", "8"),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
