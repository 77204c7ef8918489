"""The whole run: truth, classification, report tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.functions.expr import present
from workwindow.operators.classify import (
    classify,
    classify_by_site_rules,
    classify_packed,
    classify_packed_by_site_rules,
)
from workwindow.plans.bundle import Bundle, build_bundle
from workwindow.rules import bysite
from workwindow.rules.fixed import SOURCE_FIELD
from workwindow.rules.runwide import checked_rules
from workwindow.session import stage
from workwindow.sources.landed import read_landed, truth_from_landed
from workwindow.sources.truth import analysis_years, in_years, read_truth


def run(truth: DataFrame, config: Mapping[str, Any], **options: Any) -> Bundle:
    """Report bundle of an hourly truth table under run-wide rules."""
    rules = checked_rules(config)
    packed = classify_packed(truth, rules)
    return build_bundle(classify(truth, rules), config, packed=packed, **options)


def run_by_site(
    truth: DataFrame, configs: DataFrame, project: Mapping[str, Any] | None = None, **options: Any
) -> Bundle:
    """Report bundle of many sites, each under its own row of ``configs`` (``bysite.CONFIG_SCHEMA``).

    Sites that cannot be judged are left out of the reports and listed, with every finding
    and their number of hours, in the table ``sites_set_aside``: broken rules, a site
    listed twice, a required parameter without measurements, or hours without rules.
    """
    # hours are often grouped out of something larger: once, not for each of their readers
    truth = stage(truth, "truth")
    measured = present(truth, SOURCE_FIELD)
    split = stage(bysite.split_sites(configs, measured), "sites")
    rules = stage(bysite.packed_rules(split.filter("copies = 1 AND size(findings) = 0")), "site-rules")
    packed = classify_packed_by_site_rules(truth, rules, only_ruled=True)
    hourly = classify_by_site_rules(truth, rules, only_ruled=True)
    described = _described(rules, project)
    bundle = build_bundle(hourly, described, packed=packed, **options)
    aside = sites_set_aside(truth, split)
    return replace(bundle, tables={**bundle.tables, "sites_set_aside": aside})


def sites_set_aside(truth: DataFrame, split: DataFrame) -> DataFrame:
    """(site_id, rule, key, detail, n_hours) of all sites that ``split_sites`` speaks against
    and of those with hours but without a configuration."""
    hours = truth.groupBy("site_id").agg(F.count("*").alias("n_hours"))
    hours = hours.select(F.col("site_id").alias("id"), "n_hours")
    same = F.col("site_id").eqNullSafe(F.col("id"))
    found = split.select("site_id", F.inline("findings")).distinct()
    found = found.join(hours, same, "left").select(*found.columns, F.coalesce("n_hours", F.lit(0)).alias("n_hours"))
    unruled = hours.join(split.select("site_id"), same, "left_anti").select(
        F.col("id").alias("site_id"),
        F.lit("site_without_rules").alias("rule"),
        F.lit("").alias("key"),
        F.lit("").alias("detail"),
        "n_hours",
    )
    return found.unionByName(unruled)


def _described(rules: DataFrame, project: Mapping[str, Any] | None) -> dict[str, Any]:
    """What run metadata tell of rules by site: all required parameters and a hash of all rules."""
    limits = F.col("scenarios")[0].limits
    params = rules.select(F.explode(F.transform(limits, lambda x: x.param)).alias("param")).distinct()
    site = F.xxhash64("site_id", "timezone", bysite.rule_id())
    facts = rules.agg(F.count("*").alias("sites"), F.count_distinct(bysite.rule_id()).alias("sets"), F.bit_xor(site).alias("hash"))
    named = {r.param for r in params.collect()}  # of a closed set
    row = facts.first()
    return {
        "project": dict(project or {}),
        "required_parameters": [p for p in SOURCE_FIELD if p in named],
        "rules_by_site": {"sites": row.sites, "rule_sets": row.sets, "hash": row.hash},
    }


def _years(config: Mapping[str, Any]) -> tuple[int, int] | None:
    period = (config.get("project") or {}).get("analysis_period") or {}
    return analysis_years(period) if "analysis_end_year" in period else None


def run_parquet(
    spark: SparkSession, path: str, config: Mapping[str, Any], **options: Any
) -> Bundle:
    """The same from hourly Parquet, limited to the configured years."""
    rules = checked_rules(config)
    truth = read_truth(spark, path, list(rules.required), rules.timezone, _years(config))
    return run(truth, config, **options)


def run_landed(
    spark: SparkSession, path: str, config: Mapping[str, Any], **options: Any
) -> Bundle:
    """The same from landed JSON responses."""
    rules = checked_rules(config)
    responses = read_landed(spark, path, rules.required)
    truth = truth_from_landed(responses, rules.required, rules.timezone)
    years = _years(config)
    return run(truth if years is None else in_years(truth, *years), config, **options)
