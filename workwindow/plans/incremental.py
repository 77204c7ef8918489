"""Report bundles that are kept up to date month by month.

All report tables but the parameter means follow from three additive states of the
hours: count cubes, value counts and operational steps. They are kept below a folder in
pieces, one for each site and UTC month, and a manifest names the folder of every
piece with a hash of the hours and the rules it was made of. A refresh hashes the
hours, classifies only those of pieces whose hash is new, adds their states as a new
folder, and publishes the next manifest; no file that an older one names is touched.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.operators import streaks, weather
from workwindow.operators.classify import classify, classify_packed
from workwindow.operators.counts import count_cubes
from workwindow.plans.bundle import Bundle, hours_in, run_meta, tables_of
from workwindow.rules.runwide import checked_rules
from workwindow.session import at_once, stage

STATES = ("cubes", "values", "steps")
PIECE = ("site_id", "_month")


def _month(time_utc: Column) -> Column:
    return F.year(time_utc) * 12 + F.month(time_utc)


def fingerprints(truth: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """(site_id, _month, n_hours, print): a hash of each piece's hours, in whatever order, and
    of the configuration; combined on the map side."""
    rules = json.dumps(config, sort_keys=True, default=str)
    row = F.xxhash64(F.lit(rules), *sorted(truth.columns)).cast("decimal(38,0)")
    pieces = truth.groupBy("site_id", _month(F.col("time_utc")).alias("_month"))
    return pieces.agg(F.count("*").alias("n_hours"), F.sum(row).cast("string").alias("print"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(site_id, _month, n_hours, print, part) as published last, None before the first run."""
    try:
        current = spark.read.parquet(f"{path.rstrip('/')}/_current").first()
    except AnalysisException:
        return None
    return spark.read.parquet(current.manifest)


def _states(hours: DataFrame, config: Mapping[str, Any], folder: str) -> None:
    """Write the states of ``hours``, which have a ``_month``, side by side."""
    rules = checked_rules(config)
    packed = classify_packed(hours, rules)
    made = {
        "cubes": count_cubes(classify(hours, rules), also=("_month",)),
        "values": weather.value_counts(packed, list(rules.required), also=("_month",)),
        "steps": streaks.operational_steps(packed),
    }
    at_once([functools.partial(df.write.parquet, f"{folder}/{name}") for name, df in made.items()])


def read_states(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The states of all pieces that the manifest names, from whichever folder."""
    root, manifest = path.rstrip("/"), read_manifest(spark, path)
    valid = manifest.select(*PIECE, "part")
    folders = [r.part for r in valid.select("part").distinct().collect()]  # one for each refresh still in use
    found = {}
    for name in STATES:
        parts = [spark.read.parquet(f"{root}/{part}/{name}").withColumn("part", F.lit(part)) for part in folders]
        found[name] = functools.reduce(DataFrame.unionByName, parts).join(valid, [*PIECE, "part"]).drop("part")
    return found


def refresh(truth: DataFrame, config: Mapping[str, Any], path: str, run_id: str = "run") -> Bundle:
    """Bring the states below ``path`` up to ``truth`` and give the bundle of all hours.

    Needs ``site_id``. Pieces without hours now leave the manifest.
    """
    spark, root = truth.sparkSession, path.rstrip("/")
    prints = stage(fingerprints(truth, config), "prints")
    known = read_manifest(spark, path)
    part = f"part-{uuid.uuid4().hex}"
    if known is None:
        kept, changed = None, prints
    else:
        kept = prints.join(known.select(*PIECE, "print", "part"), [*PIECE, "print"])
        changed = prints.join(known.select(*PIECE, "print"), [*PIECE, "print"], "left_anti")
    if not changed.isEmpty():
        hours = truth.withColumn("_month", _month(F.col("time_utc")))
        if known is not None:
            hours = hours.join(changed.select(*PIECE), list(PIECE), "left_semi")
        _states(hours, config, f"{root}/{part}")
    manifest = changed.withColumn("part", F.lit(part))
    manifest = manifest if kept is None else manifest.unionByName(kept)
    folder = f"{root}/manifest-{uuid.uuid4().hex}"
    manifest.write.parquet(folder)
    current = spark.range(1).select(F.lit(folder).alias("manifest"))
    current.coalesce(1).write.mode("overwrite").parquet(f"{root}/_current")

    states = read_states(spark, path)
    cubes = stage(states["cubes"].drop("_month"), "cubes", ("grain",))
    values = stage(states["values"].drop("_month"), "values")
    runs = stage(streaks.runs_of(states["steps"].repartition(*PIECE)), "runs")
    tables = tables_of(cubes, runs, values, list(checked_rules(config).required))
    return Bundle(run_meta(hours_in(cubes), config, run_id), tables)
