"""Local session for tests and benchmarks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from workwindow.session import SETTINGS


def with_shared_dir(spark: SparkSession) -> SparkSession:
    """Name a folder for intermediate tables where a local session has none."""
    set_already = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not set_already and context._jsc.sc().getCheckpointDir().isEmpty():
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="workwindow-"))
    return spark


def local_session(cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("workwindow-local")
    local = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        # Test tables are small; keep their shuffles spread over the local cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in local.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return with_shared_dir(spark)
