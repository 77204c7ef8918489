"""Session settings and shared staging storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")
JOBS_AT_ONCE = 8

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot never compiles longer methods; above this, plain operators are faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A report run has a few hundred generated classes; the default keeps a hundred.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Stack traces per Column call cost more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "workwindow", **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` wins over them.

    Shuffle width is left to the cluster (``spark.sql.shuffle.partitions`` plus
    adaptive coalescing); nothing here fixes it to a small number.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or the context's own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        configured = found.get() if found.isDefined() else None
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return configured.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage: readers of the result never repeat the scan behind it, and
    a lost executor costs at most a re-read.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/workwindow/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(jobs: Sequence[Callable[[], Result]]) -> list[Result]:
    """Submit independent Spark jobs side by side, so small ones fill idle executors."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(in_session(job)) for job in jobs]]
