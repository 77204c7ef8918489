"""Classified hours laid out for the plans that read them.

The table is bucketed by site and UTC month and sorted by time. Runs and value counts
group by both, so they are made where the hours lie: the hours themselves never cross
the network again. A site of any size is spread over its months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_placed(hourly: DataFrame, table: str, buckets: int) -> DataFrame:
    """Write packed or unpacked classified hours with a site as the catalog table ``table``.

    ``buckets`` bounds how many tasks read it: eight or so for each GB of hours. Hours
    without site or time fail the run.
    """
    t = F.col("time_utc")
    named = lambda c: F.coalesce(c, F.raise_error(F.lit(f"{c} must not be null")))
    rows = hourly.withColumns({c: named(c) for c in ("site_id", "time_utc")})
    rows = rows.withColumn("_month", F.year(t) * 12 + F.month(t))
    # dealt as the buckets are, so that each is one file
    dealt = rows.repartition(buckets, "site_id", "_month")
    writer = dealt.write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, "site_id", "_month").sortBy("site_id", "_month", "time_utc").saveAsTable(table)
    return hourly.sparkSession.table(table)
