"""Hourly truth from landed weather responses: JSON documents of parallel arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.functions.expr import known
from workwindow.operators.classify import with_local_clock
from workwindow.rules.fixed import SOURCE_FIELD
from workwindow.session import stage


def source_fields(params: Sequence[str]) -> dict[str, str]:
    """Canonical parameter -> field name in the response; unknown names are an error."""
    unknown = [p for p in params if p not in SOURCE_FIELD]
    if unknown:
        raise ValueError(f"unsupported parameters: {unknown}")
    return {p: SOURCE_FIELD[p] for p in params}


def response_schema(params: Sequence[str]) -> str:
    fields = ", ".join(f"{f}: ARRAY<DOUBLE>" for f in source_fields(params).values())
    return f"hourly STRUCT<time: ARRAY<STRING>{', ' + fields if fields else ''}>"


def read_landed(spark: SparkSession, path: str, params: Sequence[str]) -> DataFrame:
    """Responses below ``path``, one document per file.

    Folders named ``site_id=...`` give the site. The schema is fixed, so nothing
    is read to infer it.
    """
    schema = f"{response_schema(params)}, site_id STRING"
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_landed(documents: DataFrame, column: str, params: Sequence[str]) -> DataFrame:
    """Responses held as JSON text in a column."""
    parsed = F.from_json(F.col(column), response_schema(params)).alias("_response")
    others = [c for c in documents.columns if c != column]
    return documents.select(*others, parsed).select(*others, "_response.hourly")


def _problems(params: Sequence[str]) -> Column:
    """What is wrong with a response; empty when it is complete."""
    time = F.col("hourly.time")
    no_time = F.coalesce(F.size(time), F.lit(0)) < 1

    def problem(kind: str, field: str, detail: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("problem"), F.lit(field).alias("field"), detail.alias("detail")
        )

    blank = F.lit("")
    cases = F.when(F.col("hourly").isNull(), F.array(problem("missing_block", "hourly", blank)))
    cases = cases.when(no_time, F.array(problem("missing_time", "time", blank)))
    fields = []
    for name in source_fields(params).values():
        values = F.col(f"hourly.{name}")
        lengths = F.concat_ws(" vs ", F.size(values).cast("string"), F.size(time).cast("string"))
        fields.append(
            F.when(values.isNull(), problem("missing_field", name, blank)).when(
                F.size(values) != F.size(time), problem("length_mismatch", name, lengths)
            )
        )
    return cases.otherwise(F.array_compact(F.array(*fields)))


def landed_violations(responses: DataFrame, params: Sequence[str]) -> DataFrame:
    """Every problem of every response; the other columns identify the document."""
    keys = [c for c in responses.columns if c != "hourly"]
    return responses.select(*keys, F.inline(_problems(params)))


def _hours(params: Sequence[str]) -> Column:
    """The hours of a response that has passed the checks, as an array."""
    return F.arrays_zip(
        F.col("hourly.time").alias("time"),
        *(F.col(f"hourly.{f}").alias(p) for p, f in source_fields(params).items()),
    )


def _truth(rows: DataFrame, keys: Sequence[str], params: Sequence[str], timezone: Column | str) -> DataFrame:
    truth = rows.select(
        *keys,
        F.to_timestamp_ntz(F.col("time")).alias("time_utc"),
        *(known(F.col(p)).alias(p) for p in params),
    )
    return with_local_clock(truth, timezone)


def split_landed(
    responses: DataFrame, params: Sequence[str], timezone: Column | str
) -> tuple[DataFrame, DataFrame]:
    """Hourly rows of the sound responses, and every problem of the others.

    The responses are read once: a written table holds the hours or the problems of each,
    and both results read that.
    """
    keys = [c for c in responses.columns if c != "hourly"]
    judged = responses.select(*keys, "hourly", _problems(params).alias("problems"))
    hours = F.when(F.size("problems") == 0, _hours(params)).alias("hours")
    split = stage(judged.select(*keys, hours, "problems"), "landed")
    rows = split.filter("hours IS NOT NULL").select(*keys, F.inline("hours"))
    return _truth(rows, keys, params, timezone), split.select(*keys, F.inline("problems"))


def truth_from_landed(
    responses: DataFrame, params: Sequence[str], timezone: Column | str, strict: bool = True
) -> DataFrame:
    """Hourly rows of the responses.

    A faulty response fails the job when ``strict``; otherwise it gives no rows
    and shows up in :func:`landed_violations`. The lengths are compared before
    zipping, which would pad short arrays in silence.
    """
    problems = _problems(params)
    hours = _hours(params)
    if strict:
        message = F.concat(F.lit("faulty weather response: "), F.to_json(problems))
        checked = F.when(F.size(problems) > 0, F.raise_error(message)).otherwise(hours)
    else:
        checked = F.when(F.size(problems) == 0, hours)
    keys = [c for c in responses.columns if c != "hourly"]
    return _truth(responses.select(*keys, F.inline(checked)), keys, params, timezone)
