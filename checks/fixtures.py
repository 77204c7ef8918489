"""Hourly truth, site configurations and landed documents derived from the given tables.

Each fixture is defined twice with one meaning: as a Spark plan and as the SQL
the oracle runs. Only ``min`` and ``min_by`` are used, so nothing depends on the
order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workwindow.operators.classify import classify, classify_packed, with_local_clock
from workwindow.rules.bysite import CONFIG_SCHEMA
from workwindow.rules.runwide import RuleSet

ZONE = "America/Denver"
PARAMS = ["temperature", "wind_speed", "precipitation"]


def _config(thresholds: dict, **window) -> dict:
    return {
        "project": {"location": {"timezone": ZONE, "name": "fixture"}},
        "required_parameters": PARAMS,
        "scenario_mode": "standard_3",
        "weather_thresholds": thresholds,
        "operational_window": {
            "calendar_model": "all_days",
            "time_bounds": {"start_time": "09:00", "end_time": "17:00"},
            **window,
        },
    }


def _maxima(temperature: float, wind: float, rain: float) -> dict:
    return {
        "temperature": {"max": temperature},
        "wind_speed": {"max": wind},
        "precipitation": {"max": rain},
    }


def _cold_limits(temperature: float, wind: float, rain: float) -> dict:
    return {**_maxima(0, wind, rain), "temperature": {"min": temperature}}


EVENTS_CONFIG = _config(
    {
        "base": _maxima(100, 90, 7),
        "conservative": _maxima(60, 70, 5),
        "optimistic": _maxima(200, 98, 9),
    }
)
LINEITEM_CONFIG = _config(
    {
        "base": _cold_limits(0.01, 45, 0.09),
        "conservative": _cold_limits(0.02, 35, 0.07),
        "optimistic": _cold_limits(0.01, 49, 0.10),
    }
)
OVERRIDE_CONFIG = _config(
    EVENTS_CONFIG["weather_thresholds"],
    weekly_overrides={
        "4": {"start_time": "09:00", "end_time": "12:00"},
        "6": {"start_time": "06:30", "end_time": "20:15"},
    },
)
WEEKDAYS_CONFIG = _config(
    EVENTS_CONFIG["weather_thresholds"], calendar_model="custom", weekdays=[0, 2, 4, 5]
)
EVENTS_RULES = RuleSet.from_config(EVENTS_CONFIG)
LINEITEM_RULES = RuleSet.from_config(LINEITEM_CONFIG)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("site_id"), F.date_trunc("hour", "ts").alias("hour"))
        .agg(
            F.min_by("value", "event_id").alias("temperature"),
            F.min_by(k.cast("double"), "event_id").alias("wind_speed"),
            F.min_by((k % 10).cast("double"), "event_id").alias("precipitation"),
        )
        .withColumn("hour", F.col("hour").cast("timestamp_ntz"))
        .withColumnRenamed("hour", "time_utc")
    )


def truth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_local_clock(events_hourly(spark, sf_dir), ZONE)


def _lineitem_hourly(spark: SparkSession, sf_dir: str, site) -> DataFrame:
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(site.cast("string").alias("site_id"), (F.col("l_shipdate") + hours).alias("t"))
        .agg(
            F.nullif(F.min("l_tax"), F.lit(0.0)).alias("temperature"),
            F.min("l_quantity").alias("wind_speed"),
            F.min("l_discount").alias("precipitation"),
        )
        .withColumnRenamed("t", "time_utc")
    )


def truth_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_local_clock(_lineitem_hourly(spark, sf_dir, F.col("l_suppkey") % 4), ZONE)


def truth_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_hourly(spark, sf_dir, F.col("l_suppkey"))


def classified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(truth_events(spark, sf_dir), EVENTS_RULES)


def packed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_packed(truth_lineitem(spark, sf_dir), LINEITEM_RULES)


def classified_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(truth_lineitem(spark, sf_dir), LINEITEM_RULES)


def supplier_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per supplier, with blocks and names that some modes do not use."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    zone = (
        F.when(nation % 4 == 0, "UTC")
        .when(nation % 4 == 1, "America/Denver")
        .when(nation % 4 == 2, "Europe/Berlin")
        .otherwise("Asia/Kolkata")
    )
    mode = (
        F.when(key % 3 == 0, "base_only").when(key % 3 == 1, "standard_3").otherwise("standard_3_plus")
    )
    calendar = F.when(key % 4 == 0, "custom").when(key % 4 == 1, "mon_fri").otherwise("all_days")
    base = table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("site_id"),
        zone.alias("timezone"),
        mode.alias("scenario_mode"),
        calendar.alias("calendar_model"),
        (key % 2).alias("odd"),
        nation.alias("nation"),
    )
    doc = F.format_string(
        """{"custom_scenarios": ["night", " base", "", "c%d"],
            "required_parameters": [%s"wind_speed", "precipitation"],
            "weather_thresholds": {
              "base": {"temperature": {"min": 0.01}, "wind_speed": {"max": %d},
                       "precipitation": {"max": 0.09}},
              "conservative": {"wind_speed": {"min": 2, "max": 30}},
              "night": {"precipitation": {"max": 0.05}, "temperature": {}}},
            "weekdays": [0, 1, 2, 3, 5],
            "time_bounds": {"start": "fixed_time", "end": "fixed_time",
                            "start_time": "0%d:30", "end_time": "17:00"},
            "weekly_overrides": {"4": {"start_time": "08:00", "end_time": "12:00"}}}""",
        F.col("nation").cast("int"),
        F.when(F.col("odd") == 0, '"temperature", ').otherwise(""),
        (40 + F.col("nation") % 10).cast("int"),
        (6 + F.col("nation") % 3).cast("int"),
    )
    return _from_documents(base, doc)


def sound_supplier_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without what a mode does not use: nothing is left to refuse."""
    mode, plus = F.col("scenario_mode"), F.col("scenario_mode") == "standard_3_plus"
    used = lambda k, _: (k == "base") | ((k == "night") & plus) | ((k == "conservative") & (mode != "base_only"))
    named = F.filter("custom_scenarios", lambda s: F.trim(s) != "")
    return supplier_config(spark, sf_dir).withColumns(
        {
            "custom_scenarios": F.when(plus, named).otherwise(F.array().cast("array<string>")),
            "weather_thresholds": F.map_filter("weather_thresholds", used),
        }
    )


def mixed_supplier_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of seven suppliers one has a broken calendar, one is listed twice, one is missing, one
    asks for a parameter that is not measured."""
    sound = sound_supplier_config(spark, sf_dir)
    kind = F.col("site_id").cast("long") % 7
    asked = F.when(kind == 3, F.array_append("required_parameters", F.lit("rain")))
    mixed = sound.filter(kind != 2).withColumns(
        {
            "calendar_model": F.when(kind == 0, "weekends").otherwise(F.col("calendar_model")),
            "required_parameters": F.coalesce(asked, "required_parameters"),
        }
    )
    return mixed.unionByName(mixed.filter(kind == 1))


def customer_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per customer, most of them broken in some way."""
    key = F.col("c_custkey")
    mode = (
        F.when(key % 5 == 0, "standard_3_plus").when(key % 5 == 1, "standard_9").otherwise("base_only")
    )
    base = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("site_id"),
        F.lit("UTC").alias("timezone"),
        mode.alias("scenario_mode"),
        F.when(key % 7 == 0, "weekends").when(key % 7 == 1, "custom").otherwise("all_days").alias(
            "calendar_model"
        ),
        key,
        F.col("c_nationkey").cast("int").alias("nation"),
    )
    doc = F.format_string(
        """{"custom_scenarios": [%s],
            "required_parameters": [%s],
            "weather_thresholds": {
              "base": {"wind_speed": {"min": %d, "max": 12}},
              "%s": {"%s": {"max": "%s"}}},
            "weekdays": [%s],
            "time_bounds": {"start": "%s", "end": "%s", "start_time": "%s", "end_time": "%s"},
            "weekly_overrides": {"%d": {"start_time": "08:00", "end_time": "0%d:00"}}}""",
        F.when(key % 5 == 0, '"extra one", "x%s"').otherwise("").alias("c"),
        F.when(key % 4 == 0, "").when(key % 4 == 1, '"wind_speed", "humidity"').otherwise(
            '"wind_speed"'
        ),
        F.col("nation"),
        F.when(key % 3 == 0, "storm").otherwise("conservative"),
        F.when(key % 6 == 0, "pollen").otherwise("rain"),
        F.when(key % 8 == 0, "high").otherwise("1.5"),
        F.when(key % 9 == 0, "").when(key % 9 == 1, "0, 7, -1").otherwise("0, 1"),
        F.when(key % 10 == 0, "sunset").when(key % 10 == 1, "noon").otherwise("fixed_time"),
        F.when(key % 11 == 0, "sunrise").when(key % 11 == 1, "sunset").otherwise("fixed_time"),
        F.when(key % 12 == 0, "9:00").when(key % 12 == 1, "24:00").otherwise("09:00"),
        F.when(key % 13 == 0, "17:60").when(key % 13 == 1, "08:59").otherwise("17:00"),
        (key % 9).cast("int"),
        (F.col("nation") % 10).cast("int"),
    )
    return _from_documents(base, doc)


def part_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per part, each with one of the faults that customers never have."""
    key = F.col("p_partkey")
    kind = key % 9
    plus = kind.isin(0, 2, 4)
    many = ", ".join(f'"extra{i}"' for i in range(8))
    base = table(spark, sf_dir, "part").select(
        key.cast("string").alias("site_id"),
        F.lit("UTC").alias("timezone"),
        F.when(plus, "standard_3_plus").otherwise("base_only").alias("scenario_mode"),
        F.lit("all_days").alias("calendar_model"),
        key,
        kind.alias("kind"),
    )
    kind = F.col("kind")
    doc = F.format_string(
        """{"custom_scenarios": [%s],
            "required_parameters": ["wind_speed"],
            "weather_thresholds": {"base": {"wind_speed": {"min": "%s"}}%s},
            "time_bounds": {"start": "fixed_time", "end": "%s", "start_time": "08:00", "end_time": "17:00"},
            "weekly_overrides": {"3": {%s"start_time": "%s", "end_time": "%s"}}}""",
        F.when(kind == 0, '"", "fine"').when(kind == 1, '"one"').when(kind == 2, '"bad id"').when(kind == 4, many).otherwise(""),
        F.when(kind == 3, F.concat(F.lit("low"), key.cast("string"))).otherwise("1"),
        F.when(kind == 2, ', "bad id": {}').otherwise(""),
        F.when(kind == 5, "dusk").otherwise("fixed_time"),
        F.when(kind == 6, '"start": "dawn", ').otherwise(""),
        F.when(kind == 7, "7:00").otherwise("08:00"),
        F.when(kind == 8, "25:00").otherwise("12:00"),
    )
    return _from_documents(base, doc)


def customers_some_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations of which every eighth site is listed twice; every fourth of the sound
    suppliers' sites is among them, under the name ``s<key>``."""
    customers = customer_config(spark, sf_dir)
    sound = sound_supplier_config(spark, sf_dir).withColumn("site_id", F.concat(F.lit("s"), "site_id"))
    key = F.regexp_extract("site_id", r"\d+", 0).cast("long")
    both = customers.unionByName(sound.filter(key % 4 == 0))
    return both.unionByName(both.filter(key % 8 == 0))


def damaged_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the hour, with keys and times missing at some hours."""
    hour = F.hour("time_utc")
    return truth_events(spark, sf_dir).withColumns(
        {
            "site_id": F.when(hour % 5 != 0, F.col("site_id")),
            "time_local": F.when(hour % 7 != 0, F.col("time_local")),
        }
    )


def _from_documents(rows: DataFrame, doc: Column) -> DataFrame:
    own = ("site_id", "timezone", "scenario_mode", "calendar_model")
    # a small file is read by one task; the documents are made and parsed by all
    return rows.repartition("site_id").select(
        *(c for c in own), F.from_json(doc, CONFIG_SCHEMA).alias("config")
    ).select(
        "site_id",
        "timezone",
        "scenario_mode",
        "config.custom_scenarios",
        "config.required_parameters",
        "config.weather_thresholds",
        "calendar_model",
        "config.weekdays",
        "config.custom_weekdays",
        "config.time_bounds",
        "config.weekly_overrides",
    )


def landed_documents(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """One JSON response per site and day, at most 24 hours each.

    With ``faulty``, documents of every third day of the month lose an element of
    one array, and those of every fifth day lose a field. On the 7th they have no block,
    on the 11th no time, on the 13th they are none.
    """
    hourly = events_hourly(spark, sf_dir).withColumn("day", F.to_date("time_utc"))
    hour = F.struct(
        F.date_format("time_utc", "yyyy-MM-dd'T'HH:mm").alias("time"), *PARAMS
    )
    days = hourly.groupBy("site_id", "day").agg(F.sort_array(F.collect_list(hour)).alias("h"))
    n, d = F.size("h"), F.dayofmonth("day")
    wind = F.col("h.wind_speed")
    rain = F.col("h.precipitation")
    if faulty:
        wind = F.when(d % 3 == 0, F.slice(wind, F.lit(1), n - 1)).otherwise(wind)
        rain = F.when(d % 5 != 0, rain)
    response = F.struct(
        F.struct(
            F.col("h.time").alias("time"),
            F.col("h.temperature").alias("temperature_2m"),
            wind.alias("wind_speed_10m"),
            rain.alias("precipitation"),
        ).alias("hourly")
    )
    document = F.to_json(response)
    if faulty:
        document = (
            F.when(d == 7, "{}").when(d == 11, '{"hourly": {"time": []}}').when(d == 13, "no document").otherwise(document)
        )
    return days.select("site_id", "day", document.alias("document"))
