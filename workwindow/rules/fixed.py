"""Parameter names, source field names, scenario and window vocabularies."""

# Canonical parameter -> hourly field name in a landed response.
SOURCE_FIELD = {
    "temperature": "temperature_2m",
    "apparent_temperature": "apparent_temperature",
    "wind_speed": "wind_speed_10m",
    "wind_gusts": "wind_gusts_10m",
    "wind_direction": "wind_direction_10m",
    "precipitation": "precipitation",
    "rain": "rain",
    "snowfall": "snowfall",
    "snow_depth": "snow_depth",
    "cloud_cover": "cloud_cover",
    "shortwave_radiation": "shortwave_radiation",
    "direct_radiation": "direct_radiation",
    "relative_humidity": "relative_humidity_2m",
    "dew_point": "dew_point_2m",
    "surface_pressure": "surface_pressure",
    "visibility": "visibility",
    "weather_code": "weather_code",
}

# Scenario vocabulary.
BASE_ONLY = ("base",)
STANDARD_3 = ("base", "conservative", "optimistic")
SCENARIO_MODES = ("base_only", "standard_3", "standard_3_plus")
MAX_SCENARIOS = 10
SCENARIO_ID_PATTERN = "^[A-Za-z0-9_-]+$"

# Operational window vocabulary.
CALENDAR_MODELS = ("all_days", "mon_fri", "custom")
TIME_REFERENCES = ("fixed_time", "sunrise", "sunset")
HHMM_PATTERN = r"^\d{2}:\d{2}$"
