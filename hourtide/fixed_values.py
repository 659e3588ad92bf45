"""Values that results depend on, stated plainly in one place.

Everything here is a fixed value of the data model (category lists, thresholds, labels, message
formats). Operators take them as default arguments, so another table can bring its own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The nine raw columns and their types. ``seq`` (the file order) is added by the readers.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("holiday", T.StringType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("rain_1h", T.DoubleType()),
        T.StructField("snow_1h", T.DoubleType()),
        T.StructField("clouds_all", T.IntegerType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("weather_description", T.StringType()),
        T.StructField("date_time", T.StringType()),
        T.StructField("traffic_volume", T.IntegerType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Columns with imputable nulls, and the label for hours without a holiday.
NUMERIC_COLUMNS = ["temp", "rain_1h", "snow_1h", "clouds_all", "traffic_volume"]
NO_HOLIDAY = "No Holiday"

# Weather category -> severity rank; an unknown category ranks 2.
WEATHER_SEVERITY = {
    "Clear": 0,
    "Clouds": 1,
    "Mist": 2,
    "Haze": 2,
    "Drizzle": 2,
    "Rain": 3,
    "Fog": 3,
    "Snow": 4,
    "Thunderstorm": 4,
    "Squall": 4,
    "Smoke": 4,
}
DEFAULT_SEVERITY = 2
WEATHER_CATEGORIES = sorted(WEATHER_SEVERITY)

# Weather category -> travel-advice group; an unknown category is "Other".
WEATHER_GROUPS = {
    "Clear": "Clear",
    "Clouds": "Cloudy",
    "Rain": "Rain",
    "Drizzle": "Rain",
    "Snow": "Snow",
    "Mist": "Fog",
    "Haze": "Fog",
    "Fog": "Fog",
    "Smoke": "Fog",
    "Thunderstorm": "Storm",
    "Squall": "Storm",
}
DEFAULT_WEATHER_GROUP = "Other"

# Lower-case weather category -> basket bucket for the association rules.
WEATHER_BUCKETS = {
    "clear": ["clear"],
    "cloudy": ["clouds", "mist", "haze", "fog", "smoke"],
    "rain": ["rain", "drizzle", "thunderstorm"],
    "snow": ["snow"],
}
DEFAULT_WEATHER_BUCKET = "other"

# Category sets behind the indicator columns and the risk label.
RAINY_WEATHER = ["Rain", "Drizzle", "Thunderstorm"]
SNOWY_WEATHER = ["Snow"]
LOW_VISIBILITY_WEATHER = ["Fog", "Mist", "Haze", "Smoke"]
LOW_VISIBILITY_CLOUDS = 80
RISKY_WEATHER = ["Thunderstorm", "Squall", "Fog", "Smoke", "Haze", "Mist", "Snow", "Rain"]
RISKY_CONGESTION = ["High", "Severe"]

# Impossible readings (column, comparison, bound).
OUTLIER_RULES = [("temp", "=", 0.0), ("rain_1h", ">", 9000.0)]

# Labels of the volume bands, quartile categories and serving levels.
VOLUME_BAND_EDGES = [4500, 5500]
VOLUME_BAND_LABELS = ["Low", "Medium", "High"]
QUARTILE_LABELS = ["Low", "Medium", "High", "Severe"]
SERVING_LEVELS = ["low", "moderate", "high", "very_high"]

# Statistics thresholds.
KELVIN_OFFSET = 273.15
CONGESTED_ABOVE = 5500
WARM_ABOVE_KELVIN = 292.0
INDEPENDENCE_TOLERANCE = 0.005
CORRELATION_STRENGTHS = [(0.1, "negligible"), (0.3, "weak"), (0.5, "moderate"), (0.7, "strong")]
STRONGEST_CORRELATION = "very strong"

# Day parts (first hour inclusive, last hour exclusive), anything else is night.
DAY_PARTS = [("morning", 6, 12), ("afternoon", 12, 17), ("evening", 17, 21)]
DEFAULT_DAY_PART = "night"
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTH_NAMES = (
    "January February March April May June July August September October November December".split()
)
TRAVEL_HOURS = (6, 22)

# Base model inputs in order; the one-hot weather columns follow.
BASE_FEATURES = [
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "is_weekend",
    "is_holiday",
    "is_low_visibility",
    "weather_severity",
    "temp",
    "rain_1h",
    "snow_1h",
    "clouds_all",
]
SCALED_COLUMNS = ["temp", "clouds_all", "rain_1h"]
DRIFT_FEATURES = ["temp", "clouds_all", "rain_1h", "hour"]
CLUSTER_FEATURES = ["hour_sin", "hour_cos", "weather_severity", "traffic_volume"]

# Limits of the cluster names, on mean volume and mean hour.
LULL_BELOW, SHOULDER_BELOW, PEAK_FROM = 1500, 3000, 4500
SHOULDER_HOURS = (8, 18)

# Centres in the scaled space of the cluster features, for assignment without training.
REFERENCE_CENTRES = [(0.5, 1.0, 0.2, 0.1), (1.0, 0.5, 0.3, 0.6), (0.5, 0.0, 0.3, 0.45), (0.0, 0.5, 0.3, 0.8)]

# Cluster names with their advice.
CLUSTER_ACTIONS = {
    "Night lull": "Low-demand window suitable for roadwork and lane closures",
    "Shoulder hours": "Transitional period; ramp metering can smooth flow",
    "Peak commute": "Signal priority and congestion pricing most effective here",
    "Midday moderate": "Stable flow; standard signal timing sufficient",
}

# Drift thresholds and status texts.
DRIFT_ALPHA = 0.05
ERROR_INCREASE_LIMIT = 0.20
STATUS_MESSAGES = {"ALERT": "ALERT / Requires investigation", "PASS": "PASS / Normal"}

# Sentence formats of the travel advice.
TRAVEL_ADVICE_FORMAT = (
    "For a %s journey in %s weather, consider travelling between %s, "
    "when traffic is typically ~%s vehicles/hour (%s%% below the %s peak)."
)
PEAK_WARNING_FORMAT = (
    "Avoid travelling between %s on %ss — average volume reaches %s vehicles/hour."
)
HOUR_RANGE_SEPARATOR = " – "

# Scoring request columns with their types and accepted ranges (None = open).
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("rain_1h", T.DoubleType()),
        T.StructField("snow_1h", T.DoubleType()),
        T.StructField("clouds_all", T.IntegerType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("is_holiday", T.IntegerType()),
    ]
)
REQUEST_RANGES = {
    "hour": (0, 23),
    "day_of_week": (0, 6),
    "is_weekend": (0, 1),
    "temp": (None, None),
    "rain_1h": (0.0, None),
    "snow_1h": (0.0, None),
    "clouds_all": (0, 100),
    "is_holiday": (0, 1),
}
