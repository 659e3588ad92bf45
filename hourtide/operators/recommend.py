"""Peak hours and best times to travel: one grouped plan for every combination, no loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtide import fixed_values as fv
from hourtide.functions import calendar as cal
from hourtide.functions.lookups import weather_group
from hourtide.functions.text import hour_label, hour_range_label, whole_number
from hourtide.operators.ranks import quantiles

VOLUME = "traffic_volume"
DAY_TYPES = ("weekday", "weekend")


def with_groups(df: DataFrame) -> DataFrame:
    """Add day_type and weather_category."""
    return df.withColumns({"day_type": cal.day_type(F.col("is_weekend")), "weather_category": weather_group(F.col("weather_main"))})


def hourly_stats(df: DataFrame, keys: tuple[str, ...] = ("day_type", "weather_category"), value: str = VOLUME) -> DataFrame:
    """Mean, deviation, quartiles and count per group and hour. The groups are a bounded set: day types
    by weather groups by hours."""
    keys = [*keys, "hour"]
    moments = df.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count")
    )
    parts = quantiles(df, value, {"p25": 0.25, "median": 0.5, "p75": 0.75}, keys)
    return moments.join(parts, keys, "left")


def hourly_means(df: DataFrame, keys: list[str], value: str = VOLUME) -> DataFrame:
    return df.groupBy(*keys, "hour").agg(F.avg(value).alias("mean_volume"))


def pct_below_peak(means: DataFrame, keys: list[str]) -> DataFrame:
    """Add the peak of each group, its hour (the earliest on a tie) and the distance below it in per
    cent. ``means`` has at most 24 rows per group."""
    group = Window.partitionBy(*keys)
    volume = F.col("mean_volume")
    below = F.coalesce((1 - F.try_divide(volume, F.col("peak_volume"))) * 100, F.lit(0.0))
    return (
        means.withColumn("peak_volume", F.max("mean_volume").over(group))
        .withColumn("peak_hour", F.max_by("hour", F.struct(volume, -F.col("hour"))).over(group))
        .withColumn("pct_below_peak", F.when(F.col("peak_volume") > 0, below).otherwise(F.lit(0.0)))
    )


def peak_hours(df: DataFrame, n: int = 5, keys: tuple[str, ...] = ("day_type",), value: str = VOLUME) -> DataFrame:
    """The ``n`` busiest hours per group (ties by hour) with a worded warning."""
    means = hourly_means(df, list(keys), value)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("mean_volume"), "hour"))
    worded = F.format_string(
        fv.PEAK_WARNING_FORMAT, hour_range_label(F.col("hour")), F.col(keys[0]), whole_number(F.col("mean_volume"))
    )
    return means.withColumn("place", place).where(F.col("place") <= n).withColumn("message", worded)


def travel_means(df: DataFrame, keys: list[str], hours: tuple[int, int] = fv.TRAVEL_HOURS, value: str = VOLUME) -> DataFrame:
    """Hourly means within the travel hours; a group with none of those hours keeps all of its hours."""
    means = hourly_means(df, keys, value)
    inside = F.col("hour").between(*hours)
    any_inside = F.max(inside.cast("int")).over(Window.partitionBy(*keys))
    return means.withColumn("any_inside_", any_inside).where(inside | (F.col("any_inside_") == 0)).drop("any_inside_")


def best_hours(df: DataFrame, keys: list[str], n: int = 5, hours: tuple[int, int] = fv.TRAVEL_HOURS, value: str = VOLUME) -> DataFrame:
    """The ``n`` quietest travel hours per group (ties by hour) with the distance below the peak."""
    ranked = pct_below_peak(travel_means(df, keys, hours, value), keys).withColumn(
        "place", F.row_number().over(Window.partitionBy(*keys).orderBy("mean_volume", "hour"))
    )
    return ranked.where(F.col("place") <= n)


def best_hours_exact(df: DataFrame, day_type: str, weather: str, n: int = 5) -> DataFrame:
    """Quietest hours for one day type and one exact weather category, whatever its case. Unknown
    weather gives no row; ``profile.distinct_categories`` lists what is known."""
    _known_day_type(day_type)
    chosen = df.where((F.col("day_type") == day_type) & (F.lower("weather_main") == weather.lower()))
    return best_hours(chosen, ["day_type", "weather_main"], n)


def recommend_travel_time(df: DataFrame, day_type: str, weather: str, n: int = 3) -> DataFrame:
    """Worded advice for one day type and weather group; no data gives no row."""
    _known_day_type(day_type)
    chosen = df.where((F.col("day_type") == day_type) & (F.col("weather_category") == weather))
    return worded_advice(best_hours(chosen, ["day_type", "weather_category"], n))


def worded_advice(best: DataFrame) -> DataFrame:
    text = F.format_string(
        fv.TRAVEL_ADVICE_FORMAT,
        F.col("day_type"),
        F.lower("weather_category"),
        hour_range_label(F.col("hour")),
        whole_number(F.col("mean_volume")),
        whole_number(F.col("pct_below_peak")),
        hour_label(F.col("peak_hour")),
    )
    return best.select("day_type", "weather_category", "place", "hour", F.bround("mean_volume", 1).alias("mean_volume"), text.alias("message"))


def recommendation_report(df: DataFrame, n: int = 3) -> DataFrame:
    """Peak warnings per day type and advice per day type and weather group present, in one table."""
    peaks = peak_hours(df, n).select(
        F.lit("peak").alias("section"),
        "day_type",
        F.lit("all").alias("weather_category"),
        "place",
        "hour",
        F.bround("mean_volume", 1).alias("mean_volume"),
        "message",
    )
    advice = worded_advice(best_hours(df, ["day_type", "weather_category"], n))
    return peaks.unionByName(advice.withColumn("section", F.lit("advice")))


def _known_day_type(day_type: str) -> None:
    if day_type not in DAY_TYPES:
        raise ValueError(f"day_type must be one of {DAY_TYPES}, got {day_type!r}")
