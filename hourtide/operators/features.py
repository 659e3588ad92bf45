"""Feature columns of the cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions import calendar as cal
from hourtide.functions.lookups import low_visibility, member_flag, quartile_category, sql_literal, weather_severity
from hourtide.operators.ranks import quantiles


def time_features(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """hour, day_of_week (Monday 0), is_weekend and the cyclic encodings."""
    stamped = df.withColumns({"hour": F.hour(ts), "day_of_week": cal.day_of_week(F.col(ts))})
    return cyclic_features(stamped.withColumn("is_weekend", cal.is_weekend(F.col("day_of_week"))))


def cyclic_features(df: DataFrame) -> DataFrame:
    """Sine and cosine of hour and day of week; training and serving share this."""
    hour_sin, hour_cos = cal.cyclic(F.col("hour"), 24)
    dow_sin, dow_cos = cal.cyclic(F.col("day_of_week"), 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def holiday_flag(df: DataFrame, ts: str = "date_time", holiday: str = "holiday") -> DataFrame:
    """1 for every hour of a date that carries a holiday label on any of its hours.

    The broadcast side has one row per labelled calendar date: at most 366 a year, so a century of data
    stays below a megabyte whatever the number of readings.
    """
    labelled = df.where(F.col(holiday).isNotNull() & (F.col(holiday) != fv.NO_HOLIDAY))
    dates = labelled.select(F.to_date(ts).alias("holiday_date_")).distinct()
    joined = df.join(F.broadcast(dates), F.to_date(df[ts]) == dates["holiday_date_"], "left")
    return joined.select(*df.columns, F.col("holiday_date_").isNotNull().cast("int").alias("is_holiday"))


def one_hot_weather(df: DataFrame, categories: list[str] | None = None, column: str = "weather_main", other: str | None = None) -> DataFrame:
    """A 0/1 column per category. The category list is given, so the schema does not depend on the data.
    ``other`` names one more column that is 1 for a category outside the list and for a missing one."""
    listed = categories or fv.WEATHER_CATEGORIES
    flags = [f"int(`{column}` <=> {sql_literal(c)}) AS `weather_{c}`" for c in listed]
    if other:
        flags.append(f"int(NOT coalesce(`{column}` IN ({', '.join(sql_literal(c) for c in listed)}), false)) AS `{other}`")
    return df.selectExpr("*", *flags)


def weather_indicators(df: DataFrame, weather: str = "weather_main", clouds: str = "clouds_all") -> DataFrame:
    """is_rainy, is_snowy, is_low_visibility and the severity rank."""
    w = F.col(weather)
    return df.withColumns(
        {
            "is_rainy": member_flag(w, fv.RAINY_WEATHER),
            "is_snowy": member_flag(w, fv.SNOWY_WEATHER),
            "is_low_visibility": low_visibility(w, F.col(clouds)),
            "weather_severity": weather_severity(w),
        }
    )


def minmax_scale(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``<column>_norm`` in [0, 1] over the whole table; a constant column gives null.

    The extremes are one row from one pass, read as a scalar subquery: no join and no global window.
    """
    columns = columns or fv.SCALED_COLUMNS
    extremes = df.agg(
        F.struct(*[F.min(c).alias(f"{c}_min") for c in columns], *[F.max(c).alias(f"{c}_max") for c in columns]).alias("e")
    ).scalar()
    return df.withColumns(
        {
            f"{c}_norm": F.try_divide(
                (F.col(c) - extremes[f"{c}_min"]).cast("double"), (extremes[f"{c}_max"] - extremes[f"{c}_min"]).cast("double")
            )
            for c in columns
        }
    )


def quartiles(df: DataFrame, value: str = "traffic_volume") -> DataFrame:
    """One row (q1, q2, q3), exact and linearly interpolated."""
    return quantiles(df, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75})


def congestion_category(df: DataFrame, value: str = "traffic_volume", name: str = "congestion_category") -> DataFrame:
    """Low / Medium / High / Severe by the table's own quartiles (upper bounds included)."""
    cuts = quartiles(df, value).select(F.struct("q1", "q2", "q3").alias("q")).scalar()
    return df.withColumn(name, quartile_category(F.col(value), [cuts["q1"], cuts["q2"], cuts["q3"]]))


def featurize(df: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Cleaned table (10 columns) to featured table (37 columns with the default categories).

    ``df`` is read by several passes (dates, extremes, quartiles); pass a stage table.
    """
    return (
        df.transform(time_features)
        .transform(holiday_flag)
        .transform(lambda d: one_hot_weather(d, categories))
        .transform(weather_indicators)
        .transform(minmax_scale)
        .transform(congestion_category)
    )


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: the base columns in order, then the one-hot weather columns, those present."""
    not_one_hot = {"weather_main", "weather_description", "weather_severity"}
    one_hot = [c for c in df.columns if c.startswith("weather_") and c not in not_one_hot]
    return [c for c in fv.BASE_FEATURES + one_hot if c in df.columns]


def risk_label(df: DataFrame, name: str = "high_risk") -> DataFrame:
    """1 where congestion is high and the weather or the visibility is bad. A proxy built from model
    inputs: scores against it are no evidence of predicting accidents."""
    congested = F.col("congestion_category").isin(fv.RISKY_CONGESTION)
    bad = F.col("weather_main").isin(fv.RISKY_WEATHER) | (F.col("is_low_visibility") == 1)
    return df.withColumn(name, F.coalesce(congested & bad, F.lit(False)).cast("int"))
