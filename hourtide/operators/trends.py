"""Trends over time, pivots, rankings, distributions and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtide import fixed_values as fv
from hourtide.functions import calendar as cal
from hourtide.functions.numeric import positive_if
from hourtide.operators.ranks import running_totals, with_previous

TS, VOLUME = "date_time", "traffic_volume"


def timestamp_means(df: DataFrame, ts: str = TS, columns: tuple[str, ...] = ("temp", VOLUME)) -> DataFrame:
    """One row per timestamp with the mean of each column."""
    return df.groupBy(ts).agg(*[F.avg(c).alias(c) for c in columns])


def annual_trend(df: DataFrame, first: int, last: int, ts: str = TS, value: str = VOLUME) -> DataFrame:
    """Per year: hours with data, mean and total of the per-timestamp means, first and last timestamp."""
    hourly = timestamp_means(df.where(cal.years_between(F.col(ts), first, last)), ts, (value,))
    return hourly.groupBy(F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("hours_of_data"),
        F.avg(value).alias("avg_volume_per_hour"),
        F.sum(value).cast("bigint").alias("total_volume"),
        F.min(ts).alias("first_record"),
        F.max(ts).alias("last_record"),
    )


def change_from_previous(annual: DataFrame, value: str, order: str = "year", digits: int = 2) -> DataFrame:
    """Previous value, change and percentage change by year. ``annual`` has one row per year, so the
    window without partitions sees some dozens of rows."""
    current = F.round(F.col(value).cast("double"), digits)
    previous = F.lag(value).over(Window.orderBy(order))
    rounded = annual.withColumn(value, current)
    return rounded.withColumn("previous_value", previous).select(
        order,
        "hours_of_data",
        value,
        "previous_value",
        F.round(F.col(value) - F.col("previous_value"), digits).alias("yoy_change"),
        F.round(F.try_divide(F.col(value) - F.col("previous_value"), F.col("previous_value")) * 100, digits).alias("yoy_pct_change"),
    )


def yoy_change(df: DataFrame, first: int, last: int) -> DataFrame:
    """Year-on-year change of the mean volume, on means rounded to two decimals."""
    annual = annual_trend(df, first, last).withColumnRenamed("avg_volume_per_hour", "avg_volume")
    return change_from_previous(annual, "avg_volume")


def annual_total_yoy(df: DataFrame, first: int, last: int) -> DataFrame:
    """Year-on-year change of the total volume."""
    return change_from_previous(annual_trend(df, first, last), "total_volume")


def holiday_temperature(df: DataFrame, holidays: list[str], first: int, last: int, ts: str = TS) -> DataFrame:
    """Temperatures and volume over all hours of the dates that carry one of the holidays.

    The date list (one row per holiday and labelled date of the chosen years) is broadcast: at most
    366 dates a year for each name asked for.
    """
    chosen = df.where(cal.years_between(F.col(ts), first, last))
    dates = (
        chosen.where(F.col("holiday").isin(holidays))
        .select("holiday", F.to_date(ts).alias("holiday_date"), F.year(ts).alias("year"))
        .distinct()
    )
    hourly = timestamp_means(chosen, ts)
    joined = hourly.withColumn("holiday_date", F.to_date(ts)).join(F.broadcast(dates), "holiday_date")
    kelvin = {"avg": F.avg("temp"), "min": F.min("temp"), "max": F.max("temp")}
    return joined.groupBy("holiday", "year", "holiday_date").agg(
        F.count(F.lit(1)).alias("hours_observed"),
        *[value.alias(f"{name}_temp_k") for name, value in kelvin.items()],
        *[(value - fv.KELVIN_OFFSET).alias(f"{name}_temp_c") for name, value in kelvin.items()],
        F.avg(VOLUME).alias("avg_traffic"),
    )


def daily_trend(df: DataFrame, first: int, last: int, ts: str = TS, value: str = VOLUME) -> DataFrame:
    """Daily means with the day of the year as the common axis."""
    chosen = df.where(cal.years_between(F.col(ts), first, last))
    daily = chosen.groupBy(F.to_date(ts).alias("day")).agg(F.avg(value).alias("avg_volume"))
    return daily.select(F.year("day").alias("year"), "day", F.dayofyear("day").alias("day_of_year"), "avg_volume")


def hourly_profile(df: DataFrame, year: int | None = None, ts: str = TS, value: str = VOLUME) -> DataFrame:
    """Mean by hour of the day, within one year if given."""
    chosen = df if year is None else df.where(cal.years_between(F.col(ts), year, year))
    return chosen.groupBy(F.hour(ts).alias("hour")).agg(F.avg(value).alias("avg_volume"), F.count(value).alias("n"))


def category_ranking(df: DataFrame, category: str = "weather_main", value: str = VOLUME, min_count: int = 1) -> DataFrame:
    """Mean per category (rank 1 is the highest) with the best, the worst and the spread between them."""
    means = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.avg(value).alias("avg_volume"), F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("avg_volume").isNull().alias("unknown"), (-F.col("avg_volume")).alias("height"), F.col(category).alias("name"))
    kept = means.where(F.col("n") >= min_count).withColumns({"order_": order, "one_": F.lit(1)})
    ranked = running_totals(kept, "order_", ["one_"])
    ends = ranked.agg(F.struct(F.min("order_").alias("first"), F.max("order_").alias("last")).alias("ends")).scalar()
    return ranked.select(
        category,
        "avg_volume",
        "n",
        (F.col("one__before") + 1).cast("int").alias("place"),
        ends["first"]["name"].alias("highest"),
        ends["last"]["name"].alias("lowest"),
        (ends["last"]["height"] - ends["first"]["height"]).alias("value_range"),
    )


def hour_by_day_type(df: DataFrame, value: str = VOLUME) -> DataFrame:
    """Mean by hour, weekday and weekend side by side."""
    wide = df.groupBy("hour").pivot("is_weekend", [0, 1]).agg(F.avg(value))
    return wide.select("hour", F.col("0").alias("weekday"), F.col("1").alias("weekend"))


def dow_hour_heatmap(df: DataFrame, value: str = VOLUME) -> DataFrame:
    """Seven rows (Monday 0) by 24 hour columns ``h00`` to ``h23``."""
    wide = df.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.avg(value))
    return wide.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def hour_dow_heatmap(df: DataFrame, value: str = VOLUME) -> DataFrame:
    """24 rows by a column per named day."""
    wide = df.groupBy("hour").pivot("day_of_week", list(range(7))).agg(F.avg(value))
    return wide.select("hour", *[F.col(str(i)).alias(name) for i, name in enumerate(fv.DAY_NAMES)])


def top_category_points(df: DataFrame, category: str = "weather_main", points: tuple[str, ...] = ("temp", VOLUME), n: int = 5) -> DataFrame:
    """The points of the ``n`` most frequent categories (ties by name)."""
    leaders = df.groupBy(category).agg(F.count(F.lit(1)).alias("n_")).orderBy(F.desc("n_"), category).limit(n)
    return df.select(category, *points).join(leaders.select(category), category, "left_semi")


def weekday_weekend_compare(df: DataFrame, month: int | None = None, ts: str = TS, value: str = VOLUME) -> DataFrame:
    """Weekday mean, weekend mean and difference per calendar month, or for the one asked for."""
    if month is not None and month not in range(1, 13):
        raise ValueError(f"month must be 1..12, got {month!r}")
    by_month = df.withColumn("month", F.month(ts))
    if month is not None:
        by_month = by_month.where(F.col("month") == month)
    weekday = F.avg(F.when(F.col("is_weekend") == 0, F.col(value)))
    weekend = F.avg(F.when(F.col("is_weekend") == 1, F.col(value)))
    return by_month.groupBy("month", cal.month_name(F.col(ts)).alias("month_name")).agg(
        weekday.alias("weekday_avg"), weekend.alias("weekend_avg"), (weekday - weekend).alias("difference")
    )


def coverage_gaps(df: DataFrame, longer_than_hours: float = 1.0, ts: str = TS) -> DataFrame:
    """Gaps between successive timestamps.

    The distinct timestamps are dealt by ranges, and each range's first one looks at the end of the
    ranges before: no task sorts all timestamps, wherever they crowd. Runs the job of ``with_previous``.
    """
    stamps = df.where(F.col(ts).isNotNull()).select(ts).distinct()
    joined = with_previous(stamps, ts, "before_")
    start, end = F.col("before_"), F.col(ts)

    def second_of_day(c):
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c).cast("double")

    seconds = F.datediff(F.to_date(end), F.to_date(start)) * 86400 + second_of_day(end) - second_of_day(start)
    return joined.select(start.alias("gap_start"), end.alias("gap_end"), (seconds / 3600.0).alias("gap_hours")).where(
        F.col("gap_hours") > longer_than_hours
    )


def category_counts(df: DataFrame) -> DataFrame:
    """Rows per congestion category with the count and rate of the risk label."""
    return df.groupBy("congestion_category").agg(
        F.count(F.lit(1)).alias("n"),
        positive_if(F.col("high_risk") == 1).alias("high_risk_n"),
        F.avg(F.col("high_risk").cast("double")).alias("high_risk_rate"),
    )
