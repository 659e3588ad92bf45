"""Counts, null profiles, descriptive statistics and probabilities: one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions.numeric import positive_if, ratio_or, share
from hourtide.functions.text import is_blank
from hourtide.operators.ranks import quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def unique_values(df: DataFrame, column: str = "date_time", name: str = "unique_timestamps", approximate: bool = False) -> DataFrame:
    """Exact distinct count, or the sketch-based estimate when ``approximate``."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    return df.agg(count.alias(name))


def column_info(df: DataFrame) -> DataFrame:
    """(position, name, type, n_values): the schema with the non-null count of each column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "name", "n_values")
    position = {name: i for i, name in enumerate(df.columns)}
    kinds = dict(df.dtypes)
    return counts.select(
        F.create_map(*[F.lit(x) for pair in position.items() for x in pair])[F.col("name")].alias("position"),
        "name",
        F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("name")].alias("type"),
        "n_values",
    )


def column_presence(df: DataFrame, required: list[str]) -> DataFrame:
    """(column_name, present, n_values) for each required column; absent columns count no values."""
    counts = df.agg(*[(F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in required])
    long = counts.unpivot([], required, "column_name", "n_values")
    here = [c for c in required if c in df.columns]
    return long.select("column_name", F.col("column_name").isin(here).alias("present"), "n_values")


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first rows by a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, key: list[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run and on every engine: the smallest
    digests of seed and key. Each task keeps ``n`` rows; nothing is sorted as a whole."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.orderBy(digest, *key).limit(n)


def null_blank_counts(df: DataFrame) -> DataFrame:
    """Null counts per column; blank text counts as null."""
    text = {"holiday", "weather_main"}
    columns = [c for c in fv.RAW_COLUMNS if c != "weather_description"]
    stamped_text = dict(df.dtypes)["date_time"] == "string"

    def missing(name: str) -> Column:
        blankable = name in text or (name == "date_time" and stamped_text)
        return is_blank(F.col(name)) if blankable else F.col(name).isNull()

    names = {"rain_1h": "rain", "snow_1h": "snow", "clouds_all": "clouds"}
    return df.agg(*[positive_if(missing(c)).alias(f"{names.get(c, c)}_nulls") for c in columns])


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, named_count) per raw column."""
    columns = fv.RAW_COLUMNS
    total = df.agg(*[F.struct(positive_if(F.col(c).isNull()).alias("nulls"), F.count(c).alias("named")).alias(c) for c in columns])
    long = total.unpivot([], columns, "column_name", "counted")
    return long.select("column_name", F.col("counted.nulls").alias("null_count"), F.col("counted.named").alias("named_count"))


def distinct_categories(df: DataFrame, column: str = "weather_main") -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def descriptive_stats(df: DataFrame, column: str = "traffic_volume") -> DataFrame:
    """Count, mean, median, sample deviation and variance, extremes and range."""
    value = F.col(column).cast("double")
    stats = df.agg(
        F.count(column).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std_dev"),
        F.var_samp(value).alias("variance"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
        (F.max(value) - F.min(value)).alias("value_range"),
    )
    median = quantiles(df, column, {"median": 0.5})
    return stats.withColumn("median", median.scalar())


def correlation(df: DataFrame, x: str = "temp", y: str = "traffic_volume") -> DataFrame:
    """Pearson r with its direction and strength label."""
    r = F.col("r")
    strength = None
    for limit, label in fv.CORRELATION_STRENGTHS:
        strength = F.when(F.abs(r) < limit, label) if strength is None else strength.when(F.abs(r) < limit, label)
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r")).select(
        "r",
        F.when(r > 0, "positive").when(r.isNotNull(), "negative").alias("direction"),
        strength.when(r.isNotNull(), F.lit(fv.STRONGEST_CORRELATION)).alias("strength"),
    )


def congested(column: str = "traffic_volume") -> Column:
    return F.col(column) > fv.CONGESTED_ABOVE


def in_weather(category: str, column: str = "weather_main") -> Column:
    return F.col(column) == category


def joint_probabilities(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Counts and probabilities of two events and of both together."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        positive_if(a).alias("n_a"),
        positive_if(b).alias("n_b"),
        positive_if(a & b).alias("n_ab"),
        share(a).alias("p_a"),
        share(b).alias("p_b"),
        share(a & b).alias("p_ab"),
    )


def conditional_probabilities(df: DataFrame, given: Column, events: dict[str, Column]) -> DataFrame:
    """P(event | given) per event; 0 where ``given`` never holds."""
    return df.agg(
        *[ratio_or(positive_if(given & event), positive_if(given), 0.0).alias(f"p_{name}") for name, event in events.items()]
    )


def independence_test(df: DataFrame, a: Column, b: Column, tolerance: float = fv.INDEPENDENCE_TOLERANCE) -> DataFrame:
    """Compare P(A and B) with P(A) P(B)."""
    gap = F.abs(F.col("p_ab") - F.col("p_a") * F.col("p_b"))
    return joint_probabilities(df, a, b).select(
        "p_ab",
        (F.col("p_a") * F.col("p_b")).alias("p_a_times_p_b"),
        gap.alias("difference"),
        F.when(gap < tolerance, "approximately independent").otherwise("NOT independent (dependent)").alias("conclusion"),
    )


def odds_ratio(df: DataFrame, event: Column, group: str, first: str, second: str) -> DataFrame:
    """Odds of ``event`` in two groups and their ratio; null where a denominator is zero."""
    inside = {name: F.col(group) == value for name, value in (("first", first), ("second", second))}
    counts = df.where(F.col(group).isin(first, second)).agg(
        *[positive_if(cond & event).alias(f"{name}_hits") for name, cond in inside.items()],
        *[positive_if(cond & ~F.coalesce(event, F.lit(False))).alias(f"{name}_misses") for name, cond in inside.items()],
    )
    odds = {name: ratio_or(F.col(f"{name}_hits"), F.col(f"{name}_misses")) for name in inside}
    ratio = F.try_divide(odds["first"], odds["second"])
    return counts.select(
        "*",
        odds["first"].alias("first_odds"),
        odds["second"].alias("second_odds"),
        ratio.alias("odds_ratio"),
        F.when(ratio > 1, "more likely in first")
        .when(ratio < 1, "more likely in second")
        .when(ratio.isNotNull(), "equal")
        .otherwise("undefined")
        .alias("direction"),
    )


def kpis(df: DataFrame) -> DataFrame:
    """Rows, mean volume and mean temperature in Celsius."""
    return df.agg(
        F.count(F.lit(1)).alias("total_hours"),
        F.avg("traffic_volume").alias("avg_volume"),
        F.avg(F.col("temp") - fv.KELVIN_OFFSET).alias("avg_temp_c"),
    )
