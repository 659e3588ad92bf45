"""Cleaning: schema check, null imputation, text, duplicates, one row per timestamp, outliers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions.lookups import weather_severity
from hourtide.functions.numeric import positive_if
from hourtide.functions.text import lower_text, title_text
from hourtide.operators.ranks import quantiles
from hourtide.sources.readers import parse_timestamps
from hourtide.sources.stages import write_stage


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    return sorted(set(required or fv.RAW_COLUMNS) - set(df.columns))


def validate_schema(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Return ``df`` unchanged, or fail listing the missing columns. Extra columns are fine."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def standardise_text(df: DataFrame) -> DataFrame:
    """Trim and title-case the category, trim and lower-case the description, label empty holidays."""
    return df.withColumns(
        {
            "weather_main": title_text(F.col("weather_main")),
            "weather_description": lower_text(F.col("weather_description")),
            "holiday": F.coalesce(F.col("holiday"), F.lit(fv.NO_HOLIDAY)),
        }
    )


def text_changes(df: DataFrame) -> DataFrame:
    """(column, changed): rows whose text the standardisation alters. Null to null is no change."""
    changed = df.agg(
        positive_if(~F.col("weather_main").eqNullSafe(title_text(F.col("weather_main")))).alias("weather_main"),
        positive_if(~F.col("weather_description").eqNullSafe(lower_text(F.col("weather_description")))).alias(
            "weather_description"
        ),
        positive_if(F.col("holiday").isNull()).alias("holiday"),
    )
    return changed.unpivot([], ["weather_main", "weather_description", "holiday"], "column_name", "changed")


def exact_dedupe(df: DataFrame, columns: list[str] | None = None, order: str = "seq") -> DataFrame:
    """One row per distinct combination of ``columns`` (null equals null), at its first position.

    Copies collapse in the map-side aggregate, so a row repeated a billion times shuffles as one row
    per task.
    """
    columns = columns or fv.RAW_COLUMNS
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def repeat_profile(df: DataFrame, ts: str = "date_time", volume: str = "traffic_volume") -> DataFrame:
    """Timestamps with several rows, the rows beyond the first, and timestamps whose volumes differ."""
    per_ts = df.groupBy(ts).agg(
        F.count(F.lit(1)).alias("rows"), F.min(volume).alias("low"), F.max(volume).alias("high")
    )
    repeated = F.col("rows") > 1
    return per_ts.agg(
        positive_if(repeated).alias("repeated_timestamps"),
        F.coalesce(F.sum(F.when(repeated, F.col("rows") - 1)), F.lit(0)).cast("bigint").alias("extra_rows"),
        positive_if(F.col("low") < F.col("high")).alias("inconsistent_timestamps"),
    )


def timestamp_aggregate(
    df: DataFrame,
    ts: str = "date_time",
    order: str = "seq",
    means: tuple[str, ...] = ("temp", "rain_1h", "snow_1h", "clouds_all"),
    separator: str = "; ",
) -> DataFrame:
    """One row per timestamp.

    Means of the readings, the first holiday and volume, the most severe category (the first on a tie),
    the distinct descriptions in first-seen order, and the number of rows. The first level, over the raw
    rows, groups by everything that is not averaged and keeps numbers only, so it stays in a hash map; the
    smallest structs are picked over what it leaves. The second groups by timestamp and description, so
    the list built per timestamp holds distinct descriptions only.
    """
    by_values = df.groupBy(ts, "weather_description", "holiday", "weather_main", "traffic_volume").agg(
        F.min(order).alias("seen_"),
        F.count(F.lit(1)).alias("rows_"),
        *[F.sum(c).alias(f"{c}_sum_") for c in means],
        *[F.count(c).alias(f"{c}_n_") for c in means],
    )
    first = F.struct(F.col("seen_"), F.col("holiday"), F.col("traffic_volume"))
    worst = F.struct((-weather_severity(F.col("weather_main"))).alias("rank_"), F.col("seen_"), F.col("weather_main"))
    by_text = by_values.groupBy(ts, "weather_description").agg(
        F.min("seen_").alias("seen_"),
        F.min(first).alias("first_"),
        F.min(worst).alias("worst_"),
        F.sum("rows_").alias("rows_"),
        *[F.sum(f"{c}_{x}_").alias(f"{c}_{x}_") for c in means for x in ("sum", "n")],
    )
    texts = F.array_sort(F.collect_list(F.struct("seen_", "weather_description")))
    per_ts = by_text.groupBy(ts).agg(
        F.min("first_").alias("first_"),
        F.min("worst_").alias("worst_"),
        F.sum("rows_").alias("rows_"),
        texts.alias("texts_"),
        *[F.try_divide(F.sum(f"{c}_sum_"), F.sum(f"{c}_n_")).alias(f"{c}_mean_") for c in means],
    )
    return per_ts.select(
        ts,
        F.col("first_.holiday").alias("holiday"),
        *[F.col(f"{c}_mean_").alias(c) for c in means],
        F.col("worst_.weather_main").alias("weather_main"),
        F.array_join(F.col("texts_.weather_description"), separator).alias("weather_description"),
        F.col("first_.traffic_volume").alias("traffic_volume"),
        F.col("rows_").alias("n_weather_conditions"),
    )


def month_of(ts: str) -> Column:
    """Calendar month; rows without a timestamp count as January."""
    return F.coalesce(F.month(F.col(ts)), F.lit(1))


def monthly_medians(
    df: DataFrame, columns: dict[str, Column], ts: str = "date_time", wanted: Column | None = None
) -> DataFrame:
    """Exact median per calendar month (years pooled): at most twelve rows, ``<name>_median`` columns.

    ``wanted`` is a condition on ``column_`` that drops readings before they are counted; the medians of
    the dropped columns are null.
    """
    long = df.select(month_of(ts).alias("month_"), *[c.cast("double").alias(name) for name, c in columns.items()]).unpivot(
        ["month_"], list(columns), "column_", "reading_"
    )
    if wanted is not None:
        long = long.where(wanted)
    medians = quantiles(long, "reading_", {"median_": 0.5}, ["month_", "column_"])
    return medians.groupBy("month_").agg(
        *[F.max(F.when(F.col("column_") == name, F.col("median_"))).alias(f"{name}_median") for name in columns]
    )


def impute_nulls(df: DataFrame, columns: list[str] | None = None, ts: str = "date_time") -> DataFrame:
    """Nulls become the median of their calendar month. The columns widen to double: a median can be x.5.

    Null counts come first, as a one-row subquery, so that only columns with nulls have their readings
    counted for a median.
    """
    columns = list(columns or fv.NUMERIC_COLUMNS)
    nulls = df.agg(F.struct(*[positive_if(F.col(c).isNull()).alias(c) for c in columns]).alias("nulls")).scalar()
    wanted = reduce(lambda a, b: a | b, [(F.col("column_") == c) & (nulls[c] > 0) for c in columns])
    medians = F.broadcast(monthly_medians(df, {c: F.col(c) for c in columns}, ts, wanted))
    joined = df.withColumn("month_", month_of(ts)).join(medians, "month_", "left")
    return joined.select(
        *[F.coalesce(F.col(c).cast("double"), F.col(f"{c}_median")).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def outlier_flags(rules: list[tuple] | None = None) -> dict[str, Column]:
    """Column name -> condition (never null) that marks an impossible reading."""
    tests = {"=": lambda c, b: c == b, ">": lambda c, b: c > b, "<": lambda c, b: c < b}
    return {
        name: F.coalesce(tests[op](F.col(name), F.lit(bound)), F.lit(False)) for name, op, bound in rules or fv.OUTLIER_RULES
    }


def detect_outliers(df: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """Add ``<column>_outlier`` flags."""
    return df.withColumns({f"{name}_outlier": flag for name, flag in outlier_flags(rules).items()})


def impute_outliers(df: DataFrame, rules: list[tuple] | None = None, ts: str = "date_time") -> DataFrame:
    """Impossible readings become the median of the valid readings of their calendar month; a month
    without a valid reading gives null."""
    flags = outlier_flags(rules)
    medians = F.broadcast(monthly_medians(df, {c: F.when(~flag, F.col(c)) for c, flag in flags.items()}, ts))
    joined = df.withColumn("month_", month_of(ts)).join(medians, "month_", "left")
    return joined.select(
        *[
            F.when(flags[c], F.col(f"{c}_median")).otherwise(F.col(c).cast("double")).alias(c) if c in flags else F.col(c)
            for c in df.columns
        ]
    )


def deduplicated(df: DataFrame, order: str = "seq") -> DataFrame:
    """Everything before the outlier step: checked, null-imputed, standardised, parsed, distinct rows."""
    validate_schema(df)
    df = df.select(*fv.RAW_COLUMNS, order)
    if dict(df.dtypes)["date_time"] == "string":
        df = parse_timestamps(df)
    return exact_dedupe(standardise_text(impute_nulls(df)), order=order)


def clean(
    df: DataFrame,
    order: str = "seq",
    outliers_first: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = write_stage,
) -> DataFrame:
    """Raw readings to the cleaned table (ten columns, one row per timestamp).

    Averaging comes before outlier detection, as in the published results, so a 0 K reading averaged
    with a valid one is not seen; ``outliers_first`` reverses that. The per-timestamp table feeds both
    the medians and the result, so ``stage`` cuts there instead of running the shuffles twice.
    """
    distinct = deduplicated(df, order)
    if outliers_first:
        return timestamp_aggregate(impute_outliers(stage(distinct, "distinct")), order=order)
    return impute_outliers(stage(timestamp_aggregate(distinct, order=order), "per-timestamp"))


def quality_log(df: DataFrame, order: str = "seq") -> DataFrame:
    """(step, level, metric, value): what each cleaning step finds and changes."""
    raw = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[positive_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in fv.RAW_COLUMNS],
        positive_if(~F.col("weather_main").eqNullSafe(title_text(F.col("weather_main")))).alias("changed_weather_main"),
        positive_if(~F.col("weather_description").eqNullSafe(lower_text(F.col("weather_description")))).alias(
            "changed_weather_description"
        ),
    )
    distinct = write_stage(deduplicated(df, order), "distinct")
    hourly = timestamp_aggregate(distinct, order=order)
    found = hourly.agg(
        F.count(F.lit(1)).alias("rows_out"),
        *[positive_if(flag).alias(f"outliers_{c}") for c, flag in outlier_flags().items()],
    )
    repeats = repeat_profile(distinct)
    kept = distinct.agg(F.count(F.lit(1)).alias("kept")).scalar()
    counted = raw.withColumn("exact_duplicates", F.col("rows_in") - kept)
    parts = [part.unpivot([], part.columns, "metric", "value") for part in (counted, repeats, found)]
    metric, value = F.col("metric"), F.col("value")
    step = (
        F.when(metric == "rows_in", F.lit("load"))
        .when(metric.startswith("nulls_"), F.lit("missing_values"))
        .when(metric.startswith("changed_"), F.lit("standardise"))
        .when(metric.startswith("outliers_"), F.lit("outliers"))
        .when(metric == "rows_out", F.lit("save"))
        .otherwise(F.lit("duplicates"))
    )
    quiet = metric.isin("rows_in", "rows_out", "nulls_holiday")
    return (
        reduce(DataFrame.unionByName, parts)
        .select(
            step.alias("step"),
            F.when(~quiet & (value > 0), F.lit("WARNING")).otherwise(F.lit("INFO")).alias("level"),
            metric,
            value.cast("bigint").alias("value"),
        )
    )
