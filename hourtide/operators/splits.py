"""Time splits, scaling and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.functions import calendar as cal
from hourtide.operators.ranks import running_totals

TS = "date_time"


def chronological_split(
    df: DataFrame, train_through: int, test_year: int | None = None, production_year: int | None = None, ts: str = TS
) -> DataFrame:
    """Add ``split``: train up to a year, then the test and the production year; other rows are null."""
    test_year = train_through + 1 if test_year is None else test_year
    production_year = train_through + 2 if production_year is None else production_year
    stamp = F.col(ts)
    return df.withColumn(
        "split",
        F.when(cal.through_year(stamp, train_through), "train")
        .when(cal.years_between(stamp, test_year, test_year), "test")
        .when(cal.years_between(stamp, production_year, production_year), "production"),
    )


def split_counts(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_record"), F.max(ts).alias("last_record"))


def holdout_tail(df: DataFrame, fraction: float = 0.2, ts: str = TS, tie: str | None = None) -> DataFrame:
    """Add ``part``: the last ``fraction`` of the rows in time order is the holdout (rounded up), the
    rest is for fitting. ``tie`` orders rows that share a timestamp; without it the timestamp is unique.

    The cut-off is one value found from counts per timestamp; the rows themselves are not sorted.
    """
    order = F.struct(ts, tie) if tie else F.col(ts)
    counts = df.groupBy(order.alias("order_")).agg(F.count(F.lit(1)).alias("n_"))
    ranked = running_totals(counts, "order_", ["n_"])
    kept = F.col("n__total") - F.ceil(F.col("n__total") * F.lit(fraction))
    cut = ranked.where(F.col("n__before") + F.col("n_") <= kept).agg(F.max("order_").alias("cut")).scalar()
    return df.withColumn("part", F.when(order <= cut, "fit").otherwise("holdout"))


def standard_scale(df: DataFrame, columns: list[str], fit_on, suffix: str = "_z") -> DataFrame:
    """z-scores with the mean and population deviation of the rows where ``fit_on`` holds; a constant
    column is only centred."""
    train = df.where(fit_on)
    fitted = train.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns]
        ).alias("fitted")
    ).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - fitted[f"{c}_mean"]) / F.when(fitted[f"{c}_sd"] > 0, fitted[f"{c}_sd"]).otherwise(F.lit(1.0))
            for c in columns
        }
    )


def class_weights(df: DataFrame, label: str = "high_risk") -> DataFrame:
    """One row per class: n and the balanced weight total / (classes * n)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).alias("whole")).scalar()
    return counts.withColumn("weight", whole["total"] / (whole["classes"] * F.col("n")))


def with_class_weights(df: DataFrame, label: str = "high_risk") -> DataFrame:
    """Join the balanced weight to every row (one broadcast row per class)."""
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)
