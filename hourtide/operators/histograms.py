"""Equal-width histograms over the observed range, empty bins included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _edges(low, high):
    """A constant column gets a range of width one around it."""
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def _bin(value, low, high, bins: int):
    """Bin index; the last bin includes the maximum."""
    return F.least(F.floor((value - low) / (high - low) * bins).cast("int"), F.lit(bins - 1))


def histogram(df: DataFrame, column: str = "traffic_volume", bins: int = 50) -> DataFrame:
    """(bin, lower, upper, n)."""
    value = F.col(column).cast("double")
    low, high = _edges(F.min(value), F.max(value))
    ends = df.agg(F.struct(low.alias("low"), high.alias("high")).alias("ends")).scalar()
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(_bin(value, ends["low"], ends["high"], bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (ends["high"] - ends["low"]) / bins
    return axis.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (ends["low"] + F.col("bin") * width).alias("lower"),
        (ends["low"] + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def sample_histograms(df: DataFrame, features: list[str], sample: str = "sample", bins: int = 50) -> DataFrame:
    """Density histograms per (feature, sample), each over its own range: (feature, sample, bin, lower,
    upper, n, density). The range table has one row per feature and sample."""
    long = df.select(sample, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([sample], features, "feature", "value")
    long = long.where(F.col("value").isNotNull())
    low, high = _edges(F.min("value"), F.max("value"))
    ranges = long.groupBy("feature", sample).agg(low.alias("low"), high.alias("high"), F.count(F.lit(1)).alias("total"))
    counts = (
        long.join(F.broadcast(ranges), ["feature", sample])
        .groupBy("feature", sample, _bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / bins
    n = F.coalesce("n", F.lit(0))
    return axis.join(counts, ["feature", sample, "bin"], "left").select(
        "feature",
        sample,
        "bin",
        (F.col("low") + F.col("bin") * width).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("upper"),
        n.alias("n"),
        (n / (F.col("total") * width)).alias("density"),
    )
