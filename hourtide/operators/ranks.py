"""Exact running totals and quantiles over distinct values, one way for every size of input.

Values are first reduced to (value, count), spread over all tasks by value with map-side combine, so a
group holding a third of the table costs one row per distinct reading. The counts are dealt to the tasks
by ranges of (keys, value) and written once to the shared folder with the number of their range. Each
range is summed on its own; the sums of the ranges, one row per range and group in it, give the offsets.
No task sees a whole group, and the ranges grow in number with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtide.sources.stages import write_stage


def running_totals(counts: DataFrame, order: str, measures: list[str], keys: list[str] | None = None) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller ``order`` values) and ``<m>_total`` per group of ``keys``.

    ``counts`` holds each (keys, order) once. Runs a job: the ranges are written to the shared folder
    when this is called, so that both passes over them see the same split.
    """
    keys = list(keys or [])
    dealt = counts.repartitionByRange(*keys, order).withColumn("part_", F.spark_partition_id())
    staged = write_stage(dealt, "ranges", sort_by=order)
    sums = staged.groupBy(*keys, "part_").agg(*[F.sum(m).alias(f"{m}_sum_") for m in measures])
    whole = Window.partitionBy(*keys)
    lower = whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"{k}_k") for k in keys],
        F.col("part_").alias("part_k"),
        *[F.coalesce(F.sum(f"{m}_sum_").over(lower), F.lit(0)).alias(f"{m}_offset_") for m in measures],
        *[F.sum(f"{m}_sum_").over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy("part_", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = staged.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"{m}_inside_") for m in measures])
    same = F.col("part_") == F.col("part_k")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}_k"))
    return summed.join(offsets, same).select(
        *counts.columns,
        *[(F.col(f"{m}_offset_") + F.col(f"{m}_inside_")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def with_previous(values: DataFrame, order: str, name: str) -> DataFrame:
    """Add ``name``, the next smaller ``order`` (null for the smallest). ``values`` holds each once.

    Ranges of values look back within themselves; a table of one row per range gives the end of the
    ranges before. Runs a job: the ranges are written to the shared folder when this is called.
    """
    staged = write_stage(values.repartitionByRange(order).withColumn("part_", F.spark_partition_id()), "ranges", sort_by=order)
    ends = staged.groupBy("part_").agg(F.max(order).alias("end_"))
    earlier = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(F.col("part_").alias("part_k"), F.max("end_").over(earlier).alias("end_before_"))
    inside = staged.withColumn("inside_", F.lag(order).over(Window.partitionBy("part_").orderBy(order)))
    joined = inside.join(before, F.col("part_") == F.col("part_k"))
    return joined.select(*values.columns, F.coalesce("inside_", "end_before_").alias(name))


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group: one column per entry of ``probabilities``.

    Nulls are ignored. Without ``keys`` the result is one row, null if there is no value. Runs the job of
    ``running_totals``.
    """
    keys = list(keys or [])
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value_"))
        .agg(F.count(F.lit(1)).alias("n_"))
    )
    ranked = running_totals(counts, "value_", ["n_"], keys)

    def at(position):
        inside = (F.col("n__before") <= position) & (position < F.col("n__before") + F.col("n_"))
        return F.max(F.when(inside, F.col("value_")))

    picks, results = [], []
    for name, probability in probabilities.items():
        position = (F.col("n__total") - 1) * F.lit(float(probability))
        picks += [
            at(F.floor(position)).alias(f"{name}_low_"),
            at(F.ceil(position)).alias(f"{name}_high_"),
            F.max(position - F.floor(position)).alias(f"{name}_part_"),
        ]
        low, high = F.col(f"{name}_low_"), F.col(f"{name}_high_")
        results.append((low + (high - low) * F.col(f"{name}_part_")).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)
