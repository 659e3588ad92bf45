"""Typed scans. Every reader declares its schema; nothing is inferred by reading the data twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtide.fixed_values import RAW_SCHEMA, TIMESTAMP_FORMAT, TIMESTAMP_PATTERN
from hourtide.operators.ranks import running_totals
from hourtide.sources.stages import write_stage


def with_file_order(df: DataFrame, name: str = "seq") -> DataFrame:
    """Add a dense number that follows (file, position in file), one way for any number of files.

    A first pass counts the rows of each split of a file; their running total says where the split begins,
    and a row stands as far behind as its row id behind the split's first. Runs that pass when called.
    """
    placed = df.withColumns(
        {"file_": F.input_file_name(), "block_": F.input_file_block_start(), "row_": F.monotonically_increasing_id()}
    )
    counts = placed.groupBy("file_", "block_").agg(F.count(F.lit(1)).alias("rows_"), F.min("row_").alias("first_"))
    splits = counts.select("file_", "block_", "rows_", "first_", F.struct("file_", "block_").alias("order_"))
    begins = running_totals(splits, "order_", ["rows_"]).select("file_", "block_", "first_", "rows__before")
    return placed.join(begins, ["file_", "block_"]).select(
        *df.columns, (F.col("rows__before") + F.col("row_") - F.col("first_")).alias(name)
    )


def read_observations_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    null_value: str | None = "None",
    strict: bool = True,
) -> DataFrame:
    """CSV scan with a header row. ``strict`` fails on a value that does not fit its type.

    ``null_value`` is the text read as null; pass None to keep the literal text as the SQL path does.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return with_file_order(reader.csv(path))


def read_observations_aside(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, null_value: str | None = "None"
) -> tuple[DataFrame, DataFrame]:
    """The readable rows of a CSV scan, in file order, and the others: (file, line, reason, columns).

    ``reason`` is "quotes" for a line with an open quote, "fields" for one with more or fewer values than the schema has
    columns, and "values" for one with values that do not fit their types, named in ``columns`` in the schema's order.
    Nothing is dropped: a record is in one of the two. Runs a job: the parsed rows are written to the shared folder.
    """
    names = [f.name for f in schema.fields]
    wide = T.StructType([*schema.fields, T.StructField("unreadable_", T.StringType())])
    reader = spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "unreadable_")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    # Written whole: a scan of fewer columns would not look at the values of the others.
    rows = write_stage(with_file_order(reader.csv(path).withColumn("source_", F.input_file_name())), "parsed")
    text = T.StructType([T.StructField(f"v{i}", T.StringType()) for i in range(len(names) + 1)])
    bad = rows.where(F.col("unreadable_").isNotNull()).select(F.col("source_").alias("file"), F.col("unreadable_").alias("line"))
    outside = F.regexp_replace("line", r'"(?:[^"\\]|\\.)*"', "q")
    values = F.from_csv("line", text.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE"})
    broken = []
    for i, field in enumerate(schema.fields):
        value = values[f"v{i}"]
        kept = value.isNotNull() & ((value != null_value) if null_value is not None else F.lit(True))
        broken.append(F.when(kept & (F.trim(value) != "") & F.trim(value).try_cast(field.dataType).isNull(), F.lit(field.name)))
    reason = (
        F.when(outside.contains('"'), "quotes").when(F.regexp_count(outside, F.lit(",")) != len(names) - 1, "fields").otherwise("values")
    )
    judged = bad.select("file", "line", reason.alias("reason"), F.array_compact(F.array(*broken)).alias("columns"))
    aside = judged.withColumn("columns", F.when(F.col("reason") == "values", F.col("columns")).otherwise(F.array().cast("array<string>")))
    return rows.where(F.col("unreadable_").isNull()).drop("unreadable_", "source_"), aside


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A typed stage table (cleaned or featured)."""
    return spark.read.parquet(path)


def parse_timestamps(
    df: DataFrame, column: str = "date_time", fmt: str = TIMESTAMP_FORMAT, quarantine: bool = False
) -> DataFrame:
    """Text to zone-less timestamp. A value that does not parse fails the job; with ``quarantine`` it
    becomes null and ``parse_error`` is set, so a caller can route the row aside. Quarantine knows the
    default format only: no Spark function parses leniently without going through the session's zone."""
    if quarantine:
        if fmt != TIMESTAMP_FORMAT:
            raise ValueError(f"quarantine parses {TIMESTAMP_FORMAT} only")
        parsed = F.when(F.col(column).rlike(TIMESTAMP_PATTERN), F.col(column).try_cast("timestamp_ntz"))
        return df.withColumn("parsed_", parsed).select(
            *[F.col("parsed_").alias(c) if c == column else F.col(c) for c in df.columns],
            (F.col("parsed_").isNull() & F.col(column).isNotNull()).alias("parse_error"),
        )
    return df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(fmt)))
