"""Sinks: replaceable tables, CSV, JSON status and text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_table(df: DataFrame, path: str, sort_by: str | None = None, partition_by: list[str] | None = None) -> None:
    """Drop-and-reload Parquet sink. ``sort_by`` orders rows inside each file, so that row groups and
    pages carry narrow min/max ranges and range filters skip them."""
    if sort_by:
        df = df.sortWithinPartitions(sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, for consumers outside Spark."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; nested columns stay nested."""
    df.write.mode("overwrite").json(path)


def write_report(lines: DataFrame, path: str, column: str = "line") -> None:
    """Text report from a one-column frame of formatted lines (a report is some dozens of rows)."""
    lines.select(column).coalesce(1).write.mode("overwrite").text(path)
