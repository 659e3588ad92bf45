"""Stage tables: the written cut points between cleaning, features and analysis.

A frame that several downstream passes read is written once to the shared checkpoint folder and read
back. That cuts lineage, gives later scans column pruning and filter pushdown, and lets lost executors
be replaced without recomputing the upstream shuffles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtide.session import checkpoint_folder

_known: dict[tuple[str, str], str] = {}


def write_stage(df: DataFrame, name: str, sort_by: str | None = None) -> DataFrame:
    """Write ``df`` under a fresh name in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(sort_by)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def listing(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and times of the files under ``folder``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    row = files.select(F.xxhash64("path", "length", "modificationTime").alias("mark")).agg(F.count("mark"), F.bit_xor("mark")).first()
    return f"{row[0]}-{row[1]}"


def shared_stage(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], sort_by: str | None = None) -> DataFrame:
    """The stage ``name`` of the tables under ``folder`` in this application, built on first use and again when their
    files have changed."""
    slot = (spark.sparkContext.applicationId, f"{name}:{folder}:{listing(spark, folder)}")
    if slot not in _known:
        df = build()
        path = f"{checkpoint_folder(spark)}/stages/{slot[0]}/{name}-{uuid.uuid4().hex}"
        # Ranges of the sort column per file, so that whole files can be skipped.
        (df.repartitionByRange(sort_by).sortWithinPartitions(sort_by) if sort_by else df).write.parquet(path)
        _known[slot] = path
    return spark.read.parquet(_known[slot])
