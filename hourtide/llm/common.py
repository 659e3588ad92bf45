"""What the operators of this package share: reading tables and cutting jobs at written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtide.sources.stages import write_stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The same lower-casing for UTF-8 bytes: other bytes, and so all other letters, stay.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows does not recompute it, and the
    planner knows its size."""
    return write_stage(df, name)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has this name in any spelling of case."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash with them."""
    return df.select(*[df[f"`{given}`"].alias(own) for own, given in columns.items()])


def crc32_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal digits modulo ``divisor``; a missing id counts as 0."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(divisor)), F.lit(0))


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)

