"""Input views that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The text of the derived view, valid on Spark and on DuckDB. It plants every defect the
# cleaning handles: repeats, copies, nulls, 0 K, impossible rain, stray white space and case.
OBSERVATIONS_FROM_ORDERS = """
SELECT seq, holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume
FROM (
 SELECT o_orderkey AS seq,
  CASE WHEN h < 6 AND month(o_orderdate)=1 AND day(o_orderdate)=1 THEN 'New Years Day'
       WHEN h < 6 AND month(o_orderdate)=9 AND day(o_orderdate)=4 THEN 'Labor Day'
       WHEN h < 6 AND month(o_orderdate)=7 AND day(o_orderdate)=4 THEN 'Independence Day'
       WHEN h < 6 AND month(o_orderdate)=12 AND day(o_orderdate)=25 THEN 'Christmas Day' END AS holiday,
  CASE WHEN o_orderkey % 1201 = 3 THEN NULL WHEN o_orderkey % 997 = 5 THEN CAST(0 AS DOUBLE) ELSE CAST(250 + o_custkey % 57 AS DOUBLE) END AS temp,
  CASE WHEN o_orderkey % 4999 = 7 THEN CAST(9831.5 AS DOUBLE) WHEN o_orderkey % 9 = 0 THEN CAST(o_custkey % 40 AS DOUBLE) / 4 ELSE CAST(0 AS DOUBLE) END AS rain_1h,
  CASE WHEN o_custkey % 11 = 7 THEN CAST(o_custkey % 4 AS DOUBLE) / 8 ELSE CAST(0 AS DOUBLE) END AS snow_1h,
  CAST(o_custkey % 101 AS INT) AS clouds_all,
  CASE o_custkey % 11 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN chr(9) || 'mist ' WHEN 3 THEN 'Haze' WHEN 4 THEN 'DRIZZLE' WHEN 5 THEN 'Rain' WHEN 6 THEN 'Fog' WHEN 7 THEN 'Snow' WHEN 8 THEN 'Thunderstorm' WHEN 9 THEN 'Squall' ELSE 'Smoke' END AS weather_main,
  o_orderpriority AS weather_description,
  o_orderdate + h * INTERVAL '1' HOUR AS date_time,
  CAST(CASE WHEN h < 6 THEN 500 WHEN h < 10 THEN 5000 WHEN h < 16 THEN 4300 WHEN h < 19 THEN 5400 ELSE 2400 END + CAST(floor(o_totalprice / 100) AS BIGINT) % 1400 AS INT) AS traffic_volume
 FROM (SELECT *, CAST(o_orderkey % 24 AS INT) AS h FROM {orders})
)
"""

# Fixed value: one order in this many is repeated as an exact copy.
COPY_EVERY = 499


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations derived from ``orders``; ``seq`` is the file order."""
    base = spark.sql(OBSERVATIONS_FROM_ORDERS, orders=load(spark, sf_dir, "orders"))
    return base.unionAll(base.where(F.col("seq") % COPY_EVERY == 0))


def scoring_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests derived from ``orders``, some of them outside an accepted range."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return load(spark, sf_dir, "orders").select(
        key.alias("request_id"),
        F.when(key % 701 == 1, F.lit(24)).otherwise(key % 24).cast("int").alias("hour"),
        F.when(key % 709 == 2, F.lit(7)).otherwise(key % 7).cast("int").alias("day_of_week"),
        F.when(key % 719 == 3, F.lit(2)).otherwise((key % 7 >= 5).cast("int")).cast("int").alias("is_weekend"),
        (F.lit(250) + cust % 57).cast("double").alias("temp"),
        F.when(key % 727 == 4, F.lit(-1.0)).otherwise((cust % 40).cast("double") / 4).alias("rain_1h"),
        F.when(key % 733 == 5, F.lit(-0.5)).otherwise((cust % 4).cast("double") / 8).alias("snow_1h"),
        F.when(key % 739 == 6, F.lit(101)).otherwise(cust % 101).cast("int").alias("clouds_all"),
        F.when(cust % 13 == 12, F.lit("Tornado"))
        .otherwise(F.element_at(F.array(*[F.lit(w) for w in _REQUEST_WEATHER]), (cust % 11 + 1).cast("int")))
        .alias("weather_main"),
        F.when(key % 743 == 7, F.lit(3)).when(key % 31 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_holiday"),
    )


# Weather categories of the derived requests, by customer key.
_REQUEST_WEATHER = [
    "Clear",
    "Clouds",
    "Mist",
    "Haze",
    "Drizzle",
    "Rain",
    "Fog",
    "Snow",
    "Thunderstorm",
    "Squall",
    "Smoke",
]
