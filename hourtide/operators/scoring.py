"""Scoring of requests: validation, features, prediction, level. Batch and stream share all of it."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions.lookups import banded, low_visibility, weather_severity
from hourtide.operators.features import cyclic_features, one_hot_weather


def request_problems(check_weekend: bool = True) -> Column:
    """Array with the name of every rule a request breaks; empty for a valid request."""
    broken = []
    for name, (low, high) in fv.REQUEST_RANGES.items():
        c = F.col(name)
        bad = [c.isNull()]
        if low is not None:
            bad.append(c < low)
        if high is not None:
            bad.append(c > high)
        broken.append(F.when(reduce(lambda a, b: a | b, bad), F.lit(name)))
    broken.append(F.when(F.col("weather_main").isNull(), F.lit("weather_main")))
    if check_weekend:
        contradiction = F.col("is_weekend") != (F.col("day_of_week") >= 5).cast("int")
        broken.append(F.when(contradiction, F.lit("weekend_mismatch")))
    return F.array_compact(F.array(*broken))


def validate_requests(requests: DataFrame, check_weekend: bool = True) -> DataFrame:
    """Add ``problems`` and ``is_valid``. A missing holiday flag means no holiday."""
    if "is_holiday" in requests.columns:
        filled = requests.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
    else:
        filled = requests.withColumn("is_holiday", F.lit(0))
    return filled.withColumn("problems", request_problems(check_weekend)).withColumn("is_valid", F.size("problems") == 0)


def request_features(requests: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """The training features of a request, by the same expressions."""
    described = requests.withColumns(
        {
            "is_low_visibility": low_visibility(F.col("weather_main"), F.col("clouds_all")),
            "weather_severity": weather_severity(F.col("weather_main")),
        }
    )
    return one_hot_weather(cyclic_features(described), categories)


def score(requests: DataFrame, model: PipelineModel, thresholds: tuple[float, float, float], keep: str = "request_id", check_weekend: bool = True) -> DataFrame:
    """(key, predicted_traffic_volume, congestion_level) of the valid requests. Negative predictions
    become zero; the level uses the unrounded value."""
    valid = validate_requests(requests, check_weekend).where("is_valid")
    return graded(model.transform(request_features(valid)), thresholds, keep)


def graded(predicted: DataFrame, thresholds: tuple[float, float, float], keep: str = "request_id") -> DataFrame:
    """(key, predicted_traffic_volume, congestion_level) of rows with ``prediction``."""
    return predicted.withColumn("volume_", F.greatest(F.col("prediction"), F.lit(0.0))).select(
        keep,
        F.round("volume_", 2).alias("predicted_traffic_volume"),
        banded(F.col("volume_"), list(thresholds), fv.SERVING_LEVELS).alias("congestion_level"),
    )


def quarantined(requests: DataFrame, keep: str = "request_id", check_weekend: bool = True) -> DataFrame:
    """(key, problems) of the requests that are not scored."""
    return validate_requests(requests, check_weekend).where(~F.col("is_valid")).select(keep, F.array_join("problems", ",").alias("problems"))
