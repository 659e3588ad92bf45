import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions import text
from hourtide.operators import clean, features, recommend
from hourtide.sources.observations import observations

H = dt.datetime


def test_time_features(raw):
    row = features.time_features(raw({"date_time": H(2000, 1, 1, 6)})).first()
    assert (row["hour"], row["day_of_week"], row["is_weekend"]) == (6, 5, 1)
    assert row["hour_sin"] == pytest.approx(1.0) and row["dow_cos"] == pytest.approx(math.cos(2 * math.pi * 5 / 7))


def test_every_hour_of_a_labelled_date_is_a_holiday(raw, rows):
    df = raw(
        {"holiday": "Labor Day"},
        {"holiday": fv.NO_HOLIDAY, "date_time": H(2000, 1, 1, 23)},
        {"holiday": fv.NO_HOLIDAY, "date_time": H(2000, 1, 2)},
    )
    assert rows(features.holiday_flag(df), "seq", "is_holiday") == [(0, 1), (1, 1), (2, 0)]


def test_low_visibility_needs_clouds_and_category(raw, rows):
    df = raw({"weather_main": "Fog", "clouds_all": 81}, {"weather_main": "Fog", "clouds_all": 80}, {"weather_main": None})
    out = rows(features.weather_indicators(df), "seq", "is_low_visibility", "weather_severity", "is_rainy")
    assert out == [(0, 1, 3, 0), (1, 0, 3, 0), (2, 0, 2, 0)]


def test_constant_column_scales_to_null(raw, rows):
    df = raw({"temp": 1.0, "rain_1h": 0.0}, {"temp": 3.0, "rain_1h": 0.0}, {"temp": None})
    assert rows(features.minmax_scale(df, ["temp", "rain_1h"]), "seq", "temp_norm", "rain_1h_norm") == [
        (0, 0.0, None),
        (1, 1.0, None),
        (2, None, None),
    ]


def test_quartile_categories_close_on_the_right(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate((1, 2, 3, 4, 5, None))], "seq int, traffic_volume int")
    assert [c for _, c in rows(features.congestion_category(df), "seq", "congestion_category")] == [
        "Low", "Low", "Medium", "High", "Severe", "Medium",
    ]


def test_featured_table_has_37_columns_in_order(spark, sf_dir):
    out = features.featurize(clean.clean(observations(spark, sf_dir)))
    assert len(out.columns) == 37 and out.columns[10] == "hour" and out.columns[-1] == "congestion_category"
    assert features.feature_columns(out)[:12] == fv.BASE_FEATURES and len(features.feature_columns(out)) == 23
    hot = [f"weather_{c}" for c in fv.WEATHER_CATEGORIES]
    assert out.where(sum(F.col(c) for c in hot) != 1).count() == 0
    shares = dict(out.groupBy("congestion_category").count().collect())
    assert set(shares) == set(fv.QUARTILE_LABELS)
    assert max(shares.values()) - min(shares.values()) < 0.02 * sum(shares.values())


def test_hour_labels(spark):
    df = spark.createDataFrame([(h,) for h in (0, 1, 11, 12, 13, 23)], "h int")
    got = [tuple(r) for r in df.select(text.hour_label(F.col("h")), text.hour_range_label(F.col("h"))).collect()]
    assert [g[0] for g in got] == ["12:00 AM", "1:00 AM", "11:00 AM", "12:00 PM", "1:00 PM", "11:00 PM"]
    assert got[-1][1] == "11:00 PM – 12:00 AM"


HOURLY = "day_type string, weather_category string, weather_main string, hour int, is_weekend int, traffic_volume double"


def hourly(spark, *rows):
    return spark.createDataFrame([("weekday", "Rain", "Rain", h, 0, v) for h, v in rows], HOURLY)


def test_best_hours_rank_travel_hours_only(spark, rows):
    df = hourly(spark, (3, 1.0), (6, 50.0), (7, 100.0), (8, 100.0), (9, 50.0))
    out = recommend.best_hours_exact(df, "weekday", "rain", 2)
    assert rows(out, "place", "hour", "pct_below_peak", "peak_hour") == [(1, 6, 50.0, 7), (2, 9, 50.0, 7)]


def test_all_hours_are_used_when_none_is_a_travel_hour(spark, rows):
    out = recommend.best_hours_exact(hourly(spark, (2, 5.0), (23, 4.0)), "weekday", "Rain")
    assert [h for _, h in rows(out, "place", "hour")] == [23, 2]


def test_unknown_weather_gives_nothing_and_bad_day_type_fails(spark):
    df = hourly(spark, (8, 5.0))
    assert recommend.best_hours_exact(df, "weekday", "Ash").count() == 0
    with pytest.raises(ValueError, match="day_type"):
        recommend.recommend_travel_time(df, "monday", "Rain")


def test_wording(spark):
    df = hourly(spark, (13, 1234.4), (17, 4937.6))
    message = recommend.recommend_travel_time(df, "weekday", "Rain", 1).first()["message"]
    assert message == (
        "For a weekday journey in rain weather, consider travelling between 1:00 PM – 2:00 PM, "
        "when traffic is typically ~1,234 vehicles/hour (75% below the 5:00 PM peak)."
    )
    warning = recommend.peak_hours(df, 1).first()["message"]
    assert warning == "Avoid travelling between 5:00 PM – 6:00 PM on weekdays — average volume reaches 4,938 vehicles/hour."


def test_zero_peak_is_zero_percent_below(spark):
    assert recommend.best_hours_exact(hourly(spark, (8, 0.0)), "weekday", "Rain").first()["pct_below_peak"] == 0.0


def test_unlisted_categories_have_their_flag(spark):
    df = spark.createDataFrame([("Rain",), ("Tornado",), (None,)], "weather_main string")
    out = features.one_hot_weather(df, ["Rain", "Snow"], other="weather_other").collect()
    assert [(r["weather_Rain"], r["weather_Snow"], r["weather_other"]) for r in out] == [(1, 0, 0), (0, 0, 1), (0, 0, 1)]
