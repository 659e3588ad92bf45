import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourtide.functions import calendar as cal
from hourtide.functions import lookups
from hourtide.operators import histograms, profile, trends
from hourtide.sources.observations import observations

H = dt.datetime


def test_null_and_blank_counts(raw):
    df = raw({"holiday": ""}, {"holiday": "Labor Day", "temp": None}, {"weather_main": ""})
    row = profile.null_blank_counts(df).first()
    assert (row["holiday_nulls"], row["temp_nulls"], row["weather_main_nulls"], row["date_time_nulls"]) == (2, 1, 1, 0)


def test_volume_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-1, 0, 4500, 4501, 5500, 5501, None)], "v int")
    got = [r[0] for r in df.select(lookups.volume_band(F.col("v"))).collect()]
    assert got == [None, "Low", "Low", "Medium", "Medium", "High", None]


def test_probabilities_without_the_event(raw):
    df = raw({}, {"weather_main": "Rain"})
    row = profile.conditional_probabilities(df, profile.congested(), {"clear": profile.in_weather("Clear")}).first()
    assert row["p_clear"] == 0.0
    joint = profile.joint_probabilities(df, profile.congested(), profile.in_weather("Clear")).first()
    assert joint["p_ab"] <= min(joint["p_a"], joint["p_b"])


def test_odds_ratio_on_the_published_counts(spark):
    cells = [("Clear", 6000, 1763), ("Clear", 1, 11628), ("Clouds", 6000, 2592), ("Clouds", 1, 12572)]
    df = spark.createDataFrame(cells, "w string, v int, n int").withColumn("i", F.explode(F.expr("sequence(1, n)")))
    row = profile.odds_ratio(df, F.col("v") > 5500, "w", "Clear", "Clouds").first()
    assert round(row["odds_ratio"], 3) == 0.735 and row["direction"] == "more likely in second"


def test_odds_ratio_is_undefined_when_a_cell_is_empty(raw):
    row = profile.odds_ratio(raw({}), profile.congested(), "weather_main", "Clear", "Clouds").first()
    assert row["odds_ratio"] is None and row["direction"] == "undefined"


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    a = {r[0] for r in profile.sample_n(df, ["id"], 100).collect()}
    b = {r[0] for r in profile.sample_n(df.repartition(7), ["id"], 100).collect()}
    assert len(a) == 100 and a == b
    assert profile.sample_n(df, ["id"], 5000).count() == 1000


def test_distinct_count_exact_and_estimated(spark):
    df = spark.range(1000).selectExpr("id % 200 as date_time")
    assert profile.unique_values(df).first()[0] == 200
    assert abs(profile.unique_values(df, approximate=True).first()[0] - 200) <= 20


def test_day_lookup_rejects_a_bad_date_and_pushes_the_range(spark, tmp_path):
    with pytest.raises(ValueError, match="not a date"):
        cal.on_day(F.col("date_time"), "1997-15-06")
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'1997-06-15 05:00:00' date_time, 1 x").write.parquet(path)
    day = spark.read.parquet(path).where(cal.on_day(F.col("date_time"), "1997-06-15")).select("x")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 1
    assert "GreaterThanOrEqual(date_time,1997-06-15" in plan


def test_histogram_equals_numpy(spark, sf_dir):
    obs = observations(spark, sf_dir)
    values = np.array([r[0] for r in obs.select("traffic_volume").collect()])
    counts, edges = np.histogram(values, 50)
    out = histograms.histogram(obs, "traffic_volume").orderBy("bin").collect()
    assert [r["n"] for r in out] == counts.tolist()
    assert [r["upper"] for r in out] == pytest.approx(edges[1:].tolist())


def test_histogram_of_a_constant(spark):
    out = histograms.histogram(spark.createDataFrame([(3,)] * 5, "v int"), "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in out] == np.histogram([3] * 5, 4)[0].tolist()
    assert sum(r["n"] for r in out) == 5


def test_sample_histograms_integrate_to_one(spark):
    df = spark.createDataFrame([("a", float(i % 13)) for i in range(200)] + [("b", 1.0)] * 4, "split string, x double")
    out = histograms.sample_histograms(df, ["x"], "split", 10).collect()
    for name in "ab":
        area = sum(r["density"] * (r["upper"] - r["lower"]) for r in out if r["split"] == name)
        assert area == pytest.approx(1.0) and len([r for r in out if r["split"] == name]) == 10


def test_year_on_year_uses_rounded_means(raw):
    df = raw(
        {"traffic_volume": 100, "date_time": H(1999, 1, 1)},
        {"traffic_volume": 150, "date_time": H(2000, 1, 1)},
        {"traffic_volume": 151, "date_time": H(2000, 1, 1, 1)},
    )
    out = trends.yoy_change(df, 1999, 2000).orderBy("year").collect()
    assert out[0]["yoy_change"] is None
    assert (out[1]["avg_volume"], out[1]["yoy_change"], out[1]["yoy_pct_change"]) == (150.5, 50.5, 50.5)


def test_holiday_temperature_covers_all_hours_of_the_date(raw):
    df = raw(
        {"holiday": "Labor Day", "temp": 280.0},
        {"temp": 290.0, "date_time": H(2000, 1, 1, 13)},
        {"temp": 400.0, "date_time": H(2000, 1, 2)},
    )
    row = trends.holiday_temperature(df, ["Labor Day"], 2000, 2000).first()
    assert (row["hours_observed"], row["avg_temp_k"], row["max_temp_k"]) == (2, 285.0, 290.0)


def test_gaps_cross_months_without_data(raw, rows):
    df = raw(*[{"date_time": t} for t in (H(2000, 1, 31, 23), H(2000, 2, 1, 0), H(2000, 2, 1, 3), H(2000, 5, 1, 3))])
    out = rows(trends.coverage_gaps(df))
    assert out == [(H(2000, 2, 1, 0), H(2000, 2, 1, 3), 3.0), (H(2000, 2, 1, 3), H(2000, 5, 1, 3), 90 * 24.0)]
    assert rows(trends.coverage_gaps(df.where("false"))) == []


def test_ranking_drops_rare_categories(raw):
    df = raw({"traffic_volume": 10}, {"traffic_volume": 20}, {"weather_main": "Rain", "traffic_volume": 99})
    everything = trends.category_ranking(df).orderBy("place").collect()
    assert [r["weather_main"] for r in everything] == ["Rain", "Clear"] and everything[0]["value_range"] == 84.0
    assert [r["highest"] for r in trends.category_ranking(df, min_count=2).collect()] == ["Clear"]


def test_month_out_of_range(raw):
    with pytest.raises(ValueError, match="month"):
        trends.weekday_weekend_compare(raw({}), 13)
