import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions.text import lower_text, title_text
from hourtide.operators import clean
from hourtide.sources.observations import observations
from hourtide.sources.readers import read_observations_csv

H = dt.datetime


def test_schema_check_lists_what_is_missing(raw):
    with pytest.raises(ValueError, match="rain_1h, temp"):
        clean.validate_schema(raw({}).drop("temp", "rain_1h"))
    extra = raw({}).withColumn("visibility", F.lit(1))
    assert clean.validate_schema(extra) is extra


def test_text_is_standardised_and_changes_are_null_safe(raw, rows):
    df = raw(
        {"weather_main": " heavy RAIN ", "weather_description": " Light Drizzle"},
        {"weather_main": "Clear", "weather_description": "sky", "holiday": "Labor Day"},
        {"weather_main": None, "weather_description": None},
    )
    out = rows(clean.standardise_text(df), "seq", "weather_main", "weather_description", "holiday")
    assert out[0] == (0, "Heavy Rain", "light drizzle", fv.NO_HOLIDAY)
    assert out[1] == (1, "Clear", "sky", "Labor Day")
    assert out[2] == (2, None, None, fv.NO_HOLIDAY)
    assert rows(clean.text_changes(df)) == [("holiday", 2), ("weather_description", 1), ("weather_main", 1)]


def test_exact_copies_collapse_null_equals_null_first_position_kept(raw, rows):
    df = raw({"seq": 5, "temp": None}, {"seq": 3, "temp": None}, {"seq": 9})
    once = clean.exact_dedupe(df)
    assert rows(once, "seq", "temp") == [(3, None), (9, 280.0)]
    assert rows(clean.exact_dedupe(once), "seq") == rows(once, "seq")


def test_repeat_profile(raw):
    a, b = H(2000, 1, 1), H(2000, 1, 2)
    df = raw({"date_time": a}, {"date_time": a, "temp": 1.0}, {"date_time": a, "traffic_volume": 7}, {"date_time": b})
    assert tuple(clean.repeat_profile(df).first()) == (1, 2, 1)
    assert tuple(clean.repeat_profile(df.where("false")).first()) == (0, 0, 0)


def test_one_row_per_timestamp(raw):
    df = raw(
        {"weather_main": "Rain", "weather_description": "b", "temp": 280.0, "holiday": "Labor Day", "traffic_volume": 9},
        {"weather_main": "Fog", "weather_description": "a", "temp": None, "traffic_volume": 1},
        {"weather_main": "Clear", "weather_description": "b", "temp": 290.0},
    )
    row = clean.timestamp_aggregate(df).first()
    assert row["weather_main"] == "Rain", "equal severity: the first row wins"
    assert row["weather_description"] == "b; a", "distinct, in first-seen order"
    assert row["temp"] == 285.0 and row["holiday"] == "Labor Day" and row["traffic_volume"] == 9
    assert row["n_weather_conditions"] == 3


def test_unknown_category_has_middle_severity(raw):
    df = raw({"weather_main": "Clouds"}, {"weather_main": "Tornado"})
    assert clean.timestamp_aggregate(df).first()["weather_main"] == "Tornado"
    df = raw({"weather_main": "Tornado"}, {"weather_main": "Rain"})
    assert clean.timestamp_aggregate(df).first()["weather_main"] == "Rain"


def test_nulls_take_the_median_of_their_month_over_all_years(raw, rows):
    df = raw(
        {"temp": 270.0, "traffic_volume": 10, "date_time": H(2000, 3, 1)},
        {"temp": 280.0, "traffic_volume": 13, "date_time": H(2001, 3, 2)},
        {"temp": None, "traffic_volume": None, "date_time": H(2002, 3, 3)},
        {"temp": 100.0, "date_time": H(2002, 4, 3)},
    )
    assert rows(clean.impute_nulls(df), "seq", "temp", "traffic_volume")[2] == (2, 275.0, 11.5)


def test_complete_columns_pass_through_the_imputation(raw, rows):
    df = raw({"temp": 1.5, "date_time": H(2000, 3, 1)}, {"temp": 2.5, "date_time": H(2000, 4, 1)})
    assert rows(clean.impute_nulls(df), "temp", "clouds_all") == [(1.5, 50.0), (2.5, 50.0)]
    assert clean.impute_nulls(df.where("false")).count() == 0


def test_outliers_take_the_median_of_valid_rows(raw, rows):
    df = raw(
        {"temp": 0.0, "date_time": H(2000, 3, 1)},
        {"temp": 270.0, "rain_1h": 9001.0, "date_time": H(2000, 3, 2)},
        {"temp": 272.0, "rain_1h": 1.0, "date_time": H(2000, 3, 3)},
        {"temp": 0.0, "date_time": H(2000, 5, 3)},
    )
    out = rows(clean.impute_outliers(df), "seq", "temp", "rain_1h")
    assert out[0] == (0, 271.0, 0.0)
    assert out[1] == (1, 270.0, 0.5)
    assert out[3] == (3, None, 0.0), "a month without valid readings gives null"


def test_averaging_hides_an_outlier_unless_outliers_come_first(raw):
    df = raw(
        {"temp": 0.0},
        {"temp": 280.0, "weather_main": "Rain"},
        {"temp": 290.0, "date_time": H(2000, 1, 1, 5)},
    )
    first_hour = F.col("date_time") == F.lit(H(2000, 1, 1)).cast("timestamp_ntz")
    assert clean.clean(df).where(first_hour).first()["temp"] == 140.0
    assert clean.clean(df, outliers_first=True).where(first_hour).first()["temp"] == (285.0 + 280.0) / 2


def test_clean_parses_text_timestamps_and_rejects_bad_ones(raw):
    df = raw({}).withColumn("date_time", F.lit("2000-01-01 00:00:00"))
    assert clean.clean(df).first()["date_time"] == H(2000, 1, 1)
    with pytest.raises(Exception, match="(?i)parse"):
        clean.clean(df.withColumn("date_time", F.lit("01/01/2000"))).collect()


def test_cleaned_table_shape_and_identities(spark, sf_dir):
    obs = observations(spark, sf_dir)
    out = clean.clean(obs)
    assert out.columns == [
        "date_time", "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
        "weather_main", "weather_description", "traffic_volume", "n_weather_conditions",
    ]
    log = {r["metric"]: r["value"] for r in clean.quality_log(obs).collect()}
    assert log["rows_in"] - log["exact_duplicates"] - log["extra_rows"] == log["rows_out"] == out.count()
    assert out.select("date_time").distinct().count() == log["rows_out"]
    assert out.agg(F.sum("n_weather_conditions")).first()[0] == log["rows_in"] - log["exact_duplicates"]


def test_timestamp_aggregate_equals_a_row_loop(spark, sf_dir):
    distinct = clean.exact_dedupe(clean.standardise_text(observations(spark, sf_dir)))
    frame = distinct.toPandas().sort_values("seq")
    expected = {}
    for stamp, group in frame.groupby("date_time"):
        rank = [fv.WEATHER_SEVERITY.get(w, 2) for w in group["weather_main"]]
        expected[stamp] = (
            group["weather_main"].iloc[rank.index(max(rank))],
            "; ".join(dict.fromkeys(group["weather_description"])),
            group["holiday"].iloc[0],
            group["traffic_volume"].iloc[0],
            len(group),
        )
    got = clean.timestamp_aggregate(distinct).toPandas()
    assert len(got) == len(expected)
    for r in got.itertuples():
        assert expected[pd.Timestamp(r.date_time)] == (
            r.weather_main, r.weather_description, r.holiday, r.traffic_volume, r.n_weather_conditions,
        )


def test_hot_timestamp_keeps_every_description(spark, raw):
    """Half of the rows share one timestamp; the list per timestamp holds distinct texts only."""
    hot = spark.range(3000).selectExpr(
        "id as seq", "cast(null as string) holiday", "280d temp", "0d rain_1h", "0d snow_1h", "cast(id % 100 as int) clouds_all",
        "'Rain' weather_main", "concat('text ', id % 5) weather_description",
        "timestamp_ntz'2000-01-01 00:00:00' date_time", "7 traffic_volume",
    )
    row = clean.timestamp_aggregate(clean.exact_dedupe(hot)).first()
    assert row["weather_description"] == "; ".join(f"text {i}" for i in range(5))
    assert row["n_weather_conditions"] == 100


def test_text_is_stripped_of_all_white_space_and_titled_by_letters(spark):
    cases = {"\tmist": "Mist", "o'neil x-y": "O'Neil X-Y", " heavy  RAIN\r\n": "Heavy  Rain", "3rd été": "3Rd Été", "": "", " ": "", "ab1cd": "Ab1Cd"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    out = df.select("t", title_text(F.col("t")).alias("title"), lower_text(F.col("t")).alias("lower")).collect()
    assert {r["t"]: r["title"] for r in out} == cases == {k: k.strip().title() for k in cases}
    assert all(r["lower"] == r["t"].strip().lower() for r in out)
    assert df.where("false").unionByName(spark.sql("select cast(null as string) as t")).select(title_text(F.col("t"))).first()[0] is None


@pytest.mark.parametrize("files", [1, 4])
def test_raw_rows_are_hashed_not_sorted(spark, tmp_path, files):
    """No sort aggregate reads raw rows: neither for copies nor on the first level per timestamp."""
    rows = spark.range(200).select(
        F.lit(None).cast("string").alias("holiday"), F.lit(1.5).alias("temp"), F.lit(0.0).alias("rain_1h"), F.lit(0.0).alias("snow_1h"),
        F.lit(40).alias("clouds_all"), F.lit("Clear").alias("weather_main"), F.lit("sky").alias("weather_description"),
        F.lit("2000-01-01 00:00:00").alias("date_time"), F.col("id").alias("traffic_volume"),
    )
    rows.repartition(files).write.option("header", True).csv(str(tmp_path / "raw"))
    df = read_observations_csv(spark, str(tmp_path / "raw"))
    assert dict(df.dtypes)["seq"] == "bigint"
    assert sorted(r["seq"] for r in df.select("seq").collect()) == list(range(200))
    plan = clean.exact_dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    per_ts = clean.timestamp_aggregate(df)._jdf.queryExecution().executedPlan().toString()
    # The deepest aggregates come last in the text.
    levels = [line.strip() for line in per_ts.splitlines() if "Aggregate(" in line]
    assert "SortAggregate" not in levels[-1] and "SortAggregate" not in levels[-2]
