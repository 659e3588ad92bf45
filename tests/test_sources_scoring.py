import json
import os

import pytest
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.operators import clean, features, models, scoring
from hourtide.plans import jobs
from hourtide.session import checkpoint_folder
from hourtide.sources import readers, sinks, stages
from hourtide.sources.observations import observations, scoring_requests
from hourtide.streaming.score_stream import request_stream, start_scoring

HEADER = ",".join(fv.RAW_COLUMNS)
LINES = [
    "None,281.5,0.0,0.0,35,Clouds,thin veil,2003-05-06 09:00:00,4321",
    "May Day,270.25,,0.0,2,Clear,blue,2003-05-01 00:00:00,321",
    "None,281.5,0.0,0.0,35,Clouds,thin veil,2003-05-06 09:00:00,4321",
]


@pytest.fixture
def csv_file(tmp_path):
    def write(lines, name="raw.csv"):
        path = tmp_path / name
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


def test_csv_scan_is_typed_and_keeps_the_file_order(spark, csv_file):
    df = readers.read_observations_csv(spark, csv_file(LINES))
    out = df.orderBy("seq").collect()
    assert [r["traffic_volume"] for r in out] == [4321, 321, 4321]
    assert dict(df.dtypes)["seq"] == "bigint"
    assert out[0]["holiday"] is None and out[1]["holiday"] == "May Day" and out[1]["rain_1h"] is None
    assert df.schema["temp"].dataType.typeName() == "double"


def test_literal_none_can_stay_text(spark, csv_file):
    df = readers.read_observations_csv(spark, csv_file(LINES), null_value=None)
    assert df.where("holiday = 'None'").count() == 2


def test_bad_number_and_missing_file_fail(spark, csv_file):
    bad = csv_file([LINES[0].replace("4321", "many")])
    with pytest.raises(Exception):
        readers.read_observations_csv(spark, bad).collect()
    with pytest.raises(Exception, match="(?i)path"):
        readers.read_observations_csv(spark, "/nowhere/raw.csv").collect()


def test_file_order_spans_files(spark, tmp_path, csv_file):
    csv_file([LINES[1]] * 1, "b.csv")
    csv_file([LINES[0]] * 50, "a.csv")
    df = readers.read_observations_csv(spark, str(tmp_path / "*.csv"))
    assert df.orderBy("seq").collect()[-1]["holiday"] == "May Day"
    assert clean.clean(df).count() == 2


def test_split_file_keeps_its_order(spark, csv_file):
    lines = [f"None,281.5,0.0,0.0,35,Clouds,text,2003-05-06 09:00:00,{i}" for i in range(5000)]
    path = csv_file(lines, "long.csv")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_observations_csv(spark, path)
        assert spark.read.csv(path).rdd.getNumPartitions() > 3
        assert [r["traffic_volume"] for r in df.orderBy("seq").select("traffic_volume").collect()] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_csv_to_cleaned_to_featured(spark, csv_file, tmp_path):
    df = readers.read_observations_csv(spark, csv_file(LINES))
    cleaned = clean.clean(df)
    out = {r["date_time"].hour: r for r in cleaned.collect()}
    assert len(out) == 2 and out[9]["n_weather_conditions"] == 1 and out[0]["rain_1h"] == 0.0
    path = str(tmp_path / "featured")
    sinks.replace_table(features.featurize(cleaned), path, sort_by="date_time")
    sinks.replace_table(features.featurize(cleaned), path, sort_by="date_time")
    back = readers.read_stage(spark, path)
    assert back.count() == 2 and len(back.columns) == 37


def test_quarantine_mode_keeps_bad_timestamps_apart(spark):
    df = spark.createDataFrame([("2000-01-01 00:00:00",), ("yesterday",), ("2000-13-01 00:00:00",), ("2000-1-1",), (None,)], "date_time string")
    out = readers.parse_timestamps(df, quarantine=True).collect()
    assert sorted(r["parse_error"] for r in out) == [False, False, True, True, True]
    assert sum(r["date_time"] is not None for r in out) == 1


def test_sinks_write_csv_json_and_text(spark, tmp_path):
    df = spark.sql("select 1 a, named_struct('b', array(1, 2)) s")
    sinks.write_csv(df.select("a"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["a"]
    sinks.write_json(df, str(tmp_path / "j"))
    part = next(f for f in os.listdir(tmp_path / "j") if f.endswith(".json"))
    assert json.loads((tmp_path / "j" / part).read_text()) == {"a": 1, "s": {"b": [1, 2]}}
    sinks.write_report(spark.sql("select 'hello' line"), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first()[0] == "hello"


def test_stage_tables_live_in_the_shared_folder(spark, sf_dir):
    staged = stages.write_stage(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].startswith("file:" + "//" + checkpoint_folder(spark))
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert stages.shared_stage(spark, sf_dir, "three", build).count() == 3
    assert len(calls) == 1


SAMPLES = [
    (1, 8, 1, 0, 280.0, 0.0, 0.0, 10, "Clear", 0),
    (2, 19, 5, 1, 290.0, 5.0, 0.0, 90, "Rain", 0),
    (3, 12, 3, 0, 295.0, 0.0, 0.0, 75, "Clouds", 0),
    (4, 2, 0, 0, 260.0, 0.0, 3.0, 100, "Snow", None),
    (5, 12, 0, 0, 270.0, 0.0, 0.0, 5, "Clear", 1),
    (6, 17, 4, 0, 275.0, 0.0, 0.0, 100, "Fog", 0),
]
BROKEN = [
    ((7, 24, 1, 0, 280.0, 0.0, 0.0, 10, "Clear", 0), "hour"),
    ((8, 8, 7, 1, 280.0, 0.0, 0.0, 10, "Clear", 0), "day_of_week"),
    ((9, 8, 1, 2, 280.0, 0.0, 0.0, 10, "Clear", 0), "is_weekend,weekend_mismatch"),
    ((10, 8, 1, 0, None, 0.0, 0.0, 10, "Clear", 0), "temp"),
    ((11, 8, 1, 0, 280.0, -0.1, 0.0, 10, "Clear", 0), "rain_1h"),
    ((12, 8, 1, 0, 280.0, 0.0, -0.1, 10, "Clear", 0), "snow_1h"),
    ((13, 8, 1, 0, 280.0, 0.0, 0.0, 101, "Clear", 0), "clouds_all"),
    ((14, 8, 1, 0, 280.0, 0.0, 0.0, 10, None, 0), "weather_main"),
    ((15, 8, 1, 0, 280.0, 0.0, 0.0, 10, "Clear", 2), "is_holiday"),
    ((16, 8, 6, 0, 280.0, 0.0, 0.0, 10, "Clear", 0), "weekend_mismatch"),
]


def test_validation_names_the_broken_rules(spark):
    df = spark.createDataFrame(SAMPLES + [r for r, _ in BROKEN], fv.REQUEST_SCHEMA)
    assert scoring.validate_requests(df).where("is_valid").count() == len(SAMPLES)
    found = dict(tuple(r) for r in scoring.quarantined(df).collect())
    assert found == {r[0]: problem for r, problem in BROKEN}
    lenient = scoring.validate_requests(df, check_weekend=False).where("is_valid")
    assert lenient.count() == len(SAMPLES) + 1
    assert scoring.validate_requests(df.drop("is_holiday")).where("request_id = 1").first()["is_holiday"] == 0


@pytest.fixture(scope="module")
def served(spark, sf_dir):
    table = jobs.featured_table(spark, sf_dir)
    model = models.fit(models.GBT.with_params(maxIter=2), table, features.feature_columns(table))
    return model, jobs.serving_thresholds(table)


def test_scores_are_banded_by_the_training_quartiles(spark, served):
    model, cuts = served
    out = scoring.score(spark.createDataFrame(SAMPLES, fv.REQUEST_SCHEMA), model, cuts).collect()
    assert len(out) == 6 and all(r["predicted_traffic_volume"] >= 0 for r in out)
    for r in out:
        level = sum(r["predicted_traffic_volume"] > c for c in cuts)
        assert r["congestion_level"] == fv.SERVING_LEVELS[level]
    huge = scoring.score(spark.createDataFrame(SAMPLES, fv.REQUEST_SCHEMA), model, (1e9, 2e9, 3e9))
    assert {r["congestion_level"] for r in huge.collect()} == {"low"}


def test_request_features_equal_training_features(spark, sf_dir):
    table = jobs.featured_table(spark, sf_dir)
    names = features.feature_columns(table)
    asked = ["hour", "day_of_week", "is_weekend", "temp", "rain_1h", "snow_1h", "clouds_all", "weather_main", "is_holiday"]
    rebuilt = scoring.request_features(table.select("date_time", *asked)).select("date_time", *names)
    assert rebuilt.exceptAll(table.select("date_time", *names)).count() == 0


def test_stream_equals_batch(spark, sf_dir, served, tmp_path):
    model, cuts = served
    requests = scoring_requests(spark, sf_dir)
    requests.repartition(3).write.parquet(str(tmp_path / "in"))
    for started in start_scoring(request_stream(spark, str(tmp_path / "in"), 1), model, cuts, str(tmp_path / "out")):
        started.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out/scored"))
    batch = scoring.score(requests, model, cuts)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0
    aside = spark.read.parquet(str(tmp_path / "out/quarantine"))
    assert aside.exceptAll(scoring.quarantined(requests)).count() == 0
    assert aside.count() + streamed.count() == requests.count()


def test_observations_plant_every_defect(spark, sf_dir):
    obs = observations(spark, sf_dir)
    row = obs.agg(
        F.count_if(F.col("temp").isNull()).alias("nulls"),
        F.count_if(F.col("temp") == 0).alias("zeros"),
        F.count_if(F.col("rain_1h") > 9000).alias("rain"),
        F.count_if(F.col("holiday").isNotNull()).alias("holidays"),
    ).first()
    assert all(row[c] > 0 for c in row.__fields__)
