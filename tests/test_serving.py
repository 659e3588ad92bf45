"""Serving by alias, versions, and records that cannot be read."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hourtide.operators import models, registry
from hourtide.plans import jobs
from hourtide.sources.readers import read_observations_aside
from hourtide.streaming.score_stream import AliasedModel, request_stream, start_serving


@pytest.fixture(scope="module")
def two_models(spark, tmp_path_factory):
    """A run table with two versions that predict 100 and 900, the first in production."""
    folder = str(tmp_path_factory.mktemp("models"))
    rows = spark.range(20).select((F.col("id") % 24).cast("double").alias("temp"))
    for level in (100, 900):
        spec = models.LINEAR
        fitted = models.fit(spec, rows.withColumn("traffic_volume", level + F.col("temp") * 0), ["temp"])
        fitted.write().overwrite().save(f"{folder}/{level}")
        found = spark.createDataFrame([(0.0, 1.0)], "mae double, r2 double").select(F.lit(spec.name).alias("model"), "*")
        registry.append_run(spark, f"{folder}/runs", spec, found, f"{folder}/{level}", "production" if level == 100 else None)
    return f"{folder}/runs"


def request(i):
    return (i, 1, 1, 0, 280.0, 0.0, 0.0, 50, "Clear", 0)


REQUEST = (
    "request_id bigint, hour int, day_of_week int, is_weekend int, temp double, rain_1h double, snow_1h double, clouds_all int, "
    "weather_main string, is_holiday int"
)


def test_alias_moves_between_batches(spark, two_models, tmp_path):
    serve = AliasedModel(lambda: registry.aliased_path(spark, two_models, "production"))
    for start in (0, 10):
        spark.createDataFrame([request(start + i) for i in range(3)] + [(start + 9, 77, 1, 0, 280.0, 0.0, 0.0, 50, "Clear", 0)], REQUEST).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = request_stream(spark, f"{tmp_path}/in")
        start_serving(stream, serve, (200.0, 400.0, 600.0), f"{tmp_path}/out").awaitTermination()
        registry.move_alias(spark, two_models, models.LINEAR.name, 2, "production")
    scored = {r["request_id"]: (r["predicted_traffic_volume"], r["congestion_level"]) for r in spark.read.parquet(f"{tmp_path}/out/scored").collect()}
    assert {i: scored[i] for i in (0, 1, 2)} == dict.fromkeys((0, 1, 2), (100.0, "low"))
    assert {i: scored[i] for i in (10, 11, 12)} == dict.fromkeys((10, 11, 12), (900.0, "very_high"))
    aside = {r["request_id"] for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect()}
    assert len(scored) == 6 and aside == {9, 19}
    with pytest.raises(LookupError):
        registry.move_alias(spark, two_models, models.LINEAR.name, 7, "production")


def test_writers_at_once_take_different_versions(spark, two_models):
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda _: registry.claim_version(spark, two_models, "other"), range(8)))
    assert sorted(taken) == list(range(1, 9))


def test_unreadable_records_go_aside(spark, tmp_path):
    header = "holiday,temp,rain_1h,snow_1h,clouds_all,weather_main,weather_description,date_time,traffic_volume"
    lines = [
        "None,280.5,0.0,0.0,40,Clear,sky is clear,2012-10-02 09:00:00,5545",
        "None,warm,0.0,0.0,many,Clear,sky is clear,2012-10-02 10:00:00,5545",
        'Labor Day,281,0,0,40,Clear,"clear, but cold",2012-10-02 11:00:00,10',
        "None,280.5,0.0",
        "None,280.5,0.0,0.0,40,Clear,sky is clear,2012-10-02 09:00:00,5545,extra",
        "None,,,,,,,,",
        "None,280.5,0.0,0.0,4.5,Clear,sky,2012-10-02 12:00:00,7",
    ]
    (tmp_path / "a.csv").write_text("\n".join([header, *lines]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, lines[0]]) + "\n")
    good, aside = read_observations_aside(spark, str(tmp_path / "*.csv"))
    rows = good.orderBy("seq").collect()
    assert [r["temp"] for r in rows] == [280.5, 281.0, None, 280.5]
    assert rows[1]["weather_description"] == "clear, but cold" and rows[0]["holiday"] is None
    found = {r["line"]: (r["reason"], r["columns"]) for r in aside.collect()}
    assert found == {
        lines[1]: ("values", ["temp", "clouds_all"]),
        lines[3]: ("fields", []),
        lines[4]: ("fields", []),
        lines[6]: ("values", ["clouds_all"]),
    }
    counts = {r["reason"]: r["count"] for r in aside.groupBy("reason").count().collect()}
    assert counts == {"values": 2, "fields": 2}


def test_a_batch_does_not_compute_the_means_again(spark, sf_dir):
    predict = jobs.mean_predictor(spark, sf_dir)
    scored = predict(spark.createDataFrame([(0, 0), (7, 1)], "hour int, is_weekend int"))
    assert "Aggregate" not in scored._jdf.queryExecution().optimizedPlan().toString()
    fitted = jobs.training_rows(spark, sf_dir).where("hour = 7 and is_weekend = 1").agg(F.avg("traffic_volume")).first()[0]
    assert {r["hour"]: r["prediction"] for r in scored.collect()}[7] == pytest.approx(fitted)
