import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 94


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, sf_dir, key):
    _, _, verdict = compare(spark, con, key, sf_dir)
    assert verdict == "ok", verdict


def test_entry_profiles_the_day(spark):
    out = entry.entry(spark)
    assert out.columns == ["hour", "weekday", "weekend"] and out.count() == 24


def test_results_do_not_depend_on_the_session_zone(spark, con, sf_dir):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for key in ("day_lookup", "parse_timestamps", "chronological_split", "weekday_weekend_compare", "coverage_gaps", "annual_trend"):
            _, _, verdict = compare(spark, con, key, sf_dir)
            assert verdict == "ok", f"{key}: {verdict}"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_no_python_rows_in_the_plans(spark, sf_dir):
    for key in ("timestamp_aggregate", "feature_pipeline", "association_rules", "recommendation_report", "feature_drift_ks"):
        plan = entry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, f"{key}: {node}"
