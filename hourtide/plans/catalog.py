"""The registered queries: key -> (spark, data folder) -> DataFrame.

Each reads the given tables through the derived observations, or a stage table Spark builds from them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions import calendar as cal
from hourtide.functions import lookups
from hourtide.functions.numeric import positive_if
from hourtide.operators import (
    clean,
    clusters,
    drift,
    features,
    histograms,
    lloyd,
    metrics,
    models,
    newton,
    profile,
    recommend,
    registry,
    rules,
    scoring,
    splits,
    trends,
)
from hourtide.plans import jobs
from hourtide.plans.jobs import FIRST_YEAR, LAST_YEAR, TEST_YEAR, TRAIN_THROUGH
from hourtide.session import checkpoint_folder
from hourtide.sources.observations import load, observations, scoring_requests
from hourtide.sources.readers import parse_timestamps
from hourtide.streaming.score_stream import AliasedModel, request_stream, start_serving

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    CATALOG[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Round every double: last digits depend on the order of summation. ``other`` sets the digits of
    single columns."""
    return df.select(*[F.round(c, other.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- scans and profiles -----------------------------------------------------------------------------


@query
def scan_typed(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return obs.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"{c}_n") for c in fv.RAW_COLUMNS])


@query
def validate_schema(spark, sf_dir):
    obs = clean.validate_schema(observations(spark, sf_dir))
    return profile.column_presence(obs, fv.RAW_COLUMNS + ["visibility"])


@query
def column_info(spark, sf_dir):
    return profile.column_info(observations(spark, sf_dir))


@query
def sample_rows(spark, sf_dir):
    return profile.sample_rows(observations(spark, sf_dir), ["seq"], 5)


@query
def sample_n(spark, sf_dir):
    obs = observations(spark, sf_dir).select("seq", "date_time", "temp", "traffic_volume")
    return profile.sample_n(obs, ["seq"], 5000)


@query
def row_count(spark, sf_dir):
    return profile.row_count(observations(spark, sf_dir))


@query
def unique_timestamps(spark, sf_dir):
    return profile.unique_values(observations(spark, sf_dir))


@query
def null_blank_counts(spark, sf_dir):
    return profile.null_blank_counts(observations(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(observations(spark, sf_dir))


@query
def standardise_text(spark, sf_dir):
    return clean.text_changes(observations(spark, sf_dir))


@query
def parse_timestamps_strict(spark, sf_dir):
    text = observations(spark, sf_dir).select("seq", F.col("date_time").cast("string").alias("date_time"))
    return parse_timestamps(text)


CATALOG["parse_timestamps"] = CATALOG.pop("parse_timestamps_strict")


@query
def day_lookup(spark, sf_dir):
    day = jobs.featured_table(spark, sf_dir).where(cal.on_day(F.col("date_time"), "1997-06-15"))
    return day.select("date_time", "hour", "traffic_volume", "weather_main", "temp").orderBy("date_time")


@query
def filter_year_range(spark, sf_dir):
    chosen = jobs.cleaned_table(spark, sf_dir).where(cal.years_between(F.col("date_time"), 1997, 1999))
    return chosen.select("date_time", "temp", "traffic_volume")


@query
def filter_membership(spark, sf_dir):
    cleaned = jobs.cleaned_table(spark, sf_dir)
    labelled = F.col("holiday").isin("New Years Day", "Labor Day")
    rainy = F.lower("weather_main").isin([w.lower() for w in fv.RAINY_WEATHER])
    return cleaned.where(labelled | rainy).select("date_time", "holiday", "weather_main")


@query
def volume_band(spark, sf_dir):
    band = lookups.volume_band(F.col("traffic_volume"))
    return observations(spark, sf_dir).groupBy(band.alias("volume_band")).agg(
        F.count(F.lit(1)).alias("n"), F.min("traffic_volume").alias("low"), F.max("traffic_volume").alias("high")
    )


@query
def kelvin_to_celsius(spark, sf_dir):
    obs = observations(spark, sf_dir)
    return rounded(obs.select("seq", "temp", (F.col("temp") - fv.KELVIN_OFFSET).alias("temp_celsius")))


@query
def distinct_categories(spark, sf_dir):
    return profile.distinct_categories(jobs.cleaned_table(spark, sf_dir))


# --- cleaning ---------------------------------------------------------------------------------------


@query
def exact_dedupe(spark, sf_dir):
    distinct = clean.exact_dedupe(clean.standardise_text(observations(spark, sf_dir)))
    return distinct.select("seq", *fv.RAW_COLUMNS)


@query
def repeat_profile(spark, sf_dir):
    return clean.repeat_profile(clean.exact_dedupe(clean.standardise_text(observations(spark, sf_dir))))


@query
def timestamp_aggregate(spark, sf_dir):
    distinct = clean.exact_dedupe(clean.standardise_text(observations(spark, sf_dir)))
    return rounded(clean.timestamp_aggregate(distinct))


@query
def timestamp_mean_dedupe(spark, sf_dir):
    return rounded(trends.timestamp_means(observations(spark, sf_dir)))


@query
def impute_null_monthly_median(spark, sf_dir):
    return clean.impute_nulls(observations(spark, sf_dir)).select("seq", "date_time", *fv.NUMERIC_COLUMNS)


@query
def detect_outliers(spark, sf_dir):
    flagged = clean.detect_outliers(jobs.hourly_table(spark, sf_dir))
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        positive_if(F.col("temp_outlier")).alias("temp_outliers"),
        positive_if(F.col("rain_1h_outlier")).alias("rain_1h_outliers"),
    )


@query
def impute_outlier_monthly_median(spark, sf_dir):
    return rounded(clean.impute_outliers(jobs.hourly_table(spark, sf_dir)).select("date_time", "temp", "rain_1h"))


@query
def clean_pipeline(spark, sf_dir):
    return rounded(clean.clean(observations(spark, sf_dir)))


@query
def quality_log(spark, sf_dir):
    return clean.quality_log(observations(spark, sf_dir))


@query
def holiday_flag(spark, sf_dir):
    return features.holiday_flag(jobs.cleaned_table(spark, sf_dir)).select("date_time", "holiday", "is_holiday")


@query
def severity_lookup(spark, sf_dir):
    return _per_category(jobs.cleaned_table(spark, sf_dir), lookups.weather_severity, "weather_severity")


@query
def weather_category(spark, sf_dir):
    return _per_category(jobs.cleaned_table(spark, sf_dir), lookups.weather_group, "weather_category")


@query
def weather_bucket(spark, sf_dir):
    return _per_category(jobs.cleaned_table(spark, sf_dir), lookups.weather_bucket, "weather_bucket")


def _per_category(df: DataFrame, expression: Callable[[Column], Column], name: str) -> DataFrame:
    weather = F.col("weather_main")
    return df.groupBy(weather, expression(weather).alias(name)).agg(F.count(F.lit(1)).alias("n"))


# --- trends -----------------------------------------------------------------------------------------


@query
def annual_trend(spark, sf_dir):
    return rounded(trends.annual_trend(observations(spark, sf_dir), FIRST_YEAR, LAST_YEAR))


@query
def yoy_change(spark, sf_dir):
    return trends.yoy_change(observations(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


@query
def annual_total_yoy(spark, sf_dir):
    return trends.annual_total_yoy(observations(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


@query
def holiday_temperature(spark, sf_dir):
    names = ["New Years Day", "Labor Day"]
    return rounded(trends.holiday_temperature(observations(spark, sf_dir), names, FIRST_YEAR, LAST_YEAR))


@query
def descriptive_stats(spark, sf_dir):
    return rounded(profile.descriptive_stats(observations(spark, sf_dir)), variance=3)


@query
def temp_volume_correlation(spark, sf_dir):
    return rounded(profile.correlation(observations(spark, sf_dir)))


@query
def congestion_probabilities(spark, sf_dir):
    return rounded(profile.joint_probabilities(observations(spark, sf_dir), profile.congested(), profile.in_weather("Clear")))


@query
def conditional_probabilities(spark, sf_dir):
    events = {"clear_given_congested": profile.in_weather("Clear"), "warm_given_congested": F.col("temp") > fv.WARM_ABOVE_KELVIN}
    return rounded(profile.conditional_probabilities(observations(spark, sf_dir), profile.congested(), events))


@query
def independence_test(spark, sf_dir):
    return rounded(profile.independence_test(observations(spark, sf_dir), profile.congested(), profile.in_weather("Clear")))


@query
def odds_ratio(spark, sf_dir):
    return rounded(profile.odds_ratio(observations(spark, sf_dir), profile.congested(), "weather_main", "Clear", "Clouds"))


@query
def daily_trend(spark, sf_dir):
    return rounded(trends.daily_trend(observations(spark, sf_dir), 1998, 2000))


@query
def hourly_profile(spark, sf_dir):
    return rounded(trends.hourly_profile(observations(spark, sf_dir), 2000))


@query
def category_ranking(spark, sf_dir):
    return rounded(trends.category_ranking(observations(spark, sf_dir)))


@query
def kpis(spark, sf_dir):
    return rounded(profile.kpis(observations(spark, sf_dir)))


@query
def hour_by_day_type(spark, sf_dir):
    return rounded(trends.hour_by_day_type(jobs.featured_table(spark, sf_dir)))


@query
def dow_hour_heatmap(spark, sf_dir):
    return rounded(trends.dow_hour_heatmap(jobs.featured_table(spark, sf_dir)))


@query
def hour_dow_heatmap(spark, sf_dir):
    return rounded(trends.hour_dow_heatmap(jobs.featured_table(spark, sf_dir)))


@query
def volume_histogram(spark, sf_dir):
    return rounded(histograms.histogram(jobs.featured_table(spark, sf_dir)))


@query
def drift_histogram(spark, sf_dir):
    rows = jobs.featured_rows(spark, sf_dir, "train", "production")
    return rounded(histograms.sample_histograms(rows, fv.DRIFT_FEATURES, "split"))


@query
def top_weather_scatter(spark, sf_dir):
    return rounded(trends.top_category_points(jobs.featured_table(spark, sf_dir)))


@query
def hourly_stats(spark, sf_dir):
    return rounded(recommend.hourly_stats(jobs.grouped_table(spark, sf_dir)))


@query
def weekday_weekend_compare(spark, sf_dir):
    return rounded(trends.weekday_weekend_compare(jobs.featured_table(spark, sf_dir)))


@query
def coverage_gaps(spark, sf_dir):
    return rounded(trends.coverage_gaps(observations(spark, sf_dir)))


@query
def category_counts(spark, sf_dir):
    return rounded(trends.category_counts(jobs.labelled_table(spark, sf_dir)))


@query
def pct_below_peak(spark, sf_dir):
    means = recommend.hourly_means(jobs.grouped_table(spark, sf_dir), ["day_type", "weather_category"])
    return rounded(recommend.pct_below_peak(means, ["day_type", "weather_category"]))


@query
def minmax_scale(spark, sf_dir):
    scaled = features.minmax_scale(jobs.cleaned_table(spark, sf_dir))
    return rounded(scaled.select("date_time", *[f"{c}_norm" for c in fv.SCALED_COLUMNS]))


@query
def quartile_category(spark, sf_dir):
    categorised = features.congestion_category(jobs.cleaned_table(spark, sf_dir))
    return categorised.select("date_time", "traffic_volume", "congestion_category")


@query
def peak_hours(spark, sf_dir):
    peaks = recommend.peak_hours(jobs.grouped_table(spark, sf_dir), 5)
    return rounded(peaks.select("day_type", "place", "hour", "mean_volume"))


@query
def best_hours_exact(spark, sf_dir):
    best = recommend.best_hours_exact(jobs.grouped_table(spark, sf_dir), "weekday", "RAIN")
    return rounded(best)


@query
def recommend_travel_time(spark, sf_dir):
    return recommend.recommend_travel_time(jobs.grouped_table(spark, sf_dir), "weekend", "Fog")


@query
def recommendation_report(spark, sf_dir):
    return recommend.recommendation_report(jobs.grouped_table(spark, sf_dir))


# --- features ---------------------------------------------------------------------------------------


@query
def time_features(spark, sf_dir):
    stamped = features.time_features(jobs.cleaned_table(spark, sf_dir).select("date_time"))
    return rounded(stamped)


@query
def one_hot_weather(spark, sf_dir):
    return features.one_hot_weather(jobs.cleaned_table(spark, sf_dir).select("date_time", "weather_main"))


@query
def weather_indicators(spark, sf_dir):
    cleaned = jobs.cleaned_table(spark, sf_dir).select("date_time", "weather_main", "clouds_all")
    return rounded(features.weather_indicators(cleaned))


@query
def feature_pipeline(spark, sf_dir):
    return rounded(features.featurize(jobs.cleaned_table(spark, sf_dir)))


@query
def feature_columns(spark, sf_dir):
    table = jobs.featured_table(spark, sf_dir)
    info = profile.column_info(table.select(*features.feature_columns(table)))
    return info.select("position", "name", "n_values")


@query
def proxy_label(spark, sf_dir):
    labelled = features.risk_label(jobs.featured_table(spark, sf_dir))
    return rounded(
        labelled.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("high_risk").cast("bigint").alias("high_risk_n"),
            F.avg(F.col("high_risk").cast("double")).alias("high_risk_rate"),
        )
    )


@query
def time_of_day_band(spark, sf_dir):
    part = cal.day_part(F.col("hour"))
    return jobs.featured_table(spark, sf_dir).groupBy("hour", part.alias("time_of_day")).agg(F.count(F.lit(1)).alias("n"))


@query
def day_type(spark, sf_dir):
    kind = cal.day_type(F.col("is_weekend"))
    return jobs.featured_table(spark, sf_dir).groupBy("day_of_week", kind.alias("day_type")).agg(F.count(F.lit(1)).alias("n"))


# --- learning ---------------------------------------------------------------------------------------


@query
def chronological_split(spark, sf_dir):
    return splits.split_counts(jobs.labelled_table(spark, sf_dir))


@query
def holdout_tail_split(spark, sf_dir):
    return splits.holdout_tail(jobs.training_rows(spark, sf_dir)).select("date_time", "part")


@query
def standard_scale(spark, sf_dir):
    columns = ["temp", "rain_1h", "clouds_all", "hour_sin"]
    in_train = cal.through_year(F.col("date_time"), TRAIN_THROUGH)
    scaled = splits.standard_scale(jobs.featured_table(spark, sf_dir), columns, in_train)
    return rounded(scaled.select("date_time", *[f"{c}_z" for c in columns]))


@query
def class_weights(spark, sf_dir):
    return rounded(splits.class_weights(jobs.training_rows(spark, sf_dir)))


@query
def logistic_high_risk(spark, sf_dir):
    return jobs.evaluated(spark, sf_dir, models.LOGISTIC)


@query
def logistic_newton(spark, sf_dir):
    """The weighted, penalised logistic optimum on two inputs, and what is left of its gradient."""
    rows = splits.with_class_weights(jobs.training_rows(spark, sf_dir))
    found = newton.logistic_newton(rows, ["hour_cos", "is_weekend"], "high_risk", "weight")
    return rounded(found.select("term", "coefficient", F.abs("gradient").alias("gradient")), 4)


@query
def forest_high_risk(spark, sf_dir):
    return jobs.evaluated(spark, sf_dir, models.FOREST_CLASSIFIER)


@query
def linear_volume(spark, sf_dir):
    return jobs.evaluated(spark, sf_dir, models.LINEAR)


@query
def linear_coefficients(spark, sf_dir):
    """Least squares on two inputs that are not collinear: intercept and slopes."""
    names = ["hour_cos", "is_weekend"]
    fitted = models.fit(models.LINEAR, jobs.training_rows(spark, sf_dir), names).stages[-1]
    row = (float(fitted.intercept), *[float(c) for c in fitted.coefficients])
    return rounded(spark.createDataFrame([row], "intercept double, hour_cos double, is_weekend double"), 4)


@query
def gbt_volume(spark, sf_dir):
    return jobs.evaluated(spark, sf_dir, models.GBT)


@query
def forest_volume(spark, sf_dir):
    return jobs.evaluated(spark, sf_dir, models.FOREST)


@query
def feature_importance(spark, sf_dir):
    names = features.feature_columns(jobs.featured_table(spark, sf_dir))
    tables = [
        models.feature_importance(jobs.trained(spark, sf_dir, spec), names, spark).withColumn("task", F.lit(task))
        for task, spec in (("classification", models.FOREST_CLASSIFIER), ("regression", models.GBT))
    ]
    return tables[0].unionByName(tables[1])


def _baseline_regression(spark, sf_dir) -> DataFrame:
    rows = jobs.featured_rows(spark, sf_dir, "train", "test")
    return jobs.hour_day_prediction(rows, F.col("split") == "train").where(F.col("split") == "test")


def _baseline_classification(spark, sf_dir) -> DataFrame:
    rows = jobs.featured_rows(spark, sf_dir, "train", "test")
    return jobs.weather_hour_risk(rows, F.col("split") == "train").where(F.col("split") == "test")


@query
def regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(_baseline_regression(spark, sf_dir), "traffic_volume"))


@query
def classification_metrics(spark, sf_dir):
    return rounded(metrics.classification_metrics(_baseline_classification(spark, sf_dir), "high_risk"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_baseline_classification(spark, sf_dir), "high_risk")


@query
def error_by_slice(spark, sf_dir):
    quarter = F.quarter("date_time").cast("string")
    rows = _baseline_regression(spark, sf_dir).withColumn("quarter", quarter)
    return rounded(metrics.error_by_slice(rows, {"hour": "hour", "weather": "weather_main", "quarter": "quarter"}, "traffic_volume"))


@query
def kmeans_k_sweep(spark, sf_dir):
    return clusters.k_sweep(jobs.featured_table(spark, sf_dir))


@query
def kmeans_profiles(spark, sf_dir):
    return clusters.cluster_profiles(jobs.featured_table(spark, sf_dir))


@query
def kmeans_seeded(spark, sf_dir):
    """Ten runs of four clusters, the best by cost."""
    return rounded(lloyd.seeded_kmeans(jobs.featured_table(spark, sf_dir), fv.CLUSTER_FEATURES, [4], most_steps=30))


@query
def centre_profiles(spark, sf_dir):
    """Assignment to given centres, with the profiles and names of the clusters."""
    labelled = clusters.assigned_to(jobs.featured_table(spark, sf_dir), fv.REFERENCE_CENTRES)
    return rounded(clusters.profiles_of(labelled))


@query
def association_rules(spark, sf_dir):
    return _rules_as_text(rules.association_rules(jobs.featured_table(spark, sf_dir), rules.basket_columns()))


@query
def top_association_rules(spark, sf_dir):
    found = rules.association_rules(jobs.featured_table(spark, sf_dir), rules.basket_columns())
    return _rules_as_text(rules.top_rules(found, 5))


def _rules_as_text(found: DataFrame) -> DataFrame:
    return rounded(
        found.select(
            F.array_join("antecedent", ",").alias("antecedent"),
            F.array_join("consequent", ",").alias("consequent"),
            "support",
            "confidence",
            "lift",
        )
    )


@query
def model_leaderboard(spark, sf_dir):
    """Evaluates the five models, appends their runs to the run table of this input, and reads it back."""
    for spec in (models.LINEAR, models.GBT, models.FOREST, models.LOGISTIC, models.FOREST_CLASSIFIER):
        jobs.record(spark, sf_dir, spec, jobs.PRODUCTION if spec == models.GBT else None)
    return registry.leaderboard(spark, jobs.run_table(spark, sf_dir))


@query
def validate_requests(spark, sf_dir):
    checked = scoring.validate_requests(scoring_requests(spark, sf_dir))
    return checked.select("request_id", "is_valid", F.array_join("problems", ",").alias("problems"))


@query
def batch_score(spark, sf_dir):
    """Requests scored by the model with the production alias."""
    cuts = jobs.serving_thresholds(jobs.featured_table(spark, sf_dir))
    return scoring.score(scoring_requests(spark, sf_dir), models.load(spark, jobs.production_path(spark, sf_dir)), cuts)


@query
def baseline_score(spark, sf_dir):
    """Requests scored by the training mean of their hour and day type instead of a model."""
    cuts = jobs.serving_thresholds(jobs.featured_table(spark, sf_dir))
    valid = scoring.validate_requests(scoring_requests(spark, sf_dir)).where("is_valid")
    return scoring.graded(jobs.mean_predictor(spark, sf_dir)(valid), cuts)


def _served(spark, sf_dir, predictor) -> DataFrame:
    out = f"{checkpoint_folder(spark)}/streams/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    scoring_requests(spark, sf_dir).write.parquet(f"{out}/requests")
    cuts = jobs.serving_thresholds(jobs.featured_table(spark, sf_dir))
    start_serving(request_stream(spark, f"{out}/requests"), predictor, cuts, out).awaitTermination()
    return spark.read.parquet(f"{out}/scored").drop("model", "batch")


@query
def stream_score(spark, sf_dir):
    """The request stream, each batch scored by the model that has the production alias then."""
    return _served(spark, sf_dir, AliasedModel(lambda: jobs.production_path(spark, sf_dir)))


@query
def stream_baseline(spark, sf_dir):
    """The same stream scored by training means instead of a model."""
    means = jobs.mean_predictor(spark, sf_dir)
    return _served(spark, sf_dir, lambda: ("means", means))


@query
def permutation_importance(spark, sf_dir):
    test = jobs.featured_rows(spark, sf_dir, "test")
    names = features.feature_columns(test)
    return models.permutation_importance(jobs.trained(spark, sf_dir, models.GBT), test, names, "traffic_volume", "date_time")


# --- drift ------------------------------------------------------------------------------------------


@query
def feature_drift_ks(spark, sf_dir):
    found = drift.feature_drift_ks(jobs.featured_rows(spark, sf_dir, "train", "production"))
    return rounded(found.select("feature", "n_first", "n_second", "ks_statistic", "p_value", "status"))


@query
def prediction_error_drift(spark, sf_dir):
    return rounded(drift.prediction_error_drift(jobs.monitored(spark, sf_dir), "traffic_volume"))


@query
def model_error_drift(spark, sf_dir):
    """The error of boosted trees fitted on the ``fit`` rows, on the holdout and in production."""
    return drift.prediction_error_drift(jobs.monitored_by_trees(spark, sf_dir), "traffic_volume")


@query
def monitoring_summary(spark, sf_dir):
    return rounded(drift.monitoring_summary(*jobs.monitoring_checks(spark, sf_dir)))


@query
def drift_status_json(spark, sf_dir):
    status = drift.monitoring_status(*jobs.monitoring_checks(spark, sf_dir))
    written = status.select(F.to_json(F.struct(*status.columns)).alias("status_json"))
    read = written.select(F.from_json("status_json", status.schema).alias("s"))
    return read.select(
        "s.overall_status",
        "s.overall_message",
        F.col("s.prediction_error_drift.status").alias("error_status"),
        F.col("s.prediction_error_drift.holdout_mae").alias("holdout_mae"),
        F.col("s.prediction_error_drift.production_mae").alias("production_mae"),
        F.col("s.prediction_error_drift.pct_change").alias("pct_change"),
        F.inline("s.feature_drift"),
    )


# --- the same operators on other tables -------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").select("ts", "event_type", "value")


@query
def events_hourly_profile(spark, sf_dir):
    return rounded(trends.hourly_profile(_events(spark, sf_dir), ts="ts", value="value"), 4)


@query
def events_dow_hour_heatmap(spark, sf_dir):
    stamped = _events(spark, sf_dir).select(cal.day_of_week(F.col("ts")).alias("day_of_week"), F.hour("ts").alias("hour"), "value")
    return rounded(trends.dow_hour_heatmap(stamped, "value"), 4)


@query
def events_category_ranking(spark, sf_dir):
    return rounded(trends.category_ranking(_events(spark, sf_dir), "event_type", "value"), 4)


@query
def events_gaps(spark, sf_dir):
    """The table lies within one month."""
    return rounded(trends.coverage_gaps(load(spark, sf_dir, "events"), 0.05, "ts"))


@query
def lineitem_descriptive_stats(spark, sf_dir):
    return rounded(profile.descriptive_stats(load(spark, sf_dir, "lineitem"), "l_quantity"))


@query
def lineitem_histogram(spark, sf_dir):
    return rounded(histograms.histogram(load(spark, sf_dir, "lineitem"), "l_quantity", 20))


@query
def lineitem_odds_ratio(spark, sf_dir):
    large = F.col("l_quantity") > 40
    return rounded(profile.odds_ratio(load(spark, sf_dir, "lineitem"), large, "l_returnflag", "R", "A"))


@query
def lineitem_shipdate_gaps(spark, sf_dir):
    return rounded(trends.coverage_gaps(load(spark, sf_dir, "lineitem"), 12.0, "l_shipdate"))
