"""Stage tables, model store and the scheduled jobs that tie the operators together."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtide.functions import calendar as cal
from hourtide.operators import clean as cleaning
from hourtide.operators import drift, features, metrics, models, recommend, registry, splits
from hourtide.session import checkpoint_folder
from hourtide.sources.observations import observations
from hourtide.sources.stages import listing, shared_stage, write_stage

# The years of the derived observations (the last one is partial).
FIRST_YEAR, LAST_YEAR = 1995, 2001
TRAIN_THROUGH, TEST_YEAR, PRODUCTION_YEAR = 1999, 2000, 2001
# The alias of the model that serves.
PRODUCTION = "production"


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_stage(spark, sf_dir, "cleaned", lambda: cleaning.clean(observations(spark, sf_dir)), sort_by="date_time")


def featured_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_stage(spark, sf_dir, "featured", lambda: features.featurize(cleaned_table(spark, sf_dir)), sort_by="date_time")


def hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-timestamp table without null imputation, so that nulls and outliers are still visible."""

    def build() -> DataFrame:
        return cleaning.timestamp_aggregate(cleaning.exact_dedupe(cleaning.standardise_text(observations(spark, sf_dir))))

    return shared_stage(spark, sf_dir, "hourly", build, sort_by="date_time")


def labelled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured table with the risk label and the chronological split."""
    labelled = features.risk_label(featured_table(spark, sf_dir))
    return splits.chronological_split(labelled, TRAIN_THROUGH, TEST_YEAR, PRODUCTION_YEAR)


def grouped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.with_groups(featured_table(spark, sf_dir))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured_rows(spark, sf_dir, "train")


def featured_rows(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    """Rows of the given splits, chosen by ranges on the timestamp that the scan can use."""
    ts = F.col("date_time")
    ranges = {
        "train": cal.through_year(ts, TRAIN_THROUGH),
        "test": cal.years_between(ts, TEST_YEAR, TEST_YEAR),
        "production": cal.years_between(ts, PRODUCTION_YEAR, PRODUCTION_YEAR),
    }
    return labelled_table(spark, sf_dir).where(reduce(lambda a, b: a | b, [ranges[p] for p in parts]))


def store(spark: SparkSession, sf_dir: str, *what: object) -> str:
    """A folder in the shared folder that follows the files under ``sf_dir`` and ``what``; it outlives the
    application."""
    mark = hashlib.sha1("|".join(map(str, (sf_dir, listing(spark, sf_dir), *what))).encode()).hexdigest()[:16]
    return f"{checkpoint_folder(spark)}/models/{mark}"


def trained(spark: SparkSession, sf_dir: str, spec: models.ModelSpec, *parts: str) -> models.Model:
    """The model for the input and ``spec``: stored by this or an earlier application, or fitted once and
    stored. ``parts`` names the part of the monitored rows to fit on, instead of all training rows."""
    rows = parted_rows(spark, sf_dir).where(F.col("part").isin(*parts)) if parts else training_rows(spark, sf_dir)
    names = features.feature_columns(training_rows(spark, sf_dir))
    return models.load_or_fit(spec, rows, names, [f"{store(spark, sf_dir, spec, *parts)}/{spec.kind}"])[0]


def run_table(spark: SparkSession, sf_dir: str) -> str:
    return f"{store(spark, sf_dir)}/runs"


def record(spark: SparkSession, sf_dir: str, spec: models.ModelSpec, alias: str | None = None) -> None:
    """Evaluate the stored model on the test rows and append the run; it becomes the next version."""
    model = trained(spark, sf_dir, spec)
    found = models.evaluate(spec, model, featured_rows(spark, sf_dir, "test"))
    registry.append_run(spark, run_table(spark, sf_dir), spec, found, f"{store(spark, sf_dir, spec)}/{spec.kind}", alias)


def production_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the serving model lies: the run with the production alias, else the stored boosted trees, else these fitted now."""
    try:
        return registry.aliased_path(spark, run_table(spark, sf_dir), PRODUCTION)
    except LookupError:
        trained(spark, sf_dir, models.GBT)
        return f"{store(spark, sf_dir, models.GBT)}/{models.GBT.kind}"


def evaluated(spark: SparkSession, sf_dir: str, spec: models.ModelSpec) -> DataFrame:
    return models.evaluate(spec, trained(spark, sf_dir, spec), featured_rows(spark, sf_dir, "test"))


def serving_thresholds(table: DataFrame) -> tuple[float, float, float]:
    """The three quartiles of the volume as numbers (one row), for the level bands."""
    row = features.quartiles(table).first()
    return row["q1"], row["q2"], row["q3"]


def hour_day_prediction(labelled: DataFrame, fit_on) -> DataFrame:
    """Baseline regressor: the fitted mean volume of the hour and day type."""
    return metrics.group_mean_prediction(labelled, fit_on, ["hour", "is_weekend"], "traffic_volume")


def mean_predictor(spark: SparkSession, sf_dir: str):
    """Adds to requests, as ``prediction``, the training mean of their hour and day type: one row per hour and day type.
    They are written once, so that a batch of a stream does not read the training rows."""
    means = training_rows(spark, sf_dir).groupBy("hour", "is_weekend").agg(F.avg("traffic_volume").alias("prediction"))
    means = write_stage(means, "means")
    return lambda valid: valid.join(F.broadcast(means), ["hour", "is_weekend"])


def weather_hour_risk(labelled: DataFrame, fit_on) -> DataFrame:
    """Baseline classifier: the fitted risk rate of the weather and hour, positive above one half."""
    scored = metrics.group_mean_prediction(labelled, fit_on, ["weather_main", "hour"], "high_risk", "score")
    return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and production rows with ``part`` (fit / holdout / production) and the baseline
    prediction fitted on the ``fit`` rows."""
    return hour_day_prediction(parted_rows(spark, sf_dir), F.col("part") == "fit")


def parted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = splits.holdout_tail(featured_rows(spark, sf_dir, "train"))
    production = featured_rows(spark, sf_dir, "production").withColumn("part", F.lit("production"))
    return train.unionByName(production)


def monitored_by_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and production rows with ``part`` and the prediction of trees fitted on ``fit``."""
    return models.predict(trained(spark, sf_dir, models.GBT, "fit"), parted_rows(spark, sf_dir))


def monitoring_checks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = monitored(spark, sf_dir)
    compared = featured_rows(spark, sf_dir, "train", "production")
    return drift.feature_drift_ks(compared), drift.prediction_error_drift(rows, "traffic_volume")
