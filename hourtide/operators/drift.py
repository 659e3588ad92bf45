"""Drift checks: feature distributions, prediction error, overall status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide import fixed_values as fv
from hourtide.functions.numeric import kolmogorov_tail, positive_if
from hourtide.operators.ranks import running_totals


def feature_drift_ks(
    df: DataFrame,
    features: list[str] | None = None,
    sample: str = "split",
    first: str = "train",
    second: str = "production",
    alpha: float = fv.DRIFT_ALPHA,
    min_statistic: float = 0.0,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov check per feature.

    Both samples are counted per distinct value in one pass; the statistic is the largest distance of
    the two running shares. On big tables any difference is significant, so ``min_statistic`` can ask
    for a minimum distance besides the p-value.
    """
    features = features or fv.DRIFT_FEATURES
    chosen = df.where(F.col(sample).isin(first, second))
    long = chosen.select(sample, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([sample], features, "feature", "value")
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(positive_if(F.col(sample) == first).alias("a"), positive_if(F.col(sample) == second).alias("b"))
    )
    ranked = running_totals(counts, "value", ["a", "b"], ["feature"])
    gap = F.abs(
        F.try_divide(F.col("a_before") + F.col("a"), F.col("a_total")) - F.try_divide(F.col("b_before") + F.col("b"), F.col("b_total"))
    )
    statistics = ranked.groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"), F.max("a_total").alias("n_first"), F.max("b_total").alias("n_second")
    )
    tested = statistics.withColumn("p_value", kolmogorov_tail(F.col("ks_statistic"), F.col("n_first"), F.col("n_second")))
    alert = (F.col("p_value") < alpha) & (F.col("ks_statistic") >= min_statistic)
    return tested.withColumn("status", F.when(alert, "ALERT").otherwise("PASS"))


def prediction_error_drift(
    df: DataFrame,
    label: str,
    prediction: str = "prediction",
    sample: str = "part",
    before: str = "holdout",
    after: str = "production",
    limit: float = fv.ERROR_INCREASE_LIMIT,
) -> DataFrame:
    """Mean absolute error before and after; only an increase beyond ``limit`` is an alert."""
    error = F.abs(F.col(label) - F.col(prediction))
    errors = df.agg(
        F.avg(F.when(F.col(sample) == before, error)).alias("holdout_mae"),
        F.avg(F.when(F.col(sample) == after, error)).alias("production_mae"),
    )
    change = F.when(F.col("holdout_mae") > 0, (F.col("production_mae") - F.col("holdout_mae")) / F.col("holdout_mae")).otherwise(
        F.lit(0.0)
    )
    return errors.withColumn("change", change).select(
        "holdout_mae",
        "production_mae",
        (F.col("change") * 100).alias("pct_change"),
        F.when(F.col("change") > limit, "ALERT").otherwise("PASS").alias("status"),
        F.when(F.col("change") < 0, "error decreased").otherwise("").alias("note"),
    )


def monitoring_summary(features: DataFrame, error: DataFrame) -> DataFrame:
    """(check, name, statistic, status) per check and one overall row."""
    checks = features.select(
        F.lit("feature_drift").alias("check"), F.col("feature").alias("name"), F.col("ks_statistic").alias("statistic"), "status"
    ).unionByName(
        error.select(
            F.lit("prediction_error").alias("check"), F.lit("mae").alias("name"), F.col("pct_change").alias("statistic"), "status"
        )
    )
    alerts = positive_if(F.col("status") == "ALERT")
    overall = checks.agg(alerts.cast("double").alias("statistic"), F.when(alerts > 0, "ALERT").otherwise("PASS").alias("status"))
    return checks.unionByName(
        overall.select(F.lit("overall").alias("check"), F.lit("alerts").alias("name"), "statistic", "status")
    )


def monitoring_status(features: DataFrame, error: DataFrame) -> DataFrame:
    """One nested row for the JSON sink. The array has one entry per checked feature."""
    entries = features.agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "feature",
                    "status",
                    F.round("ks_statistic", 4).alias("ks_statistic"),
                    F.round("p_value", 4).alias("p_value"),
                )
            )
        ).alias("feature_drift")
    )
    checked = error.select(
        F.struct(
            "status",
            F.round("holdout_mae", 2).alias("holdout_mae"),
            F.round("production_mae", 2).alias("production_mae"),
            F.round("pct_change", 2).alias("pct_change"),
        ).alias("prediction_error_drift")
    )
    both = entries.withColumn("prediction_error_drift", checked.scalar())
    alert = F.exists("feature_drift", lambda f: f["status"] == "ALERT") | (F.col("prediction_error_drift.status") == "ALERT")
    overall = F.when(alert, "ALERT").otherwise("PASS")
    messages = F.create_map(*[F.lit(x) for pair in fv.STATUS_MESSAGES.items() for x in pair])
    return both.select(
        overall.alias("overall_status"), messages[overall].alias("overall_message"), "prediction_error_drift", "feature_drift"
    )


def monitoring_report(status: DataFrame) -> DataFrame:
    """(line_no, line): the text report, one line per finding, from the nested status row."""
    error = F.col("prediction_error_drift")
    lines = F.concat(
        F.array(
            F.lit("MODEL MONITORING REPORT"),
            F.format_string("Holdout MAE: %.2f", error["holdout_mae"]),
            F.format_string("Production MAE: %.2f", error["production_mae"]),
            F.format_string("Change: %+.2f%% [%s]", error["pct_change"], error["status"]),
        ),
        F.transform(
            "feature_drift",
            lambda f: F.format_string("%s KS=%.4f p=%.4f [%s]", f["feature"], f["ks_statistic"], f["p_value"], f["status"]),
        ),
        F.array(F.concat(F.lit("OVERALL: "), F.col("overall_message"))),
    )
    return status.select(F.posexplode(lines).alias("line_no", "line"))
