"""Model metrics as plain aggregates, and the table-driven baseline predictors they are checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.functions.numeric import positive_if, ratio_or
from hourtide.operators.ranks import running_totals


def group_mean_prediction(df: DataFrame, fit_on, keys: list[str], target: str, name: str = "prediction") -> DataFrame:
    """Predict the mean of ``target`` over the fitted rows with the same ``keys``; unseen keys get the
    overall mean. The planner broadcasts the table of means where it is small."""
    fitted = df.where(fit_on)
    table = fitted.groupBy(*keys).agg(F.avg(target).alias("group_mean_"))
    overall = fitted.agg(F.avg(target).alias("overall")).scalar()
    return df.join(table, keys, "left").select(
        *df.columns, F.coalesce(F.col("group_mean_"), overall).alias(name)
    )


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """n, MAE and R2 (null for a constant label)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    residual = F.sum((y - p) * (y - p))
    total = F.var_pop(y) * F.count(y)
    return df.agg(
        F.count(y).alias("n"), F.avg(F.abs(y - p)).alias("mae"), (1 - F.try_divide(residual, total)).alias("r2")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(actual, predicted, n) for the four cells, empty ones included."""
    cells = {(a, p): f"c{a}{p}" for a in (0, 1) for p in (0, 1)}
    counts = df.agg(
        *[positive_if((F.col(label) == a) & (F.col(prediction) == p)).alias(name) for (a, p), name in cells.items()]
    )
    long = counts.unpivot([], list(cells.values()), "cell", "n")
    return long.select(
        F.substring("cell", 2, 1).cast("int").alias("actual"), F.substring("cell", 3, 1).cast("int").alias("predicted"), "n"
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: area under the ROC curve by rank sums; equal scores share their rank."""
    scored = df.groupBy(F.col(score).alias("score_")).agg(
        positive_if(F.col(label) == 1).alias("pos"), positive_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_totals(scored, "score_", ["neg", "pos"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return ranked.agg(F.try_divide(wins, pairs).alias("roc_auc"))


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction", score: str = "score") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (0 where undefined) and ROC AUC."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        positive_if(y & p).alias("tp"),
        positive_if(~y & p).alias("fp"),
        positive_if(y & ~p).alias("fn"),
        positive_if(F.col(label) == F.col(prediction)).alias("correct"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "n",
        ratio_or(F.col("correct"), F.col("n")).alias("accuracy"),
        ratio_or(tp, tp + fp, 0.0).alias("precision"),
        ratio_or(tp, tp + fn, 0.0).alias("recall"),
        ratio_or(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"),
        roc_auc(df, label, score).scalar().alias("roc_auc"),
    )


def error_by_slice(df: DataFrame, slices: dict[str, str], label: str, prediction: str = "prediction") -> DataFrame:
    """(slice, value, mae, n): error within each value of each slicing column, in one pass."""
    error = F.abs(F.col(label) - F.col(prediction)).alias("error_")
    long = df.select(error, *[F.col(c).cast("string").alias(name) for name, c in slices.items()]).unpivot(
        ["error_"], list(slices), "slice", "value"
    )
    return long.groupBy("slice", "value").agg(F.avg("error_").alias("mae"), F.count(F.lit(1)).alias("n"))
