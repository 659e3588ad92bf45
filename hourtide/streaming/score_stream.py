"""Scoring requests as they arrive. Stateless: the same transformation as the batch job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourtide.fixed_values import REQUEST_SCHEMA
from hourtide.operators.models import load
from hourtide.operators.scoring import graded, quarantined, request_features, score, validate_requests

#: Adds ``prediction`` to valid requests.
Predictor = Callable[[DataFrame], DataFrame]


def request_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Request files as a stream; the number of files per batch bounds the work of a trigger."""
    return spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def start_scoring(
    requests: DataFrame, model: PipelineModel, thresholds: tuple[float, float, float], out: str, available_now: bool = True, check_weekend: bool = True
) -> list[StreamingQuery]:
    """Two append-only sinks under ``out``: scored requests and the quarantine. Their checkpoints make
    each output exactly-once over restarts."""
    sinks = {
        "scored": score(requests, model, thresholds, check_weekend=check_weekend),
        "quarantine": quarantined(requests, check_weekend=check_weekend),
    }
    started = []
    for name, frame in sinks.items():
        writer = frame.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{out}/checkpoints/{name}")
        if available_now:
            writer = writer.trigger(availableNow=True)
        started.append(writer.start(f"{out}/{name}"))
    return started


class AliasedModel:
    """The predictor of the model at the path that ``resolve`` names now; it is loaded when that has changed."""

    def __init__(self, resolve: Callable[[], str]) -> None:
        self.resolve, self.path, self.model = resolve, None, None

    def __call__(self) -> tuple[str, Predictor]:
        path = self.resolve()
        if path != self.path:
            self.path, self.model = path, load(SparkSession.active(), path)
        return path, lambda valid: self.model.transform(request_features(valid))


def start_serving(
    requests: DataFrame,
    predictor: Callable[[], tuple[str, Predictor]],
    thresholds: tuple[float, float, float],
    out: str,
    keep: str = "request_id",
    available_now: bool = True,
    check_weekend: bool = True,
) -> StreamingQuery:
    """Score each batch by what ``predictor`` names when the batch begins, so a moved alias serves from the next batch on.

    Both outputs of a batch, ``scored`` with the name of the predictor and ``quarantine``, are folders of its number
    that a repeated batch overwrites: exactly-once over restarts.
    """

    def serve(batch: DataFrame, number: int) -> None:
        name, predict = predictor()
        valid = validate_requests(batch, check_weekend).where("is_valid")
        scored = graded(predict(valid), thresholds, keep).withColumn("model", F.lit(name))
        scored.write.mode("overwrite").parquet(f"{out}/scored/batch={number}")
        quarantined(batch, keep, check_weekend).write.mode("overwrite").parquet(f"{out}/quarantine/batch={number}")

    writer = requests.writeStream.foreachBatch(serve).option("checkpointLocation", f"{out}/checkpoints/serving")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
