"""MLlib pipelines over the featured table: fit, evaluate, store, reload."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from hourtide.operators.metrics import classification_metrics, regression_metrics
from hourtide.operators.ranks import running_totals
from hourtide.operators.splits import with_class_weights
from hourtide.session import checkpoint_folder
from hourtide.sources.stages import write_stage

SEED = 42
#: Rows of a part in boosting, and the most in a part of a regression forest.
PARTITION_ROWS, MOST_ROWS = 20_000, 500_000
#: Nodes of the trees that one fit of a regression forest may hold in the driver.
MOST_NODES = 500_000
#: Between the seeds of two groups of trees, so that no group draws by another's numbers.
SEED_STEP = 1_000_003


@dataclass(frozen=True)
class ModelSpec:
    """What to train. ``params`` are the estimator's own; the defaults below are the published settings."""

    name: str
    kind: str
    label: str
    params: dict = field(default_factory=dict)

    def with_params(self, **params) -> "ModelSpec":
        return ModelSpec(self.name, self.kind, self.label, {**self.params, **params})

    @property
    def classifies(self) -> bool:
        return self.kind in ("logistic", "forest_classifier")


LINEAR = ModelSpec("LinearRegression", "linear", "traffic_volume", {"solver": "normal"})
GBT = ModelSpec("GradientBoosting", "gbt", "traffic_volume", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.1, "seed": SEED})
FOREST = ModelSpec("RandomForestRegressor", "forest", "traffic_volume", {"numTrees": 200, "maxDepth": 15, "seed": SEED})
LOGISTIC = ModelSpec("LogisticRegression", "logistic", "high_risk", {"maxIter": 1000})
FOREST_CLASSIFIER = ModelSpec("RandomForestClassifier", "forest_classifier", "high_risk", {"numTrees": 100, "maxDepth": 30, "seed": SEED})


def pipeline(spec: ModelSpec, features: list[str], train_rows: int | None = None) -> Pipeline:
    """Assembler, scaler for the logistic model, estimator. The logistic model gets an L2 penalty of
    1 / rows, the counterpart of a unit penalty on the summed loss. Forests keep the node of every row and tree from pass
    to pass: without that each pass sends all trees to the tasks and sends every row down from their roots."""
    columns = {"featuresCol": "features", "labelCol": spec.label}
    forest = {**columns, "cacheNodeIds": True}
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    if spec.kind == "linear":
        return Pipeline(stages=[assemble, LinearRegression(**columns, **spec.params)])
    if spec.kind == "gbt":
        return Pipeline(stages=[assemble, GBTRegressor(**columns, **spec.params)])
    if spec.kind == "forest":
        return Pipeline(stages=[assemble, RandomForestRegressor(**{**forest, **spec.params})])
    if spec.kind == "forest_classifier":
        return Pipeline(stages=[assemble, RandomForestClassifier(**{**forest, "weightCol": "weight", **spec.params})])
    if spec.kind == "logistic":
        assemble = VectorAssembler(inputCols=features, outputCol="assembled")
        scale = StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True)
        penalty = {"regParam": 1.0 / train_rows} if train_rows else {}
        fit = LogisticRegression(**columns, weightCol="weight", standardization=False, **{**penalty, **spec.params})
        return Pipeline(stages=[assemble, scale, fit])
    raise ValueError(f"unknown model kind {spec.kind!r}")


class GroupedForest:
    """A regression forest stored in groups of trees under ``path``. One group at a time is held in the driver."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path
        table = spark.read.schema("number int, trees int").parquet(f"{path}/groups")
        self.trees = {r["number"]: r["trees"] for r in table.orderBy("number").collect()}

    def _group(self, number: int) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/group-{number}")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the mean over all trees. Runs a job per group, which writes the sum so far."""
        scored = df.withColumn("sum_", F.lit(0.0))
        for number, trees in self.trees.items():
            added = self._group(number).transform(scored).withColumn("sum_", F.col("sum_") + trees * F.col("prediction"))
            scored = write_stage(added.select(*df.columns, "sum_"), "forest")
        return scored.select(*df.columns, (F.col("sum_") / sum(self.trees.values())).alias("prediction"))

    def importances(self) -> list[float]:
        """Impurity importances, the mean over all trees."""
        weighted = [trees * self._group(number).stages[-1].featureImportances.toArray() for number, trees in self.trees.items()]
        return [float(x) / sum(self.trees.values()) for x in sum(weighted)]


Model = PipelineModel | GroupedForest


def fit(spec: ModelSpec, train: DataFrame, features: list[str], path: str | None = None) -> Model:
    """Fit on ``train``. The estimators pass over the data many times, so the needed columns are held
    (memory first, then disk) while they do; lost blocks are recomputed from the stage table.

    A regression forest whose trees could have more than ``MOST_NODES`` nodes is fitted in groups of trees, each stored
    under ``path`` (by default a fresh folder) before the next."""
    prepared = train.select(*features, F.col(spec.label).cast("double").alias(spec.label))
    if spec.classifies:
        prepared = with_class_weights(prepared, spec.label)
    rows = train.count()
    context = train.sparkSession.sparkContext
    if spec.kind in ("forest", "forest_classifier") and context.getCheckpointDir() is None:
        # The kept nodes are cut off from the passes before, every tenth pass.
        context.setCheckpointDir(checkpoint_folder(train.sparkSession))
    prepared = dealt(spec, prepared, rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if spec.kind == "forest" and spec.params["numTrees"] * most_nodes(spec, rows) > MOST_NODES:
            return fit_in_groups(spec, prepared, features, rows, path)
        return pipeline(spec, features, rows).fit(prepared)
    finally:
        prepared.unpersist()


def dealt(spec: ModelSpec, prepared: DataFrame, rows: int) -> DataFrame:
    """``prepared`` in the parts that its passes run over. Boosting runs several small jobs per tree, so the rows are held
    in as few parts as they need. A pass of a regression forest is long, so all cores share it; its parts and their order
    follow from the rows, not from the files, and so do the bootstrap samples."""
    if spec.kind != "forest" or rows <= PARTITION_ROWS:
        return prepared.coalesce(max(1, -(-rows // PARTITION_ROWS)))
    cores = prepared.sparkSession.sparkContext.defaultParallelism
    return prepared.repartition(max(cores, -(-rows // MOST_ROWS)), *prepared.columns).sortWithinPartitions(*prepared.columns)


def most_nodes(spec: ModelSpec, rows: int) -> int:
    """Nodes that a tree has at most, by its depth and by its rows."""
    return 2 * min(2 ** spec.params["maxDepth"], max(rows, 1)) - 1


def fit_in_groups(spec: ModelSpec, prepared: DataFrame, features: list[str], rows: int, path: str | None = None) -> GroupedForest:
    """As many trees at a time as ``MOST_NODES`` allows: the first group by the bound of a tree's nodes, each other by
    twice the mean of the groups before. The bootstrap samples of a group follow from the seed and its number."""
    spark = prepared.sparkSession
    path = path or f"{checkpoint_folder(spark)}/models/{uuid.uuid4().hex}"
    groups: list[tuple[int, int]] = []
    left, nodes, bound = spec.params["numTrees"], 0, most_nodes(spec, rows)
    while left:
        trees = min(left, max(1, MOST_NODES // bound))
        part = spec.with_params(numTrees=trees, seed=spec.params["seed"] + SEED_STEP * len(groups))
        model = pipeline(part, features, rows).fit(prepared)
        model.write().overwrite().save(f"{path}/group-{len(groups)}")
        nodes, left = nodes + model.stages[-1].totalNumNodes, left - trees
        bound = min(most_nodes(spec, rows), -(-2 * nodes // (spec.params["numTrees"] - left)))
        groups.append((len(groups), trees))
        del model
    # Written last: a forest without it is not whole.
    spark.createDataFrame(groups, "number int, trees int").coalesce(1).write.mode("overwrite").parquet(f"{path}/groups")
    return GroupedForest(spark, path)


def load(spark: SparkSession, path: str) -> Model:
    """The model stored at ``path``, in groups of trees or as one."""
    try:
        return GroupedForest(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return PipelineModel.load(path)


def load_or_fit(spec: ModelSpec, train: DataFrame, features: list[str], paths: list[str]) -> tuple[Model, str]:
    """The first stored model among ``paths``, else a fresh fit saved to the last path. Returns the
    model and where it came from."""
    for path in paths:
        if stored(train.sparkSession, path):
            return load(train.sparkSession, path), path
    model = fit(spec, train, features, paths[-1] if paths else None)
    if paths and isinstance(model, PipelineModel):
        model.write().overwrite().save(paths[-1])
    return model, "fitted"


def stored(spark: SparkSession, path: str) -> bool:
    locations = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}/_SUCCESS") for part in ("metadata", "groups")]
    return any(x.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(x) for x in locations)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, for a classifier, ``score``, the probability of the positive class."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    extra = [c for c in ("prediction", "score") if c in scored.columns]
    return scored.select(*df.columns, *extra)


def evaluate(spec: ModelSpec, model: Model, test: DataFrame) -> DataFrame:
    """One row of metrics with the model name."""
    scored = predict(model, test)
    found = classification_metrics(scored, spec.label) if spec.classifies else regression_metrics(scored, spec.label)
    return found.select(F.lit(spec.name).alias("model"), "*")


def feature_importance(model: Model, features: list[str], spark: SparkSession, n: int = 15) -> DataFrame:
    """The ``n`` largest impurity importances of a tree model (one number per feature)."""
    grouped = isinstance(model, GroupedForest)
    values = model.importances() if grouped else [float(x) for x in model.stages[-1].featureImportances.toArray()]
    table = spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def permutation_importance(
    model: Model,
    df: DataFrame,
    features: list[str],
    label: str,
    key: str,
    seed: int = SEED,
) -> DataFrame:
    """Increase of the mean absolute error when one feature at a time is permuted.

    The rows form one ring in the order of a seeded hash of the unique key; each takes the values of the
    row that stands a seeded number of places further on. The permutation depends on the keys and the
    seed alone. All features share it and one scoring pass.
    """
    base = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in features])
    placed = base.select("*", F.struct(F.xxhash64(F.lit(seed), key).alias("hash"), F.col(key).alias("key")).alias("place_"))
    ring = running_totals(placed.withColumn("one_", F.lit(1)), "place_", ["one_"])
    step = 1 + F.pmod(F.xxhash64(F.lit(seed), F.lit("step")), F.greatest(F.col("one__total") - 1, F.lit(1)))
    ranked = ring.select(key, label, *features, F.pmod(F.col("one__before") + step, F.col("one__total")).alias("rank_"))
    partners = ring.select(F.col("one__before").alias("rank_"), *[F.col(f).alias(f"{f}_other_") for f in features])
    paired = ranked.join(partners, "rank_")
    each = paired.withColumn("permuted_", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features])))
    swapped = each.select(
        label, "permuted_", *[F.when(F.col("permuted_") == f, F.col(f"{f}_other_")).otherwise(F.col(f)).alias(f) for f in features]
    )
    errors = predict(model, swapped).groupBy("permuted_").agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae"))
    # One row per feature: a window without partitions is fine.
    base_mae = F.max(F.when(F.col("permuted_") == "", F.col("mae"))).over(Window.partitionBy())
    return (
        errors.withColumn("base_mae", base_mae)
        .where(F.col("permuted_") != "")
        .select(F.col("permuted_").alias("feature"), "base_mae", "mae", (F.col("mae") - F.col("base_mae")).alias("increase"))
    )
