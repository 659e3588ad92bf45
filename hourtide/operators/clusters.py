"""k-means over scaled conditions, with profiles and names."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from hourtide import fixed_values as fv


def scaled_vectors(df: DataFrame, features: list[str] | None = None, keep: tuple[str, ...] = ("hour",)) -> DataFrame:
    """Rows without nulls, min-max scaled into a ``scaled`` vector."""
    features = features or fv.CLUSTER_FEATURES
    rows = df.select(*dict.fromkeys([*keep, *features])).na.drop()
    steps = [VectorAssembler(inputCols=features, outputCol="assembled"), MinMaxScaler(inputCol="assembled", outputCol="scaled")]
    return Pipeline(stages=steps).fit(rows).transform(rows).drop("assembled")


def best_kmeans(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42):
    """The restart with the lowest training cost."""
    fits = [KMeans(k=k, seed=seed + i, featuresCol="scaled").fit(vectors) for i in range(restarts)]
    return min(fits, key=lambda model: model.summary.trainingCost)


def k_sweep(df: DataFrame, ks=range(2, 9), restarts: int = 10, seed: int = 42) -> DataFrame:
    """(k, inertia, silhouette) per k; the silhouette is over squared distances and all rows."""
    vectors = scaled_vectors(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        judge = ClusteringEvaluator(featuresCol="scaled")
        rows = []
        for k in ks:
            model = best_kmeans(vectors, k, restarts, seed)
            rows.append((k, float(model.summary.trainingCost), float(judge.evaluate(model.transform(vectors)))))
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def cluster_profiles(df: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42) -> DataFrame:
    """Clusters numbered by mean volume, with size, means, name and advice."""
    vectors = scaled_vectors(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = best_kmeans(vectors, k, restarts, seed)
    finally:
        vectors.unpersist()
    return profiles_of(model.transform(vectors))


def assigned_to(df: DataFrame, centres: list[tuple[float, ...]], features: list[str] | None = None, keep: tuple[str, ...] = ("hour",)) -> DataFrame:
    """Rows without nulls with ``prediction``, the number of the nearest given centre in min-max scaled
    space; the first centre on a tie. A constant feature counts as one half."""
    features = features or fv.CLUSTER_FEATURES
    rows = df.select(*dict.fromkeys([*keep, *features])).na.drop()
    ends = [x for f in features for x in (F.min(f).cast("double").alias(f"{f}_low"), F.max(f).cast("double").alias(f"{f}_high"))]
    bounds = rows.agg(F.struct(*ends).alias("bounds")).scalar()
    scaled = [F.coalesce(F.try_divide(F.col(f) - bounds[f"{f}_low"], bounds[f"{f}_high"] - bounds[f"{f}_low"]), F.lit(0.5)) for f in features]
    distances = [
        F.struct(sum((x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(scaled, centre)).alias("distance"), F.lit(i).alias("number"))
        for i, centre in enumerate(centres)
    ]
    return rows.withColumn("prediction", F.array_min(F.array(*distances))["number"])


def profiles_of(labelled: DataFrame) -> DataFrame:
    """Clusters of rows with ``prediction``, numbered by mean volume, with size, means, name and advice."""
    profiles = labelled.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("hour").alias("mean_hour"),
        F.avg("weather_severity").alias("mean_severity"),
        F.avg("traffic_volume").alias("mean_volume"),
    )
    number = F.row_number().over(Window.orderBy("mean_volume", "prediction")) - 1
    return name_profiles(profiles.select(number.alias("cluster"), "size", "mean_hour", "mean_severity", "mean_volume"))


def name_profiles(profiles: DataFrame) -> DataFrame:
    """Add name and action by mean hour and volume."""
    h, v = F.col("mean_hour"), F.col("mean_volume")
    name = (
        F.when(v < fv.LULL_BELOW, "Night lull")
        .when((v < fv.SHOULDER_BELOW) & ((h > fv.SHOULDER_HOURS[1]) | (h < fv.SHOULDER_HOURS[0])), "Shoulder hours")
        .when(v >= fv.PEAK_FROM, "Peak commute")
        .otherwise("Midday moderate")
    )
    actions = F.create_map(*[F.lit(x) for pair in fv.CLUSTER_ACTIONS.items() for x in pair])
    return profiles.withColumn("name", name).withColumn("action", actions[F.col("name")])
