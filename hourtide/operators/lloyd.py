"""k-means by aggregates: seeding by hashed draws, all runs in one pass per step, and a sampled silhouette.

Rows come down to distinct points with counts, written once. A run is a number of clusters and a restart; the
centres of all runs are a small literal that every task holds. Seeding draws a point with probability in proportion to its
count times its squared distance to the centres so far, as the smallest of exponential waiting times whose rates
are those products; the draws are hashes, so results do not depend on the partitioning. A step of Lloyd's method is
one aggregate over (run, cluster).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.sources.stages import write_stage

DIGITS = 6
#: Points of the sample that silhouettes are measured on.
MOST_SAMPLED = 2000


def scaled_points(df: DataFrame, features: list[str]) -> DataFrame:
    """(x0, x1, ..., n): distinct min-max scaled points, rounded to six digits, with their rows. Rows with a null take no
    part; a constant feature counts as one half."""
    rows = df.select(*features).na.drop()
    ends = [x for i, f in enumerate(features) for x in (F.min(f).cast("double").alias(f"low{i}"), F.max(f).cast("double").alias(f"high{i}"))]
    bounds = rows.agg(F.struct(*ends).alias("bounds")).scalar()
    scaled = [
        F.round(F.coalesce(F.try_divide(F.col(f).cast("double") - bounds[f"low{i}"], bounds[f"high{i}"] - bounds[f"low{i}"]), F.lit(0.5)), DIGITS).alias(f"x{i}")
        for i, f in enumerate(features)
    ]
    return rows.select(*scaled).groupBy(*[f"x{i}" for i in range(len(features))]).agg(F.count(F.lit(1)).alias("n"))


def _key(width: int) -> Column:
    return F.concat_ws(",", *[F.round(F.col(f"x{i}") * 10**DIGITS).cast("bigint").cast("string") for i in range(width)])


def _of_runs(points: DataFrame, runs: dict[tuple[int, int], list[list[float]]]) -> DataFrame:
    """Each point once for each run: ``run`` has k, restart and the centres."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("restart"), F.lit(c).cast("array<array<double>>").alias("centres")) for (k, r), c in runs.items()])
    return points.withColumn("run", F.explode(each))


def _distances(width: int) -> Column:
    def squared(centre: Column) -> Column:
        total = F.lit(0.0)
        for i in range(width):
            total = total + (F.col(f"x{i}") - centre[i]) * (F.col(f"x{i}") - centre[i])
        return total

    return F.transform("run.centres", squared)


def seeds(points: DataFrame, width: int, ks: list[int], restarts: int, seed: int) -> dict[tuple[int, int], list[list[float]]]:
    """The first centres of each (k, restart); fewer where there are fewer points. One job per centre."""
    runs: dict[tuple[int, int], list[list[float]]] = {(k, r): [] for k in ks for r in range(restarts)}
    for step in range(max(ks)):
        open_ = {run: c for run, c in runs.items() if len(c) == step < run[0]}
        if not open_:
            break
        draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("run.k"), F.col("run.restart"), F.lit(str(step)), _key(width)))
        even = (F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
        rate = F.col("n") * (F.array_min(_distances(width)) if step else F.lit(1.0))
        waiting = F.when(rate > 0, -F.log(even) / rate)
        first = F.min(F.struct(waiting.alias("at"), *[f"x{i}" for i in range(width)]))
        drawn = _of_runs(points, open_).where(rate > 0).groupBy("run.k", "run.restart").agg(first.alias("first"))
        for r in drawn.collect():
            runs[r["k"], r["restart"]].append([float(r["first"][f"x{i}"]) for i in range(width)])
    return runs


def steps(points: DataFrame, width: int, runs: dict[tuple[int, int], list[list[float]]], most_steps: int, tolerance: float = 1e-10):
    """({run: centres}, {run: cost}) after Lloyd's steps; the first centre wins a tie, and one without points stays. One
    job per step, until nothing moves or ``most_steps``."""
    centres = {run: [list(c) for c in found] for run, found in runs.items() if found}
    costs: dict[tuple[int, int], float] = {}
    if not centres:
        return centres, costs
    for done in range(most_steps + 1):
        distances = _distances(width)
        near = _of_runs(points, centres).withColumn("distances", distances).withColumn("least", F.array_min("distances"))
        cluster = F.array_position("distances", F.col("least")) - 1
        sums = near.groupBy("run.k", "run.restart", cluster.alias("cluster")).agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("least")).alias("cost"), *[F.sum(F.col("n") * F.col(f"x{i}")).alias(f"s{i}") for i in range(width)]
        )
        costs, moved = dict.fromkeys(centres, 0.0), 0.0
        found = sums.collect()
        for r in found:
            costs[r["k"], r["restart"]] += r["cost"]
        if done == most_steps:
            break
        for r in found:
            own = centres[r["k"], r["restart"]]
            fresh = [r[f"s{i}"] / r["n"] for i in range(width)]
            moved = max(moved, *[abs(a - b) for a, b in zip(fresh, own[int(r["cluster"])])])
            own[int(r["cluster"])] = fresh
        if moved <= tolerance:
            break
    return centres, costs


def seeded_kmeans(df: DataFrame, features: list[str], ks: list[int], restarts: int = 10, seed: int = 42, most_steps: int = 100) -> DataFrame:
    """(k, restart, cluster, size, cost, c0, c1, ...): the restart with the lowest cost (the first of equal ones) for each k, with
    clusters numbered by their centres' coordinates. ``cost`` is that of the whole run. No rows give no clusters."""
    width = len(features)
    # Few bytes are much work here: written in one part per core, so that no step waits for one task.
    cores = df.sparkSession.sparkContext.defaultParallelism
    points = write_stage(scaled_points(df, features).repartition(cores, F.xxhash64(*[f"x{i}" for i in range(width)])), "points")
    centres, costs = steps(points, width, seeds(points, width, ks, restarts, seed), most_steps)
    best = {}
    for (k, restart), cost in sorted(costs.items()):
        if k not in best or round(cost, 9) < round(costs[k, best[k]], 9):
            best[k] = restart
    # In the order in which the results number them.
    chosen = {(k, r): sorted(centres[k, r], key=lambda c: [round(x, 9) for x in c]) for k, r in best.items()}
    shape = "k int, restart int, cluster int, size bigint, cost double, " + ", ".join(f"c{i} double" for i in range(width))
    if not chosen:
        return df.sparkSession.createDataFrame([], shape)
    near = _of_runs(points, chosen).withColumn("distances", _distances(width))
    cluster = F.array_position("distances", F.array_min("distances")) - 1
    sizes = {(r["k"], r["cluster"]): r["n"] for r in near.groupBy("run.k", cluster.alias("cluster")).agg(F.sum("n").alias("n")).collect()}
    rows = [
        (k, r, i, int(sizes.get((k, i), 0)), costs[k, r], *map(float, c)) for (k, r), found in chosen.items() for i, c in enumerate(found)
    ]
    return df.sparkSession.createDataFrame(rows, shape)


def sampled_silhouette(points: DataFrame, width: int, centres: list[list[float]], most: int = MOST_SAMPLED) -> float:
    """The mean silhouette under Euclidean distance of the rows of at most ``most`` points, the first by a hash of their
    coordinates. The sample is a literal in all tasks: one pass over it adds up the distances to each cluster. A point alone
    in its cluster counts 0, and so does all if there is one cluster."""
    chosen = points.orderBy(F.md5(_key(width)), *[f"x{i}" for i in range(width)]).limit(most)
    labelled = _of_runs(chosen, {(0, 0): centres}).withColumn("distances", _distances(width))
    labelled = write_stage(labelled.select(*[f"x{i}" for i in range(width)], "n", (F.array_position("distances", F.array_min("distances")) - 1).cast("int").alias("own")), "sample")
    held = [tuple(r) for r in labelled.collect()]
    sizes: dict[int, int] = {}
    for row in held:
        sizes[row[-1]] = sizes.get(row[-1], 0) + row[-2]
    if len(sizes) < 2:
        return 0.0
    # The sample as one value in all tasks: a stated set of at most ``most`` points against itself.
    fields = [*[F.col(f"x{i}").alias(f"y{i}") for i in range(width)], F.col("n").alias("m"), F.col("own").alias("cluster")]
    sample = labelled.agg(F.collect_list(F.struct(*fields))).scalar()
    each = labelled.withColumn("at", F.explode(sample))
    total = F.lit(0.0)
    for i in range(width):
        total = total + (F.col(f"x{i}") - F.col(f"at.y{i}")) * (F.col(f"x{i}") - F.col(f"at.y{i}"))
    point = [*[f"x{i}" for i in range(width)], "n", "own"]
    sums = each.groupBy(*point, F.col("at.cluster").alias("other")).agg(F.sum(F.col("at.m") * F.sqrt(total)).alias("sum"))
    count = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    mean = F.when(F.col("other") == F.col("own"), F.try_divide(F.col("sum"), count[F.col("other")] - 1)).otherwise(F.col("sum") / count[F.col("other")])
    each = sums.withColumn("mean", mean).groupBy(*point).agg(
        F.max(F.when(F.col("other") == F.col("own"), F.col("mean"))).alias("a"), F.min(F.when(F.col("other") != F.col("own"), F.col("mean"))).alias("b")
    )
    shape = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return float(each.agg(F.sum(F.col("n") * shape) / F.sum("n")).first()[0])
