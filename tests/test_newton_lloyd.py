"""Newton's logistic regression and seeded k-means against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourtide.operators import lloyd, newton


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 3)) * [1, 5, 0.1]
    y = (rng.random(600) < 1 / (1 + np.exp(-(x @ [1.5, -0.4, 3.0] + 0.3)))).astype(int)
    w = rng.integers(1, 4, 600)
    rows = [(*map(float, v), int(t), float(u)) for v, t, u in zip(x, y, w)]
    return rows, spark.createDataFrame([*rows, (None, 1.0, 1.0, 1, 1.0), (1.0, 1.0, 1.0, None, 1.0)], "a double, b double, c double, y int, w double")


def test_gradient_vanishes_at_the_optimum(labelled):
    rows, frame = labelled
    found = {r["term"]: r["coefficient"] for r in newton.logistic_newton(frame.repartition(5), ["a", "b", "c"], "y", "w", penalty=2.0).collect()}
    data = np.array(rows)
    x = np.column_stack([np.ones(len(data)), data[:, :3]])
    beta = np.array([found[t] for t in ("intercept", "a", "b", "c")])
    p = 1 / (1 + np.exp(-x @ beta))
    gradient = x.T @ (data[:, 4] * (p - data[:, 3])) + np.array([0, 2, 2, 2]) * beta
    assert np.abs(gradient).max() < 1e-4
    # Any step away raises the loss.
    loss = lambda b: float(data[:, 4] @ (np.logaddexp(0, x @ b) - data[:, 3] * (x @ b)) + (b[1:] ** 2).sum())
    assert all(loss(beta) < loss(beta + d) for d in 1e-3 * np.random.default_rng(1).normal(size=(20, 4)))


def test_separable_labels_have_a_penalised_optimum(spark):
    frame = spark.range(40).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 20).cast("int").alias("y"))
    found = {r["term"]: r for r in newton.logistic_newton(frame, ["x"], "y").collect()}
    assert found["x"]["coefficient"] > 0.3 and max(abs(r["gradient"]) for r in found.values()) < 1e-5
    with pytest.raises(ValueError):
        newton.logistic_newton(frame.where("y = 1"), ["x"], "y")
    with pytest.raises(ValueError):
        newton.logistic_newton(frame.where("false"), ["x"], "y")


def plain_lloyd(points, counts, centres, steps):
    for _ in range(steps):
        d = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = np.average(points[near == k], axis=0, weights=counts[near == k])
    d = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    return centres, float(counts @ d.min(axis=1)), d.argmin(axis=1)


@pytest.fixture(scope="module")
def clumps(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(m, 0.4, (60, 2)) for m in ((0, 0), (5, 5), (0, 6))]).round(2)
    rows = [tuple(map(float, v)) for v in values] + [tuple(map(float, values[0]))] * 3
    return spark.createDataFrame([*rows, (None, 1.0)], "p double, q double")


def test_runs_equal_a_plain_version(clumps):
    points = lloyd.scaled_points(clumps, ["p", "q"])
    held = points.orderBy("x0", "x1").collect()
    x, n = np.array([[r["x0"], r["x1"]] for r in held]), np.array([r["n"] for r in held])
    assert n.sum() == 183
    firsts = lloyd.seeds(points, 2, [2, 3], 3, 42)
    assert all(len(c) == k and len({tuple(p) for p in c}) == k for (k, _), c in firsts.items())
    centres, costs = lloyd.steps(points, 2, firsts, 25)
    for run, first in firsts.items():
        own, cost, _ = plain_lloyd(x, n, np.array(first), 25)
        assert np.array(centres[run]) == pytest.approx(own, abs=1e-9) and costs[run] == pytest.approx(cost)
    best = lloyd.seeded_kmeans(clumps.repartition(7), ["p", "q"], [2, 3], restarts=3, most_steps=25).collect()
    assert {(r["k"], round(r["cost"], 9)) for r in best} == {(k, round(min(c for run, c in costs.items() if run[0] == k), 9)) for k in (2, 3)}
    assert sorted(r["size"] for r in best if r["k"] == 3) == [60, 60, 63]


def test_fewer_points_than_clusters(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (2.0, 3.0)], "p double, q double")
    found = lloyd.seeded_kmeans(frame, ["p", "q"], [4], restarts=2).collect()
    assert sorted(r["size"] for r in found) == [1, 2] and found[0]["cost"] == 0
    assert lloyd.seeded_kmeans(frame.where("false"), ["p", "q"], [2]).count() == 0


def test_silhouette_equals_a_plain_one(clumps):
    points = lloyd.scaled_points(clumps, ["p", "q"])
    held = points.collect()
    x, n = np.array([[r["x0"], r["x1"]] for r in held]), np.array([r["n"] for r in held])
    centres = [[0.1, 0.1], [0.9, 0.8], [0.1, 0.9]]
    own = ((x[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2).argmin(axis=1)
    full, label = np.repeat(x, n, axis=0), np.repeat(own, n)
    scores = []
    for i in range(len(full)):
        d = np.sqrt(((full - full[i]) ** 2).sum(axis=1))
        same = label == label[i]
        a = d[same].sum() / (same.sum() - 1)
        b = min(d[label == k].mean() for k in set(label.tolist()) - {label[i]})
        scores.append((b - a) / max(a, b))
    assert lloyd.sampled_silhouette(points, 2, centres) == pytest.approx(np.mean(scores))
    assert lloyd.sampled_silhouette(points, 2, centres[:1]) == 0.0
    assert math.isfinite(lloyd.sampled_silhouette(points, 2, centres, most=40))


def test_steps_share_the_points_among_the_cores(spark, clumps, monkeypatch):
    """The few bytes of the points would else be one file, and each step one task."""
    staged = {}
    write = lloyd.write_stage
    monkeypatch.setattr(lloyd, "write_stage", lambda df, name: staged.setdefault(name, write(df, name)))
    assert lloyd.seeded_kmeans(clumps, ["p", "q"], [2], restarts=1, most_steps=1).count() == 2
    files = [r["file"] for r in staged["points"].select(F.input_file_name().alias("file")).distinct().collect()]
    assert len(files) == spark.sparkContext.defaultParallelism > 1
