"""Logistic regression by Newton's method, each step one aggregate.

Loss, gradient and Hessian of all rows are sums, so a step is one pass with map-side combine that returns some
(features + 1) squared numbers; the system of that size is solved where they arrive. The penalised loss is strictly
convex, so the optimum is one point, whatever the partitioning, and its gradient vanishes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sums(rows: DataFrame, terms: list[Column], label: Column, weight: Column, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian without the penalty."""
    margin = F.lit(float(beta[0]))
    for value, term in zip(beta[1:], terms[1:]):
        margin = margin + F.lit(float(value)) * term
    chance = 1 / (1 + F.exp(-margin))
    # log(1 + exp(margin)) - label * margin without an overflow.
    loss = F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - label * margin
    width = len(terms)
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    named = rows.select(*[t.alias(f"x{i}") for i, t in enumerate(terms)], (weight * (chance - label)).alias("g"), (weight * chance * (1 - chance)).alias("h"), (weight * loss).alias("l"))
    found = named.agg(
        F.sum("l"),
        *[F.sum(F.col("g") * F.col(f"x{i}")) for i in range(width)],
        *[F.sum(F.col("h") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs],
    ).first()
    gradient, hessian = np.array(found[1 : 1 + width], dtype=float), np.zeros((width, width))
    for (i, j), value in zip(pairs, found[1 + width :]):
        hessian[i, j] = hessian[j, i] = value
    return float(found[0]), gradient, hessian


def logistic_newton(
    df: DataFrame,
    features: list[str],
    label: str,
    weight: str | None = None,
    penalty: float = 1.0,
    tolerance: float = 1e-8,
    most_steps: int = 50,
) -> DataFrame:
    """(position, term, coefficient, gradient): the optimum of the weighted log loss plus half ``penalty`` times the
    squared slopes; the intercept is free.

    Stops when no part of the gradient exceeds ``tolerance`` of the summed weights; a step that would raise the loss is
    halved. Rows with a null in a column used take no part. Without rows, or with one kind of label, where no intercept is best,
    ValueError is raised. One job per step.
    """
    used = df.select(*dict.fromkeys([*features, label, *([weight] if weight else [])])).na.drop()
    terms = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    y, w = F.col(label).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    counts = used.agg(F.sum(w).alias("all"), F.sum(w * y).alias("ones")).first()
    if not counts["all"] or not 0 < counts["ones"] < counts["all"]:
        raise ValueError("rows of both labels are needed")
    ridge = np.full(len(terms), penalty)
    ridge[0] = 0.0
    beta = np.zeros(len(terms))
    loss, gradient, hessian = _sums(used, terms, y, w, beta)
    for _ in range(most_steps):
        slope = gradient + ridge * beta
        if np.abs(slope).max() <= tolerance * counts["all"]:
            break
        step = np.linalg.solve(hessian + np.diag(ridge), slope)
        whole = loss + (ridge @ beta**2) / 2
        share = 1.0
        while True:
            moved = beta - share * step
            loss, gradient, hessian = _sums(used, terms, y, w, moved)
            if loss + (ridge @ moved**2) / 2 <= whole * (1 + 1e-12) or share < 1e-6:
                break
            share /= 2
        beta = moved
    slope = gradient + ridge * beta
    rows = [(i, name, float(b), float(g)) for i, (name, b, g) in enumerate(zip(["intercept", *features], beta, slope))]
    return df.sparkSession.createDataFrame(rows, "position int, term string, coefficient double, gradient double")
