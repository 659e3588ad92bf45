"""Association rules over baskets with one item per attribute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.functions import calendar as cal
from hourtide.functions.lookups import weather_bucket


def basket_columns() -> dict[str, Column]:
    """The item attributes of the featured table."""
    return {
        "time": cal.day_part(F.col("hour")),
        "day": cal.day_type(F.col("is_weekend")),
        "weather": weather_bucket(F.col("weather_main")),
        "congestion": F.col("congestion_category"),
    }


def association_rules(
    df: DataFrame,
    attributes: dict[str, Column],
    consequent: str = "congestion",
    min_support: float = 0.01,
    min_lift: float = 1.0,
) -> DataFrame:
    """Rules ``antecedent -> one item of the consequent attribute`` with support, confidence and lift.

    Each row holds one item per attribute, so rows reduce to their distinct baskets (a few hundred,
    combined before the shuffle) and a cube over those counts every itemset exactly. No candidate pairs
    are generated and the data is read once.
    """
    names = list(attributes)
    baskets = df.select(*[F.coalesce(c, F.lit("unknown")).alias(n) for n, c in attributes.items()]).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    items = [F.concat(F.lit(f"{n}="), F.col(n)).alias(n) for n in names]
    cube = baskets.select(*items, "n").cube(*names).agg(F.sum("n").alias("n"))
    total = baskets.agg(F.sum("n").alias("n")).scalar()
    others = [n for n in names if n != consequent]

    full = cube.where(F.col(consequent).isNotNull() & F.coalesce(*[F.col(n) for n in others]).isNotNull())
    frequent = full.where(F.col("n") >= F.lit(min_support) * total)
    left = cube.where(F.col(consequent).isNull()).select(*[F.col(n).alias(f"{n}_l") for n in others], F.col("n").alias("n_left"))
    alone = F.lit(True)
    for n in others:
        alone = alone & F.col(n).isNull()
    right = cube.where(F.col(consequent).isNotNull() & alone).select(F.col(consequent).alias("item_"), F.col("n").alias("n_right"))

    same = None
    for n in others:
        match = F.col(n).eqNullSafe(F.col(f"{n}_l"))
        same = match if same is None else same & match
    # One row per itemset: as many as the product of the attribute sizes, so the planner chooses how to join.
    joined = frequent.join(left, same).join(right, F.col(consequent) == F.col("item_"))
    confidence = F.col("n") / F.col("n_left")
    lift = confidence / (F.col("n_right") / total)
    return joined.select(
        F.array_sort(F.array_compact(F.array(*others))).alias("antecedent"),
        F.array(consequent).alias("consequent"),
        (F.col("n") / total).alias("support"),
        confidence.alias("confidence"),
        lift.alias("lift"),
    ).where(F.col("lift") >= min_lift)


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent").limit(n)
