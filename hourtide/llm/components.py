"""Connected components of a table of links, by contraction in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) per node of ``links`` (a, b).

    Each round hooks every node to its smallest neighbour if that is smaller, halves the paths twice and
    renames the links; links inside a component vanish and the rest is smaller, so the work of all rounds
    is a small multiple of the first. Nodes should not be numbered along paths (hashes are not). Rounds
    are written tables; only the number of links left comes to the driver. Runs jobs when called.
    """
    edges = stage(_both_ways(links), "links")
    renames = []
    while not edges.isEmpty():
        smallest = edges.groupBy("a").agg(F.min("b").alias("b"))
        hooked = stage(smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hooks")
        for _ in range(2):
            hooked = follow(hooked, hooked)
        hooked = stage(hooked, "roots")
        renames.append(hooked)
        left = edges.join(hooked.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").select("x", "b")
        both = left.join(hooked.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        edges = stage(both.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    if not renames:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    found = renames[0]
    for later in renames[1:]:
        found = follow(found, later)
    return found


def follow(found: DataFrame, later: DataFrame) -> DataFrame:
    """Replace each root by its own root in ``later``, where it has one."""
    further = later.select(F.col("node").alias("node_"), F.col("root").alias("root_"))
    return found.join(further, found["root"] == further["node_"], "left").select(
        found["node"], F.coalesce("root_", "root").alias("root")
    )


def _both_ways(links: DataFrame) -> DataFrame:
    pairs = links.where("a <> b")
    return pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
