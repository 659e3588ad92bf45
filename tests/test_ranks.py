import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourtide.operators.ranks import quantiles, running_totals, with_previous


def skewed(spark, n=4000):
    """A third of the rows sit on one value of one group; the rest are spread over many."""
    rng = random.Random(7)
    data = [("hot", 5.0)] * (n // 3)
    data += [("hot", round(rng.gauss(0, 50), 3)) for _ in range(n // 3)]
    data += [(rng.choice("abc"), rng.random() * 1e6) for _ in range(n // 3)]
    data += [(None, float(i)) for i in range(9)] + [("a", None)]
    return data, spark.createDataFrame(data, "g string, v double")


def test_quantiles_match_numpy(spark):
    data, df = skewed(spark)
    found = {r["g"]: r for r in quantiles(df, "v", {"p": 0.3, "m": 0.5, "q": 0.99}, ["g"]).collect()}
    for group in ("hot", "a", "b", "c", None):
        values = [v for g, v in data if g == group and v is not None]
        for name, p in (("p", 0.3), ("m", 0.5), ("q", 0.99)):
            assert found[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_global_quantiles_and_empty_input(spark):
    data, df = skewed(spark)
    row = quantiles(df, "v", {"m": 0.5}).first()
    assert row["m"] == pytest.approx(np.median([v for _, v in data if v is not None]))
    empty = quantiles(df.where("false"), "v", {"m": 0.5}).collect()
    assert [r["m"] for r in empty] == [None]


def test_running_totals_equal_a_plain_cumulative_sum(spark):
    data, df = skewed(spark)
    counts = df.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {}
    for r in running_totals(counts, "v", ["n"], ["g"]).collect():
        got.setdefault(r["g"], []).append((r["v"], r["n"], r["n_before"], r["n_total"]))
    for group, entries in got.items():
        entries.sort()
        running, total = 0, sum(e[1] for e in entries)
        for _, n, before, whole in entries:
            assert (before, whole) == (running, total)
            running += n


def test_running_totals_on_structs_without_keys(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "a int, b int")
    counts = df.groupBy(F.struct("a", "b").alias("o")).agg(F.count("*").alias("n"))
    out = [(tuple(r["o"]), r["n_before"]) for r in running_totals(counts, "o", ["n"]).collect()]
    out.sort()
    assert [before for _, before in out] == list(range(500))


def test_plan_has_no_global_sort_of_values(spark):
    _, df = skewed(spark)
    plan = quantiles(df, "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan



def test_previous_values_cross_the_ranges(spark):
    values = spark.createDataFrame([(i * i,) for i in range(400)], "v bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["v"]: r["before"] for r in with_previous(values.repartition(5), "v", "before").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i * i: (i - 1) ** 2 if i else None for i in range(400)}


def test_one_range_or_many_give_the_same_totals(spark):
    counts = spark.createDataFrame([(i % 3, i, 1 + i % 5) for i in range(600)], "g int, v int, n int")
    results = []
    for merge in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
        results.append(sorted(map(tuple, running_totals(counts, "v", ["n"], ["g"]).collect())))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert results[0] == results[1] and len(results[0]) == 600
