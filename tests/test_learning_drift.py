import datetime as dt
import inspect
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from hourtide.functions.numeric import kolmogorov_tail
from hourtide.operators import clusters, drift, features, metrics, models, registry, rules, splits
from hourtide.plans import catalog, jobs


def stamps(spark, n, per_stamp=1):
    start = dt.datetime(2000, 1, 1)
    return spark.createDataFrame(
        [(start + dt.timedelta(hours=i // per_stamp), i) for i in range(n)], "date_time timestamp_ntz, id int"
    )


@pytest.mark.parametrize("n", [1, 4, 10, 101])
def test_holdout_is_the_last_fifth_rounded_up(spark, n):
    out = splits.holdout_tail(stamps(spark, n)).collect()
    held = sorted(r["id"] for r in out if r["part"] == "holdout")
    assert held == list(range(n - math.ceil(0.2 * n), n))


def test_holdout_breaks_ties_by_key(spark):
    out = splits.holdout_tail(stamps(spark, 20, per_stamp=7), tie="id").collect()
    assert sorted(r["id"] for r in out if r["part"] == "holdout") == [16, 17, 18, 19]


def test_chronological_split_leaves_other_years_out(spark):
    df = spark.sql("select explode(sequence(1998, 2003)) y").selectExpr("make_timestamp_ntz(y, 12, 31, 23, 59, 59) date_time", "y")
    got = dict(splits.chronological_split(df, 1999).select("y", "split").collect())
    assert got == {1998: "train", 1999: "train", 2000: "test", 2001: "production", 2002: None, 2003: None}


def test_standard_scale_uses_training_rows_and_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1), (3.0, 5.0, 1), (5.0, 6.0, 0)], "a double, b double, train int")
    out = splits.standard_scale(df, ["a", "b"], F.col("train") == 1).orderBy("a").collect()
    assert [r["a_z"] for r in out] == [-1.0, 1.0, 3.0] and [r["b_z"] for r in out] == [0.0, 0.0, 1.0]


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "high_risk int")
    weighted = splits.with_class_weights(df)
    assert [r[0] for r in weighted.groupBy("high_risk").agg(F.sum("weight")).select("sum(weight)").collect()] == [6.0, 6.0]


def scored(spark, n=600, ties=11):
    rng = random.Random(3)
    data = [(rng.randint(0, 1), round(rng.random() * ties) / ties) for _ in range(n)]
    return spark.createDataFrame([(y, s, int(s > 0.5)) for y, s in data], "y int, score double, prediction int")


def test_auc_agrees_with_mllib_and_pairs(spark):
    df = scored(spark)
    ours = metrics.roc_auc(df, "y", "score").first()["roc_auc"]
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    assert ours == pytest.approx(judge.evaluate(df.withColumn("y", F.col("y").cast("double"))))
    pos = [r["score"] for r in df.collect() if r["y"] == 1]
    neg = [r["score"] for r in df.collect() if r["y"] == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg))
    assert ours == pytest.approx(wins / (len(pos) * len(neg)))


def test_equal_scores_give_one_half_and_one_class_gives_null(spark):
    same = spark.createDataFrame([(0, 0.3), (1, 0.3), (1, 0.3)], "y int, score double")
    assert metrics.roc_auc(same, "y", "score").first()["roc_auc"] == 0.5
    assert metrics.roc_auc(same.where("y = 1"), "y", "score").first()["roc_auc"] is None


def test_classification_metrics_are_zero_where_undefined(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (1, 0, 0.2)], "y int, prediction int, score double")
    row = metrics.classification_metrics(df, "y").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["roc_auc"]) == (0.5, 0.0, 0.0, 0.0, 1.0)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "y").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, prediction double")
    row = metrics.regression_metrics(df, "y").first()
    assert row["mae"] == 1.0 and row["r2"] == pytest.approx(1 - 5 / 8)
    assert metrics.regression_metrics(df.limit(1), "y").first()["r2"] is None


def test_unseen_groups_get_the_overall_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("b", 3.0, 1), ("c", 0.0, 0)], "k string, y double, fit int")
    out = metrics.group_mean_prediction(df, F.col("fit") == 1, ["k"], "y")
    assert {r["k"]: r["prediction"] for r in out.collect()} == {"a": 1.0, "b": 3.0, "c": 2.0}


def two_samples(spark, a, b):
    return spark.createDataFrame(
        [("train", float(x)) for x in a] + [("production", float(x)) for x in b], "split string, x double"
    )


def test_ks_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.2, 1, 170), 1)
    grid = np.concatenate([a, b])
    expected = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    row = drift.feature_drift_ks(two_samples(spark, a, b), ["x"]).first()
    assert row["ks_statistic"] == pytest.approx(expected, abs=1e-12)
    assert (row["n_first"], row["n_second"]) == (300, 170)
    turned = drift.feature_drift_ks(two_samples(spark, b, a), ["x"]).first()
    assert turned["ks_statistic"] == pytest.approx(expected, abs=1e-12)


def exact_ks_tail(d, n, m):
    """P(D >= d): lattice paths from (0, 0) to (n, m) that leave the band |i/n - j/m| < d, counted."""
    inside = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i / n - j / m) < d - 1e-12:
                inside[i][j] = 1 if i == j == 0 else (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0)
    return 1 - inside[n][m] / math.comb(n + m, n)


@pytest.mark.parametrize("n,m", [(8, 9), (30, 21), (120, 95)])
def test_ks_p_value_is_near_the_exact_one(spark, n, m):
    rng = np.random.default_rng(n)
    for shift in (0.0, 0.4, 0.9):
        a, b = rng.normal(0, 1, n), rng.normal(shift, 1, m)
        row = drift.feature_drift_ks(two_samples(spark, a, b), ["x"]).first()
        exact = exact_ks_tail(row["ks_statistic"], n, m)
        assert row["p_value"] == pytest.approx(exact, abs=0.06 if n < 10 else 0.02)


def test_ks_of_equal_and_of_disjoint_samples(spark):
    same = drift.feature_drift_ks(two_samples(spark, range(50), range(50)), ["x"]).first()
    assert (same["ks_statistic"], same["p_value"], same["status"]) == (0.0, 1.0, "PASS")
    apart = drift.feature_drift_ks(two_samples(spark, range(50), range(100, 150)), ["x"]).first()
    assert apart["ks_statistic"] == 1.0 and apart["p_value"] < 1e-12 and apart["status"] == "ALERT"
    asked = drift.feature_drift_ks(two_samples(spark, range(50), range(25, 75)), ["x"], min_statistic=0.6).first()
    assert asked["p_value"] < 0.05 and asked["status"] == "PASS"


def test_tail_probability_matches_the_published_value_within_rounding(spark):
    df = spark.createDataFrame([(0.01445,), (0.01455,), (0.0038,)], "d double")
    p = [r[0] for r in df.select(kolmogorov_tail(F.col("d"), F.lit(25329), F.lit(6533))).collect()]
    assert p[0] > 0.2237 > p[1]
    assert round(p[2], 3) == 1.0


def test_both_series_of_the_tail_agree_where_they_meet(spark):
    df = spark.createDataFrame([(0.9985,), (1.0015,)], "x double")
    root = 1e4
    p = [r[0] for r in df.select(kolmogorov_tail(F.col("x") / root, F.lit(2 * root**2), F.lit(2 * root**2))).collect()]
    plain = [2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 60)) for x in (0.9985, 1.0015)]
    assert p == pytest.approx(plain, abs=1e-4)


def test_error_drift_alerts_on_increase_only(spark):
    def check(after):
        df = spark.createDataFrame([(10.0, 0.0, "holdout"), (after, 0.0, "production"), (99.0, 0.0, "fit")], "y double, prediction double, part string")
        row = drift.prediction_error_drift(df, "y").first()
        return row["status"], row["note"]

    assert check(12.1) == ("ALERT", "") and check(12.0) == ("PASS", "") and check(5.0) == ("PASS", "error decreased")


def test_monitoring_report_lines(spark, sf_dir):
    status = drift.monitoring_status(*jobs.monitoring_checks(spark, sf_dir))
    row = status.first()
    assert row["overall_status"] in ("ALERT", "PASS") and len(row["feature_drift"]) == 4
    lines = [r["line"] for r in drift.monitoring_report(status).orderBy("line_no").collect()]
    assert lines[-1] == f"OVERALL: {row['overall_message']}" and len(lines) == 9


def test_rules_equal_frequent_pattern_growth(spark, sf_dir):
    table = jobs.featured_table(spark, sf_dir)
    ours = {
        (tuple(r["antecedent"]), tuple(r["consequent"])): (r["support"], r["confidence"], r["lift"])
        for r in rules.association_rules(table, rules.basket_columns()).collect()
    }
    items = F.array(*[F.concat(F.lit(f"{n}="), c) for n, c in rules.basket_columns().items()])
    mined = FPGrowth(itemsCol="items", minSupport=0.01, minConfidence=0.0).fit(table.select(items.alias("items")))
    theirs = {
        (tuple(sorted(r["antecedent"])), tuple(r["consequent"])): (r["support"], r["confidence"], r["lift"])
        for r in mined.associationRules.collect()
        if r["consequent"][0].startswith("congestion=") and r["lift"] >= 1
    }
    assert ours.keys() == theirs.keys() and len(ours) > 20
    assert all(ours[k] == pytest.approx(theirs[k]) for k in ours)
    top = [r["lift"] for r in rules.top_rules(rules.association_rules(table, rules.basket_columns()), 5).collect()]
    assert top == sorted((v[2] for v in ours.values()), reverse=True)[:5]


def test_linear_model_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ [2.0, -1.0, 0.5] + 4 + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, traffic_volume double")
    model = models.fit(models.LINEAR, df, ["a", "b", "c"]).stages[-1]
    solution = np.linalg.lstsq(np.c_[x, np.ones(200)], y, rcond=None)[0]
    assert list(model.coefficients) + [model.intercept] == pytest.approx(solution.tolist(), abs=1e-6)


def test_boosting_beats_the_mean_and_is_stored(spark, sf_dir, tmp_path):
    train, test = jobs.training_rows(spark, sf_dir), jobs.featured_rows(spark, sf_dir, "test")
    spec = models.GBT.with_params(maxIter=3)
    names = features.feature_columns(train)
    paths = [str(tmp_path / "registry"), str(tmp_path / "folder")]
    model, origin = models.load_or_fit(spec, train, names, paths)
    assert origin == "fitted"
    again, origin = models.load_or_fit(spec, train, names, paths)
    assert origin == paths[1]
    mae = models.evaluate(spec, model, test).first()["mae"]
    assert models.evaluate(spec, again, test).first()["mae"] == mae
    mean = train.agg(F.avg("traffic_volume")).first()[0]
    assert mae < 0.7 * test.agg(F.avg(F.abs(F.col("traffic_volume") - mean))).first()[0]
    ranked = models.feature_importance(model, names, spark, 5).collect()
    assert len(ranked) == 5 and ranked[0]["importance"] >= ranked[-1]["importance"]
    effect = models.permutation_importance(model, test, names, "traffic_volume", "date_time")
    found = {r["feature"]: r["increase"] for r in effect.collect()}
    assert set(found) == set(names) and max(found, key=found.get) in ("hour_sin", "hour_cos")
    assert abs(found["is_snowy"] if "is_snowy" in found else 0.0) < 50


def test_permutation_covers_every_row_once(spark, sf_dir):
    """An unused feature changes nothing, and the base error is the plain error of the model."""
    train = jobs.training_rows(spark, sf_dir).withColumn("constant", F.lit(1.0))
    model = models.fit(models.GBT.with_params(maxIter=1), train, ["hour_sin", "hour_cos", "constant"])
    effect = models.permutation_importance(model, train, ["hour_sin", "hour_cos", "constant"], "traffic_volume", "date_time")
    rows = {r["feature"]: r for r in effect.collect()}
    plain = models.evaluate(models.GBT, model, train).first()["mae"]
    assert rows["constant"]["increase"] == pytest.approx(0.0, abs=1e-9)
    assert rows["hour_sin"]["base_mae"] == pytest.approx(plain)


def test_classifiers_report_all_metrics(spark, sf_dir, tmp_path):
    train, test = jobs.training_rows(spark, sf_dir), jobs.featured_rows(spark, sf_dir, "test")
    names = features.feature_columns(train)
    for spec in (models.LOGISTIC.with_params(maxIter=20), models.FOREST_CLASSIFIER.with_params(numTrees=5, maxDepth=6)):
        model = models.fit(spec, train, names)
        found = models.evaluate(spec, model, test)
        row = found.first()
        assert row["roc_auc"] > 0.8 and 0 < row["f1"] <= 1
        registry.append_run(spark, f"{tmp_path}/runs", spec, found, f"{tmp_path}/{spec.kind}", "production")
        model.write().save(f"{tmp_path}/{spec.kind}")
        record = registry.leaderboard(spark, f"{tmp_path}/runs").where(F.col("run") == spec.name).first()
        assert record["metrics"]["roc_auc"] == row["roc_auc"] and record["params"] and record["alias"] == "production"
    registry.append_run(spark, f"{tmp_path}/runs", spec, found, f"{tmp_path}/{spec.kind}")
    versions = registry.runs(spark, f"{tmp_path}/runs").where(F.col("run") == spec.name).select("version", "alias").orderBy("version").collect()
    assert [tuple(r) for r in versions] == [(1, "production"), (2, None)]
    served = registry.load_aliased(spark, f"{tmp_path}/runs", "production")
    assert models.evaluate(spec, served, test).first() == row
    with pytest.raises(LookupError):
        registry.load_aliased(spark, f"{tmp_path}/none", "production")


def test_registered_models_have_the_published_sizes():
    """The catalogue trains the library's defaults, and these are the published settings."""
    assert models.GBT.params["maxIter"] == 200 and models.GBT.params["maxDepth"] == 5
    assert (models.FOREST.params["numTrees"], models.FOREST.params["maxDepth"]) == (200, 15)
    assert (models.FOREST_CLASSIFIER.params["numTrees"], models.FOREST_CLASSIFIER.params["maxDepth"]) == (100, 30)
    assert models.LOGISTIC.params["maxIter"] == 1000
    assert inspect.signature(clusters.k_sweep).parameters["restarts"].default == 10
    source = inspect.getsource(catalog)
    assert "with_params" not in source and "restarts" not in source


def test_cluster_profiles_are_ordered_and_named(spark, sf_dir):
    table = jobs.featured_table(spark, sf_dir)
    out = clusters.cluster_profiles(table, restarts=2).orderBy("cluster").collect()
    assert [r["cluster"] for r in out] == [0, 1, 2, 3] and sum(r["size"] for r in out) == table.count()
    volumes = [r["mean_volume"] for r in out]
    assert volumes == sorted(volumes) and all(r["action"] for r in out)
    sweep = clusters.k_sweep(table, ks=(2, 4), restarts=1).orderBy("k").collect()
    assert sweep[0]["inertia"] > sweep[1]["inertia"] and -1 <= sweep[0]["silhouette"] <= 1


def test_cluster_names(spark):
    cases = [(12.0, 1499.0), (19.0, 2000.0), (12.0, 2000.0), (7.0, 2999.0), (7.0, 3000.0), (12.0, 4500.0)]
    df = spark.createDataFrame([(i, h, v) for i, (h, v) in enumerate(cases)], "cluster int, mean_hour double, mean_volume double")
    names = [r["name"] for r in clusters.name_profiles(df).orderBy("cluster").collect()]
    assert names == ["Night lull", "Shoulder hours", "Midday moderate", "Shoulder hours", "Midday moderate", "Peak commute"]


def test_large_forest_is_fitted_in_groups(spark, tmp_path, monkeypatch):
    """Trees that could have more nodes than one fit may hold come in groups; the forest is the mean of all of them."""
    frame = spark.range(400).select(F.pmod(F.col("id") * 37, 101).cast("double").alias("a"), F.rand(1).alias("b"), (F.col("id") % 7).cast("double").alias("traffic_volume"))
    spec = models.FOREST.with_params(numTrees=9, maxDepth=3)
    whole, _ = models.load_or_fit(spec, frame, ["a", "b"], [str(tmp_path / "whole")])
    assert isinstance(whole, models.PipelineModel) and models.most_nodes(spec, 400) == 15 and models.most_nodes(spec, 2) == 3
    monkeypatch.setattr(models, "MOST_NODES", 45)
    path = str(tmp_path / "grouped")
    model, origin = models.load_or_fit(spec, frame, ["a", "b"], [path])
    assert origin == "fitted" and sum(model.trees.values()) == 9 and len(model.trees) >= 3
    parts = [models.PipelineModel.load(f"{path}/group-{i}") for i in model.trees]
    assert all(p.stages[-1].totalNumNodes <= 45 and p.stages[-1].getNumTrees == n for p, n in zip(parts, model.trees.values()))
    scored = frame.limit(20).cache()
    plain = [[tree.predict(p.stages[0].transform(scored).collect()[i]["features"]) for p in parts for tree in p.stages[-1].trees] for i in range(3)]
    again, origin = models.load_or_fit(spec, frame, ["a", "b"], [path])
    assert origin == path and isinstance(models.load(spark, path), models.GroupedForest)
    found = models.predict(again, scored)
    assert found.columns == [*scored.columns, "prediction"] and found.count() == 20
    keyed = {(r["a"], r["b"]): r["prediction"] for r in found.collect()}
    rows = scored.collect()
    assert [keyed[r["a"], r["b"]] for r in rows[:3]] == pytest.approx([sum(p) / 9 for p in plain])
    ranked = models.feature_importance(again, ["a", "b"], spark)
    assert sum(r["importance"] for r in ranked.collect()) == pytest.approx(1.0)


def test_training_rows_are_dealt_by_their_number(spark):
    """However few files the rows lie in, a regression forest has a part per core."""
    few = spark.range(0, 50_000, 1, 1).select((F.col("id") % 1000).cast("double").alias("a"), F.col("id").cast("double").alias("traffic_volume"))
    cores = spark.sparkContext.defaultParallelism

    def parts(spec, rows, frame=few):
        counts = models.dealt(spec, frame, rows).groupBy(F.spark_partition_id().alias("part")).count()
        return len(counts.collect())

    assert cores == 4 and parts(models.FOREST, 50_000) == 4 and parts(models.FOREST, 3_000_000) == 6
    assert parts(models.GBT, 50_000, few.repartition(5)) == 3
    assert parts(models.FOREST, 20_000) == 1 and parts(models.GBT, 20_000, few.repartition(5)) == 1
    one, other = ([r["a"] for r in models.dealt(models.FOREST, f, 50_000).collect()] for f in (few, few.repartition(7)))
    assert one == other


def test_forests_keep_the_nodes_of_rows(spark):
    """A pass starts from the kept nodes, not from the roots of all trees; the trees are the same ones."""
    a, b, c = F.pmod(F.col("id") * 37, 101), F.pmod(F.col("id") * 53, 97), F.pmod(F.col("id") * 11, 7)
    frame = spark.range(0, 600, 1, 1).select(
        a.cast("double").alias("a"), b.cast("double").alias("b"), (a * b + c).cast("double").alias("traffic_volume"), ((a + c) % 3 == 0).cast("int").alias("high_risk")
    )
    for spec in (models.FOREST.with_params(numTrees=4, maxDepth=12), models.FOREST_CLASSIFIER.with_params(numTrees=4, maxDepth=14)):
        assert models.pipeline(spec, ["a", "b"]).getStages()[-1].getCacheNodeIds()
        kept, plain = (models.fit(s, frame, ["a", "b"]).stages[-1] for s in (spec, spec.with_params(cacheNodeIds=False)))
        assert max(t.depth for t in kept.trees) > 10
        assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]
    assert spark.sparkContext.getCheckpointDir()
