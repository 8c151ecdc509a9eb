import math

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from furlens.operators import bayes, classifiers as M, metrics, neighbors, performance, split, sweep
from furlens.operators.scaling import scale, scaler
from furlens.plans import evaluate, extract
from furlens.sources import schemas as S


def labelled(spark, n=120, dim=24, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[: n // 2] += 1.0
    rows = [(f"img_{i}", int(i >= n // 2), x[i].tolist()) for i in range(n)]
    rows += [(f"copy_{i}", 1, x[0].tolist()) for i in range(copies)]
    return spark.createDataFrame(rows, "image_id string, label int, features array<double>").repartition(4)


# ----------------------------------------------------------------------- split


@pytest.mark.parametrize("rows, want", [({0: 4, 1: 4}, {0: 2, 1: 1}), ({0: 10}, {0: 3}), ({0: 1, 1: 99}, {0: 0, 1: 30})])
def test_quotas(rows, want):
    assert split.quotas(rows, 0.3) == want
    assert sum(want.values()) == math.ceil(sum(rows.values()) * 0.3 - 1e-9)


def test_split_is_exact_and_reproducible(spark):
    df = labelled(spark, 500)
    flagged = split.stratified_split(df)
    per_label = {r["label"]: (r["n"], r["t"]) for r in flagged.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert per_label == {0: (250, 75), 1: (250, 75)}
    again = split.stratified_split(df.repartition(7))
    picked = {r["image_id"] for r in flagged.filter("is_test").collect()}
    assert picked == {r["image_id"] for r in again.filter("is_test").collect()}
    assert picked != {r["image_id"] for r in split.stratified_split(df, seed=7).filter("is_test").collect()}


def test_split_with_a_third_of_the_rows_under_one_id(spark):
    same_id = spark.range(400).selectExpr("'hot' as image_id", "0 as label", "array(cast(id as double)) as features")
    others = spark.range(800).selectExpr("cast(id as string) as image_id", "cast(id % 2 as int) as label", "array(0.5D) as features")
    flagged = split.stratified_split(same_id.union(others))
    assert flagged.count() == 1200
    assert flagged.filter("is_test").count() == 360
    assert flagged.select("image_id", "label", "features").distinct().count() == 1200


def test_split_of_equal_rows(spark):
    equal = spark.range(1000).selectExpr("'same' as image_id", "1 as label", "array(1.0D) as features")
    flagged = split.stratified_split(equal)
    assert flagged.count() == 1000 and flagged.filter("is_test").count() == 300


def test_split_shuffles_no_rows(spark):
    plan = split.stratified_split(spark.range(100).selectExpr("cast(id as string) image_id", "cast(id % 2 as int) label"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- scaling, bayes


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([([1.0, 5.0],), ([3.0, 5.0],)], "features array<double>")
    fitted = scaler(df)
    assert fitted.mean == [2.0, 5.0] and fitted.scale == [1.0, 1.0]
    assert sorted(r[0] for r in scale(df, fitted).collect()) == [[-1.0, 0.0], [1.0, 0.0]]


def test_naive_bayes_matches_the_formula(spark):
    df = labelled(spark, 80, dim=5)
    rows = df.collect()
    x = np.array([r["features"] for r in rows])
    y = np.array([r["label"] for r in rows])
    floor = 1e-9 * x.var(axis=0).max()
    score = []
    for c in (0, 1):
        m, v = x[y == c].mean(axis=0), x[y == c].var(axis=0) + floor
        score.append(np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * v) + (x - m) ** 2 / v).sum(axis=1))
    want = {r["image_id"]: int(k) for r, k in zip(rows, np.argmax(score, axis=0))}
    got = bayes.predict(df, bayes.fit(df)).collect()
    assert {r["image_id"]: r["prediction"] for r in got} == want


# ------------------------------------------------------------------ neighbours


def brute_force(train, test, k=5):
    ids = sorted(range(len(train)), key=lambda i: train[i]["image_id"])
    want = {}
    for t in test:
        d = [(round(float(((np.array(t["features"]) - np.array(train[i]["features"])) ** 2).sum()), 9), train[i]["image_id"], train[i]["label"]) for i in ids]
        near = sorted(d)[:k]
        want[t["image_id"]] = int(sum(n[2] for n in near) * 2 > len(near))
    return want


@pytest.mark.parametrize("copies", [0, 90])
def test_neighbours_match_brute_force(spark, copies):
    train, test = labelled(spark, 150, dim=3, copies=copies), labelled(spark, 60, dim=3, seed=5, copies=copies // 2)
    got = {r["image_id"]: r["prediction"] for r in neighbors.predict(train, test).collect()}
    assert got == brute_force(train.collect(), test.collect())


def test_neighbours_with_few_or_no_train_rows(spark):
    few, test = labelled(spark, 4, dim=2), labelled(spark, 6, dim=2, seed=1)
    assert neighbors.predict(few, test).count() == 6
    assert neighbors.predict(few.limit(0), test).count() == 0


def test_neighbours_shuffle_nothing(spark):
    train, test = labelled(spark, 40, dim=2), labelled(spark, 30, dim=2, seed=1)
    plan = neighbors.predict(train, test)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan


def test_train_rows_are_bounded_by_hash(spark):
    rows = labelled(spark, 400, dim=2)
    assert split.bounded_rows(rows, "image_id", None).count() == split.bounded_rows(rows, "image_id", 400).count() == 400
    few = split.bounded_rows(rows, "image_id", 100)
    assert 60 <= few.count() <= 140 and few.exceptAll(split.bounded_rows(rows, "image_id", 200)).isEmpty()


def test_split_counts_without_reading_features(spark, tmp_path):
    path = str(tmp_path / "rows")
    labelled(spark, 40, dim=2).write.parquet(path)
    rows = spark.read.parquet(path)
    seen = []
    real = split._narrow
    split._narrow = lambda keyed, *a: seen.append(keyed._jdf.queryExecution().executedPlan().toString()) or real(keyed, *a)
    try:
        split.stratified_split(rows).count()
    finally:
        split._narrow = real
    assert seen and all("features" not in plan for plan in seen)


# ----------------------------------------------------------------- metrics


def test_weighted_f1_golden(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    got = metrics.scores(df).first()
    assert abs(got["accuracy"] - 2 / 3) < 1e-12 and abs(got["f1_score"] - 0.5333333333333333) < 1e-12
    assert metrics.accuracy(df).first()[0] == got["accuracy"]


def test_weighted_f1_agrees_with_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(200).selectExpr("cast(id % 3 as int) label", "cast(id * 7 % 5 % 3 as double) prediction")
    theirs = MulticlassClassificationEvaluator(metricName="f1", labelCol="label").evaluate(df)
    assert abs(metrics.weighted_f1(df).first()[0] - theirs) < 1e-12


# ------------------------------------------------------------ models and sweep


def light_models():
    def few(f, **kw):
        return lambda train, test: f(train, test, **kw)

    return [
        M.ModelSpec("Random Forest", False, few(M.random_forest, trees=3)),
        M.ModelSpec("Logistic Regression", True, few(M.logistic, max_iter=5)),
        M.ModelSpec("Decision Tree", False, M.decision_tree),
        M.ModelSpec("SVM", True, few(M.kernel_svm, max_iter=5)),
        M.ModelSpec("Naive Bayes", False, M.naive_bayes),
        M.ModelSpec("K-Neighbors", True, M.nearest),
        M.ModelSpec("Neural Network", True, few(M.perceptron, max_iter=5)),
        M.ModelSpec("XGBoost", False, few(M.boosted_trees, rounds=2, depth=2)),
    ]


def test_default_models_in_order():
    assert [m.name for m in M.default_models()] == [m.name for m in light_models()]
    assert [m.needs_scaling for m in M.default_models()] == [m.needs_scaling for m in light_models()]
    assert M.FULL_DEPTH == 30


def test_every_model_learns_and_a_failure_is_a_row(spark, tmp_path):
    def stored(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    train, test = stored(labelled(spark, 160), "train"), stored(labelled(spark, 60, seed=9), "test")
    # The earlier stages observe their writes; models have to work in such a session.
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 3

    def broken(train, test):
        raise ValueError("no fit")

    models = light_models() + [M.ModelSpec("Broken", False, broken)]
    results = {r["model_name"]: r for r in sweep.run_sweep(models, train, test, 3)["results"]}
    bad = results.pop("Broken")
    assert not bad["success"] and bad["accuracy"] == 0.0 and "no fit" in bad["error"]
    for name, r in results.items():
        assert r["success"], (name, r["error"])
        assert r["accuracy"] > 0.7 and r["training_time"] > 0, name


def test_levels_need_enough_cores(spark):
    assert sweep.usable_levels(spark) == [1, 2, 4, 6]
    with pytest.raises(ValueError):
        sweep.usable_levels(spark, (1000,))


def test_random_features_approximate_the_kernel(spark):
    a, b = np.full(24, 0.1), np.full(24, -0.2)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<double>, b array<double>")
    lift = M.fourier_features(out_dim=8192)
    za, zb = (np.array(v) for v in df.select(lift(F.col("a")), lift(F.col("b"))).first())
    assert abs(za @ zb - math.exp(-((a - b) ** 2).sum() / 24)) < 0.05


# ---------------------------------------------------------------- performance

CONFIGS = [("1_cores", 1, 0.63517, "sequential"), ("2_cores", 2, 1.90119, "parallel_2cores"), ("6_cores", 6, 0.25183, "parallel_6cores")]


def test_speedup_golden(spark):
    got = {r["config"]: r for r in performance.speedup(spark.createDataFrame(CONFIGS, S.CONFIG_RUNS)).collect()}
    assert got["1_cores"]["speedup"] == got["1_cores"]["efficiency"] == 1.0
    assert abs(got["2_cores"]["speedup"] - 0.33409) < 1e-5 and abs(got["2_cores"]["efficiency"] - 0.16705) < 1e-5
    assert abs(got["6_cores"]["speedup"] - 2.52221) < 1e-4 and abs(got["6_cores"]["efficiency"] - 0.42037) < 1e-5
    best = performance.best_config(performance.speedup(spark.createDataFrame(CONFIGS, S.CONFIG_RUNS))).first()
    assert best["config"] == "6_cores"


def test_speedup_edges(spark):
    no_base = spark.createDataFrame(CONFIGS[1:], S.CONFIG_RUNS)
    assert performance.speedup(no_base).count() == 0
    zero = spark.createDataFrame([CONFIGS[0], ("2_cores", 2, 0.0, "p")], S.CONFIG_RUNS)
    got = performance.speedup(zero).filter("config = '2_cores'").first()
    assert got["speedup"] == 1.0 and got["efficiency"] == 0.5
    only_base = performance.speedup(spark.createDataFrame(CONFIGS[:1], S.CONFIG_RUNS))
    assert performance.best_config(only_base).count() == 0


def test_summaries_skip_failures(spark):
    runs = spark.createDataFrame(
        [("1_cores", "A", 0.5, 0.4, 1.0, True, None, 0), ("1_cores", "B", 0.5, 0.3, 2.0, True, None, 1), ("1_cores", "C", 0.9, 0.9, 1.0, False, "e", 2), ("2_cores", "A", 0.0, 0.0, 0.0, False, "e", 0)],
        S.MODEL_RUNS,
    )
    configs = spark.createDataFrame(CONFIGS, S.CONFIG_RUNS)
    assert [(r[0], r[1]) for r in performance.average_accuracy(runs).collect()] == [("1_cores", 0.5)]
    assert [tuple(r) for r in performance.simple_report(runs, configs).collect()] == [("1_cores", 0.5, 0.63517, 2)]
    assert performance.best_model(runs).first()["model_name"] == "A"


# ---------------------------------------------------------------- end to end


def test_extract_and_evaluate_run(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [
        (f"i{n}", n % 2, "k", "t", str(rng.integers(100 * (n % 2), 156 + 100 * (n % 2), (8, 8, 3)).tolist()), "[8, 8, 3]")
        for n in range(40)
    ] + [("bad", 0, "k", "t", "[[[1", None)]
    spark.createDataFrame(rows, S.VALID).write.parquet(str(tmp_path / "valid"))
    report = extract.run(spark, str(tmp_path / "valid"), str(tmp_path / "features"))
    assert report == {"total": 41, "ok": 40, "dim": 24, "no_hardcoding": True, "failed": 1}
    models = [m for m in M.default_models() if m.name in ("Naive Bayes", "K-Neighbors")]
    speedups = evaluate.run(spark, str(tmp_path / "features"), str(tmp_path / "out"), levels=(1, 2), models=models)
    assert {r["config"] for r in speedups.collect()} == {"1_cores", "2_cores"}
    csv = spark.read.option("header", True).csv(str(tmp_path / "out" / "model_performance"))
    assert csv.columns == ["config", "model", "accuracy", "f1_score", "training_time"] and csv.count() == 4
    saved = spark.read.json(str(tmp_path / "out" / "report")).first()
    assert saved["data_info"]["samples"] == 40 and saved["data_info"]["class_distribution"]["1"] == 20
    assert len(saved["parallel_results"]["2_cores"]["results"]) == 2
