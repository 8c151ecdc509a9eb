"""Rejected feature lines, and models of a sweep that are ended alone."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from furlens.operators import classifiers as M, sweep
from furlens.plans import evaluate, load
from tests.test_learn import labelled

EIGHT_MORE = list(range(11))


def line(**fields):
    return json.dumps(fields)


LINES = {
    line(image_id="a", label=1, image_features=EIGHT_MORE): None,
    line(image_id="b", label=0.0, image_features=EIGHT_MORE): None,
    "": "malformed",
    "not json": "malformed",
    '{"image_id": "c", "label": 1': "malformed",
    line(image_id="d", label=1): "no features",
    line(image_id="e", label=7): "no features",
    line(image_id="f", label=1, image_features=[]): "no features",
    line(image_id="g", label=1, image_features=EIGHT_MORE[:10]): "few features",
    line(image_id="h", image_features=EIGHT_MORE): "label",
    line(image_id="i", label=0.5, image_features=EIGHT_MORE): "label",
    line(image_id="j", label="cat", image_features=EIGHT_MORE): "malformed",
}


def test_every_line_is_stored_once_with_its_reason(spark, tmp_path):
    texts = list(LINES) * 3 + [None]
    out = str(tmp_path / "loaded")
    lines = spark.createDataFrame([(t, 1) for t in texts], "value string, line int").repartition(5)
    counts = load.load(lines, out)
    assert counts == {"valid": 6, "malformed": 13, "no features": 9, "few features": 3, "label": 6}
    rejected = sorted((r["line"] or "", r["reason"]) for r in load.rejected_lines(spark, out).collect())
    assert rejected == sorted([(t, r) for t, r in LINES.items() if r] * 3 + [("", "malformed")])
    good = load.valid_rows(spark, out)
    assert sorted((r["image_id"], r["label"]) for r in good.collect()) == [("a", 1)] * 3 + [("b", 0)] * 3
    assert evaluate.training_rows(good).count() == 6


def test_without_a_valid_line_the_rejects_stay_readable(spark, tmp_path):
    out = str(tmp_path / "loaded")
    with pytest.raises(ValueError):
        load.load(spark.createDataFrame([("x",), ("y",)], "value string"), out)
    assert load.rejected_lines(spark, out).count() == 2 and load.valid_rows(spark, out).count() == 0


def test_load_reads_text_files_once(spark, tmp_path):
    spark.createDataFrame([(t,) for t in LINES if t], "value string").repartition(3).write.text(str(tmp_path / "in"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    try:
        assert load.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))["valid"] == 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("load")]
    assert sum(len(j.stageIds) for j in jobs) == 1


# ---------------------------------------------------------------------- sweep


def slow_model(train, test):
    """Its job never ends within a test."""
    spin = F.udf(lambda v: time.sleep(90) or 1.0, "double")
    return test.coalesce(1).select("label", spin(F.size("features")).cast("int").alias("prediction"))


def restarting_model(train, test):
    """Goes on with a new job after its job was cancelled."""
    for _ in range(3):
        try:
            slow_model(train, test).collect()
        except Exception:
            continue
    raise RuntimeError("gave up")


def models():
    return [M.ModelSpec("Slow", False, slow_model), M.ModelSpec("Restarting", False, restarting_model)] + [
        M.ModelSpec(name, False, M.naive_bayes) for name in ("A", "B", "C")
    ]


@pytest.fixture(scope="module")
def sets(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sets") / "rows")
    labelled(spark, 60, dim=3).write.parquet(path)
    return spark.read.parquet(path), spark.read.parquet(path)


def outcomes(result):
    return {r["model_name"]: (r["success"], r["error"]) for r in result["results"]}


def test_an_overdue_model_ends_alone(sets):
    started = time.perf_counter()
    got = outcomes(sweep.run_sweep(models(), *sets, 3, sweep.Control(deadline=20)))
    assert time.perf_counter() - started < 100
    assert got == {n: (False, "over its 20 seconds") for n in ("Slow", "Restarting")} | {n: (True, None) for n in "ABC"}


def test_a_cancelled_model_ends_alone(spark, sets):
    control = sweep.Control()
    threading.Timer(8, lambda: [control.cancel(n) for n in ("Slow", "Restarting")]).start()
    got = outcomes(sweep.run_sweep(models(), *sets, 4, control))
    assert got == {n: (False, "cancelled") for n in ("Slow", "Restarting")} | {n: (True, None) for n in "ABC"}
    assert spark.range(10).count() == 10 and not spark.sparkContext.getJobTags()


def test_models_run_in_pools_of_their_own(spark, sets):
    seen = {}

    def noting(name):
        def fit(train, test):
            context = train.sparkSession.sparkContext
            seen[name] = (context.getLocalProperty("spark.scheduler.pool"), frozenset(context.getJobTags()))
            return M.naive_bayes(train, test)

        return M.ModelSpec(name, False, fit)

    sweep.run_sweep([noting("A"), noting("B")], *sets, 2)
    assert {n: pool for n, (pool, _) in seen.items()} == {"A": "2_cores A", "B": "2_cores B"}
    assert all(len(tags) == 1 for _, tags in seen.values()) and seen["A"][1] != seen["B"][1]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
