"""Sigmoid of decision values against the formula, SQL and its edges."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from furlens.operators import bayes, calibration as C, classifiers as M
from furlens_suite.learn_queries import sigmoid_sql
from tests.test_learn import labelled


def decided(spark, f, y):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(f, y)], "decision double, label int").repartition(4)


def loss(f, y, a, b):
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = a * f + b
    return (t * z + np.logaddexp(0, -z)).sum()


@pytest.mark.parametrize("scale, shift, share", [(1.0, 0.0, 0.5), (300.0, 40.0, 0.5), (1e-3, 0.0, 0.02)])
def test_sigmoid_is_at_the_minimum(spark, scale, shift, share):
    rng = np.random.default_rng(3)
    y = (rng.random(600) < share).astype(int)
    f = (rng.normal(size=600) + y) * scale + shift
    got = C.fit_sigmoid(decided(spark, f, y))
    best = loss(f, y, got.a, got.b)
    for da, db in rng.normal(size=(200, 2)) * 1e-3:
        assert loss(f, y, got.a + da / scale, got.b + db) >= best - 1e-9
    assert got.a < 0


@pytest.mark.parametrize("y", [[0, 0, 1, 1], [1, 1, 1, 1], [0, 0, 0, 0]])
def test_separable_rows_and_single_labels_stay_finite(spark, y):
    got = C.fit_sigmoid(decided(spark, [-2.0, -1.0, 1.0, 2.0], y))
    p = [r[0] for r in decided(spark, [-2.0, 2.0], [0, 1]).select(got.of(F.col("decision"))).collect()]
    assert np.isfinite([got.a, got.b]).all() and all(0 < v < 1 for v in p)
    if len(set(y)) == 1:
        assert all(abs(v - y[0]) < 0.25 for v in p)


def test_equal_decisions_give_the_share(spark):
    got = C.fit_sigmoid(decided(spark, [1.0] * 30, [0] * 20 + [1] * 10))
    p = decided(spark, [1.0], [0]).select(got.of(F.col("decision"))).first()[0]
    assert abs(p - (10 * 11 / 12 + 20 / 22) / 30) < 1e-6


def test_rows_without_a_usable_value_take_no_part(spark):
    rows = [(0.5, 1), (-0.5, 0), (0.1, 0), (-0.2, 1)]
    extra = [(None, 1), (float("nan"), 1), (float("inf"), 0), (3.0, None), (3.0, 7)]
    schema = "decision double, label int"
    want, got = (C.fit_sigmoid(spark.createDataFrame(r, schema)) for r in (rows, rows + extra))
    assert abs(want.a - got.a) < 1e-9 and abs(want.b - got.b) < 1e-9
    with pytest.raises(ValueError):
        C.fit_sigmoid(spark.createDataFrame(extra, schema))


def test_cross_decisions_come_from_models_that_did_not_see_the_row(spark):
    df = labelled(spark, 200, dim=3, copies=40)

    def decide(train, rows):
        seen = train.select("image_id").distinct().withColumn("seen", F.lit(True))
        assert rows.join(seen, "image_id").count() == 0
        return bayes.log_odds(rows, bayes.fit(train))

    got = C.cross_decisions(df, decide)
    assert got.count() == 240 and got.filter("decision is null").count() == 0


def test_cross_decisions_with_one_label(spark):
    one = labelled(spark, 20, dim=2).filter("label = 1")
    got = C.cross_decisions(one, lambda train, rows: pytest.fail("nothing to fit"))
    assert {r["decision"] for r in got.collect()} == {1.0} and got.count() == 10


def test_svm_probabilities_against_sql_on_stored_decisions(spark, tmp_path):
    train, test = labelled(spark, 160), labelled(spark, 60, seed=9)

    def decide(fitted_on, rows):
        return M._svm_decisions(fitted_on, rows, 5, 24, 64)

    C.cross_decisions(train, decide).write.parquet(str(tmp_path / "decisions"))
    stored = spark.read.parquet(str(tmp_path / "decisions"))
    got = C.fit_sigmoid(stored)
    sql = f"""with recursive stored as (select * from '{tmp_path}/decisions/*.parquet'), {sigmoid_sql("stored")}
    select a, b from sigmoid"""
    a, b = duckdb.sql(sql).fetchall()[0]
    assert abs(got.a - a) < 1e-6 and abs(got.b - b) < 1e-6

    rows = M.kernel_svm_probability(train, test, max_iter=5, out_dim=64, folds=2).collect()
    plain = {r["image_id"]: r["prediction"] for r in M.kernel_svm(train, test, max_iter=5, out_dim=64).collect()}
    assert {r["image_id"]: r["prediction"] for r in rows} == plain
    order = sorted(rows, key=lambda r: r["decision"])
    assert all(x["probability"] <= y["probability"] for x, y in zip(order, order[1:]))
    assert np.mean([(r["probability"] > 0.5) == r["label"] for r in rows]) > 0.8
