"""Models learn from every train row, however many there are."""

import pytest

from furlens.operators import calibration, classifiers as M, neighbors, sweep
from tests.test_learn import brute_force, labelled

MANY = 1_200_000


@pytest.fixture
def many(spark):
    return spark.range(MANY).selectExpr("cast(id as string) as image_id", "cast(id % 2 as int) as label", "array(cast(id as double)) as features")


@pytest.mark.parametrize("fit", [M.random_forest, M.decision_tree])
def test_trees_are_fitted_on_all_rows(many, monkeypatch, fit):
    seen = []
    monkeypatch.setattr(M, "_mllib", None)
    monkeypatch.setattr(M.forest, "fit_predict", lambda train, test, *a: seen.append(train.count()) or test)
    fit(many, many)
    assert seen == [MANY]


def test_svm_is_fitted_on_all_rows(many, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "_svm_decisions", lambda train, rows, *a: seen.append(train.count()) or rows.selectExpr("image_id", "label", "0D as decision"))
    monkeypatch.setattr(calibration, "cross_decisions", lambda train, decide, folds: decide(train, train))
    monkeypatch.setattr(calibration, "fit_sigmoid", lambda decisions: calibration.Sigmoid(0.0, 0.0))
    M.kernel_svm(many, many)
    M.kernel_svm_probability(many, many)
    assert seen == [MANY] * 3


def test_a_search_needs_no_installed_copy():
    """Functions of this package go to the workers by value; an import inside one would not find it there."""
    assert not [n for n in neighbors.neighbor_join._searched.__code__.co_names if "furlens" in n]


def test_more_train_rows_than_are_broadcast_all_count(spark):
    train, test = labelled(spark, 300, dim=3), labelled(spark, 60, dim=3, seed=5)
    got = {r["image_id"]: r["prediction"] for r in M.nearest(train, test, max_train_rows=50).collect()}
    assert got == brute_force(train.collect(), test.collect())


def test_train_rows_too_large_for_a_broadcast_all_count(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "MAX_BROADCAST_BYTES", 1000)
    train, test = labelled(spark, 80, dim=3), labelled(spark, 30, dim=3, seed=5)
    got = {r["image_id"]: r["prediction"] for r in M.nearest(train, test).collect()}
    assert got == brute_force(train.collect(), test.collect())


@pytest.mark.parametrize("level", [1, 4])
def test_sweeps_leave_no_train_row_out(spark, many, monkeypatch, level):
    """The models of a sweep that had a bound, of its trees, SVM and neighbours."""
    seen = {}
    monkeypatch.setattr(M.forest, "fit_predict", lambda train, test, width, trees, *a: seen.update({trees: train.count()}) or test)
    monkeypatch.setattr(M, "_svm_decisions", lambda train, rows, *a: seen.update(SVM=train.count()))
    monkeypatch.setattr(neighbors.neighbor_join, "predict", lambda train, test, *a: seen.update(neighbours=train.count()))
    models = [m for m in M.default_models() if m.name in ("Random Forest", "Decision Tree", "SVM", "K-Neighbors")]
    sweep.run_sweep(models, many, many.limit(5), level)
    assert seen == dict.fromkeys([100, 1, "SVM", "neighbours"], MANY)
