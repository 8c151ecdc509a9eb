"""Fully grown trees on larger tables."""

from furlens.operators import classifiers as M


def test_deep_trees_keep_the_node_of_each_row(spark, monkeypatch):
    """Without it every pass ships all trees grown so far and walks each row down from the root."""
    asked = []
    monkeypatch.setattr(M, "_mllib", lambda estimator, train, test: asked.append(estimator.getCacheNodeIds()))
    rows = spark.createDataFrame([("a", 0, [0.0]), ("b", 1, [1.0])], "image_id string, label int, features array<double>")
    M.random_forest(rows, rows)
    M.decision_tree(rows, rows)
    assert asked == [True, True]
