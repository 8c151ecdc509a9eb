"""Trees grown in tasks, with limits counted over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlens.operators import classifiers as M, forest
from tests.test_learn import labelled


def mllib_limits(column, bins):
    """Its rule, one value after the other."""
    values, counts = np.unique(column, return_counts=True)
    if len(values) <= bins:
        return ((values[1:] + values[:-1]) / 2).tolist()
    found, stride = [], len(column) / bins
    target, so_far = stride, counts[0]
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += stride
    return found


def test_limits_are_those_of_all_rows(spark):
    rng = np.random.default_rng(0)
    n = 12_000
    columns = [rng.normal(size=n), rng.integers(0, 20, n) * 1.0, rng.integers(0, 90, n) * 1.0, np.full(n, 3.0), np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)), rng.permutation(n) * 1.0]
    rows = np.stack(columns, axis=1)
    df = spark.createDataFrame([(x.tolist(),) for x in rows], "features array<double>").repartition(5)
    got = forest.limits(df, len(columns))
    assert [g.tolist() for g in got] == [mllib_limits(c, 32) for c in columns]


def test_a_tree_is_that_of_mllib(spark):
    train, test = labelled(spark, 600, dim=6), labelled(spark, 300, dim=6, seed=3)
    want = M.decision_tree(train, test, depth=4)
    got = forest.fit_predict(train, test, 6, 1, 4, M.SEED)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_full_trees_know_their_rows_whatever_the_partitions(spark):
    rows = labelled(spark, 300, dim=3)
    assert forest.fit_predict(rows, rows, 3, 1, 30, 1).filter("label <> prediction").isEmpty()
    test = labelled(spark, 90, dim=3, seed=4).withColumn("image_id", F.when(F.col("label") == 1, F.col("image_id")))
    first = sorted(map(str, forest.fit_predict(rows, test.union(test), 3, 7, 30, 1).collect()))
    assert first == sorted(map(str, forest.fit_predict(rows.repartition(7), test.union(test).coalesce(1), 3, 7, 30, 1).collect()))
    assert len(first) == 180


@pytest.mark.parametrize("fit", [M.random_forest, M.decision_tree])
def test_many_rows_are_not_grown_by_histograms_of_all_nodes(spark, monkeypatch, fit):
    monkeypatch.setattr(M, "_mllib", None)
    train, test = labelled(spark, 10_400, dim=4), labelled(spark, 200, dim=4, seed=5)
    right = fit(train, test, **({"trees": 5} if fit is M.random_forest else {})).filter("label = prediction").count()
    assert right > 130


def test_boosted_trees_split_between_limits_of_all_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "_mllib", lambda estimator, train, test: seen.append((estimator.getMaxBins(), train, test)))
    rows = spark.range(10_100).selectExpr("cast(id as string) as image_id", "cast(id % 2 as int) as label", "array(cast(id as double)) as features")
    M.boosted_trees(rows, rows.limit(3))
    bins, train, test = seen[0]
    assert bins**2 >= 10_100 and test.count() == 3
    per_bin = [r["count"] for r in train.groupBy("features").count().collect()]
    assert len(per_bin) == 32 and max(per_bin) - min(per_bin) <= 2
