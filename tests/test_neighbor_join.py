"""Nearest neighbours over all train rows against the bounded form and brute force."""

from __future__ import annotations

import numpy as np
import pytest

from furlens.operators import neighbor_join, neighbors


def table(spark, prefix, points, labels, extra=False):
    rows = [(f"{prefix}{i:05d}", int(y), [float(v) for v in x]) for i, (x, y) in enumerate(zip(points, labels))]
    return spark.createDataFrame([(*r, "r", 1.0) for r in rows], "image_id string, label int, features array<double>, `row` string, cell double")


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_same_as_the_bounded_form(spark, spread):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 2, (12, 5))
    which = rng.integers(0, 12, 900)
    points = centers[which] + rng.normal(0, spread, (900, 5))
    points[200:500] = points[0]  # copies: ties, and a cell with many parts
    labels = (which + rng.integers(0, 2, 900)) % 3
    train, test = table(spark, "a", points[:700], labels[:700]), table(spark, "t", np.concatenate([points[700:], points[100:300]]), np.zeros(400))
    want = neighbors.predict(train, test)
    got = neighbor_join.predict(train, test, 5, cell_rows=40, test_rows=16)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    points, asked = np.round(rng.normal(size=(300, 3)), 1), np.round(rng.normal(size=(60, 3)), 1)
    train = table(spark, "a", points, np.zeros(300)).drop("row", "cell").selectExpr("cast(substr(image_id, 2) as long) as `row`", "*")
    test = table(spark, "t", asked, np.zeros(60)).selectExpr("cast(substr(image_id, 2) as long) as `row`", "features")
    got = {}
    for r in neighbor_join.nearest(train, test, 4, 32, 8).collect():
        got[r.row, r["rank"]] = (r.d2, r.image_id)
    for i, x in enumerate(asked):
        best = sorted((round(float(((p - x) ** 2).sum()), 9), f"a{j:05d}") for j, p in enumerate(points))[:4]
        assert [got[i, k] for k in range(1, 5)] == best


def test_few_none_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    train, test = table(spark, "a", rng.normal(size=(3, 4)), [1, 1, 0]), table(spark, "t", rng.normal(size=(2, 4)), [0, 0])
    got = neighbors.predict(train, test.unionByName(test), max_train_rows=None).collect()
    assert [r.prediction for r in got] == [1] * 4
    assert neighbors.predict(train.limit(0), test, max_train_rows=None).count() == 0
    assert neighbors.predict(train, test.limit(0), max_train_rows=None).count() == 0
    ties = table(spark, "a", np.zeros((4, 4)), [2, 1, 1, 2])
    assert {r.prediction for r in neighbors.predict(ties, test, max_train_rows=None).collect()} == {1}


def test_boxes_rule_parts_out(spark):
    """Rows in well separated clumps meet few parts besides their own."""
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 50, (64, 4))
    points = centers[np.arange(2048) % 64] + rng.normal(0, 0.1, (2048, 4))
    axes, values = neighbor_join.split_planes(points, 64)
    node = np.ones(2048, int)
    for _ in range(6):
        node = 2 * node + (points[np.arange(2048), axes[node]] >= values[node])
    assert np.bincount(node - 64).max() <= 64
    low, high = (np.array([getattr(points[node == i], f)(0) for i in range(64, 128)]) for f in ("min", "max"))
    gap = (np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0) ** 2).sum(2)
    assert (gap <= 1).sum(1).mean() < 4
