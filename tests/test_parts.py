"""Image steps work on a bounded part of a batch at a time, and hand back the same rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from furlens.functions import batch_images as B
from furlens.operators import acquisition as A


def images(n):
    rng = np.random.default_rng(3)
    shapes = [(int(h), int(w), int(c)) for h, w, c in zip(rng.integers(1, 20, n), rng.integers(1, 20, n), rng.integers(1, 5, n))]
    out = [rng.integers(0, 256, s).tolist() for s in shapes]
    out[1] = None
    out[2] = []
    out[4] = [[[1, 2, 3]], [[1, 2, 3], [4, 5, 6]]]
    out[5] = [[[None, 2, 3]] * 3] * 2
    return pa.array(out, pa.list_(pa.list_(pa.list_(pa.int32()))))


def test_parts_cover_all_rows_in_order():
    for sizes in ([], [0, 0], [5], [50, 1, 1, 1, 200, 0, 3], [3] * 40):
        runs = list(B.parts(sizes, 10))
        assert [i for a, n in runs for i in range(a, a + n)] == list(range(len(sizes)))
        assert all(n <= 1 or sum(sizes[a : a + n]) < 10 + max(sizes) for a, n in runs)
    assert list(B.parts([], 10)) == [(0, 0)]


@pytest.mark.parametrize("filter", B.FILTERS)
def test_resize_hands_back_bounded_parts(monkeypatch, filter):
    monkeypatch.setattr(B.parts, "__defaults__", (2_000,))
    batch = images(60)
    seen = list(B.resizer(8, 6, filter).func(iter([batch, batch.slice(7, 20)])))
    assert len(seen) > 10 and max(len(p.flatten().flatten().flatten()) for p in seen) <= 2_000
    whole = B.batch_resize(batch, 8, 6, filter).to_pylist()
    assert [r for p in seen for r in p.to_pylist()] == whole + whole[7:27]


def test_resize_of_a_slice_reads_only_its_cells():
    batch = images(40)
    assert B.batch_resize(batch.slice(10, 5), 4, 4).to_pylist() == B.batch_resize(batch, 4, 4).to_pylist()[10:15]


def test_resize_in_spark_returns_every_row(spark, monkeypatch):
    monkeypatch.setattr(B.parts, "__defaults__", (20_000,))
    df = spark.range(500).select("id", F.expr("transform(sequence(0, 3), h -> transform(sequence(0, 3), w -> array(cast(id % 256 as int))))").alias("tensor"))
    rows = A.resize(df, side=32).select("id", F.expr("resized[31][31]").alias("p"), F.size("resized").alias("h")).collect()
    assert sorted((r["id"], r["p"][2], r["h"]) for r in rows) == [(i, i % 256, 32) for i in range(500)]


def test_decode_hands_back_bounded_parts():
    data = pa.array([bytes(range(i, i + 12)) for i in range(200)], pa.binary())
    columns = (data, pa.array([2] * 200), pa.array([2] * 200), pa.array([3] * 200))
    old = B.parts.__defaults__
    try:
        B.parts.__defaults__ = (100,)
        seen = list(B._decode.func(iter([columns])))
    finally:
        B.parts.__defaults__ = old
    assert len(seen) > 20 and sum(len(p) for p in seen) == 200
    assert [r for p in seen for r in p.to_pylist()][199] == [[[201, 200, 199], [204, 203, 202]], [[207, 206, 205], [210, 209, 208]]]
