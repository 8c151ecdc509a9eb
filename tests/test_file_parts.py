"""Files are written, made and inspected a bounded part of a batch at a time."""

import numpy as np
import pyarrow as pa

from furlens.functions import batch_images as B
from furlens.plans import acquire
from furlens_suite import bitmaps


class Captured:
    """Stands for a table: keeps the function that would run in the tasks."""

    def select(self, *_):
        return self

    def mapInArrow(self, work, _):
        self.work = work
        return self


class _Column:
    def cast(self, _):
        return self

    def alias(self, _):
        return self


def test_files_are_made_and_inspected_in_bounded_parts(monkeypatch):
    px = np.random.default_rng(5).integers(0, 256, (300, 16, 16, 3))
    rows = pa.RecordBatch.from_pydict({"vec_id": pa.array(range(300), pa.int64()), "px": pa.array(px.tolist(), pa.list_(pa.list_(pa.list_(pa.int32()))))})
    monkeypatch.setattr(bitmaps, "PART", 10_000)
    monkeypatch.setattr(bitmaps.F, "col", lambda name: _Column())
    made = list(bitmaps.as_files(Captured()).work(iter([rows])))
    assert max(b.num_rows for b in made) <= 15
    assert [v for b in made for v in b.column(0).to_pylist()] == list(range(300))
    files = pa.Table.from_batches(made).combine_chunks().to_batches()[0]
    monkeypatch.setattr(B.parts, "__defaults__", (200_000,))
    found = list(acquire.inspected(Captured()).work(iter([files])))
    assert max(b.num_rows for b in found) <= 20
    assert [v for b in found for v in b.column("candidate").to_pylist()] == list(range(300))
