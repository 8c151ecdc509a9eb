"""Arrow forms of image decoding and resizing: nested lists in and out, numpy in between, a bounded part of a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from furlens.functions.resample import STEP, resample

TENSOR = ArrayType(ArrayType(ArrayType(IntegerType())))
PART = 1_000_000  # cells, or bytes of files, that are worked on and handed back at a time


def parts(sizes, most: int = PART) -> Iterator[tuple[int, int]]:
    """(start, number) of runs of neighbours whose ``sizes`` add up to about ``most``, one at least; an empty run where there are none.

    An Arrow batch holds as many rows as Spark likes; what is made of it is
    larger than the batch and handed back in parts.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    run = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield a, b - a


def cell_counts(images: pa.ListArray) -> np.ndarray:
    """Cells of each image, 0 for NULL."""
    o1, rows = lists(images)
    o2, pixels = lists(rows)
    o3, _ = lists(pixels)
    return np.diff(o3[o2[o1]].astype(np.int64))


def nested(flat: np.ndarray, heights, widths, depths, missing=None) -> pa.Array:
    """Flat cells of many images as one Arrow list of rows of pixels; ``missing`` marks NULL images."""
    heights, widths, depths = (np.asarray(v, dtype=np.int64) for v in (heights, widths, depths))

    def offsets(sizes):
        return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))

    pixels = pa.ListArray.from_arrays(offsets(np.repeat(depths, heights * widths)), pa.array(flat, pa.int32()))
    rows = pa.ListArray.from_arrays(offsets(np.repeat(widths, heights)), pixels)
    mask = pa.array(missing) if missing is not None and len(missing) else None
    return pa.ListArray.from_arrays(offsets(heights), rows, mask=mask)


def lists(values: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Absolute offsets and child values of a list array."""
    return np.asarray(values.offsets), values.values


def _decoded(data: pa.Array, height: pa.Array, width: pa.Array, channels: pa.Array) -> pa.Array:
    shapes = list(zip(height.to_pylist(), width.to_pylist(), channels.to_pylist()))
    cells = []
    for blob, (h, w, c) in zip(data, shapes):
        block = np.frombuffer(blob.as_buffer(), np.uint8).reshape(h * w, c)
        order = [2, 1, 0] + list(range(3, c)) if c >= 3 else list(range(c))
        cells.append(block[:, order].ravel())
    flat = np.concatenate(cells).astype(np.int32) if cells else np.zeros(0, np.int32)
    return nested(flat, *(zip(*shapes) if shapes else ([], [], [])))


@F.arrow_udf(TENSOR)
def _decode(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Bytes in blue-green-red order, row by row, as delivered by Spark's image source."""
    for columns in batches:
        for a, n in parts(pc.fill_null(pc.binary_length(columns[0]), 0)):
            yield _decoded(*(c.slice(a, n) for c in columns))


decode = _decode.asNondeterministic()


FILTERS = ("nearest", "bicubic")


def _nearest(block: np.ndarray, out_height: int, out_width: int) -> np.ndarray:
    """Target cell i reads source cell floor((i + 0.5) * n / m)."""
    h, w, _ = block.shape
    at_row = ((np.arange(out_height) + 0.5) * h / out_height).astype(np.int64)
    at_column = ((np.arange(out_width) + 0.5) * w / out_width).astype(np.int64)
    return block[at_row[:, None], at_column]


def batch_resize(images: pa.ListArray, out_height: int, out_width: int, filter: str = "nearest") -> pa.Array:
    """Resize to RGB by one of ``FILTERS``; images of one shape are resampled together.

    One channel is repeated, alpha is dropped. NULL, empty and ragged images
    give NULL.
    """
    o1, rows = lists(images)
    o2, pixels = lists(rows)
    o3, cells = lists(pixels)
    first, last = o3[o2[o1[[0, -1]]]]
    cells = cells.slice(first, last - first)
    values = np.asarray(cells.fill_null(0) if cells.null_count else cells)
    missing = np.asarray(images.is_null()).copy()
    blocks: dict[int, np.ndarray] = {}
    shapes: dict[tuple[int, int], list[int]] = {}
    for i in range(len(images)):
        h = 0 if missing[i] else int(o1[i + 1] - o1[i])
        widths = np.diff(o2[o1[i] : o1[i + 1] + 1])
        depths = np.diff(o3[o2[o1[i]] : o2[o1[i + 1]] + 1]) if h else widths
        if not h or not len(depths) or depths[0] < 1 or (widths != widths[0]).any() or (depths != depths[0]).any():
            missing[i] = True
            continue
        w, depth = int(widths[0]), int(depths[0])
        start = o3[o2[o1[i]]] - first
        block = values[start : start + h * w * depth].reshape(h, w, depth)
        block = block[:, :, :3] if depth >= 3 else np.repeat(block[:, :, :1], 3, axis=2)
        if filter == "nearest":
            blocks[i] = _nearest(block, out_height, out_width)
        else:
            blocks[i] = block
            shapes.setdefault((h, w), []).append(i)
    for alike in shapes.values():
        for a in range(0, len(alike), STEP):
            some = alike[a : a + STEP]
            blocks.update(zip(some, resample(np.stack([blocks[i] for i in some]), out_height, out_width)))
    flat = np.concatenate([blocks[i].ravel() for i in sorted(blocks)]) if blocks else np.zeros(0, np.int32)
    heights = np.where(missing, 0, out_height)
    return nested(flat, heights, np.full(len(images), out_width), np.full(len(images), 3), missing)


def resizer(out_height: int, out_width: int, filter: str):
    """Arrow UDF for a fixed target size and filter, marked to be evaluated where it stands."""
    if filter not in FILTERS:
        raise ValueError(f"filter must be one of {FILTERS}")

    @F.arrow_udf(TENSOR)
    def resize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for images in batches:
            for a, n in parts(cell_counts(images) + out_height * out_width * 3):
                yield batch_resize(images.slice(a, n), out_height, out_width, filter)

    return resize.asNondeterministic()
