"""Arrow form of the feature vector: one vectorised pass per Arrow batch.

Spark parses the JSON text and hands the nested arrays over as Arrow lists, so
no text is parsed in Python. Shape checks read the list offsets, statistics run
over all images of one shape at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from furlens.functions import kernel as K
from furlens.functions.batch_images import lists
from furlens.functions.tensors import parse_tensor

# Images per numpy step: bounds the temporaries whatever the Arrow batch holds.
_STEP = 32


def _image_shapes(images: pa.ListArray):
    """Start cell, height, width and channels per image; height 0 marks a rejected one.

    An image is kept when its rows, and its pixels, are equally long. A null at
    any level shows up as a null mask or a zero length, and rejects the image.
    """
    o1, rows = lists(images)
    o2, pixels = lists(rows)
    o3, cells = lists(pixels)
    widths, depths = np.diff(o2), np.diff(o3)
    n = len(images)
    height = np.diff(o1)
    start = np.zeros(n, dtype=np.int64)
    width = np.zeros(n, dtype=np.int64)
    depth = np.zeros(n, dtype=np.int64)
    null_cells = np.asarray(cells.is_null()) if cells.null_count else None
    null_image = np.asarray(images.is_null())
    values = np.asarray(cells.fill_null(-1.0) if cells.null_count else cells)
    for i in range(n):
        h = 0 if null_image[i] else int(height[i])
        if h:
            w = widths[o1[i] : o1[i + 1]]
            first, last = o2[o1[i]], o2[o1[i + 1]]
            d = depths[first:last]
            ok = w[0] > 0 and (w == w[0]).all() and d[0] > 0 and (d == d[0]).all()
            if ok:
                a, b = o3[first], o3[last]
                block = values[a:b]
                ok = block.min() > -1.0 and block.max() < 256.0
                ok = ok and (null_cells is None or not null_cells[a:b].any())
            if ok:
                start[i], width[i], depth[i] = a, w[0], d[0]
            else:
                h = 0
        height[i] = h
    return values, start, height, width, depth


def _linear_percentiles(ordered: np.ndarray, *ps: float) -> list[np.ndarray]:
    out = []
    for p in ps:
        rank = (ordered.shape[-1] - 1) * p
        low = int(rank)
        high = min(low + 1, ordered.shape[-1] - 1)
        a = ordered[..., low].astype(np.float64)
        out.append(a + (ordered[..., high].astype(np.float64) - a) * (rank - low))
    return out


def _vectors(block: np.ndarray) -> np.ndarray:
    """Feature vectors of ``block``, bytes of shape (images, pixels, channels)."""
    n, size, depth = block.shape
    out = np.empty((n, K.N_FEATURES))
    if depth >= 3:
        planes = np.ascontiguousarray(block[:, :, :3].transpose(2, 0, 1))
        red, green, blue = (w * plane for w, plane in zip(K.GRAY_WEIGHTS, planes))
        gray = red + green + blue
    else:
        planes = np.broadcast_to(block[:, :, 0], (3, n, size))
        gray = block[:, :, 0].astype(np.float64)
    for c in range(3):
        if c and depth < 3:
            out[:, 5 * c : 5 * c + 5] = out[:, :5]
            continue
        plane = planes[c]
        median, p25, p75 = _linear_percentiles(np.sort(plane, axis=1), 0.5, 0.25, 0.75)
        out[:, 5 * c : 5 * c + 5] = np.stack(
            [plane.mean(axis=1), plane.std(axis=1), median, p25, p75], axis=1
        )
    bins = np.minimum((gray * K.ENTROPY_BINS / K.ENTROPY_TOP).astype(np.int64), K.ENTROPY_BINS - 1)
    bins += np.arange(n)[:, None] * K.ENTROPY_BINS
    counts = np.bincount(bins.ravel(), minlength=n * K.ENTROPY_BINS).reshape(n, K.ENTROPY_BINS)
    share = counts + K.ENTROPY_EPS
    share /= share.sum(axis=1, keepdims=True)
    ordered = np.sort(gray, axis=1)
    var = gray.var(axis=1)
    std = np.sqrt(var)
    p10, p90 = _linear_percentiles(ordered, 0.10, 0.90)
    out[:, 15:] = np.stack(
        [
            gray.mean(axis=1),
            std,
            var,
            -(share * np.log2(share)).sum(axis=1),
            std,
            ordered[:, 0],
            ordered[:, -1],
            p10,
            p90,
        ],
        axis=1,
    )
    return out


def batch_vectors(images: pa.ListArray) -> pa.ListArray:
    """One list of 24 doubles per image, an empty list for a rejected one."""
    if len(images) == 0:
        return pa.array([], type=pa.list_(pa.float64()))
    values, start, height, width, depth = _image_shapes(images)
    good = np.flatnonzero(height > 0)
    result = np.zeros((len(good), K.N_FEATURES))
    shapes = np.stack([height[good] * width[good], depth[good]], axis=1)
    for size, channels in np.unique(shapes, axis=0) if len(good) else []:
        same = np.flatnonzero((shapes[:, 0] == size) & (shapes[:, 1] == channels))
        for lo in range(0, len(same), _STEP):
            part = same[lo : lo + _STEP]
            cells = np.stack([values[s : s + size * channels] for s in start[good[part]]])
            result[part] = _vectors(cells.astype(np.uint8).reshape(len(part), size, channels))
    offsets = np.concatenate([[0], np.cumsum(np.where(height > 0, K.N_FEATURES, 0))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(result.ravel()))


@F.arrow_udf(ArrayType(DoubleType()))
def _vector_udf(images: pa.Array) -> pa.Array:
    return batch_vectors(images)


# Spark may copy a deterministic expression into a filter above it and then run
# it twice per row; marked like this it is evaluated where it stands.
_vector_once = _vector_udf.asNondeterministic()


def feature_vector(text: Column) -> Column:
    """24 doubles from the JSON text of an image, or an empty array."""
    return _vector_once(parse_tensor(text))
