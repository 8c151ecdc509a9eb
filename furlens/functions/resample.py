"""Bicubic resizing with antialiasing, separable: columns first, then rows, whole numbers in between."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SUPPORT = 2.0  # of the cubic kernel
SHARPNESS = -0.5
SCALE = 1 << 22  # weights are whole multiples of 1 / SCALE
STEP = 32  # images at a time


def cubic(x: np.ndarray) -> np.ndarray:
    x, a = np.abs(x), SHARPNESS
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = a * (((x - 5) * x + 8) * x - 4)
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


@lru_cache(maxsize=256)
def weights(source: int, target: int) -> np.ndarray:
    """One row of weights over the source cells for each target cell; a row adds up to about SCALE.

    When shrinking, the kernel is widened to cover all cells that fall on a target cell.
    """
    scale = source / target
    wide = max(scale, 1.0)
    out = np.zeros((target, source))
    for i in range(target):
        center = (i + 0.5) * scale
        low, high = max(0, int(center - SUPPORT * wide + 0.5)), min(source, int(center + SUPPORT * wide + 0.5))
        w = cubic((np.arange(low, high) - center + 0.5) / wide)
        w = w / w.sum() * SCALE
        out[i, low:high] = np.trunc(w + np.where(w < 0, -0.5, 0.5))
    return out


def _applied(w: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """``w`` times the cells along their second last axis, rounded to 0..255; exact, as all terms are whole."""
    return np.clip(np.floor((np.matmul(w, cells) + SCALE // 2) / SCALE), 0, 255)


def resample(images: np.ndarray, out_height: int, out_width: int) -> np.ndarray:
    """Images of one shape (number, height, width, channels) in the new size."""
    n, h, w, c = images.shape
    out = np.empty((n, out_height, out_width, c), dtype=np.int32)
    for a in range(0, n, STEP):
        part = images[a : a + STEP].astype(np.float64)
        m = len(part)
        across = _applied(weights(w, out_width), part.reshape(m * h, w, c)).reshape(m, h, out_width * c)
        out[a : a + m] = _applied(weights(h, out_height), across).reshape(m, out_height, out_width, c)
    return out
