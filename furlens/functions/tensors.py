"""Expressions on height x width x channel arrays held in one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TENSOR_TYPE = "array<array<array<double>>>"

# Fixed values of the content check.
MIN_SIDE = 10
MIN_COLOURS = 10


def parse_tensor(text: Column) -> Column:
    """JSON text to a nested array of doubles; NULL when it is not a 3-D number array."""
    return F.from_json(text, TENSOR_TYPE)


def height(tensor: Column) -> Column:
    return F.size(tensor)


def width(tensor: Column) -> Column:
    return F.size(F.get(tensor, F.lit(0)))


def channels(tensor: Column) -> Column:
    return F.size(F.get(F.get(tensor, F.lit(0)), F.lit(0)))


def shape(tensor: Column) -> Column:
    return F.array(height(tensor), width(tensor), channels(tensor))


def is_rectangular(tensor: Column, pixels: Column) -> Column:
    """Every row has the same width and every pixel the same number of channels."""
    w, c = width(tensor), channels(tensor)
    return (
        (w >= 1)
        & (c >= 1)
        & F.forall(tensor, lambda row: F.size(row) == w)
        & F.forall(pixels, lambda pixel: F.size(pixel) == c)
    )


def is_byte_valued(pixels: Column) -> Column:
    """All cells fit 0..255 once their fraction is cut off."""
    cells = F.flatten(pixels)
    return (F.array_min(cells) > -1.0) & (F.array_max(cells) < 256.0)


def channel(tensor: Column, index: int) -> Column:
    """One channel as a flat array of ints, in row order."""
    at = F.lit(index)
    return F.transform(F.flatten(tensor), lambda pixel: F.get(pixel, at).cast("int"))


def colour_codes(tensor: Column) -> Column:
    """One bigint per pixel that is equal exactly when all channels are equal.

    Hashing plain numbers lets ``array_distinct`` use its hash set; on nested
    arrays it would compare every pair of pixels.
    """

    def general(pixel: Column) -> Column:
        return F.aggregate(
            pixel, F.lit(0).cast("bigint"), lambda acc, v: acc * 256 + v.cast("bigint")
        )

    def usual(pixel: Column) -> Column:
        first, second, third = (F.get(pixel, F.lit(i)).cast("bigint") for i in range(3))
        return (first * 256 + second) * 256 + third

    # Three channels are the common case and need no inner loop.
    return F.when(
        channels(tensor) == 3, F.transform(F.flatten(tensor), usual)
    ).otherwise(F.transform(F.flatten(tensor), general))


def has_content(tensor: Column) -> Column:
    """At least 10x10 with at least 10 distinct colours. NULL tensor gives false."""
    return F.coalesce(
        (height(tensor) >= MIN_SIDE)
        & (width(tensor) >= MIN_SIDE)
        & (F.size(F.array_distinct(colour_codes(tensor))) >= MIN_COLOURS),
        F.lit(False),
    )


def has_content_gray(matrix: Column) -> Column:
    """The same check for a height x width array: only the sides are tested."""
    return F.coalesce(
        (F.size(matrix) >= MIN_SIDE) & (F.size(F.get(matrix, F.lit(0))) >= MIN_SIDE), F.lit(False)
    )


def to_rgb(pixel: Column) -> Column:
    """Three channels from any pixel: gray is repeated, alpha is dropped."""
    first = F.get(pixel, F.lit(0))
    return F.when(F.size(pixel) < 3, F.array(first, first, first)).otherwise(F.slice(pixel, 1, 3))
