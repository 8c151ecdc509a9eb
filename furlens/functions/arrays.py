"""Row-local statistics on arrays, as Column expressions.

Everything here works on one row's array, so it adds no shuffle. Percentiles,
minimum and maximum expect an array that is already sorted ascending and has
no nulls: sort once with :func:`sorted_values`, then read positions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def total(values: Column) -> Column:
    """Sum of an array of numbers, as double."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def mean(values: Column) -> Column:
    return total(values) / F.size(values)


def centred_squares(values: Column, centre: Column) -> Column:
    """Sum of squared distances from ``centre`` (second pass of a two-pass variance)."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + (v - centre) * (v - centre))


def sorted_values(values: Column) -> Column:
    """Ascending copy. On arrays without nulls Spark sorts the primitives directly."""
    return F.sort_array(values)


def percentile(ordered: Column, p: float) -> Column:
    """Linear-interpolated percentile of a sorted array, ``p`` in [0, 1]."""
    rank = (F.size(ordered) - 1) * F.lit(float(p))
    low = F.floor(rank).cast("int")
    high = F.ceil(rank).cast("int")
    at_low = F.get(ordered, low).cast("double")
    at_high = F.get(ordered, high).cast("double")
    return at_low + (at_high - at_low) * (rank - low)


def smallest(ordered: Column) -> Column:
    return F.get(ordered, F.lit(0)).cast("double")


def largest(ordered: Column) -> Column:
    return F.get(ordered, F.size(ordered) - 1).cast("double")


def run_lengths(ordered: Column) -> Column:
    """Lengths of the runs of equal neighbours in a sorted array."""
    n = F.size(ordered)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(n))
    return F.zip_with(ends, starts, lambda e, s: e - s)


def smoothed_entropy(counts: Column, n: Column, bins: int, eps: float) -> Column:
    """Shannon entropy (bits) of ``bins`` counts after adding ``eps`` to each.

    Only the occupied bins are given; the empty ones each hold ``eps``. With
    T = n + bins*eps this is log2(T) - sum(c*log2(c))/T over all bins.
    """
    occupied = F.aggregate(
        counts, F.lit(0.0), lambda acc, c: acc + (c + F.lit(eps)) * F.log2(c + F.lit(eps))
    )
    mass = n + F.lit(bins * eps)
    empty = (F.lit(bins) - F.size(counts)) * (F.lit(eps) * F.log2(F.lit(eps)))
    return F.log2(mass) - (occupied + empty) / mass
