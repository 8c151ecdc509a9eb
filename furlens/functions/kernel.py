"""The 24-value colour, gray and texture vector of one image.

Layout: mean, std, median, p25, p75 of red, green and blue (0-14); gray mean,
std, variance (15-17); entropy (18); RMS contrast (19, equal to 16); gray min,
max, p10, p90 (20-23). Standard deviations are population ones and
percentiles interpolate linearly.

The vector is built in a chain of intermediate columns, each computed once per
row. This form needs no Python worker; ``batch_kernel`` holds the faster one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from furlens.functions import arrays as A, tensors as T
from furlens.functions.once import with_columns_once

# Gray weights, entropy histogram, smoothing.
GRAY_WEIGHTS = (0.2989, 0.5870, 0.1140)
ENTROPY_BINS = 64
ENTROPY_TOP = 255.0
ENTROPY_EPS = 1e-8

_CHANNEL_STATS = ("mean", "std", "median", "p25", "p75")
FEATURE_NAMES = tuple(
    [f"{c}_{s}" for c in ("red", "green", "blue") for s in _CHANNEL_STATS]
    + [
        "gray_mean",
        "gray_std",
        "gray_var",
        "entropy",
        "contrast",
        "gray_min",
        "gray_max",
        "gray_p10",
        "gray_p90",
    ]
)
N_FEATURES = len(FEATURE_NAMES)


def with_tensor(df: DataFrame, text: str = "image_array", out: str = "tensor") -> DataFrame:
    """Add the parsed tensor, NULL where the text breaks one of the parse rules.

    Rules: three dimensions, equal row widths, equal channel counts, no null
    cell, values that fit 0..255 after cutting the fraction. Digits-only text
    holds the word null exactly when a cell is null, so a substring test
    replaces a walk over all cells.
    """
    raw, pixels = f"_{out}_raw", f"_{out}_pixels"
    df = with_columns_once(df, {raw: T.parse_tensor(F.col(text))})
    checked = F.when(
        ~F.contains(F.col(text), F.lit("null"))
        & T.is_rectangular(F.col(raw), F.col(pixels))
        & T.is_byte_valued(F.col(pixels)),
        F.col(raw),
    )
    df = with_columns_once(df.withColumn(pixels, F.flatten(raw)), {out: checked})
    return df.drop(raw, pixels)


def _byte(pixel: Column, index: Column) -> Column:
    # The coalesce never fires on a checked tensor; it tells Spark that the
    # array has no nulls, which selects the primitive sort.
    return F.coalesce(F.get(pixel, index).cast("int"), F.lit(0))


def with_channels(df: DataFrame, tensor: str = "tensor", parts: tuple[str, ...] = ("_c0", "_c1", "_c2", "_gray"), ordered: tuple[str, ...] | None = None) -> DataFrame:
    """Add the wanted ones of ``_c0 _c1 _c2`` and ``_gray``, sorted if in ``ordered`` (all by default).

    With 1 or 2 channels the first one stands for all.
    """
    ordered = parts if ordered is None else ordered
    rgb = T.channels(F.col(tensor)) >= 3
    df = df.withColumns(
        {
            "_pixels": F.flatten(tensor),
            "_g_at": F.when(rgb, 1).otherwise(0),
            "_b_at": F.when(rgb, 2).otherwise(0),
            "_wr": F.when(rgb, F.lit(GRAY_WEIGHTS[0])).otherwise(F.lit(1.0)),
            "_wg": F.when(rgb, F.lit(GRAY_WEIGHTS[1])).otherwise(F.lit(0.0)),
            "_wb": F.when(rgb, F.lit(GRAY_WEIGHTS[2])).otherwise(F.lit(0.0)),
        }
    )
    at = {"_c0": F.lit(0), "_c1": F.col("_g_at"), "_c2": F.col("_b_at")}

    def values(part: str) -> Column:
        if part != "_gray":
            return F.transform(F.col("_pixels"), lambda p: _byte(p, at[part]))
        return F.transform(
            F.col("_pixels"),
            lambda p: _byte(p, at["_c0"]) * F.col("_wr")
            + _byte(p, at["_c1"]) * F.col("_wg")
            + _byte(p, at["_c2"]) * F.col("_wb"),
        )

    built = {part: A.sorted_values(values(part)) if part in ordered else values(part) for part in parts}
    return with_columns_once(df, built).drop("_pixels", "_g_at", "_b_at", "_wr", "_wg", "_wb")


_PART_OF = {"red": "_c0", "green": "_c1", "blue": "_c2", "gray": "_gray"}
_ALIASES = {"entropy": ("_gray", "entropy"), "contrast": ("_gray", "std")}
_PERCENTILES = {"median": 0.50, "p25": 0.25, "p75": 0.75, "p10": 0.10, "p90": 0.90}


def _part_and_stat(name: str) -> tuple[str, str]:
    colour, _, stat = name.partition("_")
    return _ALIASES.get(name) or (_PART_OF[colour], stat)


def with_feature_vector(
    df: DataFrame, tensor: str = "tensor", out: str = "image_features", names: tuple[str, ...] = FEATURE_NAMES
) -> DataFrame:
    """Add the values ``names`` as one array, the 24-value vector by default; NULL where ``tensor`` is NULL.

    Only what the names need is built: no part is sorted for a mean, and no
    entropy is computed that is not asked for.
    """
    kept = df.columns
    wanted = [_part_and_stat(n) for n in names]
    parts = tuple(dict.fromkeys(p for p, _ in wanted))
    ordered = tuple(dict.fromkeys(p for p, s in wanted if s in _PERCENTILES or s == "entropy"))
    df = with_channels(df, tensor, parts, ordered)
    spread = [p for p in parts if {"std", "var"} & {s for q, s in wanted if q == p}]
    df = df.withColumns({f"{p}_mean": A.mean(F.col(p)) for p in parts if p in spread or (p, "mean") in wanted})
    df = df.withColumns({f"{p}_var": A.centred_squares(F.col(p), F.col(f"{p}_mean")) / F.size(p) for p in spread})
    if ("_gray", "entropy") in wanted:
        bins = F.transform(
            "_gray",
            lambda g: F.least(
                F.floor(g * F.lit(ENTROPY_BINS) / F.lit(ENTROPY_TOP)).cast("int"),
                F.lit(ENTROPY_BINS - 1),
            ),
        )
        df = df.withColumn("_bins", bins).withColumn("_runs", A.run_lengths(F.col("_bins")))

    def value(part: str, stat: str) -> Column:
        column = F.col(part)
        if stat in _PERCENTILES:
            return A.percentile(column, _PERCENTILES[stat])
        if stat == "mean":
            return F.col(f"{part}_mean")
        if stat == "var":
            return F.col(f"{part}_var")
        if stat == "std":
            return F.sqrt(f"{part}_var")
        if stat == "entropy":
            return A.smoothed_entropy(F.col("_runs"), F.size(column), ENTROPY_BINS, ENTROPY_EPS)
        if part in ordered:
            return A.smallest(column) if stat == "min" else A.largest(column)
        return (F.array_min(column) if stat == "min" else F.array_max(column)).cast("double")

    vector = F.when(F.col(tensor).isNotNull(), F.array(*[value(p, s) for p, s in wanted]))
    return with_columns_once(df, {out: vector}).select(*kept, out)
