"""Feature columns and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from furlens.functions import arrays as A, batch_kernel, kernel

# Fixed values of the checks.
NEAR_ZERO = 1e-6
MIN_RANGE = 1.0
MIN_FEATURES = 10
FEW_ROWS = 10


def with_features(df: DataFrame, text: str = "image_array", out: str = "image_features", engine: str = "arrow", names: tuple[str, ...] = kernel.FEATURE_NAMES) -> DataFrame:
    """Add the 24 doubles of each image; empty (arrow) or NULL (native) where it cannot be read.

    ``arrow`` is the fast form. ``native`` uses Spark expressions only, needs no
    Python worker, and can build some named values only.
    """
    if engine == "arrow":
        if names != kernel.FEATURE_NAMES:
            raise ValueError("the arrow form builds all values")
        return df.withColumn(out, batch_kernel.feature_vector(F.col(text)))
    if engine == "native":
        return kernel.with_feature_vector(kernel.with_tensor(df, text, "_tensor"), "_tensor", out, names).drop("_tensor")
    raise ValueError(f"unknown engine {engine!r}")


def keep_extracted(df: DataFrame, features: str = "image_features") -> DataFrame:
    """Rows whose extraction worked."""
    return df.filter(F.size(features) > 0)


def keep_trainable(df: DataFrame, features: str = "image_features", label: str = "label") -> DataFrame:
    """More than ten features and a label of 0 or 1."""
    return df.filter((F.size(features) > MIN_FEATURES) & F.col(label).isin(0, 1))


def extract_outcome(df: DataFrame, features: str = "image_features") -> DataFrame:
    """Input, succeeded, failed and dimension, in one pass."""
    ok = F.coalesce(F.size(features) > 0, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
        F.max(F.when(ok, F.size(features))).alias("dim"),
    )


# Why a feature line is rejected, in the order of the checks.
REASONS = ("malformed", "no features", "few features", "label")


def reject_reason() -> Column:
    """The first reason against a parsed feature line; NULL for a valid one."""
    n = F.coalesce(F.size("image_features"), F.lit(0))
    checks = (
        ~F.coalesce(F.col("parsed"), F.lit(False)),
        n <= 0,
        n <= MIN_FEATURES,
        ~F.coalesce(F.col("label").isin(0, 1), F.lit(False)),
    )
    return F.coalesce(*[F.when(check, F.lit(reason)) for reason, check in zip(REASONS, checks)])


def quality_report(parsed: DataFrame) -> DataFrame:
    """Valid and invalid lines with the valid share in percent.

    ``few`` warns below ten valid lines. No valid line at all raises when the
    report is read.
    """
    good = reject_reason().isNull()
    totals = parsed.agg(F.count_if(good).alias("valid"), F.count_if(~good).alias("invalid"))
    valid = F.when(
        F.col("valid") == 0, F.raise_error(F.lit("no valid feature rows")).cast("bigint")
    ).otherwise(F.col("valid"))
    return totals.select(
        valid.alias("valid"),
        "invalid",
        (F.col("valid") / (F.col("valid") + F.col("invalid")) * 100).alias("pct"),
        (F.col("valid") < FEW_ROWS).alias("few"),
    )


def matrix_stats(df: DataFrame, features: str = "image_features") -> DataFrame:
    """Samples, features, and minimum, maximum and mean over all cells.

    Rows are reduced in place and then aggregated. Rows of unequal length raise.
    """
    row = df.select(
        F.size(features).alias("n"),
        F.array_min(features).alias("lo"),
        F.array_max(features).alias("hi"),
        A.total(F.col(features)).alias("s"),
    )
    totals = row.agg(
        F.count(F.lit(1)).alias("samples"),
        F.min("n").alias("_short"),
        F.max("n").alias("_long"),
        F.min("lo").alias("feature_min"),
        F.max("hi").alias("feature_max"),
        (F.sum("s") / F.sum("n")).alias("feature_mean"),
    )
    features_col = F.when(
        F.col("_short") != F.col("_long"), F.raise_error(F.lit("rows differ in length")).cast("int")
    ).otherwise(F.col("_long"))
    return totals.select(
        "samples", features_col.alias("features"), "feature_min", "feature_max", "feature_mean"
    )


def data_info(df: DataFrame, source: str, features: str = "image_features") -> DataFrame:
    """One row describing the training data. The class map has one entry per label."""
    classes = df.groupBy("label").agg(F.count(F.lit(1)).alias("count")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("label").cast("string"), "count")))).alias("m")
    )
    return matrix_stats(df, features).select(
        "samples",
        "features",
        classes.scalar().alias("class_distribution"),
        F.array("feature_min", "feature_max").alias("feature_range"),
        "feature_mean",
        F.lit(source).alias("data_source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("load_time"),
    )


def is_suspicious(features: Column) -> Column:
    return F.forall(features, lambda f: F.abs(f) < NEAR_ZERO)


def hardcoded_check(df: DataFrame, features: str = "image_features") -> DataFrame:
    """Add ``status``: suspicious (all near zero), normal, or narrow (range too small)."""
    f = F.col(features)
    spread = F.array_max(f) - F.array_min(f)
    nonzero = F.exists(f, lambda v: F.abs(v) > NEAR_ZERO)
    return df.filter(F.size(f) > 0).withColumn(
        "status",
        F.when(is_suspicious(f), "suspicious")
        .when((spread > MIN_RANGE) & nonzero, "normal")
        .otherwise("narrow"),
    )


def row_stats(df: DataFrame, features: str = "image_features", key: str = "image_id") -> DataFrame:
    """Per row: length, minimum, maximum, mean, population std and count of non-zero features."""
    f = F.col(features)
    base = df.select(key, f.alias("_f"), A.mean(f).alias("mean"))
    return base.select(
        key,
        F.size("_f").alias("n"),
        F.array_min("_f").alias("min"),
        F.array_max("_f").alias("max"),
        "mean",
        F.sqrt(A.centred_squares(F.col("_f"), F.col("mean")) / F.size("_f")).alias("std"),
        F.size(F.filter("_f", lambda v: F.abs(v) > NEAR_ZERO)).alias("nonzero"),
    )


def feature_report(df: DataFrame, features: str = "image_features") -> DataFrame:
    """Verdict on hard-coded features with original and valid counts and the dimension, in one pass."""
    f = F.col(features)
    ok = F.coalesce(F.size(f) > 0, F.lit(False))
    return df.agg(
        (F.count_if(ok & is_suspicious(f)) == 0).alias("no_hardcoding"),
        F.count(F.lit(1)).alias("original"),
        F.count_if(ok).alias("valid"),
        F.max(F.when(ok, F.size(f))).alias("dim"),
    )
