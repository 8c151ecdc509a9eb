"""Standard scaling with the population standard deviation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Scaler:
    mean: list[float]
    scale: list[float]


def moments(features: str = "features") -> Column:
    """Aggregate: count, mean and sample variance of every element, in one pass and for any length."""
    return Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(F.col(features)))


def population_variance(summary) -> list[float]:
    n = summary["count"]
    return [v * (n - 1) / n for v in summary["variance"]]


CONSTANT = 1e-12


def scaler(train: DataFrame, features: str = "features") -> Scaler:
    """Mean and scale per feature; a constant feature has scale 1.

    A deviation within the rounding error of its mean counts as constant. One aggregation; two numbers per feature reach the driver.
    """
    summary = train.agg(moments(features).alias("s")).first()["s"]
    if not summary["count"]:
        raise ValueError("no rows to fit the scaler on")
    stds = [math.sqrt(v) for v in population_variance(summary)]
    return Scaler([float(m) for m in summary["mean"]], [s if s > CONSTANT * max(1.0, abs(m)) else 1.0 for s, m in zip(stds, summary["mean"])])


def numbers(values: list[float]) -> Column:
    """An array literal of doubles."""
    return F.lit([float(v) for v in values]).cast("array<double>")


def scale(df: DataFrame, fitted: Scaler, features: str = "features") -> DataFrame:
    """Replace ``features`` by scaled values."""
    centred = F.zip_with(F.col(features), numbers(fitted.mean), lambda v, m: v - m)
    return df.withColumn(features, F.zip_with(centred, numbers(fitted.scale), lambda v, d: v / d))
