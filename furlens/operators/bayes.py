"""Gaussian naive Bayes in closed form: one aggregation to fit, one projection to predict."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from furlens.operators.scaling import moments, numbers, population_variance

# Fixed value: share of the largest feature variance added to every variance.
VAR_SMOOTHING = 1e-9
_MAX_LABELS = 1000


@dataclass(frozen=True)
class ClassModel:
    label: int
    base: float
    mean: list[float]
    var: list[float]


def fit(train: DataFrame, features: str = "features", label: str = "label") -> list[ClassModel]:
    """Class moments: one row per label reaches the driver.

    The largest variance over all rows is put together from the class moments,
    so the data is read once.
    """
    summaries = (
        train.groupBy(F.col(label).alias("label"))
        .agg(moments(features).alias("s"))
        .limit(_MAX_LABELS + 1)
        .collect()
    )
    if not summaries:
        raise ValueError("no rows to fit on")
    if len(summaries) > _MAX_LABELS:
        raise ValueError(f"{label} has more than {_MAX_LABELS} distinct values")
    classes = [
        {"label": r["label"], "n": r["s"]["count"], "mean": [float(v) for v in r["s"]["mean"]], "var": population_variance(r["s"])}
        for r in summaries
    ]
    rows = sum(m["n"] for m in classes)
    overall = [sum(m["n"] * m["mean"][i] for m in classes) / rows for i in range(len(classes[0]["mean"]))]
    pooled = [
        sum(m["n"] * (m["var"][i] + (m["mean"][i] - overall[i]) ** 2) for m in classes) / rows
        for i in range(len(classes[0]["mean"]))
    ]
    # if no feature varies, any floor gives the same scores
    floor = VAR_SMOOTHING * max(pooled) or VAR_SMOOTHING
    models = []
    for m in sorted(classes, key=lambda m: m["label"]):
        var = [v + floor for v in m["var"]]
        base = math.log(m["n"] / rows) - 0.5 * sum(math.log(2 * math.pi * v) for v in var)
        models.append(ClassModel(m["label"], base, m["mean"], var))
    return models


def _score(m: ClassModel, features: str) -> Column:
    """Log-likelihood of a class and its share, up to a constant that all classes have."""
    squares = F.zip_with(F.col(features), numbers(m.mean), lambda x, c: (x - c) * (x - c))
    terms = F.zip_with(squares, numbers(m.var), lambda s, v: s / v)
    distance = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.lit(m.base) - F.lit(0.5) * distance


def predict(df: DataFrame, models: list[ClassModel], features: str = "features", out: str = "prediction") -> DataFrame:
    """Add the most likely label; the smaller label wins a tie."""
    scores = [F.struct(_score(m, features).alias("score"), F.lit(-m.label).alias("neg")) for m in models]
    return df.withColumn(out, -F.array_max(F.array(*scores))["neg"])


def log_odds(df: DataFrame, models: list[ClassModel], features: str = "features", out: str = "decision") -> DataFrame:
    """Add the log-odds of label 1 against label 0; both must have been fitted."""
    by_label = {m.label: m for m in models}
    if not {0, 1} <= set(by_label):
        raise ValueError("log-odds need the labels 0 and 1")
    return df.withColumn(out, _score(by_label[1], features) - _score(by_label[0], features))
