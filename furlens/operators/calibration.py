"""Probabilities from decision values by Platt's sigmoid, ``1 / (1 + exp(a * decision + b))``.

The fit takes Newton steps on the regularised likelihood (Lin, Lin and Weng
2007). A step is one aggregation that sums the loss, its gradient and its
Hessian, so six numbers reach the driver whatever the data. The decision values
should come from models that did not see their rows: ``cross_decisions`` deals
the train rows into folds for that.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5
MAX_STEPS = 100
_RIDGE = 1e-12  # keeps the Hessian regular when all decisions are equal
_SMALLEST_STEP = 1e-10
_DECREASE = 1e-4


@dataclass(frozen=True)
class Sigmoid:
    a: float
    b: float

    def of(self, decision: Column) -> Column:
        """Probability of label 1."""
        return 1 / (1 + F.exp(F.lit(self.a) * decision + F.lit(self.b)))


def _sums(rows: DataFrame, a: float, b: float) -> dict:
    """Loss, gradient and Hessian at (a, b), in one pass over the rows (f, t)."""
    z = rows.select("f", "t", (F.lit(a) * F.col("f") + F.lit(b)).alias("z"))
    p = z.select("f", "t", "z", (1 / (1 + F.exp("z"))).alias("p"))
    f, t, z_, p_ = (F.col(c) for c in ("f", "t", "z", "p"))
    weight = p_ * (1 - p_)
    loss = t * z_ + F.greatest(-z_, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z_)))
    return p.agg(
        F.sum(loss).alias("loss"),
        F.sum(f * (t - p_)).alias("ga"),
        F.sum(t - p_).alias("gb"),
        F.sum(f * f * weight).alias("haa"),
        F.sum(f * weight).alias("hab"),
        F.sum(weight).alias("hbb"),
    ).first().asDict()


def fit_sigmoid(decisions: DataFrame, decision: str = "decision", label: str = "label", tolerance: float = 1e-9) -> Sigmoid:
    """Fit on rows with a decision value and a label of 0 or 1.

    Rows whose decision is NULL or not finite, or whose label is neither 0 nor
    1, take no part; without any row left this raises. One class alone is fine:
    its rows get a probability near their label. ``tolerance`` bounds the
    gradient per row.
    """
    d = F.col(decision).cast("double")
    usable = decisions.select(d.alias("f"), F.col(label).alias("y")).filter(
        F.col("f").isNotNull() & ~F.isnan("f") & (F.abs("f") < float("inf")) & F.col("y").isin(0, 1)
    )
    counted = usable.agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")).first()
    n1, n0 = counted["n1"], counted["n0"]
    if n1 + n0 == 0:
        raise ValueError("no decision values to fit on")
    target = F.when(F.col("y") == 1, F.lit((n1 + 1) / (n1 + 2))).otherwise(F.lit(1 / (n0 + 2)))
    rows = usable.select("f", target.alias("t")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _newton(rows, 0.0, math.log((n0 + 1) / (n1 + 1)), tolerance * (n1 + n0))
    finally:
        rows.unpersist()


def _newton(rows: DataFrame, a: float, b: float, gradient: float) -> Sigmoid:
    at = _sums(rows, a, b)
    for _ in range(MAX_STEPS):
        if max(abs(at["ga"]), abs(at["gb"])) < gradient:
            break
        haa, hbb = at["haa"] + _RIDGE, at["hbb"] + _RIDGE
        det = haa * hbb - at["hab"] ** 2
        da = -(hbb * at["ga"] - at["hab"] * at["gb"]) / det
        db = -(haa * at["gb"] - at["hab"] * at["ga"]) / det
        slope = at["ga"] * da + at["gb"] * db
        step = 1.0
        while step >= _SMALLEST_STEP:
            trial = _sums(rows, a + step * da, b + step * db)
            if trial["loss"] < at["loss"] + _DECREASE * step * slope:
                break
            step /= 2
        else:
            break  # the loss is as small as doubles can tell
        a, b, at = a + step * da, b + step * db, trial
    return Sigmoid(a, b)


def cross_decisions(
    train: DataFrame, decide: Callable[[DataFrame, DataFrame], DataFrame], folds: int = FOLDS, seed: int = 42, key: str = "image_id"
) -> DataFrame:
    """Label and decision of every train row, from a model fitted on the other folds.

    ``decide(train, rows)`` returns ``rows`` with a column ``decision``. Rows of
    one id share a fold. If the other folds hold only one label, the decision is
    1 or -1 for it, and 0 if they hold none. No row is shuffled.
    """
    fold = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds))
    sizes = {
        (r["fold"], r["label"]): r["n"]
        for r in train.filter(F.col("label").isin(0, 1)).groupBy(fold.alias("fold"), "label").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    parts = []
    for i in range(folds):
        if not any(k == i for k, _ in sizes):
            continue
        others = {y: sum(n for (k, v), n in sizes.items() if k != i and v == y) for y in (0, 1)}
        held = train.filter(fold == i)
        if others[0] and others[1]:
            decided = decide(train.filter(fold != i), held)
        else:
            decided = held.withColumn("decision", F.lit(float(bool(others[1])) - float(bool(others[0]))))
        parts.append(decided.select("label", "decision"))
    if not parts:
        raise ValueError("no rows to fit on")
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both
