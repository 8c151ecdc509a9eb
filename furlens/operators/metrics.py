"""Classification scores from (label, prediction) rows.

Rows are first counted per pair in the map tasks; everything after works on
that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(
        F.avg((F.col(label).cast("int") == F.col(prediction).cast("int")).cast("double")).alias(
            "accuracy"
        )
    )


def scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: ``accuracy`` and ``f1_score``, the per-class F1 weighted by support.

    A class that is never predicted has F1 0; a class without support has no weight.
    """
    pairs = confusion(df, label, prediction)
    side = F.explode(
        F.array(
            F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
        )
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per_class = (
        pairs.select(hit.alias("hit"), side.alias("s"))
        .groupBy("s.class")
        .agg(
            (F.sum("hit") / 2).alias("tp"),  # a hit sits on both sides
            F.sum("s.support").alias("support"),
            F.sum("s.predicted").alias("predicted"),
        )
    )
    f1 = 2 * F.col("tp") / (F.col("support") + F.col("predicted"))
    return per_class.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1_score"),
    )


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scores(df, label, prediction).select("f1_score")
