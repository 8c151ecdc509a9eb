"""Counts of the clean and feature stages. Each is one partial and one final aggregation.

Totals group by a constant rather than not at all, so an empty input gives no
row instead of a zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlens.functions.text import shorten

# Fixed value: the text in front of the final count.
SUMMARY_PREFIX = "最终修复版完成！有效记录数: "


def count_all(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rows whose ``column`` is not NULL."""
    return df.groupBy(F.lit(1).alias("_all")).agg(F.count(column).alias(out)).drop("_all")


def line_count(lines: DataFrame) -> DataFrame:
    return count_all(lines, "value", "total_lines")


def valid_count(valid: DataFrame) -> DataFrame:
    return count_all(valid, "image_id", "valid_records")


def category_stats(valid: DataFrame) -> DataFrame:
    return valid.groupBy("label").agg(F.count("image_id").alias("count"))


def keyword_stats(valid: DataFrame) -> DataFrame:
    return valid.groupBy("keyword").agg(F.count("image_id").alias("count"))


def summary_text(valid: DataFrame, prefix: str = SUMMARY_PREFIX) -> DataFrame:
    return valid_count(valid).select(
        F.concat(F.lit(prefix), F.col("valid_records").cast("string")).alias("summary")
    )


def label_counts(records: DataFrame) -> DataFrame:
    """Cats and dogs in one row."""
    return records.agg(
        F.count_if(F.col("label") == 0).alias("cat"), F.count_if(F.col("label") == 1).alias("dog")
    )


def keyword_success(records: DataFrame) -> DataFrame:
    """Kept downloads per keyword."""
    return records.groupBy("keyword").agg(F.count(F.lit(1)).alias("downloads"))


def class_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("count")).orderBy("label")


def preview(df: DataFrame, columns: list[str], n: int = 5, width: int = 30) -> DataFrame:
    """First ``n`` rows by the first column, text cut to ``width`` characters."""
    types = dict(df.dtypes)
    return (
        df.orderBy(columns[0])
        .limit(n)
        .select(*[shorten(F.col(c), width).alias(c) if types[c] == "string" else c for c in columns])
    )


def sample_rows(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """Any ``n`` rows, or the first ``n`` in the given order."""
    return (df.orderBy(*order) if order else df).limit(n)
