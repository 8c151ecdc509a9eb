"""Batch writers. Parquet is the format to pass between stages; JSON lines and CSV serve readers outside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; null fields are written, text is not escaped to ASCII."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(path)


FEATURE_COLUMNS = ("image_id", "label", "keyword", "tags", "image_features", "original_shape")


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df.select(*FEATURE_COLUMNS), path, fmt)


def write_runs_csv(model_runs: DataFrame, path: str) -> None:
    """One row per configuration and successful model, with a header."""
    (
        model_runs.filter("success")
        .select(
            "config", F.col("model_name").alias("model"), "accuracy", "f1_score", "training_time"
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def readback_count(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Rows found when a sink is read again; with a schema nothing is inferred."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path).agg(F.count(F.lit(1)).alias("saved"))
