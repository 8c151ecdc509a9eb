"""Load stage: feature lines of any origin to valid rows and rejected lines, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from furlens.functions.once import with_columns_once
from furlens.operators import features as X
from furlens.sources import readers as R, schemas as S

VALID = "valid"
_OUTCOMES = (VALID, *X.REASONS)
_STORED = f"{S.FEATURES.replace('label int', 'label double')}, line string, outcome string"


def load(lines: DataFrame, out: str, value: str = "value") -> dict:
    """Write every line once, below a folder per outcome, and return the lines per outcome.

    A valid line is stored as its fields, a rejected one as the line itself.
    The input is parsed and read once: the counts are observed during the
    write. No row is shuffled; a task has one open file per outcome. Without
    any valid line this raises after the write, so the rejects can be read.
    """
    parsed = R.parse_feature_lines(lines.select(F.col(value).alias("line")), "line", keep=("line",))
    told = with_columns_once(parsed, {"outcome": F.coalesce(X.reject_reason(), F.lit(VALID))})
    valid = F.col("outcome") == VALID
    rows = told.select(
        *[F.when(valid, F.col(c)).alias(c) for c in ("image_id", "label", "keyword", "tags", "image_features", "original_shape")],
        F.when(~valid, F.col("line")).alias("line"),
        "outcome",
    )
    seen = Observation()
    rows.observe(
        seen, *[F.count_if(F.col("outcome") == o).alias(f"n{i}") for i, o in enumerate(_OUTCOMES)]
    ).write.mode("overwrite").partitionBy("outcome").parquet(out)
    counts = {o: seen.get[f"n{i}"] for i, o in enumerate(_OUTCOMES)}
    if not counts[VALID]:
        raise ValueError("no valid feature rows")
    return counts


def valid_rows(spark: SparkSession, out: str) -> DataFrame:
    """The valid rows of a load, with the columns of stored features."""
    stored = spark.read.schema(_STORED).parquet(out).filter(F.col("outcome") == VALID)
    return stored.drop("line", "outcome").withColumn("label", F.col("label").cast("int"))


def rejected_lines(spark: SparkSession, out: str) -> DataFrame:
    """line and reason of every rejected line of a load."""
    stored = spark.read.schema(_STORED).parquet(out).filter(F.col("outcome") != VALID)
    return stored.select("line", F.col("outcome").alias("reason"))


def run(spark: SparkSession, lines_path: str, out: str) -> dict:
    """Load text files of feature lines; the evaluate stage reads ``valid_rows``."""
    return load(R.read_lines(spark, lines_path), out)
