"""Feature stage: valid records to stored feature vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from furlens.operators import features as X
from furlens.sources.readers import read_clean
from furlens.sources.writers import write_features


def feature_rows(valid: DataFrame, engine: str = "arrow") -> DataFrame:
    return X.keep_extracted(X.with_features(valid, engine=engine))


def run(spark: SparkSession, valid_path: str, out: str, in_fmt: str = "parquet", fmt: str = "parquet") -> dict:
    """Extract and store; input, success and failure counts come from the same single pass."""
    seen, kept = Observation(), Observation()
    valid = read_clean(spark, valid_path, in_fmt).observe(seen, F.count(F.lit(1)).alias("total"))
    f = F.col("image_features")
    rows = feature_rows(valid).observe(
        kept,
        F.count(F.lit(1)).alias("ok"),
        F.max(F.size(f)).alias("dim"),
        (F.count_if(X.is_suspicious(f)) == 0).alias("no_hardcoding"),
    )
    write_features(rows, out, fmt)
    report = {**seen.get, **kept.get}
    report["failed"] = report["total"] - report["ok"]
    if not report["ok"]:
        raise ValueError("feature extraction failed for every row")
    return report
