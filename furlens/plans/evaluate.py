"""Model stage: stored features to trained, scored models and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from furlens.operators import classifiers, features as X, performance, split, sweep
from furlens.session import shared_dir
from furlens.sources.readers import read_features
from furlens.sources.writers import write_runs_csv, write_table


TRAINING = "image_id string, label int, features array<double>"


def training_rows(features: DataFrame) -> DataFrame:
    """image_id, label and features of the usable rows."""
    return X.keep_trainable(features).select(
        "image_id", F.col("label").cast("int").alias("label"), F.col("image_features").alias("features")
    )


def prepared_split(rows: DataFrame, test_fraction: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test set, written once below the shared folder and read from there.

    Every model, also of a concurrent sweep, then scans stored files with a plan
    of its own; nothing depends on cached blocks of executors that may be lost.
    The learners cache what they iterate over. ``rows`` should come straight
    from storage: it is read a few times here.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, "split")
    flagged = split.stratified_split(rows, test_fraction=test_fraction, seed=seed)
    classifiers.compact(flagged, rows.count()).write.partitionBy("is_test").parquet(path)
    stored = spark.read.schema(f"{TRAINING}, is_test string").parquet(path)
    return tuple(stored.filter(F.col("is_test") == v).drop("is_test") for v in ("false", "true"))


def run(
    spark: SparkSession,
    features_path: str,
    out: str,
    in_fmt: str = "parquet",
    levels: tuple[int, ...] = sweep.LEVELS,
    models: list[classifiers.ModelSpec] | None = None,
) -> DataFrame:
    """Run every sweep level, write the CSV and the nested report, return the speedups."""
    rows = training_rows(read_features(spark, features_path, in_fmt))
    train, test = prepared_split(rows)
    sweeps = sweep.run_levels(models or classifiers.default_models(), train, test, levels)
    model_runs, config_runs = sweep.run_tables(spark, sweeps)
    write_runs_csv(model_runs, f"{out}/model_performance")
    info = X.data_info(rows, features_path, "features")
    report = performance.full_report(model_runs, config_runs, info, features_path, [s["cores"] for s in sweeps])
    write_table(report, f"{out}/report", "json")
    return performance.speedup(config_runs)
