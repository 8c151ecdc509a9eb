"""Summaries over the run tables: model_runs (one row per configuration and model) and config_runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BASE_CONFIG = "1_cores"


def keep_success(model_runs: DataFrame) -> DataFrame:
    return model_runs.filter("success")


def average_accuracy(model_runs: DataFrame) -> DataFrame:
    """Mean accuracy of the successful models per configuration."""
    return keep_success(model_runs).groupBy("config").agg(F.avg("accuracy").alias("avg_accuracy"))


def config_summary(model_runs: DataFrame, config_runs: DataFrame) -> DataFrame:
    """Average accuracy, total time and success count; configurations without success are absent."""
    models = keep_success(model_runs).groupBy("config").agg(
        F.avg("accuracy").alias("avg_accuracy"), F.count(F.lit(1)).alias("successful_models")
    )
    return models.join(config_runs.select("config", "total_time"), "config").select(
        "config", "avg_accuracy", "total_time", "successful_models"
    )


def speedup(config_runs: DataFrame) -> DataFrame:
    """Speedup against the one-worker run and efficiency per worker.

    The baseline enters as a scalar subquery. Without one there are no rows.
    """
    base = config_runs.filter(F.col("config") == BASE_CONFIG).agg(F.min("total_time")).scalar()
    is_base = F.col("config") == BASE_CONFIG
    ratio = F.when(F.col("total_time") > 0, F.col("_base") / F.col("total_time")).otherwise(1.0)
    return (
        config_runs.withColumn("_base", base)
        .filter(F.col("_base").isNotNull())
        .withColumn("speedup", F.when(is_base, 1.0).otherwise(ratio))
        .select(
            "config",
            "speedup",
            F.when(is_base, 1.0).otherwise(F.col("speedup") / F.col("cores")).alias("efficiency"),
            "total_time",
        )
    )


def best_config(perf_metrics: DataFrame) -> DataFrame:
    """The configuration with the largest speedup, the baseline aside; no row if there is none."""
    return (
        perf_metrics.filter(F.col("config") != BASE_CONFIG)
        .orderBy(F.desc("speedup"), "config")
        .limit(1)
    )


def best_model(model_runs: DataFrame) -> DataFrame:
    """The most accurate successful model of the one-worker run; the first listed wins a tie."""
    return (
        model_runs.filter((F.col("config") == BASE_CONFIG) & F.col("success"))
        .orderBy(F.desc("accuracy"), "model_order")
        .limit(1)
        .select("model_name", "accuracy", "f1_score", "training_time")
    )


def full_report(
    model_runs: DataFrame, config_runs: DataFrame, info: DataFrame, source: str, levels: list[int]
) -> DataFrame:
    """One nested row: run information, data information, results per configuration, speedups.

    The run tables hold one row per configuration and model, so the collected
    maps are small whatever the data size.
    """
    results = model_runs.groupBy("config").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "model_order", "model_name", "accuracy", "f1_score", "training_time", "success", "error"
                )
            )
        ).alias("results")
    )
    runs = config_runs.join(results, "config").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct("config", F.struct("results", "total_time", "cores", "method")))
            )
        )
    )
    metrics = speedup(config_runs).agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("config", F.struct("speedup", "efficiency", "total_time"))))
        )
    )
    return info.select(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.lit(source).alias("data_source"),
            F.array(*[F.lit(n) for n in levels]).alias("core_configs"),
        ).alias("analysis_info"),
        F.struct("*").alias("data_info"),
        runs.scalar().alias("parallel_results"),
        metrics.scalar().alias("performance_metrics"),
    )


def simple_report(model_runs: DataFrame, config_runs: DataFrame) -> DataFrame:
    """Fallback report, one row per configuration."""
    return config_summary(model_runs, config_runs)
