"""Batch readers. All take the session and a path, and return a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from furlens.sources import schemas as S


def read_listing_responses(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed search responses, one JSON object per file or, with ``multi_line=False``, per line.

    Line form splits within files and is the one to land large crawls in.
    """
    return spark.read.schema(S.LISTING_RESPONSE).option("multiLine", multi_line).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str = S.IMAGE_METADATA) -> DataFrame:
    """Files that each hold one JSON array; one row per element, malformed input fails the job.

    Such a file cannot be split, so convert it once with ``write_ndjson``.
    """
    return (
        spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines in one column, ``value``."""
    return spark.read.text(path)


def read_clean(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(S.VALID).format(fmt).load(path)


def read_features(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(S.FEATURES).format(fmt).load(path)


def parse_feature_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse each feature line on its own; ``parsed`` is false for a malformed one.

    The label is read as a double, so that 1 and 1.0 are the same label; an
    absent label is -1 and absent features are an empty array. Columns named in
    ``keep`` stay in front.
    """
    corrupt = "_corrupt_record"
    schema = (
        "image_id string, label double, keyword string, tags string, "
        f"image_features array<double>, original_shape string, {corrupt} string"
    )
    record = F.from_json(
        F.trim(F.col(value)), schema, {"columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE"}
    )
    return lines.select(*keep, record.alias("_r")).select(
        *keep,
        "_r.image_id",
        F.coalesce("_r.label", F.lit(-1.0)).alias("label"),
        "_r.keyword",
        "_r.tags",
        F.coalesce("_r.image_features", F.array().cast("array<double>")).alias("image_features"),
        "_r.original_shape",
        (F.col("_r").isNotNull() & F.col(f"_r.{corrupt}").isNull()).alias("parsed"),
    )


def input_files(df: DataFrame) -> DataFrame:
    """Number of data files that hold rows of a file scan; a missing path raises on read."""
    return df.select(F.col("_metadata.file_path").alias("file")).agg(F.count_distinct("file").alias("files"))
