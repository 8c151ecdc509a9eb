"""Image files.

Decoding uses Spark's image source (JPEG, PNG, GIF, BMP). It delivers bytes in
blue-green-red order, row by row; an Arrow UDF turns them into nested arrays.
Headers are read from the files' own bytes, without decoding.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from furlens.functions import image_bytes
from furlens.functions.batch_images import decode

HEADER = StructType().add("format", "string").add("mode", "string").add("width", "integer").add("height", "integer").add("reason", "string")


@F.arrow_udf(HEADER)
def _header(data: pa.Array) -> pa.Array:
    rows = []
    for blob in data:
        try:
            rows.append((*image_bytes.header(blob.as_py()), None))
        except image_bytes.Unreadable as e:
            rows.append((None, None, None, None, str(e)))
    columns = list(zip(*rows)) if rows else [[]] * 5
    types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["format", "mode", "width", "height", "reason"])


def header(content: Column) -> Column:
    """format, mode, width and height of an image file's bytes, or the reason why there are none."""
    return _header.asNondeterministic()(content)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """name, origin, length and header of every file below ``path``.

    Files without a readable header keep the reason. Spark's file sources skip
    files without a single byte; those are not in the result.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = found.select("path", "length", header(F.col("content")).alias("header"))
    return found.select(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("name"), F.col("path").alias("origin"), "length", "header.*")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """name, origin, height, width, channels and tensor of every readable image file below ``path``."""
    found = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    return found.select(
        F.regexp_extract("origin", r"([^/]+?)(\.[^./]*)?$", 1).alias("name"),
        "origin",
        "height",
        "width",
        F.col("nChannels").alias("channels"),
        decode("data", "height", "width", "nChannels").alias("tensor"),
    )
