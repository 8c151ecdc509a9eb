"""Raw line to typed, filtered record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlens.functions.once import with_columns_once
from furlens.functions.text import capture, capture_value
from furlens.sources import schemas as S

# One pattern per field, the group is the value.
IMAGE_ID = r'"image_id":\s*"([^"]*)"'
LABEL = r'"label":\s*(\d+)'
KEYWORD = r'"keyword":\s*"([^"]*)"'
TAGS = r'"tags":\s*"([^"]*)"'
IMAGE_ARRAY = r'"image_array":\s*(\[\s*\[\s*\[.*?\]\s*\]\s*\])'
ORIGINAL_SHAPE = r'"original_shape":\s*(\[\d+,\s*\d+,\s*\d+\])'

# Fixed value: shorter arrays hold no usable image.
MIN_ARRAY_CHARS = 1000


FIELDS = ("image_id", "label", "keyword", "tags", "image_array", "original_shape")
COUNTED_FIELDS = ("image_id", "label", "keyword", "image_array")  # what the filters and counts need


def extract_fields(lines: DataFrame, value: str = "value", mode: str = "regex", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Text columns per line, six or those in ``fields``; the line is not searched for others.

    ``regex`` takes the first match anywhere in the line, undecoded. ``json``
    parses the line with a fixed schema and is right on escaped quotes too.
    """
    if mode == "json":
        record = F.from_json(F.col(value), S.IMAGE_METADATA)
        return (
            with_columns_once(lines.select(value), {"_r": record})
            .select(
                "_r.image_id",
                F.col("_r.label").cast("string").alias("label"),
                "_r.keyword",
                "_r.tags",
                F.to_json("_r.image_array").alias("image_array"),
                F.to_json("_r.original_shape").alias("original_shape"),
            )
            .select(*fields)
        )
    if mode != "regex":
        raise ValueError(f"unknown extraction mode {mode!r}")
    line = F.col(value)
    captures = {
        "image_id": capture(line, IMAGE_ID),
        "label": capture(line, LABEL),
        "keyword": capture(line, KEYWORD),
        "tags": capture(line, TAGS),
        "image_array": capture_value(line, IMAGE_ARRAY, "image_array"),
        "original_shape": capture_value(line, ORIGINAL_SHAPE, "original_shape"),
    }
    return with_columns_once(lines.select(value), {name: captures[name] for name in fields}).drop(value)


def keep_clean(extracted: DataFrame, min_chars: int = MIN_ARRAY_CHARS) -> DataFrame:
    """Rows with an id, a label, a keyword and an array text longer than ``min_chars``."""
    array = F.col("image_array")
    return extracted.filter(
        F.col("image_id").isNotNull()
        & (F.col("image_id") != "")
        & F.col("label").isNotNull()
        & F.col("keyword").isNotNull()
        & array.isNotNull()
        & ~array.isin("[]", "[[[]]]")
        & (F.length(array) > min_chars)
    )


def cast_label(extracted: DataFrame) -> DataFrame:
    """Label to int; a number too large becomes NULL."""
    return extracted.withColumn("label", F.col("label").try_cast("int"))


def keep_label_domain(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isin(0, 1))


def array_length_sample(extracted: DataFrame, n: int = 5) -> DataFrame:
    """Ids and array text lengths in characters, for the first ``n`` ids."""
    return (
        extracted.select("image_id", F.length("image_array").alias("array_length"))
        .orderBy("image_id")
        .limit(n)
    )
