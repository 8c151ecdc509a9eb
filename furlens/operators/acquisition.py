"""Search listing to accepted image records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from furlens.functions import labels, tensors, text
from furlens.functions.batch_images import resizer

# Acceptance rules of a download.
MIN_CONTENT_LENGTH = 10000
FORMATS = ("JPEG", "PNG", "GIF", "WEBP")
MODES = ("L", "RGB", "RGBA")
MIN_DOWNLOAD_SIDE = 100
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp")
MAX_PER_KEYWORD = 4
RESIZED_SIDE = 64


def listing_hits(responses: DataFrame) -> DataFrame:
    """One row per hit with defaults filled in and a tag label; no hits, no rows."""
    hit = responses.select(F.explode("hits").alias("h"))
    zero, empty = F.lit(0).cast("bigint"), F.lit("")
    tags = F.coalesce("h.tags", empty)
    return hit.select(
        F.col("h.id").alias("api_id"),
        F.col("h.pageURL").alias("page_url"),
        F.col("h.webformatURL").alias("image_url"),
        tags.alias("tags"),
        F.coalesce("h.views", zero).alias("views"),
        F.coalesce("h.downloads", zero).alias("downloads"),
        F.coalesce("h.user", empty).alias("user"),
        labels.tag_label(tags).alias("label"),
    )


def is_image_url(url: Column, provider_domain: str) -> Column:
    """The path ends like an image file, or the host contains the provider's domain."""
    path = F.lower(text.url_path(url))
    named = F.lit(False)
    for suffix in IMAGE_SUFFIXES:
        named = named | F.endswith(path, F.lit(suffix))
    return F.coalesce(
        (F.trim(url) != "")
        & (named | F.contains(text.url_host(url), F.lit(provider_domain))),
        F.lit(False),
    )


def keep_image_urls(df: DataFrame, provider_domain: str, url: str = "url") -> DataFrame:
    return df.filter(is_image_url(F.col(url), provider_domain))


def keep_image_responses(fetch_log: DataFrame) -> DataFrame:
    """Status 200, an image content type, and a length that is absent or large enough."""
    length = F.col("content_length")
    return fetch_log.filter(
        (F.col("status") == 200)
        & F.startswith(F.lower("content_type"), F.lit("image/"))
        & (
            length.isNull()
            | (length == "")
            | F.coalesce(length.try_cast("bigint") >= MIN_CONTENT_LENGTH, F.lit(False))
        )
    )


def keep_image_formats(fetch_log: DataFrame) -> DataFrame:
    return fetch_log.filter(
        F.col("format").isin(*FORMATS)
        & F.col("mode").isin(*MODES)
        & (F.col("width") >= MIN_DOWNLOAD_SIDE)
        & (F.col("height") >= MIN_DOWNLOAD_SIDE)
    )


def keep_content(df: DataFrame, tensor: str = "tensor") -> DataFrame:
    return df.filter(tensors.has_content(F.col(tensor)))


def resize(df: DataFrame, tensor: str = "tensor", out: str = "resized", side: int = RESIZED_SIDE, filter: str = "nearest") -> DataFrame:
    """Add an RGB copy of ``side`` x ``side``, by the nearest cell or bicubic with antialiasing."""
    return df.withColumn(out, resizer(side, side, filter)(F.col(tensor).cast("array<array<array<int>>>")))


def keep_content_twice(df: DataFrame, tensor: str = "tensor", side: int = RESIZED_SIDE, filter: str = "nearest") -> DataFrame:
    """The content check before and after the resize; adds ``resized``."""
    return keep_content(resize(keep_content(df, tensor), tensor, "resized", side, filter), "resized")


def top_candidates(df: DataFrame, order: list[Column], n: int = MAX_PER_KEYWORD, keyword: str = "keyword") -> DataFrame:
    """First ``n`` rows per keyword.

    Spark limits each keyword inside every map task before the shuffle, so a
    keyword that holds most rows sends only ``n`` of them per task.
    """
    rank = F.row_number().over(Window.partitionBy(keyword).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def image_record(df: DataFrame, provider: str, fetched_at: Column | None = None, shape: Column | None = None) -> DataFrame:
    """The twelve-field record of an accepted image.

    Expects keyword, api_id, position, image_url, tensor, resized, label, tags,
    views, downloads and user. Without an api id the position names the image.
    ``shape`` stands in for that of ``tensor``, which is not read then.
    """
    stamp = fetched_at if fetched_at is not None else F.current_timestamp()
    zero, empty = F.lit(0).cast("bigint"), F.lit("")
    return df.select(
        F.concat_ws("_", "keyword", F.coalesce("api_id", "position").cast("string")).alias("image_id"),
        F.col("resized").cast("array<array<array<int>>>").alias("image_array"),
        F.col("image_url").alias("source_url"),
        F.format_string("%s %s image", F.lit(provider), F.col("keyword")).alias("description"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("download_timestamp"),
        labels.effective_label(F.col("label"), F.col("image_url"), F.col("keyword")).alias("label"),
        F.col("keyword"),
        (tensors.shape(F.col("tensor")) if shape is None else shape).alias("original_shape"),
        F.coalesce("tags", empty).alias("tags"),
        F.coalesce("views", zero).alias("views"),
        F.coalesce("downloads", zero).alias("downloads"),
        F.coalesce("user", empty).alias("user"),
    )
