"""Acquire stage: landed listings and fetched files to image records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from furlens.functions import image_bytes
from furlens.functions.batch_images import batch_resize, nested, parts
from furlens.functions.tensors import MIN_COLOURS, MIN_SIDE
from furlens.operators import acquisition as A

CELLS = "array<array<array<int>>>"
INSPECTED = f"candidate long, reason string, shape array<int>, resized {CELLS}"


def _candidates(listing: DataFrame, n: int) -> DataFrame:
    return A.top_candidates(listing, [F.col("position").asc()], n)


def _has_content(cells: np.ndarray) -> bool:
    h, w, c = cells.shape
    return h >= MIN_SIDE and w >= MIN_SIDE and len(np.unique(cells.reshape(-1, c), axis=0)) >= MIN_COLOURS


def _inspect(data: bytes | None, side: int, filter: str) -> tuple[str | None, list[int] | None, np.ndarray | None]:
    """The reason for refusing a file, or the shape of its image and the resized image."""
    try:
        kind, mode, width, height = image_bytes.header(data)
        if kind not in A.FORMATS or mode not in A.MODES or min(width, height) < A.MIN_DOWNLOAD_SIDE:
            return "format", None, None
        cells = image_bytes.cells(data)
    except image_bytes.Unreadable as e:
        return str(e), None, None
    if not _has_content(cells):
        return "content", None, None
    h, w, c = cells.shape
    one = batch_resize(nested(cells.ravel().astype(np.int32), [h], [w], [c]), side, side, filter)
    small = one.flatten().flatten().flatten().to_numpy().reshape(side, side, 3)
    if not _has_content(small):
        return "content after resize", None, None
    return None, [h, w] if mode == "L" else [h, w, c], small


def inspected(files: DataFrame, side: int = A.RESIZED_SIDE, filter: str = "bicubic") -> DataFrame:
    """``candidate`` and what becomes of its ``content``: header, cells, content check, resize and second check in one pass.

    A refused file keeps its reason. One file is decoded at a time, and a
    bounded part of a batch handed back.
    """

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n in parts(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy() + side * side * 3):
                yield batch.slice(a, n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some(batches):
            found = [_inspect(blob.as_py(), side, filter) for blob in batch.column(1)]
            reasons, shapes, images = zip(*found) if found else ([], [], [])
            missing = np.array([i is None for i in images], dtype=bool)
            kept = [i.ravel() for i in images if i is not None]
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int32)
            n = len(found)
            cells = nested(flat, np.where(missing, 0, side), np.full(n, side), np.full(n, 3), missing)
            columns = [batch.column(0), pa.array(reasons, pa.string()), pa.array(shapes, pa.list_(pa.int32())), cells]
            yield pa.RecordBatch.from_arrays(columns, names=["candidate", "reason", "shape", "resized"])

    return files.select("candidate", "content").mapInArrow(work, INSPECTED)


def outcomes(listing: DataFrame, fetched: DataFrame, n: int = A.MAX_PER_KEYWORD, side: int = A.RESIZED_SIDE, filter: str = "bicubic") -> DataFrame:
    """The first ``n`` candidates of each keyword with ``reason`` (null: accepted), ``shape`` and ``resized``.

    ``listing`` has keyword, position (rank in the response) and the listing
    columns; ``fetched`` has url, status, content_type, content_length and
    content, one row per url. Candidates are chosen before any file is touched:
    addresses are joined first, and only files of candidates whose response is
    fit are read and decoded, above the join. Refused ones are not replaced.
    A candidate named twice by a listing is looked up twice.
    """
    wanted = _candidates(listing, n).withColumn("candidate", F.xxhash64("keyword", "position", "image_url"))
    address = wanted.filter(F.coalesce(F.col("image_url"), F.lit("")) != "").select("candidate", "image_url").distinct()
    narrow = address.join(fetched.select(F.col("url").alias("image_url"), "status", "content_type", "content_length"), "image_url")
    known = narrow.select("candidate", F.lit(True).alias("known")).distinct()
    fit = A.keep_image_responses(narrow).select("candidate", "image_url")
    files = fetched.select(F.col("url").alias("image_url"), "content").join(fit, "image_url")
    found = wanted.join(known, "candidate", "left").join(inspected(files, side, filter).withColumn("read", F.lit(True)), "candidate", "left")
    reason = (
        F.when(F.coalesce(F.col("image_url"), F.lit("")) == "", "no address")
        .when(F.col("known").isNull(), "not fetched")
        .when(F.col("read").isNull(), "response")
        .otherwise(F.col("reason"))
    )
    return found.withColumn("reason", reason).drop("known", "read", "candidate")


def records(listing: DataFrame, fetched: DataFrame, provider: str, n: int = A.MAX_PER_KEYWORD, filter: str = "bicubic") -> DataFrame:
    """Records of the accepted images of a listing and its fetched files."""
    accepted = outcomes(listing, fetched, n, filter=filter).filter("reason is null")
    return A.image_record(accepted, provider, shape=F.col("shape"))


def summary(listing: DataFrame, fetched: DataFrame, n: int = A.MAX_PER_KEYWORD) -> DataFrame:
    """keyword, found (all its hits), tried and downloads: keywords without a success have 0."""
    hits = listing.groupBy("keyword").agg(F.count("*").alias("found"))
    tried = outcomes(listing, fetched, n).groupBy("keyword").agg(F.count("*").alias("tried"), F.count_if(F.col("reason").isNull()).alias("downloads"))
    return hits.join(tried, "keyword")


def image_records(listing: DataFrame, fetched: DataFrame, provider: str, n: int = A.MAX_PER_KEYWORD) -> DataFrame:
    """Records of the accepted images where ``fetched`` holds decoded images (tensor) and their formats.

    The first ``n`` candidates per keyword are looked up, those that fail a
    check are not replaced, and at most ``n`` are kept.
    """
    candidates = _candidates(listing, n).filter(F.col("image_url").isNotNull() & (F.col("image_url") != ""))
    accepted = fetched.transform(A.keep_image_responses).transform(A.keep_image_formats)
    found = accepted.select("url", "tensor").join(candidates, F.col("image_url") == F.col("url"))
    return A.image_record(_candidates(A.keep_content_twice(found), n), provider)
