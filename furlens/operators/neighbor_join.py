"""Exact k-nearest-neighbour classification over any number of train rows.

Median splits of a bounded sample of the train rows cut space into cells; cells
with too many rows, copies of one vector among them, have several parts. Each
part knows its bounding box. Blocks of test rows first meet one part of the cell
they lie in, which gives every row a kth distance; then the rows whose kth
distance a part's box reaches are sent to that part. No side is broadcast, and
no task holds more than a block and a part: parts that many blocks need are
copied for groups of them.

Distances and ties are those of ``neighbors``: rounded to nine decimals, ties by
image id.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from furlens.session import shared_dir

CELL_ROWS = 8192
TEST_ROWS = 1024
BLOCKS_PER_COPY = 64
BOXES_PER_PAGE = 1024
SAMPLE_ROWS = 32_768  # expected bound of the sample
SAMPLE_OF_CELL = 16


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_planes(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes and values of median splits, as a heap with about ``cells`` leaves whose root is node 1."""
    inner = 1 << max(0, (cells - 1).bit_length())
    axes, values = np.zeros(inner, np.int64), np.zeros(inner)
    parts = {1: sample}
    for node in range(1, inner):
        own = parts.pop(node)
        right = np.ones(len(own), bool)
        if len(own):
            axes[node] = np.argmax(own.max(0) - own.min(0))
            column = own[:, axes[node]]
            values[node] = np.median(column)
            right = column >= values[node]
        parts[2 * node], parts[2 * node + 1] = own[~right], own[right]
    return axes, values


def _points(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.asarray(batch.column("features").flatten()).reshape(batch.num_rows, width)


def _with_cell(rows: DataFrame, width: int, planes) -> DataFrame:
    def dealt(batches):
        axes, values = planes.value
        for batch in batches:
            points, node = _points(batch, width), np.ones(batch.num_rows, np.int64)
            for _ in range(len(axes).bit_length() - 1):
                node = 2 * node + (points[np.arange(len(node)), axes[node]] >= values[node])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node - len(axes))], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(dealt, StructType([*rows.schema.fields, StructField("cell", LongType())]))


def _divided(rows: DataFrame, most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a number below ceil(rows of the cell / most), and that count of each cell."""
    counts = rows.groupBy("cell").agg(F.ceil(F.count("*") / most).alias("n"))
    counts = _stored(counts, "cells")  # at most SAMPLE_ROWS / SAMPLE_OF_CELL, rounded up to a power of two
    numbered = rows.join(F.broadcast(counts), "cell").withColumn(name, F.pmod(F.xxhash64("row"), "n")).drop("n")
    return numbered, counts


def _part(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["image_id", "label"], kind="stable")
    points = np.stack(rows["features"].to_numpy())
    ids, labels = rows["image_id"].to_numpy(), rows["label"].to_numpy()
    first = rows.iloc[0]
    return pd.DataFrame({"cell": [first["cell"]], "part": [first["part"]], "low": [points.min(0)], "high": [points.max(0)], "ids": [ids], "labels": [labels], "points": [points.tobytes()]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    first, kth = rows.iloc[0], rows["kth"].fillna(np.inf).to_numpy(np.float64)
    points = np.stack(rows["features"].to_numpy())
    return pd.DataFrame({"cell": [first["cell"]], "block": [first["block"]], "rows": [rows["row"].to_numpy(np.int64).tobytes()], "kth": [kth.tobytes()], "asked": [points.tobytes()]})


def _page(rows: pd.DataFrame) -> pd.DataFrame:
    low, high = (np.stack(rows[c].to_numpy()).tobytes() for c in ("low", "high"))
    return pd.DataFrame({"page": [rows["page"].iloc[0]], "cells": [rows["cell"].to_numpy()], "parts": [rows["part"].to_numpy()], "lows": [low], "highs": [high]})


def _floats(scalar: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer()).reshape(-1, width)


def _searched(batches, width: int, k: int, nearest_rows):
    """The k nearest rows of a part for each row of a block."""
    for batch in batches:
        for rows, asked, ids, labels, points in zip(*(batch.column(c) for c in ("rows", "asked", "ids", "labels", "points"))):
            places, d2 = nearest_rows(_floats(asked, width), _floats(points, width), k)
            flat = pa.array(places.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.frombuffer(rows.as_buffer(), np.int64), places.shape[1])), ids.values.take(flat), labels.values.take(flat), pa.array(d2.ravel())],
                names=["row", "image_id", "label", "d2"],
            )


def _sent(batches, width: int):
    """For each part whose box they reach, the rows of a block; the part they have met is left out."""
    for batch in batches:
        for home, rows, kth, asked, cells, parts, lows, highs in zip(*(batch.column(c) for c in ("cell", "rows", "kth", "asked", "cells", "parts", "lows", "highs"))):
            x, limits = _floats(asked, width), np.frombuffer(kth.as_buffer())
            numbers = np.frombuffer(rows.as_buffer(), np.int64)
            found = []
            for cell, part, low, high in zip(cells.values.to_pylist(), parts.values.to_pylist(), _floats(lows, width), _floats(highs, width)):
                if part == 0 and cell == home.as_py():
                    continue
                d2 = (np.maximum(np.maximum(low - x, x - high), 0) ** 2).sum(1)
                wanted = d2 * (1 - 1e-9) - 1e-9 <= limits  # distances are rounded
                if wanted.any():
                    found.append((cell, part, numbers[wanted].tobytes(), x[wanted].tobytes()))
            if found:
                columns = list(zip(*found))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["cell", "part", "rows", "asked"])


def _answered(blocks: DataFrame, parts: DataFrame, copies: DataFrame, id_type: str, width: int, k: int) -> DataFrame:
    """``blocks`` (cell, part, copy, rows, asked) searched in their parts, of which ``copies`` (cell, part, n) says how many are needed."""
    from furlens.operators.neighbors import nearest_rows  # goes with the tasks, whose workers need no installed copy

    copied = parts.drop("low", "high").join(copies, ["cell", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
    pairs = blocks.join(copied, ["cell", "part", "copy"]).select("rows", "asked", "ids", "labels", "points")
    return pairs.mapInArrow(partial(_searched, width=width, k=k, nearest_rows=nearest_rows), f"row long, image_id {id_type}, label int, d2 double")


def _copy_of(block: Column) -> Column:
    return F.floor(block / BLOCKS_PER_COPY).cast("long")


def nearest(train: DataFrame, test: DataFrame, k: int, cell_rows: int = CELL_ROWS, test_rows: int = TEST_ROWS) -> DataFrame:
    """row, image_id, label, d2 and rank of the k nearest rows of ``train`` for each ``row`` of ``test``; both hold row and features, and ``train`` a row at least."""
    n, width = train.agg(F.count("*"), F.max(F.size("features"))).first()
    cells = min(-(-n // cell_rows), SAMPLE_ROWS // SAMPLE_OF_CELL)
    planes = np.zeros(1, np.int64), np.zeros(1)
    if cells > 1:
        step = -(-n // (cells * SAMPLE_OF_CELL))
        sample = train.filter(F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(step)) == 0).select("features").toArrow().combine_chunks()
        planes = split_planes(np.asarray(sample["features"].combine_chunks().flatten()).reshape(-1, width), cells)
    shared = train.sparkSession.sparkContext.broadcast(planes)
    id_type = train.schema["image_id"].dataType.simpleString()

    numbered, _ = _divided(_stored(_with_cell(train.select("row", "image_id", F.col("label").cast("int").alias("label"), "features"), width, shared), "train"), cell_rows, "part")
    parts = numbered.groupBy("cell", "part").applyInPandas(
        _part, f"cell long, part long, low array<double>, high array<double>, ids array<{id_type}>, labels array<int>, points binary"
    )
    parts = _stored(parts, "parts")
    asked, counts = _divided(_stored(_with_cell(test.select("row", "features"), width, shared), "test"), test_rows, "block")
    block_type = "cell long, block long, rows binary, kth binary, asked binary"

    blocks = asked.withColumn("kth", F.lit(None).cast("double")).groupBy("cell", "block").applyInPandas(_block, block_type)
    own = blocks.select("cell", F.lit(0).cast("long").alias("part"), _copy_of(F.col("block")).alias("copy"), "rows", "asked")
    copies = counts.select("cell", F.lit(0).cast("long").alias("part"), F.ceil(F.col("n") / BLOCKS_PER_COPY).alias("n"))
    met = _stored(_answered(own, parts, copies, id_type, width, k), "met")
    order = Window.partitionBy("row").orderBy("d2", "image_id", "label")
    kth = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("row", F.col("d2").alias("kth"))

    blocks = _stored(asked.join(kth, "row", "left").groupBy("cell", "block").applyInPandas(_block, block_type), "blocks")
    pages = max(1, -(-parts.count() // BOXES_PER_PAGE))
    paged = parts.select("cell", "part", "low", "high", F.pmod(F.xxhash64("cell", "part"), F.lit(pages)).cast("int").alias("page"))
    boxes = paged.groupBy("page").applyInPandas(_page, "page int, cells array<long>, parts array<long>, lows binary, highs binary")
    meeting = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))).join(boxes.hint("shuffle_hash"), "page")
    meeting = meeting.select("cell", "rows", "kth", "asked", "cells", "parts", "lows", "highs")
    sent = _stored(meeting.mapInArrow(partial(_sent, width=width), "cell long, part long, rows binary, asked binary"), "sent")
    needed = sent.groupBy("cell", "part").agg(F.ceil(F.count("*") / BLOCKS_PER_COPY).alias("n"))
    dealt = sent.join(needed, ["cell", "part"]).withColumn("copy", F.pmod(F.xxhash64("rows"), "n")).drop("n")
    found = met.unionByName(_answered(dealt, parts, needed, id_type, width, k))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def predict(train: DataFrame, test: DataFrame, k: int, out: str = "prediction", cell_rows: int = CELL_ROWS, test_rows: int = TEST_ROWS) -> DataFrame:
    """Add the majority label of the k nearest train rows; the smaller label wins a tie. An empty train set gives no rows."""
    if train.isEmpty():
        return test.limit(0).withColumn(out, F.lit(None).cast("int"))
    plain = test.toDF(*(f"c{i}" for i in range(len(test.columns))))
    sides = {"train_rows": train.select("image_id", "label", "features"), "test_rows": plain}
    numbered = {side: _stored(df.withColumn("row", F.monotonically_increasing_id()), side) for side, df in sides.items()}
    rows = numbered["test_rows"]
    asked = rows.select("row", F.col(f"c{test.columns.index('features')}").alias("features"))
    votes = nearest(numbered["train_rows"], asked, k, cell_rows, test_rows).groupBy("row", "label").count()
    winner = votes.groupBy("row").agg(F.min_by("label", F.struct(-F.col("count"), "label")).cast("int").alias("winner"))
    return rows.join(winner, "row").drop("row").toDF(*test.columns, out)
