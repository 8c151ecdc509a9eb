"""Exact k-nearest-neighbour classification over all train rows.

Up to ``max_train_rows`` of them go to the tasks as a matrix of a few tens of
megabytes, whose bytes are counted before it is gathered. Test rows stream
through Arrow batches: no test row is shuffled, no train row is copied, and
memory per task is bounded. More train rows, or larger ones, are met by the
join of ``neighbor_join``, which gives the same neighbours.

Distances are compared after rounding to nine decimals, ties by image id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from furlens.operators import neighbor_join

K = 5
MAX_TRAIN_ROWS = 100_000
MAX_BROADCAST_BYTES = 256 * 2**20
CELLS_PER_STEP = 4_000_000  # distances held at a time


def fits(train: DataFrame, max_train_rows: int | None) -> bool:
    """Whether the train rows are few enough to be broadcast."""
    if max_train_rows is None:
        return False
    rows, cells = train.agg(F.count(F.lit(1)), F.sum(F.size("features"))).first()
    return rows <= max_train_rows and 8 * (cells or 0) <= MAX_BROADCAST_BYTES


def train_matrix(train: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, labels and vectors of the train rows."""
    rows = train.select("image_id", "label", "features").toArrow()
    n = rows.num_rows
    vectors = rows["features"].combine_chunks()
    vectors = np.asarray(vectors.flatten()).reshape(n, -1) if n else np.zeros((0, 0))
    ids = np.array(rows["image_id"].to_pylist(), dtype=object)
    order = np.argsort(ids, kind="stable")
    return ids[order], rows["label"].to_numpy()[order], vectors[order]


def nearest_rows(x: np.ndarray, train: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k nearest train rows of each row of ``x`` and their squared distances, ties to the earlier row."""
    k = min(k, len(train))
    step = max(1, CELLS_PER_STEP // max(1, len(train)))
    places, distances = [np.zeros((0, k), np.int64)], [np.zeros((0, k))]
    squares = (train**2).sum(1)
    for a in range(0, len(x), step):
        part = x[a : a + step]
        rough = squares - 2 * part @ train.T
        # candidates by the fast formula with a margin for its error, then exact differences
        top = np.partition(rough, k - 1, axis=1)[:, k - 1]
        margin = 1e-6 * (1 + (part**2).sum(1) + squares.max())
        for row, limit, point in zip(rough, top + margin, part):
            near = np.flatnonzero(row <= limit)
            d2 = np.round(((train[near] - point) ** 2).sum(1), 9)
            best = np.argsort(d2, kind="stable")[:k]
            places.append(near[best][None])
            distances.append(d2[best][None])
    return np.concatenate(places), np.concatenate(distances)


def predict(train: DataFrame, test: DataFrame, k: int = K, out: str = "prediction", max_train_rows: int | None = MAX_TRAIN_ROWS) -> DataFrame:
    """Add the majority label of the k nearest train rows; the smaller label wins a tie.

    More than ``max_train_rows`` train rows, or any number if it is None, are met by an exact join in two rounds.
    """
    if not fits(train, max_train_rows):
        return neighbor_join.predict(train, test, k, out)
    _, labels, vectors = train_matrix(train)
    if not len(labels):
        return test.limit(0).withColumn(out, F.lit(None).cast("int"))
    shared = train.sparkSession.sparkContext.broadcast((labels, vectors))

    def vote(batches):
        labels, vectors = shared.value
        classes, codes = np.unique(labels, return_inverse=True)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("features"))
            x = np.asarray(column.flatten()).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, vectors.shape[1]))
            places, _ = nearest_rows(x, vectors, k)
            votes = (codes[places][:, :, None] == np.arange(len(classes))).sum(1)
            winner = classes[votes.argmax(1)] if len(votes) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(winner.astype(np.int32))], names=[*batch.schema.names, out])

    return test.mapInArrow(vote, StructType([*test.schema.fields, StructField(out, IntegerType())]))
