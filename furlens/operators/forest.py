"""Fully grown trees over many train rows, each grown whole in one task.

MLlib grows all trees at once, level by level, and each partition shuffles a
histogram of every open node. Fully grown trees have about as many nodes as
rows, so that grows with rows times partitions, and the driver holds all nodes.
Here features become bin numbers of a byte each, which go to all tasks. A task
grows its trees over all train rows, takes the test rows along and adds up their
votes: no tree is kept, and what is shuffled are the votes of each task.

Bins, impurity, choice of features, bootstrap and vote are MLlib's, with two
differences: the bins' limits are counted over all rows, where MLlib takes a
sample of 10,000, and random numbers are others.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from furlens.session import shared_dir

BINS = 32
MOST_CELLS = 64_000_000  # bytes of train and test rows in a task
VOTE = 1 << 32  # whole votes, so that their sum does not depend on its order
ROWS_PER_BATCH = 10_000


def limits(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """The limits between the bins of each feature, all rows counted.

    Those of MLlib: half way between neighbouring values, all of them if there
    are few, else where the count passes the next multiple of rows / bins.
    """
    n = rows.count()
    values = rows.select(F.posexplode("features").alias("feature", "value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("feature").orderBy("value")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = values.select(
        "feature",
        F.row_number().over(order).alias("rank"),
        F.count(F.lit(1)).over(Window.partitionBy("feature")).alias("distinct"),
        ((F.lag("value").over(order) + F.col("value")) / 2).alias("limit"),
        F.when(F.lag("value").over(order).isNull(), 0).otherwise(F.ceil((F.sum("n").over(so_far) - F.col("n") / 2) * bins / n) - 1).alias("passed"),
    )
    passing = F.when(F.col("passed") > F.lag("passed").over(Window.partitionBy("feature").orderBy("rank")), F.col("rank"))
    steps = steps.withColumn("passing", passing).withColumn("last", F.max("passing").over(Window.partitionBy("feature").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # a value with many rows passes several multiples; the values after it then are limits one by one
    wanted = steps.filter((F.col("rank") > 1) & ((F.col("rank") <= bins) | (F.col("rank") - F.col("last") < bins)))
    found: list[list[float]] = [[] for _ in range(width)]
    for r in sorted(wanted.select("feature", "rank", "distinct", "limit", "passed").collect()):
        if r["distinct"] <= bins or r["passed"] > len(found[r["feature"]]):
            found[r["feature"]].append(r["limit"])
    return [np.array(f) for f in found]


def bin_numbers(points: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(b, points[:, i]) for i, b in enumerate(bounds)], axis=1).astype(np.uint8)


def _coded(rows: DataFrame, kept: dict[str, str], bounds: list[np.ndarray], out: str = "binary") -> DataFrame:
    """``rows`` with columns ``kept`` and the bin numbers of ``features``, as bytes or an array of doubles."""

    def work(batches):
        for batch in batches:
            codes = bin_numbers(np.asarray(batch.column("features").flatten()).reshape(batch.num_rows, len(bounds)), bounds)
            if out == "binary":
                column = pa.array([c.tobytes() for c in codes], pa.binary())
            else:
                ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * len(bounds))
                column = pa.ListArray.from_arrays(ends, pa.array(codes.ravel().astype(np.float64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), column], names=[*kept, "features"])

    return rows.select(*kept, "features").mapInArrow(work, ", ".join([*(f"{k} {t}" for k, t in kept.items()), f"features {out}"]))


def binned(train: DataFrame, test: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Both with the bin numbers of the train rows as features, for a learner that would choose its limits from a sample."""
    bounds = limits(train, width)
    return tuple(_coded(df, {k: df.schema[k].dataType.simpleString() for k in ("image_id", "label")}, bounds, "array<double>") for df in (train, test))


def _best_splits(x, y, w, rows, node, totals, picks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of the best split of each node among its ``picks``; ``rows`` are in the order of their nodes."""
    m, classes = totals.shape
    gains, features, bins = np.zeros(m), np.zeros(m, np.int64), np.zeros(m, np.uint8)
    for s in range(picks.shape[1]):
        b = x[rows, picks[node, s]]
        order = np.argsort(b, kind="stable")
        order = order[np.argsort(node[order], kind="stable")]
        n, b, own = node[order], b[order], rows[order]
        at = np.flatnonzero((n[1:] == n[:-1]) & (b[1:] != b[:-1]))
        if not len(at):
            continue
        sums = np.stack([np.concatenate([[0], np.cumsum(w[own] * (y[own] == c))]) for c in range(classes)], axis=1)
        of = n[at]
        left = sums[at + 1] - sums[np.searchsorted(n, np.arange(m))[of]]
        right = totals[of] - left
        a, z = left.sum(1), right.sum(1)
        # what the split takes from the Gini impurity; 0 exactly if both sides have the same shares
        gain = a * z / (a + z) * ((left / a[:, None] - right / z[:, None]) ** 2).sum(1)
        first = np.concatenate([[True], of[1:] != of[:-1]])
        most = np.maximum.reduceat(gain, np.flatnonzero(first))[np.cumsum(first) - 1]
        hit = np.flatnonzero(gain == most)
        hit = hit[np.concatenate([[True], of[hit][1:] != of[hit][:-1]])]
        hit = hit[gain[hit] > gains[of[hit]]]
        gains[of[hit]], features[of[hit]], bins[of[hit]] = gain[hit], picks[of[hit], s], b[at[hit]]
    return gains, features, bins


def tree_votes(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, asked: np.ndarray, subset: int, depth: int, rng: np.random.Generator) -> np.ndarray:
    """The shares of the classes in the leaf of each row of ``asked``, of one tree grown over ``x``, ``y`` with weights ``w``."""
    votes = np.zeros((len(asked), classes), np.int64)
    rows, going = np.flatnonzero(w), np.arange(len(asked))
    node, at = np.zeros(len(rows), np.int64), np.zeros(len(asked), np.int64)
    level, m = 0, min(1, len(rows))
    while m:
        totals = np.stack([np.bincount(node, w[rows] * (y[rows] == c), m) for c in range(classes)], axis=1)
        leaf = (totals.max(1) == totals.sum(1)) | (level == depth)
        for searched in (False, True):
            if searched:
                picks = np.broadcast_to(np.arange(x.shape[1]), (m, x.shape[1]))
                if subset < x.shape[1]:
                    picks = rng.random((m, x.shape[1])).argpartition(subset, axis=1)[:, :subset]
                gains, features, bins = _best_splits(x, y, w, rows, node, totals, picks)
                leaf = gains <= 0
            ended = leaf[at]
            votes[going[ended]] = np.rint(totals[at[ended]] / totals[at[ended]].sum(1, keepdims=True) * VOTE)
            number, left, kept = np.cumsum(~leaf) - 1, ~leaf[node], ~ended
            rows, node, going, at = rows[left], number[node[left]], going[kept], number[at[kept]]
            totals, m = totals[~leaf], int((~leaf).sum())
            if not m:
                return votes
        features, bins = features[~leaf], bins[~leaf]
        node = 2 * node + (x[rows, features[node]] > bins[node])
        at = 2 * at + (asked[going, features[at]] > bins[at])
        order = np.argsort(node, kind="stable")
        rows, node, m, level = rows[order], node[order], 2 * m, level + 1
    return votes


def _voted(batches, shared, trees: int, subset: int, depth: int, seed: int):
    x, y, asked, numbers, classes = shared.value
    votes = np.zeros((len(asked), classes), np.int64)
    for batch in batches:
        for tree in batch.column(0).to_pylist():
            rng = np.random.default_rng([seed, tree])
            w = rng.poisson(1.0, len(x)) if trees > 1 else np.ones(len(x), np.int64)
            votes += tree_votes(x, y, w, classes, asked, subset, depth, rng)
    for a in range(0, len(asked), ROWS_PER_BATCH):
        part = slice(a, a + ROWS_PER_BATCH)
        yield pa.RecordBatch.from_arrays([pa.array(numbers[part]), *(pa.array(votes[part, c]) for c in range(classes))], names=["row", *(f"v{c}" for c in range(classes))])


def fits(train_rows: int, test_rows: int, width: int) -> bool:
    """Whether the bin numbers of all rows are few enough for a task."""
    return (train_rows + test_rows) * width <= MOST_CELLS


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def fit_predict(train: DataFrame, test: DataFrame, width: int, trees: int, depth: int, seed: int) -> DataFrame:
    """image_id, label and prediction of each test row, by the summed class shares of its leaves; the smaller label wins a tie."""
    spark = train.sparkSession
    bounds = limits(train, width)
    key = F.xxhash64("image_id", "label", "features").alias("key")  # rows of one key are equal, so their order is of no matter
    known = _coded(train.select(key, F.col("label").cast("int").alias("label"), "features"), {"key": "long", "label": "int"}, bounds).toArrow()
    order = np.argsort(known["key"].to_numpy(), kind="stable")
    labels, y = np.unique(known["label"].to_numpy(), return_inverse=True)
    path = shared_dir(spark, "asked")
    test.select("image_id", "label", "features").withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    asked = _coded(rows, {"row": "long"}, bounds).toArrow()
    matrices = _matrix(known["features"], width)[order], y[order], _matrix(asked["features"], width), asked["row"].to_numpy()
    shared = spark.sparkContext.broadcast((*matrices, len(labels)))
    subset = width if trees == 1 else math.ceil(math.sqrt(width))
    columns = [f"v{c}" for c in range(len(labels))]
    work = partial(_voted, shared=shared, trees=trees, subset=subset, depth=depth, seed=seed)
    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    votes = spark.range(0, trees, 1, tasks).mapInArrow(work, ", ".join(["row long", *(f"{c} long" for c in columns)]))
    summed = votes.groupBy("row").agg(F.array(*(F.sum(c) for c in columns)).alias("votes"))
    place = F.array_position("votes", F.array_max("votes")).cast("int")
    winner = summed.select("row", F.element_at(F.array(*(F.lit(int(v)) for v in labels)), place).alias("prediction"))
    return rows.join(winner, "row").select("image_id", F.col("label").cast("int").alias("label"), "prediction")
