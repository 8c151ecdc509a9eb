"""Exact top-k search by inner product with KD-trees per shard.

Median splits of a bounded sample cut space into regions; every row goes to the
shard of its region, and regions with too many rows, copies of one vector among
them, are dealt to several shards. Each shard is one KD-tree: median splits along
the widest side, and a tight bounding box for each node. For a query, a box
bounds the inner product from above by its best corner. Nodes are visited best
bound first, and the search ends when no bound reaches the query's kth best
score so far. In a first round queries meet the shard they lie in, which gives
them a kth score; then only the queries whose kth score a shard's box reaches
are sent to that shard.

Queries are a stated set that meets shards and boxes in blocks, and no row of one
query and one vector is ever made. Scores are exact integers: products that
doubles might round are computed in longs, and beyond those in Python's integers.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from furlens.llm.common import small, stored, table, with_row_keys

SHARD_ROWS = 8192
LEAF_ROWS = 256
SAMPLE_ROWS = 32_768  # expected bound of the sample that cuts space into regions
SAMPLE_OF_REGION = 16
BOX_ROWS = 1024  # boxes that a block of queries meets at a time
K = 5
SCALE = 256
LOW_BITS = 62  # a score is high * 2^62 + low


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as z:
        return {k: z[k] for k in z.files}


def build_tree(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Order of the rows, and for each node its range of them, its children (-1: leaf) and its box."""
    order, nodes = np.arange(len(points)), []
    stack = [(0, len(points), -1, 0)]
    while stack:
        start, end, parent, side = stack.pop()
        own = points[order[start:end]]
        low, high = own.min(0), own.max(0)
        at = len(nodes)
        nodes.append([start, end, -1, -1, low, high])
        if parent >= 0:
            nodes[parent][2 + side] = at
        widest = int(np.argmax(high.astype(np.float64) - low))
        if end - start > leaf_rows and high[widest] > low[widest]:
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own[:, widest], middle, kind="introselect")]
            stack += [(start, start + middle, at, 0), (start + middle, end, at, 1)]
    columns = list(zip(*nodes))
    return {"order": order, "nodes": np.array(columns[:4]).T, "low": np.stack(columns[4]), "high": np.stack(columns[5])}


def split_planes(sample: np.ndarray, regions: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and value of the median splits of a sample, as a heap of about ``regions`` leaves; node 1 is the root."""
    inner = 1 << max(0, (regions - 1).bit_length())
    axes, values = np.zeros(inner, np.int64), np.zeros(inner, np.int64)
    parts = {1: sample}
    for node in range(1, inner):
        own = parts.pop(node)
        if len(own):
            axes[node] = np.argmax(own.max(0).astype(np.float64) - own.min(0))
            column = own[:, axes[node]]
            values[node] = np.partition(column, len(column) // 2)[len(column) // 2]
            right = column >= values[node]
            parts[2 * node], parts[2 * node + 1] = own[~right], own[right]
        else:
            parts[2 * node] = parts[2 * node + 1] = own
    return axes, values


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(rows, -1)


def _dealt(batches: Iterator[pa.RecordBatch], dim: int, planes) -> Iterator[pa.RecordBatch]:
    """The rows with their region; vectors of another length than the sample's are of region 0."""
    axes, values = planes.value
    for batch in batches:
        region = np.zeros(batch.num_rows, np.int64)
        fitting = np.flatnonzero(batch.column("dim").to_numpy() == dim)
        if len(fitting):
            points = _matrix(batch.column("v").take(pa.array(fitting)), len(fitting))
            node = np.ones(len(fitting), np.int64)
            for _ in range(len(axes).bit_length() - 1):
                node = 2 * node + (points[np.arange(len(node)), axes[node]] >= values[node])
            region[fitting] = node - len(axes)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], names=[*batch.schema.names, "region"])


OWN = ["vec_id", "row_file", "row_index"]


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["row_file", "row_index"])
    points = np.stack(rows["v"].to_numpy())
    tree = build_tree(points)
    own = rows[OWN].to_numpy(dtype=np.int64)[tree["order"]]
    blob = _packed(points=points[tree["order"]], own=own, nodes=tree["nodes"], low=tree["low"], high=tree["high"])
    return pd.DataFrame({"dim": [points.shape[1]], "shard": [rows["shard"].iloc[0]], "low": [tree["low"][0]], "high": [tree["high"][0]], "tree": [blob]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["row_file", "row_index"])
    blob = _packed(points=np.stack(rows["v"].to_numpy()), own=rows[OWN].to_numpy(dtype=np.int64), kth=rows[["kth_high", "kth_low"]].to_numpy(dtype=np.int64))
    return pd.DataFrame({"dim": [len(rows["v"].iloc[0])], "shard": [rows["shard"].iloc[0]], "queries": [blob]})


def _boxes(rows: pd.DataFrame) -> pd.DataFrame:
    blob = _packed(shard=rows["shard"].to_numpy(), low=np.stack(rows["low"].to_numpy()), high=np.stack(rows["high"].to_numpy()))
    return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "page": [rows["page"].iloc[0]], "boxes": [blob]})


def _largest(*arrays: np.ndarray) -> int:
    return max(max(abs(int(a.min())), abs(int(a.max()))) for a in arrays)


def upper_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box no less than any of their products. Exact below 2^53, beyond it with room for rounding."""
    x, a, b = q.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    bounds = np.maximum(x, 0) @ b.T + np.minimum(x, 0) @ a.T
    most = float(q.shape[1]) * _largest(q) * _largest(low, high)
    return bounds if most < 2**53 else bounds + most * q.shape[1] * 2.0**-50


def _kth_of(high: int, low: int) -> float | int:
    """A kth score that was passed on; a low part below 0 says that there is none."""
    return (high << LOW_BITS) + low if low >= 0 else -float("inf")


def search(tree: dict, queries: dict, k: int) -> list[tuple]:
    """The k best of one tree for each query, as far as they reach the query's kth score: (query row, vector row, score)."""
    points, own, nodes = tree["points"], tree["own"], tree["nodes"]
    q = queries["points"]
    bounds = upper_bounds(q, tree["low"], tree["high"])
    most = q.shape[1] * _largest(q) * _largest(points)
    kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
    points, q = points.astype(kind), q.astype(kind)
    out = []
    for i in range(len(q)):
        kth, best = _kth_of(*queries["kth"][i].tolist()), []
        frontier = [(-bounds[i, 0], 0)]
        while frontier:
            bound, node = heapq.heappop(frontier)
            if -bound < kth:
                break
            start, end, left, right = nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[i, child] >= kth:
                        heapq.heappush(frontier, (-bounds[i, child], child))
                continue
            scores = points[start:end] @ q[i]
            for j in np.flatnonzero(scores >= kth).tolist():
                row = own[start + j]
                if row[1] == queries["own"][i, 1] and row[2] == queries["own"][i, 2]:
                    continue
                entry = (int(scores[j]), -int(row[0]), -int(row[1]), -int(row[2]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                kth = max(kth, best[0][0])
        out += [(*queries["own"][i].tolist(), -b, -c, -d, *_parts(a)) for a, b, c, d in best]
    return out


def _parts(score: int) -> tuple[int, int]:
    """High and low part; beyond 2^125 the high part is the largest or smallest long."""
    longs = np.iinfo(np.int64)
    return min(max(score >> LOW_BITS, longs.min), longs.max), score & ((1 << LOW_BITS) - 1)


FOUND = ["query_id", "q_file", "q_index", "vec_id", "v_file", "v_index", "high", "low"]


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tree, queries in zip(batch.column(0), batch.column(1)):
            found = search(_unpacked(tree.as_py()), _unpacked(queries.as_py()), k)
            columns = list(zip(*found)) or [[]] * len(FOUND)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=FOUND)


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of a block that each of the boxes can still serve, but for the shard where they were already searched."""
    for batch in batches:
        for dim, home, queries, boxes in zip(*(batch.column(c) for c in ("dim", "home", "queries", "boxes"))):
            block, page = _unpacked(queries.as_py()), _unpacked(boxes.as_py())
            bounds = upper_bounds(block["points"], page["low"], page["high"])
            kth = np.array([float(_kth_of(*pair)) for pair in block["kth"].tolist()])
            reached = bounds >= np.where(np.abs(kth) < 2**53, kth, np.nextafter(kth, -np.inf))[:, None]
            for i, shard in enumerate(page["shard"].tolist()):
                wanted = reached[:, i]
                if shard != home.as_py() and wanted.any():
                    blob = _packed(**{name: a[wanted] for name, a in block.items()})
                    yield pa.RecordBatch.from_arrays([pa.array([dim.as_py()], pa.int32()), pa.array([shard], pa.int64()), pa.array([blob], pa.binary())], names=["dim", "shard", "queries"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "q_file", "q_index").orderBy(F.desc("high"), F.desc("low"), "vec_id", "v_file", "v_index")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _with_regions(rows: DataFrame, shard_rows: int) -> DataFrame:
    """``rows`` with their region, of which there are as many as shards are needed or the bounded sample can tell apart."""
    counts = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    n, dim = (counts["count"], counts["dim"]) if counts else (0, 0)
    regions = min(-(-n // shard_rows), SAMPLE_ROWS // SAMPLE_OF_REGION)
    if regions < 2:
        return rows.withColumn("region", F.lit(0).cast("long"))
    step = -(-n // (regions * SAMPLE_OF_REGION))
    sample = rows.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64(F.lit(1), "row_file", "row_index"), F.lit(step)) == 0)).select("v").toArrow()
    planes = split_planes(_matrix(sample["v"].combine_chunks(), sample.num_rows), regions)
    shared = rows.sparkSession.sparkContext.broadcast(planes)
    return rows.mapInArrow(partial(_dealt, dim=dim, planes=shared), StructType([*rows.schema.fields, StructField("region", LongType())]))


def top_k(vectors: DataFrame, query_step: int = 50, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row whose vec_id is divisible by ``query_step``.

    Components become floor(256 x). Rows whose id or vector is null, whose
    vector is empty, or that hold a null or non-finite component take no part;
    only vectors of one length are compared. Ties go to the smaller vec_id, then
    to the earlier row. Repeated rows are rows of their own: each is a query of
    its own and a candidate for the others. An empty table gives no rows.

    Ranks follow the exact integer scores up to 2^125. A score that no long can
    hold is returned as the largest or smallest long, and so is a component
    beyond 2^55 taken into account as if it were that.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    keyed = with_row_keys(vectors.select("vec_id", "embedding"))
    rows = keyed.select(F.col("vec_id").cast("long").alias("vec_id"), "row_file", "row_index", x.alias("x")).filter("vec_id is not null and size(x) > 0").filter(F.coalesce(fine, F.lit(False)))
    most = float(2**63 - 1024)  # the largest double below 2^63
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(most)), F.lit(-most))).cast("long"))
    rows = rows.select("vec_id", "row_file", "row_index", whole.alias("v"), F.size("x").alias("dim"))
    rows = stored(_with_regions(stored(rows, "vectors"), shard_rows), "regions")
    sizes = stored(rows.groupBy("dim", "region").agg(F.ceil(F.count("*") / shard_rows).alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("row_file", "row_index"), F.col("parts"))
    rows = rows.join(small(sizes), ["dim", "region"]).withColumn("shard", F.col("region") * (1 << 32) + part)

    trees = rows.groupBy("dim", "shard").applyInPandas(_build, "dim int, shard long, low array<long>, high array<long>, tree binary")
    trees = stored(trees, "trees")

    def asked(queries: DataFrame) -> DataFrame:
        return queries.groupBy("dim", "shard").applyInPandas(_block, "dim int, shard long, queries binary")

    def answered(blocks: DataFrame) -> DataFrame:
        pairs = blocks.join(trees.select("dim", "shard", "tree").hint("shuffle_hash"), ["dim", "shard"]).select("tree", "queries")
        return pairs.mapInArrow(partial(_searched, k=k), ", ".join(f"{c} long" for c in FOUND))

    queries = rows.filter(F.col("vec_id") % query_step == 0)
    none = {"kth_high": F.lit(0).cast("long"), "kth_low": F.lit(-1).cast("long")}
    first = stored(answered(asked(queries.withColumns(none))), "first")
    starts = _best(first, k).filter(F.col("rank") == k).select(F.col("q_file").alias("row_file"), F.col("q_index").alias("row_index"), F.col("high").alias("kth_high"), F.col("low").alias("kth_low"))
    primed = queries.join(starts, ["row_file", "row_index"], "left").withColumns({c: F.coalesce(c, unset) for c, unset in none.items()})
    blocks = stored(asked(primed), "queries").withColumnRenamed("shard", "home")

    pages = max(1, -(-trees.count() // BOX_ROWS))
    paged = trees.select("dim", "shard", "low", "high", F.pmod(F.xxhash64("shard"), F.lit(pages)).cast("int").alias("page"))
    boxes = paged.groupBy("dim", "page").applyInPandas(_boxes, "dim int, page int, boxes binary")
    meeting = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))).join(boxes, ["dim", "page"])
    sent = meeting.select("dim", "home", "queries", "boxes").mapInArrow(_sent, "dim int, shard long, queries binary")
    best = _best(first.unionByName(answered(sent)), k)
    longs = np.iinfo(np.int64)
    score = F.when(F.col("high") > 1, F.lit(longs.max)).when(F.col("high") < -2, F.lit(longs.min)).otherwise(F.col("high") * (1 << LOW_BITS) + F.col("low"))
    return best.select("query_id", "rank", "vec_id", score.alias("score"))


def op7_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS INTEGER) AS rank,
       c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
FROM v q JOIN v c ON q.r <> c.r
WHERE q.vec_id % 50 = 0
QUALIFY rank <= 5
"""
