"""Ranked lexical search by two hierarchies whose nodes hold coordinate maxima.

An item is a vector of term weights, a document one of term impacts; a score is
their inner product. Items and the documents of each batch are bisected into
balanced trees, and a node holds for each term the largest value below it. The
product of two nodes is then no less than any score of an item and a document
below them: a pair of nodes whose product is under the weakest kth score of the
items below it is dropped with all its pairs. Both trees are descended at once;
at the last level nodes are single items and documents and the products are the
scores themselves.

Items come in passes of bounded size; a pass's tree goes to all tasks, documents
never move. The kth scores of a sample of documents, which can only be too low,
are where every task begins, and each task raises its own from batch to batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furlens.llm.common import discard, sliced, stored, table, text_or_empty
from furlens.llm.runs import WORDS, runs

BEST = 10
FAN = 4
TREE_DOCS = 1024
GROUP = 16  # bisection ends at groups of so many
PASS_TERMS = 500_000  # distinct terms of all items of a pass together
EXPANDED = 2_000_000  # products held at a time
SAMPLE = 64  # one document in so many gives the first kth scores
EXACT = 1 << 53


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, times) of each item's text."""
    for batch in sliced(batches, 1):
        distinct, codes, bounds = runs(batch.column(1), WORDS)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        pairs, times = np.unique(owner * max(1, len(distinct)) + codes, return_counts=True)
        row, code = np.divmod(pairs, max(1, len(distinct)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), distinct.cast(pa.string()).take(pa.array(code)), pa.array(times.astype(np.int64))], names=["item", "term", "times"])


def _vectors(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    """doc_id, number of terms, and codes and occurrences of the items' terms in each document that has a term."""
    wanted = pa.array(terms.value, pa.large_string())
    for batch in sliced(batches, 1):
        distinct, codes, bounds = runs(batch.column(1), WORDS)
        lengths = np.diff(bounds)
        place = pc.fill_null(pc.index_in(distinct, value_set=wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        code = place[codes] if len(codes) else codes
        owner = np.repeat(np.arange(batch.num_rows), lengths)[code >= 0]
        pairs, times = np.unique(owner * max(1, len(wanted)) + code[code >= 0], return_counts=True)
        owner, code = np.divmod(pairs, max(1, len(wanted)))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (code, times)]
        found = pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths.astype(np.int64)), *lists], names=["doc_id", "n", "codes", "times"])
        yield found.filter(pa.array(lengths > 0))


class Entries:
    """A sparse matrix as (row, column, value), with the number of its rows."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int):
        self.rows, self.columns, self.values, self.n = rows, columns, values, n

    def maxima(self, fan: int) -> Entries:
        """The largest value of each column over each ``fan`` rows."""
        rows = self.rows // fan
        order = np.lexsort((self.columns, rows))
        r, c = rows[order], self.columns[order]
        first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (c[1:] != c[:-1])])) if len(r) else np.zeros(0, dtype=np.int64)
        values = np.maximum.reduceat(self.values[order], first) if len(r) else self.values
        return Entries(r[first], c[first], values, -(-self.n // fan))


def bisected(m: Entries, width: int) -> np.ndarray:
    """An order of the rows in which neighbours are alike: every group is halved between its first row and the one least like it."""
    group, size, weights = np.zeros(m.n, dtype=np.int64), m.n, m.values.astype(np.float64)
    width = max(1, width)
    order = np.arange(m.n)
    columns = int(m.columns.max()) + 1 if len(m.columns) else 1

    def likeness(seeds: np.ndarray) -> np.ndarray:
        """Inner product of each row with the seed of its group."""
        is_seed = np.zeros(m.n, dtype=bool)
        is_seed[seeds] = True
        own = is_seed[m.rows]
        keys = group[m.rows] * columns + m.columns
        at = np.argsort(keys[own], kind="stable")
        known, values = keys[own][at], weights[own][at]
        if not len(known):
            return np.zeros(m.n)
        found = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.bincount(m.rows, weights=np.where(known[found] == keys, values[found] * weights, 0.0), minlength=m.n)

    while size > width:
        starts = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
        near = likeness(order[starts])
        by_near = np.lexsort((near, group))
        far = likeness(by_near[np.flatnonzero(np.concatenate([[True], group[by_near][1:] != group[by_near][:-1]]))])
        order = np.lexsort((far - near, group))
        sizes = np.diff(np.append(starts, m.n))
        rank = np.arange(m.n) - np.repeat(starts, sizes)
        # halves of a multiple of the fan, so that nodes do not straddle groups
        half = np.repeat(np.minimum(-(-(sizes // 2) // FAN) * FAN, sizes), sizes)
        group[order] = 2 * group[order] + (rank >= half)
        size = (size + 1) // 2
    return order


def levels(m: Entries, order: np.ndarray) -> list[Entries]:
    """The tree over the rows in this order, from the top level down to the rows."""
    place = np.empty(m.n, dtype=np.int64)
    place[order] = np.arange(m.n)
    found = [Entries(place[m.rows], m.columns, m.values, m.n)]
    while found[-1].n > 1:
        found.append(found[-1].maxima(FAN))
    return found[::-1]


class ItemTree:
    """The items of a pass: per level, the entries of each term in a row."""

    def __init__(self, items: np.ndarray, m: Entries, n_terms: int, most: int):
        order = bisected(m, GROUP)
        self.items = items[order]
        self.n_terms = n_terms
        self.exact_in_floats = most < EXACT
        self.levels = []
        for level in levels(m, order):
            by_term = np.argsort(level.columns, kind="stable")
            starts = np.searchsorted(level.columns[by_term], np.arange(n_terms + 1))
            self.levels.append((starts, level.rows[by_term], level.values[by_term], level.n))

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """The smallest kth score below each node, by level."""
        found = [kth]
        for _ in self.levels[1:]:
            found.append(np.minimum.reduceat(found[-1], np.arange(0, len(found[-1]), FAN)))
        return found[::-1]

    def products(self, level: int, nodes: Entries, alive: np.ndarray) -> np.ndarray:
        """Inner products of document nodes with item nodes of a level; -1 where the pair is not alive."""
        starts, item_nodes, weights, n = self.levels[level]
        out = np.full((nodes.n, n), -1, dtype=np.int64)
        wanted = alive.any(1)
        used = alive.any(0)
        mine = wanted[nodes.rows]
        rows, columns, values = nodes.rows[mine], nodes.columns[mine], nodes.values[mine]
        order = np.argsort(rows, kind="stable")
        rows, columns, values = rows[order], columns[order], values[order]
        counts = starts[columns + 1] - starts[columns]
        total = np.cumsum(counts)
        # whole nodes at a time, so many that what is held stays bounded
        which = np.flatnonzero(wanted)
        ends = np.concatenate([[0], total])[np.searchsorted(rows, which, side="right")]
        a = 0
        while a < len(which):
            base = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, base + max(EXPANDED, 1), side="right")))
            b = min(b, a + max(1, EXPANDED // n))
            lo, hi = np.searchsorted(rows, which[a]), np.searchsorted(rows, which[b - 1], side="right")
            c = counts[lo:hi]
            at = np.arange(c.sum()) + np.repeat(starts[columns[lo:hi]] - (np.cumsum(c) - c), c)
            node, product = item_nodes[at], weights[at] * np.repeat(values[lo:hi], c)
            keep = used[node]
            key = (np.repeat(np.searchsorted(which[a:b], rows[lo:hi]), c) * n + node)[keep]
            if self.exact_in_floats:
                sums = np.bincount(key, weights=product[keep], minlength=(b - a) * n).astype(np.int64)
            else:
                sums = np.zeros((b - a) * n, dtype=np.int64)
                np.add.at(sums, key, product[keep])
            out[which[a:b]] = sums.reshape(b - a, n)
            a = b
        out[~alive] = -1
        return out


class Best:
    """The best documents of each item so far: highest score, then smallest doc_id, a null one last."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor, k
        self.item = self.score = self.doc = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)

    def kth(self) -> np.ndarray:
        """A score below which nothing is wanted any more, by item."""
        counts = np.bincount(self.item, minlength=len(self.floor))
        last = np.cumsum(counts) - 1
        full = counts == self.k
        found = self.floor.copy()
        found[full] = np.maximum(found[full], self.score[last[full]])
        return found

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, null = np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, dtype=np.int64)
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
        kept = order[rank < self.k]
        self.item, self.score, self.doc, self.null = item[rank < self.k], score[kept], doc[kept], null[kept]


def search_tree(tree: ItemTree, documents: Entries, weakest: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(document, item, score) of all pairs whose bounds reach the kth scores, and how many pairs got that far."""
    order = bisected(documents, GROUP)
    nodes = levels(documents, order)
    steps = max(len(nodes), len(tree.levels))
    d = i = 0
    alive = np.ones((nodes[0].n, tree.levels[0][3]), dtype=bool)
    for step in range(steps):
        # the deeper tree is descended first, so that both end together
        next_d, next_i = max(0, step - steps + len(nodes)), max(0, step - steps + len(tree.levels))
        if next_d > d:
            alive = np.repeat(alive, FAN, axis=0)[: nodes[next_d].n]
        if next_i > i:
            alive = np.repeat(alive, FAN, axis=1)[:, : tree.levels[next_i][3]]
        d, i = next_d, next_i
        if not alive.any():
            break
        bounds = tree.products(i, nodes[d], alive)
        alive = alive & (bounds >= np.maximum(weakest[i], 1))
    else:
        row, item = np.nonzero(alive)
        return order[row], item, bounds[row, item], int((bounds >= 0).sum())
    return (np.zeros(0, dtype=np.int64),) * 3 + (0,)


def _searched(batches: Iterator[pa.RecordBatch], tree, floor, k: int, n_docs: int, n_terms: int, tree_docs: int) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each item."""
    tree, best = tree.value, Best(floor.value, k)
    for batch in batches:
        for a in range(0, batch.num_rows, tree_docs):
            part = batch.slice(a, tree_docs)
            doc, null = pc.fill_null(part.column(0), 0).to_numpy(), pc.is_null(part.column(0)).to_numpy(zero_copy_only=False)
            counts = pc.list_value_length(part.column(2)).to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(part.num_rows), counts)
            codes, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            m = np.array([25 + 75 * n * n_docs // n_terms for n in part.column(1).to_pylist()], dtype=np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[rows])
            row, item, score, _ = search_tree(tree, Entries(rows, codes, impact, part.num_rows), tree.weakest(best.kth()))
            best.add(item, score, doc[row], null[row])
    names = ["item", "doc_id", "score"]
    yield pa.RecordBatch.from_arrays([pa.array(tree.items[best.item]), pa.array(best.doc, mask=best.null), pa.array(best.score)], names=names)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _pass(docs: DataFrame, entries: DataFrame, k: int, tree_docs: int) -> DataFrame | None:
    """The best documents of all tasks for the items of one pass."""
    context = docs.sparkSession.sparkContext
    own = entries.select("item", "term", "times").toPandas()  # about PASS_TERMS rows
    if own.empty:
        return None
    items, item = np.unique(own["item"].to_numpy(dtype=np.int64), return_inverse=True)
    code, terms = pd.factorize(own["term"])
    vectors = stored(docs.mapInArrow(partial(_vectors, terms=context.broadcast(terms.tolist())), "doc_id long, n long, codes array<int>, times array<int>"), "vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holders = np.zeros(len(terms), dtype=np.int64)
    for r in vectors.select(F.explode("codes").alias("code")).groupBy("code").count().toLocalIterator():
        holders[r[0]] = r[1]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holders.tolist()], dtype=np.int64)
    values = own["times"].to_numpy(dtype=np.int64) * weights[code]
    most = int(np.bincount(item, weights=values).max()) * 1_000_000  # an impact is below 1,000,000
    tree = context.broadcast(ItemTree(items, Entries(item, code, values, len(items)), len(terms), most))
    types = "item long, doc_id long, score long"

    def search(rows: DataFrame, floor: np.ndarray) -> DataFrame:
        work = partial(_searched, tree=tree, floor=context.broadcast(floor), k=k, n_docs=n_docs, n_terms=max(1, n_terms), tree_docs=tree_docs)
        return stored(rows.mapInArrow(work, types), "found")

    floor = np.zeros(len(items), dtype=np.int64)
    first = search(vectors.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE)) == 0), floor)
    place = {x: i for i, x in enumerate(tree.value.items.tolist())}
    for r in _ranked(first, k).filter(F.col("rank") == k).toLocalIterator():
        floor[place[r["item"]]] = r["score"]
    found = search(vectors, floor)
    discard(vectors, first)
    return found


def ranked(benchmark: DataFrame, docs: DataFrame, k: int = BEST, tree_docs: int = TREE_DOCS, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each row of ``benchmark``, all if fewer score above 0.

    Null and empty texts have no term: such items get no rows, such documents
    count nowhere. Repeated rows of either table are items and documents of
    their own. Equal scores are ranked by doc_id, a null one last; scores of very
    long items are summed in 64-bit integers. Very long texts are read whole, a
    text at a time. Without items or documents there are no rows. Only item_id,
    doc_id and the texts are read, other columns may have any name.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).withColumn("item", F.monotonically_increasing_id())
    items = stored(items, "items")
    entries = stored(items.select("item", "text").mapInArrow(_counted, "item long, term string, times long"), "terms")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n = entries.count()
    passes = -(-n // pass_terms)
    found = [_pass(rows, entries.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == i), k, tree_docs) for i in range(passes)]
    found = [f for f in found if f is not None]
    if not found:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    best = _ranked(reduce(DataFrame.union, found), k)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), terms AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term, docs
), wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""
