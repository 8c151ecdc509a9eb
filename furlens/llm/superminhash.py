"""Near duplicates by SuperMinHash signatures, banding, exact verification and union of links.

A SuperMinHash signature (Ertl 2017) lets every element of a set visit the
slots in an order of its own, a random permutation, with rank + uniform as its
value; a slot keeps the smallest value. Values of one element are correlated,
each slot is met once, so estimates vary less than those of independent hashes.
An element stops as soon as the next rank is above the largest kept value, which
for long texts is after the first rank.

Sets that agree on all slots of a band meet in a region. Regions are verified
on whole sets: their links connect exactly what J >= num / den connects in
them, however many members they have. Then links are united to components.
Equal sets are one set from the start.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import table
from furlens.llm.jaccard_join import Bounds, grouped, mixed

BANDS = 32
BAND_ROWS = 5
CHUNK = 1 << 17  # elements that hold a permutation at a time


def miss_probability(similarity: float, bands: int = BANDS, rows: int = BAND_ROWS) -> float:
    """Of two sets of this similarity sharing no band, had slots been independent."""
    return (1 - similarity**rows) ** bands


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values per set, none of them empty; a value is (rank << 32) + 32 random bits."""
    kept = np.full((len(sets), slots), np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    for a in range(0, len(elements), CHUNK):
        _update(kept, owner[a : a + CHUNK], elements[a : a + CHUNK])
    return kept


def _update(kept: np.ndarray, owner: np.ndarray, elements: np.ndarray) -> None:
    """Lower the values kept for ``owner`` by those of its ``elements``, rank by rank."""
    slots = kept.shape[1]
    flat = kept.reshape(-1)
    order = None  # the slots of each element in its own order, made when a second rank is needed
    for rank in range(slots):
        # what this rank can still lower: sets with a larger value, or with an empty slot
        open_sets = np.zeros(len(kept), dtype=bool)
        present = np.unique(owner)
        open_sets[present] = kept[present].max(axis=1) >= np.uint64(rank << 32)
        going = open_sets[owner]
        if not going.any():
            return
        if not going.all():
            owner, elements = owner[going], elements[going]
            order = order[going] if order is not None else None
        random = mixed(elements, 100 + rank)
        place = rank + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            slot = place
        else:
            row = np.arange(len(elements))
            slot = order[row, place].astype(np.int64)
            order[row, place] = order[:, rank]
        np.minimum.at(flat, owner * slots + slot, (random >> np.uint64(32)) + np.uint64(rank << 32))
        if rank == 0:
            going = np.zeros(len(kept), dtype=bool)
            going[present] = kept[present].max(axis=1) >= np.uint64(1 << 32)
            going = going[owner]
            owner, elements, place = owner[going], elements[going], place[going]
            # after the first swap only the place taken holds another slot, the first one
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int64), (len(elements), 1))
            order[np.arange(len(elements)), place] = 0


def band_keys(kept: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per set and band."""
    keys = np.empty((len(kept), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(len(kept), band, dtype=np.uint64)
            for slot in range(band * rows, (band + 1) * rows):
                key = mixed(key + kept[:, slot], slot)
            keys[:, band] = key
    return keys


def _band_keys(sets: list[np.ndarray], bands: int, rows: int) -> list[np.ndarray]:
    return list(band_keys(signatures(sets, bands * rows), bands, rows))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 85, den: int = 100, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """Row keys, doc_id, n_shingles, component_id and class_id (a hash) of each row of ``docs``.

    Two rows link when J >= num / den of their shingle sets and they share a
    band; at 0.85 the defaults miss a link with a probability of 1e-8, and only
    a pair without another way to its component would show it. Links that are
    returned are exact up to 64-bit hashes of shingles: two different shingles
    of one region share a hash with a probability of about 3e-8 per 1e6 of them.

    A null or empty text has no shingle and no link: its component is its own
    doc_id. A null doc_id links like any other but names a component only if
    there is no other id (then it is null). Repeated rows are linked as equal
    texts, whichever doc_id they have. Very long texts are read whole, a text a
    time. An empty table gives no rows. Only doc_id and text are read, other
    columns may have any name.
    """
    return grouped(docs, words, Bounds(num, den), partial(_band_keys, bands=bands, rows=rows))


def op11_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents")).drop("row_file", "row_index", "class_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
  WHERE 100 * least(na.n, nb.n) >= 85 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""
