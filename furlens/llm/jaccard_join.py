"""Exact Jaccard join of word shingles by pivots, windows and recursion in a metric space.

Jaccard distance d = 1 - J is a metric. With pivots alone, texts that have
nothing in common are all at distance 1 from all pivots and from each other, so
every triangle-inequality window holds everything and the join becomes all
pairs. Two steps come first, both windows of the same kind and both exact:

1. Rings around the empty set. The symmetric difference of two linked sets is at
   most (a + b)(1 - t)/(1 + t), so sizes differ little: sets are dealt to size
   classes and replicated to every later class that a linked set can be in.
2. Projections. The hash range is cut into more parts than linked sets of the
   class can have differing elements, so linked sets agree on a whole part
   (distance 0 in that projection). A region is one content of one part.

In each region the smallest set is the pivot and all other members are compared
with it. Sets within the threshold are in the pivot's ball, one component, and
need no further comparison among themselves. A pair with a member outside the
ball can only be linked if both differ from the pivot in a common element
(otherwise J(x, y) <= min(J(x, p), J(y, p)), which is below the threshold), and
if their distances to the pivot differ by at most 1 - t. A region of bounded
size is then joined in one task through an index of the differences, one of a
few times that size by pairs of its blocks. The members of a larger one are dealt again, by their rarest differences and by rings around
the pivot with replication to the next ring, to smaller regions, which are
joined the same way until none is left. A region never holds its parent's pivot,
so it ends.

Equal sets are one set from the start. All loops run in Spark; what reaches the
driver are counts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from furlens.llm.common import by_place, discard, free_shuffles, give_back, sliced, small, stored, table, text_or_empty, with_row_keys, without_rows
from furlens.llm.components import components

CLASS_RATIO = 1.5
REGION_ROWS = 4096  # a region up to this size, and up to so many differences, is joined in one task
REGION_ELEMENTS = 1_000_000
KEY_PASSES = 4  # a set has a key for about every second shingle at 4/5
PASS_BYTES = 256_000_000  # sets go to their regions in passes of this size, or of half of all sets if that is more
MOST_BLOCKS = 32  # a region of up to so many blocks, of which two fit into one task, is joined by pairs of blocks
ELEMENT_BYTES = 100  # about what is shuffled for an element of a set in a crowded region


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A finaliser that spreads 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int, seed: int = 0) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    A-Z count as lower case, words are separated by ASCII white space, and a
    text of fewer words is one shingle. A text without words has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    flat = split.flatten().dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    values = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in distinct), dtype=np.uint64, count=len(distinct))
    filled = np.fromiter((w != "" for w in distinct), dtype=bool, count=len(distinct))
    codes = flat.indices.to_numpy(zero_copy_only=False)
    keep = filled[codes] if len(codes) else np.zeros(0, dtype=bool)
    bounds = np.concatenate([[0], np.cumsum(keep)])[split.offsets.to_numpy(zero_copy_only=False)]
    flat = values[codes[keep]] if len(codes) else np.zeros(0, dtype=np.uint64)
    rolled = np.zeros(max(0, len(flat) - words + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(words):
            rolled = mixed(rolled + flat[j : j + len(rolled)], j)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(flat[a:b].tobytes(), seed + b - a)], dtype=np.uint64) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def set_id(shingles: np.ndarray, seed: int) -> tuple[int, int]:
    """128 bits of the set's content as two signed integers; the first names the set."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes(), seed), dtype=np.int64).tolist()
    return a, b


class Bounds:
    """Sizes and parts for sets linked at J >= num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.sizes: list[tuple[int, int, int, int]] = []

    def differences(self, a: int, b: int) -> int:
        """Most elements in which linked sets of these sizes can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def size_class(self, c: int) -> tuple[int, int, int, int]:
        """First size, first size beyond, number of parts and empty parts allowed of class ``c``."""
        while len(self.sizes) <= c:
            low = self.sizes[-1][1] if self.sizes else 1
            high = max(low + 1, math.ceil(low * CLASS_RATIO))
            most = self.differences(high - 1, high - 1)
            empty = 0
            for _ in range(8):  # enough parts that agreeing parts cannot all be empty
                parts = most + 1 + empty
                expected = parts * math.exp(-low * self.num / self.den / parts)
                empty = math.ceil(expected + 2 * math.sqrt(expected)) if most else 0
            self.sizes.append((low, high, most + 1 + empty, empty))
        return self.sizes[c]

    def classes(self, n: int) -> list[int]:
        """The class of size ``n``, and every later one where a partner may be."""
        c = 0
        while self.size_class(c)[1] <= n:
            c += 1
        found = [c]
        while n * self.den >= self.num * self.size_class(found[-1])[1]:
            found.append(found[-1] + 1)
        return found

    def part_keys(self, shingles: np.ndarray) -> np.ndarray:
        """Region keys of a set: one per filled part; empty parts too if there are unusually many."""
        out = []
        totals = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles, 7), dtype=np.uint64)])
        for c in self.classes(len(shingles)):
            _, _, parts, empty = self.size_class(c)
            if parts == 1:
                continue  # only equal sets are linked, and those are one set
            place = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            ends = np.searchsorted(place, np.arange(parts, dtype=np.uint64), side="right")
            starts = np.concatenate([[0], ends[:-1]])
            filled = ends > starts
            if parts - filled.sum() > empty:
                filled[:] = True
            i = np.flatnonzero(filled)
            with np.errstate(over="ignore"):
                out.append(mixed(totals[ends[i]] - totals[starts[i]] + mixed(i.astype(np.uint64), c)))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


SOURCE = "row_file long, row_index long, doc_id long, n_shingles long, sid long, check long"


def _identified(batches: Iterator[pa.RecordBatch], words: int, seed: int, keys_of: Callable, passes: int) -> Iterator[pa.RecordBatch]:
    """The name of each row's set, and where it comes first in a slice its region keys, dealt to columns by their range."""
    for batch in sliced(batches, 0):
        sets = shingle_sets(batch.column(0), words, seed)
        ids = [set_id(s, seed) if len(s) else (None, None) for s in sets]
        first = list({sid: i for i, (sid, _) in reversed(list(enumerate(ids))) if sid is not None}.values())
        keys = keys_of([sets[i] for i in first])
        owner = np.repeat(np.array(first, dtype=np.int64), [len(k) for k in keys])
        flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        part = (flat >> np.uint64(32)) * np.uint64(passes) >> np.uint64(32)
        arrays = [*batch.columns[1:], pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in ids], pa.int64()), pa.array([b for _, b in ids], pa.int64())]
        for i in range(passes):
            mine = part == i
            order = np.argsort(owner[mine], kind="stable")
            counts = np.bincount(owner[mine], minlength=len(sets))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[mine][order].view(np.int64))))
        yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SOURCE.split(", ")] + [f"keys{i}" for i in range(passes)])


def _fetched(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 0):
        sets = shingle_sets(batch.column(0), words, seed)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column(1), lists], names=["sid", "shingles"])


def _dealt(batches: Iterator[pa.RecordBatch], words: int, seed: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Each set once for each of its regions, in batches of about ``most`` bytes or one row."""
    for batch in sliced(batches, 0):
        sids = batch.column(1).to_numpy()
        for sid, cells, pivots, shingles in zip(sids, batch.column(2), batch.column(3), shingle_sets(batch.column(0), words, seed)):
            cells, pivots = cells.values.to_numpy(), pivots.values.to_numpy()
            rows = max(1, most // max(1, shingles.nbytes))
            for a in range(0, len(cells), rows):
                n = len(cells[a : a + rows])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(shingles)), pa.array(np.tile(shingles, n).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(cells[a : a + rows]), pa.array(pivots[a : a + rows]), pa.array(np.full(n, sid)), lists], names=["cell", "p", "sid", "shingles"])


def _compared(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[pa.RecordBatch]:
    """Distance of each set to its pivot, as link flag and ring, and the elements in which they differ."""
    num, den = bounds.num, bounds.den
    for batch in batches:
        cell, p, sid, mine, other = batch.columns
        a, a0 = mine.flatten().to_numpy().view(np.uint64), mine.offsets.to_numpy() - mine.offsets[0].as_py()
        b, b0 = other.flatten().to_numpy().view(np.uint64), other.offsets.to_numpy() - other.offsets[0].as_py()
        sizes, linked, ring, parts = np.diff(a0), [], [], []
        for i in range(batch.num_rows):
            x, y = a[a0[i] : a0[i + 1]], b[b0[i] : b0[i + 1]]
            delta = np.setxor1d(x, y, assume_unique=True)
            union = (len(x) + len(y) + len(delta)) // 2
            linked.append(den * (union - len(delta)) >= num * union)
            ring.append(len(delta) * den // (union * (den - num)) if den > num else 0)
            parts.append(delta)
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in parts])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([cell, p, sid, pa.array(sizes, pa.int32()), pa.array(linked, pa.bool_()), pa.array(ring, pa.int32()), lists], names=COMPARED)


COMPARED = ["cell", "p", "sid", "size", "linked", "ring", "delta"]
COMPARED_TYPES = "cell long, p long, sid long, size int, linked boolean, ring int, delta array<long>"


def join_region(sids: np.ndarray, sizes: np.ndarray, linked: np.ndarray, delta: np.ndarray, offsets: np.ndarray, bounds: Bounds) -> list[tuple[int, int]]:
    """Links that connect what is connected in a region, given each set's differences from the pivot.

    Only pairs with a set outside the pivot's ball are looked at, and only those
    that share a difference; a set that is already connected is not linked twice.
    """
    num, den = bounds.num, bounds.den
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(sids)), n)
    _, code, times = np.unique(delta, return_inverse=True, return_counts=True)
    by_element = owner[np.argsort(code, kind="stable")]
    starts = np.cumsum(times) - times
    root = np.arange(len(sids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ball = np.flatnonzero(linked)
    if len(ball):
        root[ball] = ball[0]
    links = []
    for i in np.flatnonzero(~linked).tolist():
        own = code[offsets[i] : offsets[i + 1]]
        own = own[times[own] > 1]
        if not len(own):
            continue
        m = times[own]
        ends = np.cumsum(m)
        others = by_element[np.arange(ends[-1]) + np.repeat(starts[own] - (ends - m), m)]
        shared = np.bincount(others, minlength=len(sids))
        differing = n + n[i] - 2 * shared
        union = (sizes + sizes[i] + differing) // 2
        near = np.flatnonzero((shared > 0) & (den * (union - differing) >= num * union))
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(sids[i]), int(sids[j])))
    return links


def _region_links(sids: np.ndarray, pivots: np.ndarray, flat: np.ndarray, offsets: np.ndarray, bounds: Bounds) -> list[tuple[int, int]]:
    """All links needed in one region; any of its sets may be the pivot, the smallest id if it is there."""
    sets = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    at = int(np.argmax(sids == pivots))
    delta = [np.setxor1d(x, sets[at], assume_unique=True) for i, x in enumerate(sets) if i != at]
    others = np.delete(sids, at)
    sizes, n = np.delete(np.diff(offsets), at), np.array([len(d) for d in delta])
    union = (sizes + len(sets[at]) + n) // 2
    linked = bounds.den * (union - n) >= bounds.num * union
    links = [(int(x), int(sids[at])) for x in others[linked]]
    if len(others) > 1 and not linked.all():
        links += join_region(others, sizes, linked, np.concatenate(delta), np.concatenate([[0], np.cumsum(n)]), bounds)
    return links


def _links_within(rows: pa.RecordBatch, bounds: Bounds) -> pa.RecordBatch:
    """The links of whole regions, whose rows follow each other."""
    cell, p, sids = (rows.column(i).to_numpy() for i in range(3))
    offsets = rows.column(3).offsets.to_numpy()
    flat, offsets = rows.column(3).flatten().to_numpy().view(np.uint64), offsets - offsets[0]
    cuts = (np.flatnonzero(np.diff(cell)) + 1).tolist()
    links = []
    for a, b in zip([0, *cuts], [*cuts, len(cell)]):
        links += _region_links(sids[a:b], p[a:b], flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], bounds)
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])


def _joined(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[pa.RecordBatch]:
    """The links of each region; rows of a region follow each other. Only a batch's last region is copied and kept."""
    held: list[pa.RecordBatch] = []

    def kept() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        cell, start = batch.column(0).to_numpy(), 0
        if held:
            other = cell != held[0].column(0)[0].as_py()
            start = int(np.argmax(other)) if other.any() else batch.num_rows
            held.append(batch.slice(0, start))
            if start == batch.num_rows:
                continue
            yield _links_within(kept(), bounds)
        last = int(np.argmax(cell == cell[-1]))
        if last > start:
            yield _links_within(batch.slice(start, last - start), bounds)
        held = [batch.take(pa.array(np.arange(last, batch.num_rows)))]
        del batch
        give_back()
    if held:
        yield _links_within(kept(), bounds)


def _members(regions: DataFrame, first: bool) -> DataFrame:
    """(cell, p, sid): every set of a region with the region's smallest set, its pivot.

    Minima are combined before the shuffle, and the join back can split a
    crowded region. The first regions of one pivot become one.
    """
    pivots = regions.groupBy("key").agg(F.min("sid").alias("p"), F.max("sid").alias("last"), *([] if first else [F.bool_or("outside").alias("open")]))
    pivots = pivots.filter("p <> last" + ("" if first else " and open")).select("key", "p")
    members = regions.select("key", "sid").join(pivots, "key").filter("sid <> p")
    return members.select(F.col("p").alias("cell"), "p", "sid").distinct() if first else members.select(F.col("key").alias("cell"), "p", "sid")


def _with_partners(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Sets of bounded regions that have another one of a linkable size in their region.

    In the order of sizes it is enough to look at both neighbours.
    """
    by_size = Window.partitionBy("cell").orderBy("n_shingles", "sid")
    n, before, after = F.col("n_shingles"), F.lag("n_shingles").over(by_size), F.lead("n_shingles").over(by_size)
    rows = rows.withColumns({"below": before * bounds.den >= n * bounds.num, "above": n * bounds.den >= after * bounds.num})
    return rows.filter(F.coalesce("below", F.lit(False)) | F.coalesce("above", F.lit(False))).select("cell", "p", "sid")


def _block_pairs(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Members (cell, p, sid, n_shingles) of larger regions, dealt to a region for each pair of blocks they are in.

    Blocks follow each other in the order of sizes; two of them meet if sets of
    theirs can be linked. Any two linkable sets of a region meet once at least.
    """
    by_size = Window.partitionBy("cell").orderBy("n_shingles", "sid").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.greatest(2 * F.col("n_shingles") / REGION_ELEMENTS, F.lit(2 / REGION_ROWS))
    rows = stored(rows.withColumn("block", F.floor(F.coalesce(F.sum(weight).over(by_size), F.lit(0.0)))), "blocks")
    blocks = stored(rows.groupBy("cell", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")), "blocks")
    one, two = blocks.toDF("cell", "one", "low1", "high1"), blocks.toDF("cell", "two", "low2", "high2")
    pairs = one.join(two, "cell").filter((F.col("one") <= F.col("two")) & (F.col("high1") * bounds.den >= F.col("low2") * bounds.num))
    # a block meets itself beside another, and alone if it has no other
    among = Window.partitionBy("cell", "one")
    pairs = pairs.withColumn("n", F.count("*").over(among)).filter("one <> two or n = 1").withColumn("pair", F.xxhash64("cell", "one", "two"))
    ways = pairs.select("cell", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"), "pair")
    return rows.join(small(stored(ways, "ways")), ["cell", "block"]).select(F.col("pair").alias("cell"), "p", "sid", "n_shingles")


def _regions(crowded: DataFrame, bounds: Bounds) -> DataFrame:
    """The next regions: members of a crowded one that share a rare difference and a ring."""
    rows = crowded.withColumn("n_delta", F.size("delta"))
    # most differences between a set and any partner, so n_delta - reach elements at least are shared, and one in any case
    reach = F.floor((F.col("size") + F.floor(F.col("size") * bounds.den / bounds.num)) * (bounds.den - bounds.num) / (bounds.den + bounds.num))
    rows = rows.withColumn("prefix", F.col("n_delta") - F.greatest(F.lit(1), F.col("n_delta") - reach) + 1)
    elements = rows.select("cell", "sid", "linked", "ring", "n_delta", "prefix", F.explode("delta").alias("e"))
    shared = elements.groupBy("cell", "e").agg(F.count("*").alias("times")).filter("times > 1")
    found = elements.join(shared, ["cell", "e"])
    own = Window.partitionBy("cell", "sid")  # the differences of one set
    place = F.col("n_delta") - F.count("*").over(own) + F.row_number().over(own.orderBy("times", "e"))
    return (
        found.withColumn("place", place)
        .filter("place <= prefix")
        .select(F.explode(F.array("ring", F.col("ring") + 1)).alias("r"), "cell", "e", "sid", (~F.col("linked")).alias("outside"))
        .select(F.xxhash64("cell", "e", "r").alias("key"), "sid", "outside")
    )


def _part_keys(sets: list[np.ndarray], bounds: Bounds) -> list[np.ndarray]:
    return [bounds.part_keys(s) for s in sets]


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """Row keys, doc_id, n_shingles, component_id and class_id (a hash) of each row of ``docs``.

    Two rows link when J >= num / den (above 0) of their shingle sets. A null or
    empty text has no shingle and no link: its component is its own doc_id. A
    null doc_id links like any other but names a component only if there is no
    other id (then it is null). Repeated rows are linked as equal texts. Very
    long texts are read whole, a text at a time. An empty table gives no rows.
    Only doc_id and text are read.

    Shingles are compared by 64-bit hashes. That two different shingles share
    one, which could add a link, has a chance of n * n / 2**65 for the n distinct
    shingles of a region, 3e-8 for a million. Set names that clash are noticed
    and given anew.
    """
    bounds = Bounds(num, den)
    return grouped(docs, words, bounds, partial(_part_keys, bounds=bounds), KEY_PASSES)


def grouped(docs: DataFrame, words: int, bounds: Bounds, keys_of: Callable, passes: int = 1) -> DataFrame:
    """Components of sets that meet under a key of ``keys_of`` and whose Jaccard similarity is in ``bounds``.

    ``keys_of`` gives the region keys of each of a list of sets. Keys are kept
    in ``passes`` columns and shuffled one column after the other, so that the
    shuffle files of one pass are gone before the next.
    """
    keyed = with_row_keys(docs.select("doc_id", "text"))
    source = keyed.select(text_or_empty().alias("text"), "row_file", "row_index", F.col("doc_id").cast("long").alias("doc_id"))
    seed = 0
    while True:
        work = partial(_identified, words=words, seed=seed, keys_of=keys_of, passes=passes)
        wide = stored(source.mapInArrow(work, SOURCE + "".join(f", keys{i} array<long>" for i in range(passes))), "keys")
        clash = wide.groupBy("sid").agg(F.min("check").alias("a"), F.max("check").alias("b")).filter("a <> b")
        if clash.isEmpty():
            break
        discard(wide)
        seed += 1
    sets = stored(wide.select("row_file", "row_index", "doc_id", "n_shingles", "sid"), "sets")
    found = []
    for i in range(passes):
        found.append(stored(_members(wide.select("sid", F.explode(f"keys{i}").alias("key")), first=True), "members"))
        free_shuffles(docs.sparkSession)
    discard(wide)
    members = found[0]
    if passes > 1:
        members = stored(reduce(DataFrame.union, found).distinct(), "members")
        discard(*found)
    links = _verified_links(source, sets, members, words, seed, bounds)

    named = sets.withColumn("root", F.col("sid"))
    if links:
        roots = stored(components(reduce(DataFrame.union, links)), "roots")
        discard(*links)
        named = stored(sets.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node"), "named")
        discard(roots)
    # both sides of the last join are tables, so that a component of very many rows can be split
    ids = stored(named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), "ids")
    return named.join(ids, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.col("root").alias("class_id"), "row_file", "row_index"
    )


def _pass_of(cell: Column, passes: int) -> Column:
    """The pass that joins a region; all its sets go there in the same one."""
    return F.pmod(F.xxhash64(cell, F.lit("pass")), F.lit(passes))


def _in_pass(texts: DataFrame, number: int, passes: int) -> DataFrame:
    """``texts`` with those of their regions that are joined in a pass."""
    pairs = F.filter(F.arrays_zip("cells", "pivots"), lambda pair: _pass_of(pair["cells"], passes) == number)
    return texts.withColumn("pairs", pairs).filter(F.size("pairs") > 0).select("text", "sid", F.col("pairs.cells").alias("cells"), F.col("pairs.pivots").alias("pivots"))


def _verified_links(source: DataFrame, sets: DataFrame, members: DataFrame, words: int, seed: int, bounds: Bounds) -> list[DataFrame]:
    """Tables of links (a, b) that connect what is connected inside the regions of ``members`` (cell, p, sid)."""
    spark = source.sparkSession
    wanted = members.select("sid").union(members.select("p")).distinct()
    places = stored(sets.join(wanted, "sid").groupBy("sid", "n_shingles").agg(F.min(F.struct("row_file", "row_index")).alias("at")).select("sid", "n_shingles", "at.*"), "places")
    sizes = places.select("sid", "n_shingles")
    whole = 8 * (sets.agg(F.sum("n_shingles")).first()[0] or 0)

    def texts_of(rows: DataFrame, *columns: str) -> DataFrame:
        """Texts of the named sets; the rows are few and narrow, the texts are read in place if they can be."""
        return source.select("text", "row_file", "row_index").join(small(stored(rows, "rows")), ["row_file", "row_index"]).select("text", "sid", *columns)

    links: list[DataFrame] = []

    def passes_of(rows: DataFrame, element_bytes: int) -> int:
        """The more sets there are, the more regions a set has by chance: passes keep what is shuffled at a time in proportion to the sets."""
        shingles = rows.join(small(sizes), "sid").agg(F.sum("n_shingles")).first()[0] or 0
        return max(1, math.ceil(element_bytes * shingles / max(PASS_BYTES, whole / 2)))

    def join_bounded(held_rows: DataFrame, contents: DataFrame | None) -> None:
        """Regions of bounded size: each in one task."""
        passes = passes_of(held_rows, 8)
        if contents is None:  # a set's regions go to its text, so that sets are shuffled once, by region
            dealt = held_rows.groupBy("sid").agg(F.collect_list("cell").alias("cells"), F.collect_list("p").alias("pivots"))
            texts = texts_of(places.join(dealt, "sid"), "cells", "pivots")
            if passes > 1:
                texts = stored(texts, "texts")
                free_shuffles(spark)
        for i in range(passes):
            if contents is None:
                mine = _in_pass(texts, i, passes) if passes > 1 else texts
                held = mine.mapInArrow(partial(_dealt, words=words, seed=seed), "cell long, p long, sid long, shingles array<long>")
            else:
                mine = held_rows.filter(_pass_of(F.col("cell"), passes) == i)
                held = contents.join(small(mine), "sid").select("cell", "p", "sid", "shingles")
            joined = held.repartition("cell").sortWithinPartitions("cell", "sid").mapInArrow(partial(_joined, bounds=bounds), "a long, b long")
            links.append(stored(joined, "joined"))
            del mine, held, joined
            free_shuffles(spark)
        if contents is None and passes > 1:
            discard(texts)

    def next_members(crowded: DataFrame, contents: DataFrame) -> DataFrame:
        """Crowded regions: all members against the pivot, and what is left to smaller regions."""
        mine = contents.join(small(crowded), "sid")
        pivots = contents.join(small(crowded.select(F.col("p").alias("sid")).distinct()), "sid").select(F.col("sid").alias("p"), F.col("shingles").alias("pivot"))
        compared = mine.join(pivots, "p").select("cell", "p", "sid", "shingles", "pivot")
        compared = stored(compared.mapInArrow(partial(_compared, bounds=bounds), COMPARED_TYPES), "compared")
        links.append(stored(compared.filter("linked").select(F.col("sid").alias("a"), F.col("p").alias("b")), "compared"))
        regions = stored(_regions(compared, bounds), "regions")
        discard(compared)
        following = stored(_members(regions, first=False), "members")
        discard(regions)
        return following

    def join(members: DataFrame, contents: DataFrame | None = None) -> None:
        """All links inside the regions of ``members``; ``contents`` has their sets once they come from a crowded region.

        What comes from a part of the crowded regions is joined before the next part is looked at.
        """
        if members.isEmpty():
            discard(members)
            return
        all_rows = members.union(members.select("cell", "p", F.col("p").alias("sid")).distinct())
        sized = all_rows.join(small(sizes), "sid").groupBy("cell").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("elements"))
        bounded = (F.col("n") <= REGION_ROWS) & (F.col("elements") <= REGION_ELEMENTS)
        blocks = 2 * (F.col("elements") / REGION_ELEMENTS + F.col("n") / REGION_ROWS)
        cells = stored(sized.select("cell", F.when(bounded, 0).when(blocks <= MOST_BLOCKS, 1).otherwise(2).alias("size")), "cells")

        def of_size(rows: DataFrame, size: int) -> DataFrame:
            return rows.join(small(cells.filter(F.col("size") == size).select("cell")), "cell")

        held = of_size(all_rows, 0).join(small(sizes), "sid").select("cell", "p", "sid", "n_shingles")
        if not cells.filter("size = 1").isEmpty():
            held = held.union(_block_pairs(of_size(all_rows, 1).join(small(sizes), "sid").select("cell", "p", "sid", "n_shingles"), bounds))
        held_rows = stored(_with_partners(held, bounds), "held")
        crowded = stored(of_size(members, 2).select("cell", "p", "sid"), "crowded")
        join_bounded(held_rows, contents)
        discard(members, cells, held_rows)
        passes = 0 if crowded.isEmpty() else passes_of(crowded, ELEMENT_BYTES)
        for i in range(passes):
            part = stored(crowded.filter(_pass_of(F.col("cell"), passes) == i), "part")
            own = contents
            if own is None:  # later regions hold sets of the first crowded ones only
                wanted = part.select("sid").union(part.select("p")).distinct()
                own = stored(texts_of(places.join(wanted, "sid")).mapInArrow(partial(_fetched, words=words, seed=seed), "sid long, shingles array<long>"), "contents")
            following = next_members(part, own)
            discard(part)
            free_shuffles(spark)
            join(following, own)
            if contents is None:
                discard(own)
        discard(crowded)

    join(members)
    discard(places)
    return links


def one_per_group(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` with one row of each component: the longest in shingles, then the smallest doc_id, then the first row.

    All columns stay as they are, whatever their names. Rows without words stay.
    """
    keyed, texts = by_place(docs)
    found = stored(jaccard_components(texts, words, num, den), "classes")
    grouped_rows = found.filter("n_shingles > 0")
    order = F.struct((-F.col("n_shingles")).alias("size"), F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("row_file").alias("row_file"), F.col("row_index").alias("row_index"))
    kept = grouped_rows.groupBy("class_id").agg(F.min(order).alias("keep")).select(F.col("keep.row_file").alias("row_file"), F.col("keep.row_index").alias("row_index"))
    return without_rows(keyed, grouped_rows.join(kept, ["row_file", "row_index"], "left_anti"), docs.columns)


def op10_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("row_file", "row_index", "class_id")


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 10 * least(na.n, nb.n) >= 9 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""
