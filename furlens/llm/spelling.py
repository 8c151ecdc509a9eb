"""Spelling variants by neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one inserted,
deleted or replaced letter have reduced words that are equal or differ by one
symbol, so a word's partners are among the words whose reduced form lies in the
full one-edit neighbourhood of its own; with few symbols that neighbourhood is
small whatever the alphabet. Many words share a reduced form, therefore a join
key also holds the half of the word that the edit leaves alone: the first half
for edits behind it, else the last. Candidates are verified on the words.

Only distinct words are joined; their counts are gathered before. A reduced
neighbour travels as a 64-bit polynomial hash, which can only add candidates.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import discard, free_shuffles, sliced, stored, table, text_or_empty
from furlens.llm.jaccard_join import mixed
from furlens.llm.runs import LATIN, runs

LEAST_LENGTH = 5
LEAST_COUNT = 3
NOISE = 97  # one in so many runs of a document loses a letter
SYMBOLS = 4
PASSES = 2  # over the words whose neighbourhoods are generated; all are looked up in each
VARIANTS_PER_BATCH = 400_000
PLAIN_BYTES = 64  # longer words are hashed one by one

POLYNOMIAL = 0xEDB88320  # of the CRC-32 checksum


def _crc_steps() -> np.ndarray:
    """What a zero byte makes of each lowest byte of a checksum."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


STEPS = _crc_steps()


def checksums(prefixes: list[bytes], words: list[bytes], prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """CRC-32 of ``prefixes[prefix[i]] + words[word[i]]`` for every i.

    A checksum is linear: that of a text followed by a word is the text's,
    moved on by the word's length in zero bytes, XOR the word's own.
    """
    own = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    moved = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)
    out = own[word]
    order = np.argsort(sizes[word], kind="stable")
    ends = np.searchsorted(sizes[word][order], np.arange(PLAIN_BYTES + 1), side="right")
    for size in range(1, PLAIN_BYTES + 1):
        moved = (moved >> np.uint32(8)) ^ STEPS[moved & np.uint32(255)]
        at = order[ends[size - 1] : ends[size]]
        out[at] ^= moved[prefix[at]]
    for i in order[ends[PLAIN_BYTES] :].tolist():
        out[i] = zlib.crc32(prefixes[prefix[i]] + words[word[i]])
    return out


def _counted(batches: Iterator[pa.RecordBatch], least_length: int, noise: int) -> Iterator[pa.RecordBatch]:
    """The words of each slice of texts with their counts there."""
    for batch in sliced(batches, 1):
        distinct, codes, bounds = runs(batch.column(1), LATIN, latin=True)
        names = distinct.to_pylist()
        documents = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        pairs, times = np.unique(documents * max(1, len(names)) + codes, return_counts=True)
        document, word = np.divmod(pairs, max(1, len(names)))
        h = checksums([f"{i}:".encode() for i in batch.column(0).to_pylist()], [w.encode() for w in names], document, word)
        changed = h % noise == 0
        counts = np.bincount(word[~changed], weights=times[~changed], minlength=len(names)).astype(np.int64)
        found, numbers = [], []
        for w, at, n in zip(word[changed].tolist(), h[changed].tolist(), times[changed].tolist()):
            name = names[w]
            at %= len(name)
            if len(name) > least_length:
                found.append(name[:at] + name[at + 1 :])
                numbers.append(n)
        kept = (counts > 0) & (pc.utf8_length(distinct).to_numpy(zero_copy_only=False) >= least_length)
        words = pa.concat_arrays([distinct.filter(pa.array(kept)).cast(pa.string()), pa.array(found, pa.string())])
        yield pa.RecordBatch.from_arrays([words, pa.array(np.concatenate([counts[kept], np.array(numbers, dtype=np.int64)]))], names=["word", "n"])


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of all texts of ``docs``, from ``least_length`` code points and ``least_count`` occurrences on."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"), text_or_empty().alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, least_length, noise)

    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class Hashes:
    """Polynomial hashes modulo 2 ** 64 of all words of one length, of their reduced words and of their halves."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, points: np.ndarray, symbols: int):
        self.m, self.length = points.shape
        self.powers = self._powers(self.BASE, self.length + 2)
        self.backward = self._powers(self.INVERSE, self.length + 2)
        self.values = mixed(np.arange(symbols, dtype=np.uint64), 11)
        self.reduced = (mixed(points, 12) >> np.uint64(33)) % np.uint64(symbols)
        self.reduced_sums = self._sums(self.values[self.reduced.astype(np.int64)])
        self.point_sums = self._sums(mixed(points, 13))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        return np.cumprod(np.array([1] + [base] * (n - 1), dtype=np.uint64), dtype=np.uint64)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Hash of each beginning, from none to all."""
        out = np.zeros((self.m, self.length + 1), dtype=np.uint64)
        np.cumsum(values * self.powers[: self.length], axis=1, dtype=np.uint64, out=out[:, 1:])
        return out

    def half(self, side: int, shorter: int) -> np.ndarray:
        """Hash of the first half, or of the rest, of a word whose pair's shorter word has so many letters."""
        cut = shorter // 2
        if side == 0:
            part = self.point_sums[:, cut]
        else:
            start = self.length - (shorter - cut)
            part = (self.point_sums[:, -1] - self.point_sums[:, start]) * self.backward[start]
        return mixed(part, 20 + 2 * shorter + side)

    def key(self, reduced: np.ndarray, side: int, shorter: int) -> np.ndarray:
        return mixed(reduced + self.half(side, shorter).reshape(-1, *[1] * (reduced.ndim - 1)), 14)

    def own(self) -> np.ndarray:
        """The keys under which a word is found: as the shorter or as long, and as the longer one, by either half."""
        whole, n = self.reduced_sums[:, -1], self.length
        return np.column_stack([self.key(whole, side, shorter) for shorter in (n, n - 1) for side in (0, 1)])

    def neighbourhood(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and key of each string within one edit of a reduced word, equal ones on one side of the middle once."""
        rows, keys, sums, n = [], [], self.reduced_sums, self.length
        whole = sums[:, -1:]

        def add(variants: np.ndarray, present: np.ndarray, side: int, shorter: int) -> None:
            row = np.broadcast_to(np.arange(self.m).reshape(-1, *[1] * (variants.ndim - 1)), variants.shape)
            rows.append(row[present])
            keys.append(self.key(variants, side, shorter)[present])

        for side in (0, 1):
            add(whole, np.ones(whole.shape, dtype=bool), side, n)
            # a symbol is deleted; of a row of equal ones the last on this side stands for all
            at = self._positions(side, n - 1, n)
            alike = np.zeros((self.m, len(at)), dtype=bool)
            alike[:, :-1] = self.reduced[:, at[:-1]] == self.reduced[:, at[1:]]
            add(sums[:, at] + (whole - sums[:, at + 1]) * np.uint64(self.INVERSE), ~alike, side, n - 1)
            # a symbol is replaced by each other one
            at = self._positions(side, n, n)
            old = self.reduced[:, at].astype(np.int64)
            change = (self.values[None, None, :] - self.values[old][:, :, None]) * self.powers[at][None, :, None]
            add(whole[:, :, None] + change, old[:, :, None] != np.arange(len(self.values)), side, n)
            # each symbol is inserted, before an equal one only if that is the last place on this side
            at = self._positions(side, n, n + 1)
            moved = sums[:, at] + (whole - sums[:, at]) * np.uint64(self.BASE)
            alike = np.zeros((self.m, len(at), len(self.values)), dtype=bool)
            alike[:, :-1] = self.reduced[:, at[:-1]][:, :, None] == np.arange(len(self.values), dtype=np.uint64)
            add(moved[:, :, None] + self.values * self.powers[at][:, None], ~alike, side, n)
        return np.concatenate(rows), np.concatenate(keys)

    @staticmethod
    def _positions(side: int, shorter: int, places: int) -> np.ndarray:
        cut = shorter // 2
        return np.arange(cut, places) if side == 0 else np.arange(cut)


def _by_length(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Hashes]]:
    """Rows of a batch whose words have one length, few enough for a batch of neighbours, and their hashes."""
    for batch in batches:
        lengths = pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            step = max(1, VARIANTS_PER_BATCH // ((2 * symbols + 2) * length))
            for a in range(0, len(at), step):
                part = at[a : a + step]
                joined = "".join(batch.column(1).take(pa.array(part)).to_pylist())
                points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).reshape(len(part), length)
                yield batch, part, Hashes(points.astype(np.uint64), symbols)


def _neighbours(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    for batch, rows, hashes in _by_length(batches, symbols):
        of, keys = hashes.neighbourhood()
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(0).take(pa.array(rows[of]))], names=["key", "id"])


def _found_under(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    for batch, rows, hashes in _by_length(batches, symbols):
        keys = hashes.own()
        at = pa.array(np.repeat(rows, keys.shape[1]))
        columns = [pa.array(keys.ravel().view(np.int64)), batch.column(1).take(at), batch.column(2).take(at), pa.array(np.tile(np.array([0, 1, 0, 1], dtype=np.int8), len(rows)))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "near_word", "near_n", "side"])


def near_words(words: DataFrame, symbols: int = SYMBOLS, which: Column | None = None) -> DataFrame:
    """(id, word, n, near_word, near_n): all ordered pairs of distinct words of a stored (id, word, n) that differ by one edit.

    With ``which``, only pairs whose first word fulfils it.
    """

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _neighbours(batches, symbols)

    def found_under(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _found_under(batches, symbols)

    wanted = words if which is None else words.filter(which)
    reduced = words.select("id", "word", "n").mapInArrow(found_under, "key long, near_word string, near_n long, side byte")
    candidates = wanted.select("id", "word").mapInArrow(neighbours, "key long, id long").join(reduced.hint("shuffle_hash"), "key")
    pairs = candidates.drop("key").join(wanted, "id")
    # a pair with equal first halves is found by them already
    half = F.floor(F.least(F.char_length("word"), F.char_length("near_word")) / 2).cast("int")
    once = (F.col("side") == 0) | (F.substring(F.col("word"), F.lit(1), half) != F.substring(F.col("near_word"), F.lit(1), half))
    return pairs.filter(once & (F.levenshtein("word", "near_word", 1) == 1)).select("id", "word", "n", "near_word", "near_n")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``docs``.

    A form is the near word of largest n, the first in code-point order of
    several, if it occurs at least twice as often; roots follow forms to the
    last. Null and empty texts have no word; a null doc_id counts as empty text
    in the choice of noise. Repeated rows count each. Very long texts and words
    are read whole, a text at a time. An empty table gives no rows. Only doc_id
    and text are read, other columns may have any name.
    """
    spark = docs.sparkSession
    words = stored(vocabulary(docs, least_length, least_count, noise).withColumn("id", F.monotonically_increasing_id()), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near_word").alias("form")))
    near = []
    for i in range(PASSES):  # so that the shuffle files of one pass are gone before the next
        pairs = near_words(words, symbols, F.pmod(F.xxhash64("word"), F.lit(PASSES)) == i)
        near.append(stored(pairs.groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best")), "near"))
        del pairs
        free_shuffles(spark)
    often = -F.col("best.order") >= 2 * F.col("n")
    rows = words.join(reduce(DataFrame.union, near), "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.order")).alias("form_n")
    )
    rows = stored(rows, "forms")
    discard(words, *near)
    # each round doubles the steps; a form occurs twice as often as its word, so there are few
    steps = stored(rows.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        following = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = stored(longer, "roots")
        discard(steps)
        steps = longer.select("word", "root")
        steps.stored_path = longer.stored_path
        if longer.filter("moved").isEmpty():
            break
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(0, 256) r(i)
  )
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda i: 16 * (strpos('0123456789ABCDEF', bytes[i]) - 1) + strpos('0123456789ABCDEF', bytes[i + 1]) - 1)),
      lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS h
  FROM counted, steps
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), shorter AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n FROM near GROUP BY word, n
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain(word, last) AS (
  SELECT word, word FROM forms
  UNION
  SELECT c.word, f.form FROM chain c JOIN forms f ON c.last = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms g ON g.word = c.last AND g.form IS NULL
"""
