"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: full
sequences first, then the binary digits of what is left, largest first. Each
piece is a sequence of its own and sequences of one length form a bucket, so
nothing is padded and no sequence crosses documents. One pass over the texts,
no shuffle.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import per_process, sliced, table, text_or_empty

SEQUENCE = 2048
END_ID = 1
MOST_WORDS = 300_000  # remembered by a worker, about 60 MB
SLICE_BYTES = 4_000_000  # of text at a time
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
# ASCII marks that never begin a piece of their own after a letter, the apostrophe excepted.
TAIL_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
DELIMITER = "<|endoftext|>"
SPECIAL = "<|"  # how special tokens begin


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of white-space separated words, each distinct word encoded once while it is remembered.

    For tokenizers that drop white space, the ids of a text are those of its
    words in a row; marks that end a word after a letter are again a token group
    of their own, and ASCII letters may be lower-cased beforehand.
    """

    def __init__(self, path: str, per_call: int = 200, most_words: int = MOST_WORDS):
        # a task has one core; each thread of the tokenizer would keep memory of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.per_call = per_call
        self.most_words = most_words
        self.delimiter = self.tokenizer.token_to_id(DELIMITER)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int32)

    def _forget_rare(self) -> None:
        """Keep the words used most often, half of what may be remembered, and none that was used once."""
        names, ids, starts, counts, uses = list(self.place), self.ids, self.starts, self.counts, self.uses
        self._forget()
        kept = np.argsort(-uses, kind="stable")[: self.most_words // 2]
        kept = np.sort(kept[uses[kept] > 1])
        self._remember([names[i] for i in kept.tolist()], _gathered(ids, starts, counts, kept), counts[kept])
        self.uses = uses[kept] // 2

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the number of ids of each word."""
        plain = [w if DELIMITER not in w else "" for w in words]
        joined = [DELIMITER.join(plain[i : i + self.per_call]) for i in range(0, len(plain), self.per_call)]
        found = []
        for encoding in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            found += [np.asarray(encoding.ids, dtype=np.uint32), np.array([self.delimiter], dtype=np.uint32)]
        flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
        ends = np.flatnonzero(flat == self.delimiter)
        counts = np.diff(np.concatenate([[-1], ends])) - 1
        flat = flat[flat != self.delimiter]
        odd = [i for i, w in enumerate(words) if DELIMITER in w]
        if odd:
            parts = np.split(flat, np.cumsum(counts)[:-1])
            for i in odd:
                parts[i] = np.asarray(self.tokenizer.encode(words[i], add_special_tokens=False).ids, dtype=np.uint32)
                counts[i] = len(parts[i])
            flat = np.concatenate(parts)
        return flat, counts

    def _remember(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int32)])

    def _learn(self, words: pa.Array) -> None:
        """Remember the ids of new words: those of a core and of the marks that end it, each encoded once."""
        core = pc.utf8_rtrim(words, characters=TAIL_MARKS)
        after_letter = pc.utf8_is_alpha(pc.utf8_slice_codeunits(core, -1))
        core = pc.if_else(pc.and_not(after_letter, pc.match_substring(words, SPECIAL)), core, words)
        trimmed = pc.not_equal(pc.binary_length(core), pc.binary_length(words))
        names, cores = words.filter(trimmed).to_pylist(), core.filter(trimmed).to_pylist()
        tails = [w[len(c) :] for w, c in zip(names, cores)]
        place = self.place
        new = [w for w in dict.fromkeys([*words.filter(pc.invert(trimmed)).to_pylist(), *cores, *tails]) if w not in place]
        self._remember(new, *self._encoded(new))
        both = np.empty((len(names), 2), dtype=np.int64)
        both[:, 0] = np.fromiter(map(place.__getitem__, cores), dtype=np.int64, count=len(names))
        both[:, 1] = np.fromiter(map(place.__getitem__, tails), dtype=np.int64, count=len(names))
        self._remember(names, _gathered(self.ids, self.starts, self.counts, both.ravel()), self.counts[both].sum(1))

    def documents(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end_id`` after each, and where each text begins, with the end last."""
        texts = texts.cast(pa.large_string())
        # special tokens are matched before letters are lower-cased, so texts that may hold one stay as they are
        special = pc.any(pc.match_substring(texts, SPECIAL)).as_py()
        split = pc.ascii_split_whitespace(texts if special else pc.ascii_lower(texts))
        word_bounds = split.offsets.to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if len(self.place) > self.most_words:
            self._forget_rare()
        distinct = coded.dictionary.to_pylist()
        unknown = [i for i, w in enumerate(distinct) if w not in self.place]
        if unknown:
            self._learn(coded.dictionary.take(pa.array(unknown)))
        places = np.fromiter(map(self.place.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        self.uses[places] += 1
        # the end of a text is one more word, after the last one
        starts, counts = np.append(self.starts[places], len(self.ids)), np.append(self.counts[places], 1)
        words = np.insert(codes.astype(np.int64), word_bounds[1:], len(distinct))
        ends = np.cumsum(counts[words])
        last = word_bounds[1:] + np.arange(len(texts))
        return _gathered(np.append(self.ids, np.uint32(end_id)), starts, counts, words), np.concatenate([[0], ends[last]]).astype(np.int64)


def _gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of each entry of ``which`` in a row."""
    n = counts[which]
    ends = np.cumsum(n)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[which] - (ends - n), n)]


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full ones, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _pieces(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The document and the length of each piece of documents of so many ids."""
    digits = 1 << np.arange(longest.bit_length() - 2, -1, -1, dtype=np.int64)  # below a full piece, largest first
    times = np.column_stack([tokens // longest, (tokens[:, None] & digits) > 0]).astype(np.int64)
    lengths = np.repeat(np.tile(np.append(longest, digits), len(tokens)), times.ravel())
    return np.repeat(np.arange(len(tokens)), times.sum(1)), lengths


def _pack(batches: Iterator[pa.RecordBatch], path: str, longest: int, end_id: int, most_words: int, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    encoder = per_process(("WordEncoder", path, most_words), partial(WordEncoder, path, most_words=most_words))
    for batch in sliced(batches, 1, slice_bytes):
        ids, bounds = encoder.documents(batch.column(1), end_id)
        tokens = np.diff(bounds)
        document, lengths = _pieces(tokens, longest)
        ends = np.cumsum(lengths)  # the pieces follow each other as the documents do
        starts = ends - lengths
        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
        crcs = [zlib.crc32(raw[a:b]) for a, b in zip((4 * starts).tolist(), (4 * ends).tolist())]
        columns = [batch.column(0).take(pa.array(document)), pa.array(starts - bounds[document]), pa.array(lengths), pa.array(crcs, pa.int64()), pa.array(tokens[document])]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])


def packed(
    docs: DataFrame,
    tokenizer: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    most_words: int = MOST_WORDS,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per piece of each row of ``docs``, with its sequence.

    A null or empty text is the end id alone. ``sequence`` is a power of two;
    ``bucket`` is the length that the piece's sequence shares with all others of
    that bucket. A null doc_id stays null and repeated rows are packed each by
    itself; an empty table gives no rows. A very long text is encoded whole, a
    text at a time. Only doc_id and text are read.
    """
    if sequence & (sequence - 1):
        raise ValueError("sequence length must be a power of two")
    work = partial(_pack, path=tokenizer or default_tokenizer(), longest=sequence, end_id=end_id, most_words=most_words, slice_bytes=slice_bytes)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(work, PIECES)
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.col("length").cast("int")}
    )


def op8_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
