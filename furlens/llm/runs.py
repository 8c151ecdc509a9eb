"""Runs of allowed characters in whole texts, split without a pattern engine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20
LATIN_LEAD = 0xC3  # first byte in UTF-8 of the code points U+00C0 to U+00FF, and of no others


def byte_table(allowed: bytes) -> np.ndarray:
    """What each byte of a text becomes: itself, A-Z in lower case, or a space if it is not allowed."""
    out = np.full(256, SPACE, dtype=np.uint8)
    kept = np.frombuffer(allowed, dtype=np.uint8)
    out[kept] = kept
    upper = np.arange(ord("A"), ord("Z") + 1)
    out[upper] = out[upper + 32]
    return out


ASCII_LETTERS = bytes(range(ord("a"), ord("z") + 1))
LATIN = byte_table(ASCII_LETTERS + bytes([LATIN_LEAD]) + bytes(range(0x80, 0xC0)))
WORDS = byte_table(ASCII_LETTERS + b"0123456789" + bytes(range(0x80, 0x100)))


def runs(texts: pa.Array, table: np.ndarray, latin: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct runs, the code of each run of all texts in a row, and where each text begins in them, with the end last.

    Null texts have no run. With ``latin`` code points above ASCII other than
    U+00C0 to U+00FF are separators.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, dtype=np.uint8)
    mapped = table[raw]
    if latin and len(raw):
        follows = np.concatenate([[False], raw[:-1] == LATIN_LEAD])
        mapped[((raw & 0xC0) == 0x80) & ~follows] = SPACE
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(offsets - (offsets[0] if len(offsets) else 0)), pa.py_buffer(mapped)])
    split = pc.ascii_split_whitespace(plain)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    keep = filled[codes] if len(codes) else np.zeros(0, dtype=bool)
    bounds = np.concatenate([[0], np.cumsum(keep)])[split.offsets.to_numpy(zero_copy_only=False)]
    # an empty run at the edge of a text is no run; codes stay below the number of distinct ones
    place = np.cumsum(filled) - 1
    return coded.dictionary.filter(pa.array(filled)), place[codes[keep]] if len(codes) else codes, bounds
