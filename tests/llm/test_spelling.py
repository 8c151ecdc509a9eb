"""Spelling variants against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from furlens.llm import spelling
from furlens.llm.runs import LATIN, WORDS, runs
from tests.llm.test_llm_operators import ODD, docs_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(rows, noise=97):
    counts = Counter()
    for i, text, _ in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        near = [(-m, v) for v, m in words.items() if one_edit(w, v)]
        m, form = min(near, default=(0, None))
        out[w] = (form, -m) if form is not None and -m >= 2 * n else (None, None)
        out[w] = (*out[w], len(near))
    found = set()
    for w, n in words.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        found.add((w, out[w][0], root, n, out[w][2], out[w][1]))
    return found


def found(docs, **settings):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, **settings).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def typing_errors(rng, word):
    at = rng.randrange(len(word) + 1)
    return rng.choice([word[:at] + rng.choice("abé") + word[at:], word[: at - 1] + word[at:], word[:at] + rng.choice("abñ") + word[at + 1 :]])


@pytest.mark.parametrize("seed, noise", [(1, 97), (2, 3)])
def test_variants_against_plain_version(spark, seed, noise):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabcñé") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) if rng.random() < 0.6 else typing_errors(rng, rng.choice(words)) for _ in range(60)]
        rows.append((i, " ".join(w.upper() if rng.random() < 0.2 else w for w in text), "s"))
    assert found(docs_of(spark, rows), noise=noise) == plain(rows, noise)


def test_repeated_letters_and_equal_halves(spark):
    words = ["aaaaa", "aaaaaa", "aaaaaaa", "abaaba", "abaabab", "babaaba", "abcabc", "abcabcc", "abbcabc", "ababab", "bababa"]
    rows = [(i, " ".join(words), "s") for i in range(5)]
    assert found(docs_of(spark, rows)) == plain(rows)


def test_odd_rows_ties_and_long_words(spark):
    long = "x" * 3000
    rows = ODD * 3 + [(20, f"{long} {long} {long} {long}y {long}y {long}y " + "alpha " * 8 + "alphb " * 3 + "alphc " * 8 + "alphd " * 3, "s")]
    assert found(docs_of(spark, rows)) == plain(rows)


def test_empty_table(spark):
    assert spelling.variants(docs_of(spark, [])).count() == 0


def test_checksums_of_joined_texts():
    rng = random.Random(4)
    prefixes = [f"{rng.randrange(10 ** rng.randint(1, 9))}:".encode() for _ in range(9)]
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 2, 7, 63, 64, 65, 300)]
    prefix, word = np.divmod(np.arange(63), 7)
    got = spelling.checksums(prefixes, words, prefix, word)
    assert got.tolist() == [zlib.crc32(prefixes[p] + words[w]) for p, w in zip(prefix, word)]


def test_runs_are_those_of_the_patterns():
    texts = ["", None, " a", "Äb×c÷ dĀeÿ", "A1-b2　é\x00z_", "ÃÀ\u0080x", "🙂a🙂", "end "]
    for table, latin, pattern in ((LATIN, True, RUN), (WORDS, False, re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))):
        distinct, codes, bounds = runs(pa.array(["skipped", *texts])[1:], table, latin)
        names = distinct.to_pylist()
        assert [[names[c] for c in codes[a:b]] for a, b in zip(bounds[:-1], bounds[1:])] == [[lower(r) for r in pattern.findall(t or "")] for t in texts]


def test_every_edit_meets_its_word():
    rng = random.Random(8)
    for _ in range(200):
        a = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9)))
        b = typing_errors(rng, a)
        if not one_edit(a, b) or not b:
            continue
        hashes = [spelling.Hashes(np.array([[ord(c) for c in w]], dtype=np.uint64), 3) for w in (a, b)]
        assert set(hashes[0].neighbourhood()[1].tolist()) & set(hashes[1].own().ravel().tolist())
        assert set(hashes[1].neighbourhood()[1].tolist()) & set(hashes[0].own().ravel().tolist())
