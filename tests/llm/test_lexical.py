"""Ranked lexical search against a plain version."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from furlens.llm import lexical
from tests.llm.test_llm_operators import ODD, docs_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id int, score string, item string, term int"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", "i", 2) for i, t in rows], ITEMS)


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, rows, k=10):
    docs = [(i, Counter(terms_of(t))) for i, t, _ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total = sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        wanted = Counter(terms_of(text))
        found = []
        for i, c, n in docs:
            m = 25 + 75 * n * len(docs) // total
            score = sum(times * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in wanted.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def found(spark, items, rows, **settings):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(items_of(spark, items), docs_of(spark, rows), **settings).collect()), key=repr)


def corpus(rng, n):
    topics = [[f"t{j}w{i}" for i in range(30)] for j in range(6)]
    common = ["the", "of", "und", "ñu"]
    text = lambda topic, size: " ".join(rng.choice(topic if rng.random() < 0.6 else common) for _ in range(size))
    rows = [(i, text(rng.choice(topics), rng.randint(1, 60)), "s") for i in range(n)]
    return [(i, text(rng.choice(topics), rng.randint(1, 25))) for i in range(23)], rows


@pytest.mark.parametrize("seed, settings", [(1, {}), (2, {"tree_docs": 7, "k": 3}), (3, {"pass_terms": 60, "k": 2})])
def test_ranks_against_plain_version(spark, seed, settings):
    items, rows = corpus(random.Random(seed), 400)
    assert found(spark, items, rows, **settings) == plain(items, rows, settings.get("k", 10))


def test_odd_rows_and_ties(spark):
    rows = ODD + [(60 + i, "same words here", "s") for i in range(14)] + [(None, "same words here", "s"), (7, "one two", "s")]
    items = [(1, "Same, words"), (1, "Same, words"), (2, None), (3, ""), (None, "one"), (4, "absent"), (5, "W w W"), (6, "öß")]
    assert found(spark, items, rows) == plain(items, rows)


def test_sums_beyond_exact_floats(spark, monkeypatch):
    items, rows = corpus(random.Random(4), 60)
    want = plain(items, rows)
    monkeypatch.setattr(lexical, "EXACT", 1)
    assert found(spark, items, rows) == want


def test_long_text(spark):
    rng = random.Random(5)
    rows = [(1, " ".join(f"w{rng.randrange(1000)}" for _ in range(300_000)), "s"), (2, "w1 w2", "s"), (3, "w3", "s")]
    items = [(1, "w1 w1 w2 w3"), (2, " ".join(f"w{i}" for i in range(3000)))]
    assert found(spark, items, rows) == plain(items, rows)


def test_empty_tables(spark):
    items, rows = corpus(random.Random(6), 5)
    assert found(spark, [], rows) == [] and found(spark, items, []) == []


def test_bounds_spare_most_pairs():
    """With topics apart, node pairs of different topics go at once; what is left is right."""
    rng = np.random.default_rng(7)
    topic, n_docs = 40, 1024
    rows = np.repeat(np.arange(n_docs), 12)
    columns = (rng.integers(0, 8, n_docs)[:, None] * topic + rng.integers(0, topic, (n_docs, 12))).ravel()
    pairs = np.unique(rows * 1000 + columns)
    documents = lexical.Entries(pairs // 1000, pairs % 1000, rng.integers(1, 10**6, len(pairs)), n_docs)
    rows = np.repeat(np.arange(64), 6)
    columns = (np.repeat(np.arange(64) % 8, 6) * topic + np.tile(np.arange(6) * 5, 64)).astype(np.int64)
    items = lexical.Entries(rows, columns, rng.integers(1, 10**4, len(rows)), 64)
    tree = lexical.ItemTree(np.arange(64), items, 8 * topic, 10**12)
    dense_d, dense_i = np.zeros((n_docs, 1000), dtype=np.int64), np.zeros((64, 1000), dtype=np.int64)
    dense_d[documents.rows, documents.columns] = documents.values
    dense_i[items.rows, items.columns] = items.values
    scores = dense_d @ dense_i[tree.items].T
    kth = np.sort(scores, axis=0)[-10]
    row, item, score, looked_at = lexical.search_tree(tree, documents, tree.weakest(kth))
    want = np.argwhere(scores >= np.maximum(kth, 1))
    assert sorted(zip(row.tolist(), item.tolist())) == sorted(map(tuple, want.tolist()))
    assert (scores[row, item] == score).all()
    assert looked_at < 0.5 * n_docs * 64
