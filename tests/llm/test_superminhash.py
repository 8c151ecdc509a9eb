"""SuperMinHash signatures, their bands and the components they lead to."""

from __future__ import annotations

import random

import numpy as np
import pytest

from furlens.llm import superminhash
from furlens.llm.jaccard_join import mixed
from tests.llm.test_llm_operators import ODD, brute_components, docs_of, edited, near_rows


def plain_signature(elements, slots):
    """Every element through its whole order, without stopping."""
    kept = [2**64 - 1] * slots
    for x in elements:
        order = list(range(slots))
        for rank in range(slots):
            r = int(mixed(np.array([x], dtype=np.uint64), 100 + rank)[0])
            k = rank + ((r & 0xFFFFFFFF) * (slots - rank) >> 32)
            order[rank], order[k] = order[k], order[rank]
            kept[order[rank]] = min(kept[order[rank]], (rank << 32) + (r >> 32))
    return kept


@pytest.mark.parametrize("chunk", [7, 1 << 17])
def test_early_stopping_changes_nothing(monkeypatch, chunk):
    monkeypatch.setattr(superminhash, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 9, 40, 150)]
    got = superminhash.signatures(sets, 20)
    assert [list(map(int, row)) for row in got] == [plain_signature(s, 20) for s in sets]


def test_no_sets():
    assert superminhash.signatures([], 10).shape == (0, 10)


def test_agreement_estimates_similarity_with_less_variance():
    rng = np.random.default_rng(6)
    found = []
    for _ in range(300):
        x = rng.integers(0, 2**63, 30, dtype=np.uint64)
        a, b = superminhash.signatures([x[:20], x[10:]], 64)
        found.append(np.mean(a == b))
    j = 10 / 30
    assert abs(np.mean(found) - j) < 0.02
    assert np.var(found) < 0.8 * j * (1 - j) / 64  # independent hashes: j (1 - j) / 64


def test_bands_miss_almost_no_pair_at_the_threshold():
    rng = np.random.default_rng(7)
    missed, pairs = 0, 0
    for n in (7, 14, 40, 200):
        common = int(np.ceil(0.85 * n))
        sets = []
        for _ in range(250):
            x = rng.integers(0, 2**63, n, dtype=np.uint64)
            cut = (n - common) // 2
            sets += [np.sort(x[: n - cut]), np.sort(x[n - common - cut :])]
        keys = superminhash.band_keys(superminhash.signatures(sets, superminhash.BANDS * superminhash.BAND_ROWS), superminhash.BANDS, superminhash.BAND_ROWS)
        missed += sum(not np.any(keys[2 * i] == keys[2 * i + 1]) for i in range(250))
        pairs += 250
    assert missed == 0 and pairs == 1000
    assert superminhash.miss_probability(0.85) < 1e-7


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_components_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = near_rows(rng)
    assert rows_of(superminhash.near_duplicates(docs_of(spark, rows))) == sorted(brute_components(rows, 5, 85, 100), key=repr)


def test_odd_rows_and_long_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = ODD + [(50, " ".join(long), "x"), (51, edited(rng, long, 200), "x")]
    assert rows_of(superminhash.near_duplicates(docs_of(spark, rows))) == sorted(brute_components(rows, 5, 85, 100), key=repr)


def test_empty_table(spark):
    assert superminhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_a_crowded_region_loses_no_link(spark, monkeypatch):
    """One group of many near copies, whose region is too large for one task."""
    from furlens.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "REGION_ROWS", 20)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, edited(rng, base, rng.choice([1, 1, 2, 3])), "s") for i in range(150)]
    assert rows_of(superminhash.near_duplicates(docs_of(spark, rows))) == sorted(brute_components(rows, 5, 85, 100), key=repr)
