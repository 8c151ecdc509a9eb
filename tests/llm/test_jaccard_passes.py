"""What the join sends to its regions at a time."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from furlens.llm import jaccard_join
from tests.llm.test_llm_operators import ODD, brute_components, docs_of, near_rows


@pytest.mark.parametrize(("rows_in_task", "blocks"), [(4096, 32), (4, 32)])
def test_passes_lose_no_link(spark, monkeypatch, rows_in_task, blocks):
    """Bounded regions and those joined by pairs of blocks; sets go to their regions in several passes."""
    monkeypatch.setattr(jaccard_join, "PASS_BYTES", 1)
    monkeypatch.setattr(jaccard_join, "MOST_BLOCKS", blocks)
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", rows_in_task)
    purposes, real = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, purpose: purposes.append(purpose) or real(df, purpose))
    rows = near_rows(random.Random(20)) + ODD
    got = jaccard_join.jaccard_components(docs_of(spark, rows), 5, 4, 5).collect()

    def order(r):
        return tuple((x is None, x or 0) for x in r)

    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=order) == sorted(brute_components(rows, 5, 4, 5), key=order)
    assert purposes.count("joined") > 1
    assert ("blocks" in purposes) == (rows_in_task == 4 and blocks == 32)


def test_linkable_sets_meet_in_bounded_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", 8)
    monkeypatch.setattr(jaccard_join, "REGION_ELEMENTS", 300)
    rng = random.Random(3)
    sizes = {sid: rng.choice([rng.randint(1, 60), 40]) for sid in range(50)}
    rows = spark.createDataFrame([(c, 0, s, n) for c in (1, 2) for s, n in sizes.items() if (s + c) % 3], "cell long, p long, sid long, n_shingles long")
    regions = {}
    for r in jaccard_join._block_pairs(rows, jaccard_join.Bounds(4, 5)).collect():
        assert r.n_shingles == sizes[r.sid]
        regions.setdefault(r.cell, []).append(r.sid)
    met = {pair for sids in regions.values() for pair in combinations(sorted(sids), 2)}
    for c in (1, 2):
        inside = [s for s in sizes if (s + c) % 3]
        assert {(a, b) for a, b in combinations(inside, 2) if 5 * min(sizes[a], sizes[b]) >= 4 * max(sizes[a], sizes[b])} <= met
    assert all(len(set(sids)) == len(sids) <= 10 for sids in regions.values())
    assert max(sum(sizes[s] for s in sids) for sids in regions.values()) <= 300 + 2 * 60
