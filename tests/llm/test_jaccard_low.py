"""Size classes of op10_metric_join at low thresholds."""

from __future__ import annotations

import pytest

from furlens.llm import jaccard_join


@pytest.mark.parametrize(("num", "den"), [(1, 5), (1, 2), (3, 5), (2, 3), (4, 5), (9, 10)])
def test_linked_sizes_share_a_class(num, den):
    bounds = jaccard_join.Bounds(num, den)
    classes = [set(bounds.classes(n)) for n in range(1, 200)]
    for a in range(1, 200):
        for b in range(a, min(199, a * den // num) + 1):
            assert classes[a - 1] & classes[b - 1], (a, b)


def test_pairs_at_one_half(spark):
    word = [f"w{i}" for i in range(40)]
    texts = [" ".join(word[:4]), " ".join(word[:8]), " ".join(word[20:27]), " ".join(word[20:32])]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    group = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, words=1, num=1, den=2).drop("row_file", "row_index").collect()}
    assert group[0] == group[1] and group[2] == group[3] and group[0] != group[2]
