"""The operators against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from furlens.llm import chat, common, components, exact_dedup, html_text, jaccard_join, language, licenses, mixing, packing, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, name string, `row` long, pos int, key string, cell long, share double, row_file string, row_index string"


def docs_of(spark, rows):
    """Rows (doc_id, text, source) with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 1, "n", 2, 3, "k", 4, 0.5, "f", "i") for i, t, s in rows], DOCS)


ODD = [
    (1, "a b c d e f g", "x"),
    (1, "a b c d e f g", "x"),
    (2, "A  b c\nd e f\tg", "x"),
    (3, None, None),
    (4, "", "y"),
    (None, "a b c d e f g", "x"),
    (5, " \n\t", "y"),
    (6, "one", "x"),
    (7, "one two", "x"),
    (8, "w " * 4_000, "x"),
    (9, "öß🙂 " * 50, None),
    (10, "öß🙂" * 50, None),
]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# exact duplicates


def test_exact_duplicates_odd_rows(spark):
    got = exact_dedup.exact_duplicates(docs_of(spark, ODD), block_chars=64).collect()
    norm = {}
    for i, t, _ in ODD:
        norm.setdefault("".join(words_of(t)), []).append((i, t or ""))
    assert len(got) == len(ODD)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in norm.items()}
    for r in got:
        group = by_sha[r.text_sha256]
        best = min(group, key=lambda g: (-len(g[1]), g[0] is None, g[0] or 0))
        assert (r.group_size, r.keep_id) == (len(group), best[0])
    assert sum(r.kept for r in got) == len(norm)


def test_deduplicated_keeps_columns_and_one_row(spark):
    out = exact_dedup.deduplicated(docs_of(spark, ODD), block_chars=64)
    assert out.columns == docs_of(spark, ODD).columns
    assert out.count() == len({"".join(words_of(t)) for _, t, _ in ODD})


def test_block_names_tell_texts_apart(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 12))), "s") for i in range(300)]
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_duplicates(docs_of(spark, rows), block_chars=2).collect()}
    first = {}
    for i, t, _ in rows:
        first.setdefault(t, i)
    assert got == {i: first[t] for i, t, _ in rows}


# Jaccard join


def brute_components(rows, words, num, den):
    sets = []
    for _, t, _ in rows:
        w = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    ids = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [(d, len(s), ids.get(find(i))) for i, ((d, _, _), s) in enumerate(zip(rows, sets))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def near_rows(rng):
    rows, i = [], 0
    for _ in range(5):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 12, 30, 90, 200]))]
        for _ in range(rng.randint(3, 20)):
            rows.append((i, edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5])), "s"))
            i += 1
    return rows + [(100_000 + j, f"alone {j} " + "same passage in many texts " * 3, "s") for j in range(10)]


@pytest.mark.parametrize("words,num,den,rows_in_task", [(3, 9, 10, 4096), (5, 4, 5, 12)])
def test_components_against_brute_force(spark, monkeypatch, words, num, den, rows_in_task):
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", rows_in_task)
    rows = near_rows(random.Random(words * num)) + ODD
    got = jaccard_join.jaccard_components(docs_of(spark, rows), words, num, den).collect()

    def order(r):
        return tuple((x is None, x or 0) for x in r)

    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=order) == sorted(brute_components(rows, words, num, den), key=order)


def test_parts_of_linked_sets_agree():
    bounds, rng = jaccard_join.Bounds(4, 5), np.random.default_rng(1)
    for n in (2, 5, 9, 17, 40, 133, 500):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(30):
            most = bounds.differences(n, n) // 2
            y = np.unique(np.concatenate([rng.permutation(x)[most:], rng.integers(0, 2**63, most).astype(np.uint64)]))
            union = len(np.union1d(x, y))
            if 5 * len(np.intersect1d(x, y)) >= 4 * union and len(np.setxor1d(x, y)):
                assert set(bounds.part_keys(x).tolist()) & set(bounds.part_keys(y).tolist())


def test_one_per_group(spark):
    rows = near_rows(random.Random(5))[-20:] + ODD
    out = jaccard_join.one_per_group(docs_of(spark, rows))
    assert out.columns == docs_of(spark, rows).columns
    assert out.count() == len({c for _, n, c in brute_components(rows, 5, 4, 5) if n}) + sum(not n for _, n, _ in brute_components(rows, 5, 4, 5))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(8, 60, 3)] + [(1, 1)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100}
    assert {got[j] for j in range(8, 60, 3)} == {7} and 1 not in got


# packing


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = [*(t for _, t, _ in ODD), "It's O'Neil's don't “q.” x.y,z!!! 3.14 <|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>", "É\u0301 İ ΑΣ\u00a0q", "word,*** élan... “.”"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    pieces = {}
    for r in packing.packed(docs_of(spark, rows), sequence=64).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    sequences = [r.sequence_id for p in pieces.values() for r in p]
    assert len(set(sequences)) == len(sequences)
    for i, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == np.concatenate([[0], np.cumsum([r.length for r in own])[:-1]]).tolist()
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            assert r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_word_memory_is_bounded(monkeypatch):
    import pyarrow as pa

    encoder = packing.WordEncoder(packing.default_tokenizer())
    texts = pa.array([f"alpha{i} beta, gamma." for i in range(50)])
    first = [x.tolist() for x in encoder.documents(texts, 1)]
    monkeypatch.setattr(packing, "MOST_WORDS", 1)
    assert [x.tolist() for x in encoder.documents(texts, 1)] == first and len(encoder.place) <= 60


# mixing


def test_mixing_budgets(spark):
    rng = random.Random(2)
    rows = [(i, "t " * rng.randint(1, 30), s) for i, s in enumerate(["big"] * 300 + ["mid"] * 60 + ["low"] * 20 + [None] * 20)]
    out = mixing.mixed(docs_of(spark, rows), max_repeats=2.0)
    assert out.columns == [*docs_of(spark, rows).columns, "mix_pass", "mix_block"]
    got = out.collect()
    used = {}
    for r in got:
        used[r.source] = used.get(r.source, 0) + len(words_of(r.text))
    total = {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + len(words_of(t))
    passes = {s: used[s] / total[s] for s in total}
    assert passes["big"] == 1.0 and max(passes.values()) <= 2.0
    smallest = min(total, key=total.get)
    assert passes[smallest] > 1.85
    assert {r.doc_id for r in got} == {i for i, _, _ in rows}


def test_mixing_entropy_bisection(spark):
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "source string, share double")
    alpha = mixing.temperature(shares, entropy=0.9)
    w = np.array([0.7, 0.2, 0.1]) ** alpha
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() / np.log(3) - 0.9) < 1e-4


def test_mixing_odd_rows(spark):
    assert mixing.mixed(docs_of(spark, [(1, "", "a"), (2, None, None)])).count() == 2
    assert mixing.mixed(docs_of(spark, ODD)).count() >= len(ODD)


# top-k


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 8).tolist(), 0) for i in range(400)]
    rows += [(50, rows[0][1], 1), (7, rows[0][1], 1), (401, None, 0), (None, rows[1][1], 0), (402, [float("nan")] * 8, 0), (403, [None] * 8, 0), (404, [float("inf")] * 8, 0), (405, [], 0), (450, [1.0, 2.0], 0)]
    frame = spark.createDataFrame([(*r, "v", 1) for r in rows], "vec_id long, embedding array<float>, label int, v string, shard int")
    valid = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float))) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    expected = []
    for a, (i, q) in enumerate(valid):
        if i % 50 == 0:
            scores = sorted((-int(q @ v), j) for b, (j, v) in enumerate(valid) if b != a and len(v) == len(q))
            expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:5], 1)]
    got = [tuple(r) for r in topk.top_k(frame, shard_rows=64).collect()]
    assert sorted(got) == sorted(expected)


def test_top_k_of_large_vectors_is_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 4) * 2 ** int(rng.choice([3, 22, 27, 30, 40])) + rng.integers(0, 9, 4)]) for i in range(300)]
    rows += [(150, [2.0**22, 3.0 / 256, 2.0**22 + 1 / 256, 1.0]), (600, [1e10, 1e10, -1e10, 1.0]), (601, [1e10, 1e10, -1e10, 2.0])]
    rows += [(602, [-1e10, -1e10, 1e10, 1.0]), (650, [1e300, -1e300, 0.0, 0.0]), (603, [1e300, -1e300, 1.0, 0.0]), (604, [-1e300, 1e300, 1.0, 0.0])]
    most = 2**63 - 1024
    valid = [(i, [min(max(math.floor(256 * x) if abs(x) < 1e30 else int(math.copysign(2**64, x)), -most), most) for x in v]) for i, v in rows]
    expected = []
    for a, (i, q) in enumerate(valid):
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(valid) if b != a)
            expected += [(i, rank, j, min(max(-s, -(2**63)), 2**63 - 1)) for rank, (s, j) in enumerate(scores[:5], 1)]
    assert max(e[3] for e in expected) == 2**63 - 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (32, 10_000):
        assert sorted(tuple(r) for r in topk.top_k(frame, shard_rows=shard_rows).collect()) == sorted(expected)


def test_top_k_visits_few_shards_where_boxes_tell(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(0, 4, (32, 6))
    points = centers[rng.integers(0, 32, 4000)] + rng.normal(0, 0.1, (4000, 6))
    points[1000:2500] = points[0]  # copies of one vector go to several shards
    whole = np.floor(256 * points)
    planes = topk.split_planes(whole[::4].astype(np.int64), 32)
    node = np.ones(4000, int)
    for _ in range(5):
        node = 2 * node + (whole[np.arange(4000), planes[0][node]] >= planes[1][node])
    low, high = (np.array([getattr(whole[node == i], f)(0) for i in np.unique(node)]) for f in ("min", "max"))
    queries = whole[::50]
    kth = np.sort(queries @ whole.T, axis=1)[:, -6]
    assert (topk.upper_bounds(queries, low, high) >= kth[:, None]).mean() < 0.4
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame, shard_rows=128).collect()}
    for i in range(0, 4000, 50):
        scores = (whole @ whole[i]).astype(int)
        best = sorted((-s, j) for j, s in enumerate(scores.tolist()) if j != i)[:5]
        assert [got[i, r] for r in range(1, 6)] == [(j, -s) for s, j in best]


def test_tree_boxes_are_tight():
    points = np.random.default_rng(0).integers(-99, 99, (1000, 5)).astype(float)
    tree = topk.build_tree(points, 50)
    for (start, end, _, _), low, high in zip(tree["nodes"], tree["low"], tree["high"]):
        own = points[tree["order"][start:end]]
        assert (own.min(0) == low).all() and (own.max(0) == high).all()


# chat


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool", "[ROLE]x"]), st.text(st.sampled_from("\\<>/[]sSYINTROLEX a\n"), max_size=30)), max_size=6))
def test_chat_round_trip(turns):
    machine = chat.Machine()
    segments = [s for role, text in turns for s in machine.step(role, text)[1]]
    formatted = "".join(t for t, _ in segments)
    assert machine.read(formatted) == turns
    assert [machine.unescaped(t) for t, loss in segments if loss] == [t for r, t in turns if r == "assistant"]


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 5, None, "x"), (None, 0, "user", "y"), (1, 1, "assistant", None), (3, None, "assistant", "\\[INST]")]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(frame)).collect()}
    assert set(got) == {1, 2, 3, None}
    assert got[1].n_turns == 3 and not got[1].in_order and got[1].loss_chars == 0
    assert got[3].loss_sha256 == hashlib.sha256(b"\\[INST]").hexdigest()


# html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B, b</a></ul></nav>
<div class="cookie-notice">We use cookies, really.</div>
<article><h1>Head &amp; line</h1><p>First,&nbsp; one<br>two.<p><b>Second <i>x</i>y.<p>Third.<script>var t="</p>";</script></p>
<div class="comments"><p>A reader said a long thing, with marks. And more, and more.</p></div><form><input value="v">Go</form></article>
<aside>Also read</aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Head & line\nFirst, one two.\nSecond xy.\nThird."


def test_main_text_without_article():
    page = "<body><div id=menu><a href=x>One</a> <a href=y>Two</a></div><div><p>A long paragraph, with marks. It goes on, and on.</p><p>Another long one, it is. Yes.</p></div><div class=footer>me</div>"
    assert html_text.main_text(page) == "A long paragraph, with marks. It goes on, and on.\nAnother long one, it is. Yes."


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("<>/\"'=!-abp &;\n"), max_size=60))
def test_broken_markup_does_not_crash(page):
    html_text.main_text(page)


def test_extracted_odd_rows(spark):
    frame = spark.createDataFrame([(1, "u", None, "t"), (None, None, "", "t"), (2, "u", PAGE, "t"), (2, "u", PAGE, "t")], "page_id long, url string, html string, text string")
    got = html_text.extracted(frame).collect()
    assert sorted(r.n_chars for r in got)[:2] == [0, 0] and len(got) == 4


# language


def test_language_of_pages(spark):
    english, german = "the cat and the dog of this house " * 20, "der hund und die katze von dem haus " * 20
    docs = spark.createDataFrame([(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(40)] + [(None, None, None), (99, "", "en")], "doc_id long, text string, lang string")
    pages = [(i, f"http://{'a' if i % 2 else 'b'}.example.{'com' if i % 2 else 'de'}/x", f"<html lang='{'en' if i % 2 else 'de'}'><p>{english if i % 2 else german}</p>") for i in range(30)]
    pages += [(100, "http://b.example.de/y", "<p></p>"), (101, None, None), (101, None, None)]
    frame = spark.createDataFrame([(*p, 1.0) for p in pages], "page_id long, url string, html string, p double")
    got = {r.page_id: r for r in language.identified(frame, docs).collect()}
    assert all(got[i].lang == ("en" if i % 2 else "de") for i in range(30))
    assert got[100].lang == "de" and got[101].lang in ("en", "de")
    assert language.identified(frame, docs.limit(0)).filter("lang is null").count() == len(pages)


# licenses


def test_licenses_found_and_near(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"]
    rows = [(1, f"x y. {licenses.TEMPLATES['MIT']} z", "s"), (2, gpl.replace("3", "2") + " tail", "s"), (3, "Released under the GNU license", "s"), (4, "pad " * 5000 + licenses.TEMPLATES["BSD"].upper(), "s"), *ODD]
    got = {(r.doc_id, r.license): r for r in licenses.scanned(docs_of(spark, rows)).collect()}
    assert set(got) == {(1, "MIT"), (2, "GPL-3.0"), (4, "BSD")}
    assert got[2, "GPL-3.0"].containment == 7 / 8 and got[1, "MIT"].first_word == 2


def test_bands_reach_the_probability():
    for group in licenses.grouped(licenses.TEMPLATES):
        for words in group.templates.values():
            n = len(licenses.Group.shingles(words))
            found = -(-int(licenses.CONTAINMENT * n * 1000) // 1000)
            likeness = found / (group.window + n - found)
            assert 1 - (1 - min(1.0, likeness)) ** group.bands >= licenses.COLLISION


# toxicity


def toxic_rows(n):
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"w{rng.randrange(300)}" .replace("0", "a").replace("1", "b") for _ in range(60)]
        words = [re.sub(r"\d", lambda m: "cdefghijkl"[int(m[0])], w) for w in words]
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(["scum", "idiot", "trash"])
        rows.append((i, " ".join(words), "s"))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows(1200)
    frame = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs_of(spark, rows + [(-1, None, None), (-2, "", None)]), frame).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i, _, _ in rows)
    assert np.mean([got[i].predicted == int(i % 5 == 0) for i in held]) > 0.97
    assert got[-1].score == got[-2].score and 0 <= got[-1].score < 0.5


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs_of(spark, ODD), none).collect()} == {0}
    kept = toxicity.non_toxic(docs_of(spark, ODD), none)
    assert kept.columns == docs_of(spark, ODD).columns and kept.count() == len(ODD)


def test_risk_is_prior_corrected():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (4000, 2))
    y = x[:, 0] + rng.normal(0, 0.3, 4000) > 0.8
    known = y & (rng.random(4000) < 0.5)
    w = toxicity.nn_pu_fit(x, known, y[~known].mean())
    assert ((np.hstack([x, np.ones((4000, 1))]) @ w > 0) == y).mean() > 0.9


# all


def test_empty_tables(spark):
    docs = docs_of(spark, ODD).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for out in (
        licenses.scanned(docs),
        toxicity.score_documents(docs, labels),
        exact_dedup.exact_duplicates(docs),
        html_text.extracted(pages),
        chat.digests(chat.formatted(turns)),
        language.identified(pages, docs),
        topk.top_k(vectors),
        packing.packed(docs),
        mixing.mixed(docs),
        jaccard_join.jaccard_components(docs),
    ):
        assert out.count() == 0


def test_slices_hold_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["é" * n for n in (3, 0, 50, 1, 1, 9)])], names=["i", "t"])
    parts = list(common.sliced(iter([batch]), 1, 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6)) and len(parts) > 2
