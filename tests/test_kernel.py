import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from furlens.functions import kernel
from furlens.functions.kernel import FEATURE_NAMES, N_FEATURES
from furlens.operators import features as X

ENGINES = ("arrow", "native")


def expected(image) -> list[float]:
    """Brute force over one image."""
    a = np.array(image, dtype=np.float64)
    planes = [a[:, :, c].ravel() for c in (range(3) if a.shape[2] >= 3 else (0, 0, 0))]
    out = []
    for p in planes:
        out += [p.mean(), p.std(), np.median(p), np.percentile(p, 25), np.percentile(p, 75)]
    g = 0.2989 * planes[0] + 0.5870 * planes[1] + 0.1140 * planes[2] if a.shape[2] >= 3 else planes[0]
    h, _ = np.histogram(g, 64, (0, 255))
    p = (h + 1e-8) / (h + 1e-8).sum()
    out += [g.mean(), g.std(), g.var(), -(p * np.log2(p)).sum(), g.std()]
    return out + [g.min(), g.max(), np.percentile(g, 10), np.percentile(g, 90)]


def vectors(spark, texts, engine):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, image_array string")
    got = X.with_features(df, engine=engine).orderBy("i").collect()
    return [r["image_features"] for r in got]


def random_images():
    rng = np.random.default_rng(3)
    shapes = [(64, 64, 3), (16, 16, 3), (7, 9, 3), (12, 12, 4), (12, 12, 1), (12, 12, 2), (1, 1, 3)]
    return [rng.integers(0, 256, s).tolist() for s in shapes] + [
        np.zeros((8, 8, 3), int).tolist(),
        np.full((8, 8, 3), 255).tolist(),
        np.full((8, 8, 1), 255).tolist(),
    ]


@pytest.mark.parametrize("engine", ENGINES)
def test_matches_brute_force(spark, engine):
    images = random_images()
    got = vectors(spark, [json.dumps(i) for i in images], engine)
    for image, vector in zip(images, got):
        assert len(vector) == N_FEATURES == len(FEATURE_NAMES) == 24
        # The entropy of a gray value that falls on a bin edge depends on its last bit.
        np.testing.assert_allclose(vector, expected(image), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "nonsense",
        "[[1,2],[3,4]]",
        "[[[[1]]]]",
        "[[[[1]]]",
        "[]",
        "[[[]]]",
        "[[],[]]",
        "[[[1,2,3],[1,2,3]],[[1,2,3]]]",
        "[[[1,2,3],[1,2]]]",
        "[[[1,2,300]]]",
        "[[[1,2,-3]]]",
        "[[[1,2,null]]]",
        "[[null,[1,2,3]]]",
        '[[["5",2,3]]]',
        "[[[true,2,3]]]",
    ],
)
def test_rejected(spark, engine, text):
    good = "[[[1,2,3]]]"
    bad, kept = vectors(spark, [text, good], engine)
    assert not bad and len(kept) == 24


@pytest.mark.parametrize("engine", ENGINES)
def test_fraction_is_cut_off(spark, engine):
    cut, whole = vectors(spark, ["[[[2.7,-0.5,255.9]]]", "[[[2,0,255]]]"], engine)
    assert cut == whole


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 6), st.integers(1, 6), st.integers(1, 4), st.integers(0, 2**31)),
        min_size=1,
        max_size=12,
    )
)
def test_invariants_and_engines_agree(spark, shapes):
    texts = [
        json.dumps(np.random.default_rng(seed).integers(0, 256, (h, w, c)).tolist())
        for h, w, c, seed in shapes
    ]
    for a, n in zip(vectors(spark, texts, "arrow"), vectors(spark, texts, "native")):
        np.testing.assert_allclose(a, n, rtol=1e-9, atol=1e-9)
        f = dict(zip(FEATURE_NAMES, a))
        assert f["contrast"] == f["gray_std"]
        assert abs(f["gray_var"] - f["gray_std"] ** 2) < 1e-6
        assert f["gray_min"] <= f["gray_p10"] <= f["gray_p90"] <= f["gray_max"]
        assert -1e-9 <= f["entropy"] <= 6 + 1e-9


def test_filter_does_not_run_the_kernel_again(spark):
    df = spark.createDataFrame([("[[[1,2,3]]]",)], "image_array string")
    for engine in ENGINES:
        kept = X.keep_extracted(X.with_features(df, engine=engine))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, engine


def test_black_is_suspicious_and_counts_add_up(spark):
    black = json.dumps(np.zeros((8, 8, 3), int).tolist())
    noisy = json.dumps(np.random.default_rng(0).integers(0, 256, (8, 8, 3)).tolist())
    df = X.with_features(
        spark.createDataFrame([("b", black), ("n", noisy), ("x", "[")], "image_id string, image_array string")
    )
    status = {r["image_id"]: r["status"] for r in X.hardcoded_check(df).collect()}
    assert status == {"b": "suspicious", "n": "normal"}
    outcome = X.extract_outcome(df).first().asDict()
    assert outcome == {"total": 3, "ok": 2, "failed": 1, "dim": 24}
    assert not X.feature_report(df).first()["no_hardcoding"]


def test_ragged_matrix_raises(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "image_features array<double>")
    with pytest.raises(Exception, match="differ in length"):
        X.matrix_stats(df).collect()


def test_quality_report_without_valid_rows_raises(spark):
    df = spark.createDataFrame([(True, 1.0, [1.0])], "parsed boolean, label double, image_features array<double>")
    with pytest.raises(Exception, match="no valid feature rows"):
        X.quality_report(df).collect()
    assert df.filter(F.size("image_features") > 10).count() == 0


def test_named_values_build_only_what_they_need(spark):
    tensors = spark.createDataFrame([([[[1, 2, 3]] * 3] * 2,)], "tensor array<array<array<int>>>")
    plan = kernel.with_feature_vector(tensors, names=("gray_mean",))._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan and "log2" not in plan.lower()
    every = kernel.with_feature_vector(tensors).first()["image_features"]
    for name in ("green_std", "blue_p25", "gray_min", "entropy"):
        alone = kernel.with_feature_vector(tensors, names=(name,)).first()["image_features"][0]
        assert abs(alone - every[FEATURE_NAMES.index(name)]) < 1e-9
