import numpy as np
import pytest
from pyspark.sql import functions as F

from furlens.functions import labels, tensors
from furlens.operators import acquisition as A, counts
from furlens.plans import acquire
from furlens.sources import images as I, readers as R, writers as W
from furlens_suite.bitmaps import write_bitmaps


@pytest.mark.parametrize(
    "tags, want",
    [("", -1), (None, -1), ("cat dog", -1), ("Kitten, feline", 0), ("scatter", 0), ("puppy", 1), ("cat cat dog puppy", 1), ("tree", -1)],
)
def test_tag_label(spark, tags, want):
    df = spark.createDataFrame([(tags,)], "t string")
    assert df.select(labels.tag_label(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(
    "url, keyword, want",
    [("x", "bobcat", 0), ("x", "HotDog", 1), ("a/dog.jpg", "bird", 1), ("a/CAT.jpg", None, 0), ("a/cat", "dog", 1)],
)
def test_assigned_label(spark, url, keyword, want):
    df = spark.createDataFrame([(url, keyword)], "u string, k string")
    assert df.select(labels.assigned_label(F.col("u"), F.col("k"))).first()[0] == want


def test_coin_toss_is_reproducible_and_uses_both_sides(spark):
    df = spark.range(200).select(F.concat(F.lit("u"), "id").alias("u"))
    toss = labels.assigned_label(F.col("u"), F.lit("bird"))
    a = [r[0] for r in df.orderBy("u").select(toss).collect()]
    assert a == [r[0] for r in df.orderBy("u").select(toss).collect()]
    assert set(a) == {0, 1}


def test_effective_label(spark):
    df = spark.createDataFrame([(-1, "dog"), (0, "dog")], "l int, k string")
    got = df.select(labels.effective_label(F.col("l"), F.lit("x"), F.col("k"))).collect()
    assert [r[0] for r in got] == [1, 0]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://a.org/b/c.JPG?x=1", True),
        ("https://a.org/b.webp#top", True),
        ("https://a.org/b.gif", False),
        ("https://a.org/?f=b.png", False),
        ("https://cdn.images.example/x", True),
        ("https://a.org/images.example", False),
        ("b.jpeg", True),
        ("", False),
        ("   ", False),
        (None, False),
    ],
)
def test_image_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(A.is_image_url(F.col("u"), "images.example")).first()[0] is want


@pytest.mark.parametrize(
    "status, kind, length, want",
    [
        (200, "image/png", None, 1),
        (200, "IMAGE/PNG", "", 1),
        (200, "image/png", "10000", 1),
        (200, "image/png", "9999", 0),
        (200, "image/png", "many", 0),
        (200, "text/html", None, 0),
        (200, None, None, 0),
        (404, "image/png", None, 0),
    ],
)
def test_responses(spark, status, kind, length, want):
    schema = "status int, content_type string, content_length string"
    df = spark.createDataFrame([(status, kind, length)], schema)
    assert A.keep_image_responses(df).count() == want


def test_content_check(spark):
    rng = np.random.default_rng(0)
    rich = rng.integers(0, 256, (10, 10, 3)).tolist()
    nine = [[[min(i * 10 + j, 8), 0, 0] for j in range(10)] for i in range(10)]
    thin = rng.integers(0, 256, (9, 40, 3)).tolist()
    swapped = [[[0, 1, j] if i % 2 else [0, j, 1] for j in range(10)] for i in range(10)]
    df = spark.createDataFrame([(1, rich), (2, nine), (3, thin), (4, None), (5, swapped)], "i int, tensor array<array<array<int>>>")
    assert {r["i"] for r in A.keep_content(df).collect()} == {1, 5}
    gray = spark.createDataFrame([([[0] * 10] * 10,), ([[0] * 9] * 10,)], "m array<array<int>>")
    assert [r[0] for r in gray.select(tensors.has_content_gray(F.col("m"))).collect()] == [True, False]


def test_resize_and_rgb(spark):
    df = spark.createDataFrame([([[[1], [2]], [[3], [4]]],)], "tensor array<array<array<int>>>")
    out = A.resize(df, side=4).first()["resized"]
    assert [[p[0] for p in row] for row in out] == [[1, 1, 2, 2]] * 2 + [[3, 3, 4, 4]] * 2
    assert out[0][0] == [1, 1, 1]
    alpha = spark.createDataFrame([([[[1, 2, 3, 9]]],)], "tensor array<array<array<int>>>")
    assert A.resize(alpha, side=1).first()["resized"] == [[[1, 2, 3]]]


def test_top_candidates_limits_inside_map_tasks(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 10 < 8, 'hot', 'cold') as keyword")
    top = A.top_candidates(df, [F.col("id").asc()], 3)
    assert {(r["keyword"], r["id"]) for r in top.collect()} == {
        ("hot", 0), ("hot", 1), ("hot", 2), ("cold", 8), ("cold", 9), ("cold", 18)
    }
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_listing_response_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"total": 2,\n "hits": [{"id": 7, "tags": "kitten"}, {"webformatURL": "u", "views": 3}]}')
    (tmp_path / "b.json").write_text('{"error": "none"}')
    got = A.listing_hits(R.read_listing_responses(spark, str(tmp_path))).orderBy("views").collect()
    assert [(r["api_id"], r["tags"], r["views"], r["user"], r["label"]) for r in got] == [
        (7, "kitten", 0, "", 0), (None, "", 3, "", -1)
    ]


def test_json_array_fails_on_malformed_input(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"image_id": "a", "label": 1},\n {"image_id": "b"}]')
    assert R.read_json_array(spark, str(tmp_path)).count() == 2
    (tmp_path / "a.json").write_text('[{"image_id": "a", "label": 1}, {"image_id": ')
    with pytest.raises(Exception):
        R.read_json_array(spark, str(tmp_path)).collect()


def test_image_records_end_to_end(spark):
    rng = np.random.default_rng(1)
    good = rng.integers(0, 256, (12, 12, 3)).tolist()
    flat = np.zeros((12, 12, 3), int).tolist()
    listing = spark.createDataFrame(
        [("cat", i, i if i else None, f"u{i}", "cat", -1 if i == 3 else 1) for i in range(6)],
        "keyword string, position bigint, api_id bigint, image_url string, tags string, label int",
    ).selectExpr("*", "cast(1 as bigint) views", "cast(null as bigint) downloads", "cast(null as string) user")
    fetched = spark.createDataFrame(
        [(f"u{i}", 200, "image/png", None, "PNG", "RGB", 640, 480, flat if i == 1 else good) for i in range(6)],
        "url string, status int, content_type string, content_length string, format string, mode string, "
        "width int, height int, tensor array<array<array<int>>>",
    )
    got = {r["image_id"]: r for r in acquire.image_records(listing, fetched, "Example").collect()}
    # Four candidates, one of them flat and not replaced by the fifth.
    assert set(got) == {"cat_0", "cat_2", "cat_3"}
    assert got["cat_2"]["label"] == 1 and got["cat_3"]["label"] == 0
    assert got["cat_2"]["description"] == "Example cat image"
    assert list(got["cat_2"]["original_shape"]) == [12, 12, 3]
    assert len(got["cat_2"]["image_array"]) == 64 and got["cat_2"]["downloads"] == 0


def test_image_files_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    images = [(f"i{n}", rng.integers(0, 256, (3 + n, 5, 3)).tolist()) for n in range(3)]
    df = spark.createDataFrame(images, "name string, tensor array<array<array<int>>>")
    folder = str(tmp_path / "bmp")
    assert write_bitmaps(df, folder) == 3
    (tmp_path / "bmp" / "bad.png").write_bytes(b"not an image")
    got = {r["name"]: r["tensor"] for r in I.read_images(spark, folder).collect()}
    assert got == dict(images)


def test_ndjson_keeps_text_and_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    W.write_ndjson(spark.createDataFrame([("é猫", None)], "a string, b int"), path)
    assert [r["value"] for r in R.read_lines(spark, path).collect()] == ['{"a":"é猫","b":null}']


def test_preview_and_counts(spark):
    df = spark.createDataFrame([("a" * 31, 0), ("b", 1), ("c", 1)], "t string, label int")
    assert [r["t"] for r in counts.preview(df, ["t", "label"], 2).collect()] == ["a" * 27 + "...", "b"]
    assert counts.label_counts(df).first().asDict() == {"cat": 1, "dog": 2}
    assert counts.sample_rows(df, 2).count() == 2
