import json

import pytest
from pyspark.sql import functions as F

from furlens.operators import cleaning as C, counts
from furlens.plans import clean

BIG = json.dumps([[[i % 256, 1, 2] for i in range(16)] for _ in range(16)])


def line(label="0", keyword='"cat"', tags='"t"', array=BIG, image_id='"a"', shape="[16, 16, 3]"):
    fields = [
        f'"image_id": {image_id}' if image_id else None,
        f'"label": {label}' if label else None,
        f'"keyword": {keyword}' if keyword else None,
        f'"tags": {tags}' if tags else None,
        f'"image_array": {array}' if array else None,
        f'"original_shape": {shape}' if shape else None,
    ]
    return "{" + ", ".join(f for f in fields if f) + "}"


def frame(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


@pytest.mark.parametrize(
    "text, labels",
    [
        (line(label="-1"), []),
        (line(label="10"), []),
        (line(label="1.7"), [1]),
        (line(label='"1"'), []),
        (line(label=None), []),
        (line(label="99999999999999"), []),
        (line(keyword='""'), [0]),
        (line(keyword=None), []),
        (line(image_id='""'), []),
        (line(image_id=None), []),
        (line(tags=None), [0]),
        (line(array="[]"), []),
        (line(array="[[[]]]"), []),
        (line(array="[[1,2],[3,4]]"), []),
        (line(array="[[[1,2,3]]]"), []),
        (line(array=f"[{BIG}]"), [0]),
        (line(shape=None), [0]),
        ('{"label":1,"keyword":"k","image_array":' + BIG + ',"image_id":"z"}', [1]),
        ("not json at all", []),
    ],
)
def test_edge_lines(spark, text, labels):
    assert [r["label"] for r in clean.valid_records(frame(spark, text)).collect()] == labels


def test_four_dimensional_array_is_cut_at_the_first_triple_bracket(spark):
    got = C.extract_fields(frame(spark, line(array="[[[[1,2]]],[[[3]]]]"))).first()
    assert got["image_array"] == "[[[[1,2]]]"


def test_tags_stop_at_the_first_quote(spark):
    got = C.extract_fields(frame(spark, line(tags=r'"a \"q\" b"'))).first()
    assert got["tags"] == "a \\"


def test_miss_is_null_and_empty_is_empty(spark):
    got = C.extract_fields(frame(spark, line(keyword='""', tags=None, shape="[16, 16]"))).first()
    assert got["keyword"] == "" and got["tags"] is None and got["original_shape"] is None


def test_both_modes_agree_on_clean_lines(spark):
    lines = frame(spark, line(), line(label="1", image_id='"b"'))
    cols = ["image_id", "label", "keyword", "tags"]
    regex = C.extract_fields(lines).select(*cols).orderBy("image_id").collect()
    parsed = C.extract_fields(lines, mode="json").select(*cols).orderBy("image_id").collect()
    assert regex == parsed


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        C.extract_fields(frame(spark, "x"), mode="csv")


def test_threshold_is_a_parameter(spark):
    small = frame(spark, line(array="[[[1,2,3]]]"))
    assert clean.valid_records(small, min_chars=5).count() == 1


def test_each_pattern_searches_the_line_once(spark):
    plan = clean.valid_records(frame(spark, line()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('regexp_extract(value') == 6


def test_empty_input_has_no_totals(spark):
    none = frame(spark, line()).filter(F.lit(False))
    assert counts.line_count(none).collect() == []
    assert counts.summary_text(clean.valid_records(none)).collect() == []


def test_run_writes_records_and_counts(spark, tmp_path):
    lines = [line(image_id=f'"i{i}"', label=str(i % 3), keyword='"猫"') for i in range(9)]
    (tmp_path / "in.txt").write_text("\n".join(lines), encoding="utf-8")
    totals = clean.run(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    assert totals["total_lines"] == 9 and totals["valid_records"] == 6
    assert totals["summary"].endswith(" 6")
    stats = spark.read.json(str(tmp_path / "out" / "category_stats")).orderBy("label").collect()
    assert [(r["label"], r["count"]) for r in stats] == [(0, 3), (1, 3)]
    words = spark.read.json(str(tmp_path / "out" / "keyword_stats")).collect()
    assert [(r["keyword"], r["count"]) for r in words] == [("猫", 6)]


def test_counts_search_only_for_their_fields(spark):
    lines = spark.createDataFrame([("x",)], "value string")
    plan = C.extract_fields(lines, fields=C.COUNTED_FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "image_array" in plan and "original_shape" not in plan and '"tags"' not in plan
