"""Queries read all of their input."""

from furlens.operators import cleaning as C
from furlens_suite import clean_queries, derived as D, source_queries


def test_json_fields_of_every_line(spark, sf_dir):
    got = clean_queries.proj_json_fields(spark, sf_dir)
    assert got.columns == list(C.FIELDS)
    assert got.count() == D.lines(spark, sf_dir).count()


def test_json_fields_of_malformed_lines(spark, sf_dir):
    got = {r["image_id"]: r for r in clean_queries.proj_json_fields(spark, sf_dir).collect()}
    assert got["img_29"]["label"] == "-1"
    assert [got[f"img_{n}"]["label"] for n in (1, 2, 3)] == [None] * 3
    assert got["img_37"]["tags"] == 'a "q" b'
    assert [got[f"img_{n}"]["image_array"] for n in (2, 3, 7)] == [None] * 3
    assert got["img_6"]["image_array"] and got["img_8"]["image_array"] and got["img_9"]["image_array"]


def test_listing_hits_of_every_document(spark, sf_dir):
    got = source_queries.src_listing_hits(spark, sf_dir).select("api_id")
    documents = D.table(spark, sf_dir, "documents").select("doc_id")
    assert got.count() == documents.count()
    assert documents.exceptAll(got).isEmpty()


def test_empty_responses_come_on_top(spark, sf_dir):
    pages = D.table(spark, sf_dir, "documents").selectExpr(f"doc_id div {D.RESPONSE_SIZE} as page").distinct()
    texts = [r["value"] for r in D.responses(spark, sf_dir).collect()]
    empty = [t for t in texts if t == '{"total": 0}']
    assert len(empty) == pages.filter("page % 5 = 0").count() > 0
    assert len(texts) - len(empty) == pages.count()
