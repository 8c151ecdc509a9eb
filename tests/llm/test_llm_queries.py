"""Registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from furlens.llm.queries import REGISTERED
from furlens.session import shared_dir

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTERED.items() if sql])
def test_query_against_duckdb(spark, name):
    query, sql = REGISTERED[name]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.sql(sql)
    columns = sorted(expected.columns)
    want = sorted(map(repr, expected.project(", ".join(columns)).limit(10**7).fetchall()))
    found = query(spark, SF)
    assert sorted(found.columns) == columns
    rows = found.select(*columns).collect()
    assert sorted(repr(tuple(r)) for r in rows) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        path = shared_dir(spark, "stage")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
    assert 0 < kept.select("doc_id").distinct().count() <= docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert pieces.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
