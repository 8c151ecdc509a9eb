"""What the tasks of the toxicity stage hold beside each other."""

import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from furlens.llm import packing, toxicity
from furlens.llm.common import per_process


def batch(n):
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} other text " * 40 for i in range(n)]
    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 == 0 for i in range(n)])], names=["text", "positive"])


def totals(parts):
    out = {}
    for part in parts:
        for feature, n, toxic in zip(*(c.to_pylist() for c in part.columns)):
            a, b = out.get(feature, (0, 0))
            out[feature] = a + n, b + toxic
    return out


def test_counting_drops_what_another_operator_remembered():
    made = []
    per_process(("remembered words",), lambda: made.append(1) or "large")
    list(toxicity._counted(iter([batch(3)])))
    per_process(("remembered words",), lambda: made.append(1) or "large")
    assert made == [1, 1]


def test_counting_in_slices_of_a_megabyte_gives_the_same_sums(monkeypatch):
    rows = batch(3000)
    assert pc.sum(pc.binary_length(rows.column(0))).as_py() > 2_000_000
    parts = list(toxicity._counted(iter([rows])))
    assert len(parts) >= 3
    monkeypatch.setattr(toxicity, "COUNTED_BYTES", 1 << 40)
    whole = list(toxicity._counted(iter([rows])))
    assert len(whole) == 1 and totals(parts) == totals(whole)


TEXTS = [f"plain text number {chr(97 + i % 26)}{chr(97 + i // 26)} of many" + " horrid words" * (i % 7 == 3) for i in range(300)] + [None, "", " "]


def documents(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 7 == 3)) for i in range(0, 300, 2)], "doc_id long, toxic int")


def test_each_text_is_sent_to_the_workers_once(spark, capsys):
    docs, labels = documents(spark)
    kept = toxicity.non_toxic(docs, labels)
    kept.explain("formatted")
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "text_scored" not in plan
    predicted = toxicity.score_documents(docs, labels).filter("predicted = 0").join(docs, "doc_id")
    assert sorted(map(str, kept.collect())) == sorted(map(str, predicted.select("doc_id", "text").collect()))
    assert 200 < kept.count() < len(TEXTS)


def test_a_text_of_another_type_is_scored_as_a_string(spark):
    docs, labels = documents(spark)
    kept = toxicity.non_toxic(docs.withColumn("text", F.col("text").cast("binary")), labels)
    assert kept.schema["text"].dataType.simpleString() == "binary"
    strings = toxicity.non_toxic(docs, labels)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in strings.collect())


def test_vectors_count_only_the_words_that_hold_a_feature():
    names = ["=horrid", "4numb", "6number", "=absent"]
    x = toxicity.Vectors(names).matrix(pa.array([t or "" for t in TEXTS]))
    for row, text in zip(x, TEXTS):
        words = toxicity.LETTERS.findall((text or "").lower())
        n = Counter(f for w in words for f in toxicity.features_of(w))
        assert np.allclose(row[: len(names)], [np.log1p(n[f]) for f in names])
    assert np.all(toxicity.Vectors(names).matrix(pa.array(["", "only others"]))[:, : len(names)] == 0)


def test_scoring_holds_one_batch_at_a_time():
    def batches():
        for _ in range(4):
            yield pa.RecordBatch.from_arrays([pa.array(["few words " * 100] * 20_000), pa.array(range(20_000))], names=["text", "doc_id"])
            held.append(pa.total_allocated_bytes() - before)

    held, before = [], pa.total_allocated_bytes()
    out = toxicity._score(batches(), names=["=few"], weights=np.zeros(4), steady=-1.0, at=0, keep=0)
    assert sum(part.num_rows for part in out) == 80_000
    assert max(held) < 10_000_000  # a batch has 20 MB and is gone when the next is asked for


def test_the_encoder_leaves_other_cores_to_other_tasks(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    packing.WordEncoder(packing.default_tokenizer())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")  # the user's own choice stays
    packing.WordEncoder(packing.default_tokenizer())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "true"
