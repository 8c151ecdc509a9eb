"""Toxicity by non-negative positive-unlabelled learning.

Known toxic texts and texts without a label train several linear classifiers.
The risk is corrected by the class prior: the negative part is the unlabelled
risk less the prior times the positives' risk, and where that falls below zero
its gradient is reversed (Kiryo et al. 2017). Features are words and word
beginnings that are over-represented in the toxic texts; a score is the mean of
the classifiers' log odds, mapped to 0..1. All documents are scored in one pass
without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from furlens.llm.common import forget, sliced, stored, table, text_or_empty

MAX_POSITIVE = 20_000  # expected bound of the sample of labelled rows
MAX_UNLABELLED = 20_000
N_FEATURES = 512
MIN_TEXTS = 3
MIN_EXCESS = 5.0  # in standard errors; some hundred thousand features are compared
CLASSIFIERS = 4
PREFIXES = (4, 5, 6)
STEPS = 400
RATE = 0.1
L2 = 1e-4
HELD_OUT = 5
COUNTED_BYTES = 1_000_000  # of text at a time, whose words and beginnings are held as Python strings

LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word, *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]


def _words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Number of words of each text, the distinct words, and each word's place among them."""
    pool = pa.system_memory_pool()  # gives back at once what the default one would keep for this worker's next slice
    lower = pc.utf8_lower(pc.cast(texts, pa.large_string(), memory_pool=pool), memory_pool=pool)
    split = pc.split_pattern_regex(lower, r"[^\p{L}]+", memory_pool=pool)
    counts = np.diff(split.offsets.to_numpy(zero_copy_only=False))
    coded = pc.dictionary_encode(split.flatten(), memory_pool=pool)
    return counts, coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, texts, positive texts), summed over each slice."""
    forget()
    for batch in sliced(batches, 0, COUNTED_BYTES):
        counts, words, codes = _words(batch.column(0))
        positive = np.asarray(batch.column(1).to_pylist(), dtype=bool)
        ids: dict[str, int] = {}
        own = [[ids.setdefault(f, len(ids)) for f in features_of(w)] if w else [] for w in words]
        total, toxic = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        ends = np.cumsum(counts)
        for start, end, label in zip(ends - counts, ends, positive):
            seen = list({f for w in np.unique(codes[start:end]).tolist() for f in own[w]})
            total[seen] += 1
            toxic[seen] += int(label)
        yield pa.RecordBatch.from_arrays([pa.array(list(ids), pa.string()), pa.array(total), pa.array(toxic)], names=["feature", "texts", "positives"])


class Vectors:
    """Sparse counts of the chosen features."""

    def __init__(self, names: list[str]):
        self.place = {name: i for i, name in enumerate(names)}
        self.size = len(names)

    def matrix(self, texts: pa.Array) -> np.ndarray:
        """Per text: log counts, roots of the rates, log length; dense, a few thousand texts at a time."""
        counts, words, codes = _words(texts)
        pairs = [(i, self.place[f]) for i, w in enumerate(words) if w for f in features_of(w) if f in self.place]
        found = np.zeros((len(counts), self.size))
        if pairs:
            word, feature = np.array(pairs).T
            starts = np.searchsorted(word, np.arange(len(words) + 1))
            held = np.flatnonzero(np.diff(starts)[codes])  # few words hold a feature
            rows, codes = np.searchsorted(np.cumsum(counts), held, side="right"), codes[held]
            n = np.diff(starts)[codes]
            ends = np.cumsum(n)
            which = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - n), n)
            flat = np.repeat(rows, n) * self.size + feature[which]
            found = np.bincount(flat, minlength=found.size).reshape(found.shape).astype(float)
        length = np.maximum(counts, 1)
        return np.hstack([np.log1p(found), 10 * np.sqrt(found / length[:, None]), np.log(length)[:, None] / 5])


def nn_pu_fit(x: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, l2: float = L2) -> np.ndarray:
    """Weights and offset that minimise the non-negative risk on positive and unlabelled rows."""
    return _descent(np.hstack([x, np.ones((len(x), 1))]), positive, prior, steps, rate, l2)


def _descent(x: np.ndarray, positive: np.ndarray, prior: float, steps: int, rate: float, l2: float) -> np.ndarray:
    """``nn_pu_fit`` of rows that end in a one, for the offset; makes no copy of them."""
    w, squares = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    n_pos, n_un = max(1, positive.sum()), max(1, (~positive).sum())
    for _ in range(steps):
        z = np.clip(x @ w, -30, 30)
        s, as_negative = 1 / (1 + np.exp(-z)), np.logaddexp(0, z)
        negative_risk = as_negative[~positive].sum() / n_un - prior * as_negative[positive].sum() / n_pos
        slope = np.where(positive, -prior / n_pos * s, s / n_un)  # of the negative part
        slope = slope - np.where(positive, prior / n_pos * (1 - s), 0) if negative_risk >= 0 else -slope
        gradient = x.T @ slope
        gradient[:-1] += l2 * w[:-1]
        squares += gradient**2
        w -= rate * gradient / np.sqrt(squares)
    return w


def _vectors(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    forget()
    vectors = Vectors(names)
    for batch in sliced(batches, 0):
        for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
            x = vectors.matrix(part.column(0)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([r.tobytes() for r in x], pa.binary())], names=["positive", "part", "x"])


def _train(rows: pd.DataFrame, prior: float) -> pd.DataFrame:
    rows = rows.sort_values("x", kind="stable")
    positive = rows["positive"].to_numpy(dtype=bool)
    x = np.ones((len(rows), len(rows["x"].iloc[0]) // 4 + 1))
    for i, b in enumerate(rows["x"]):
        x[i, :-1] = np.frombuffer(b, dtype=np.float32)
    return pd.DataFrame({"weights": [_descent(x, positive, prior, STEPS, RATE, L2).tolist()]})


def _score(batches: Iterator[pa.RecordBatch], names: list[str], weights: np.ndarray, steady: float, at: int, keep: int) -> Iterator[pa.RecordBatch]:
    """The first ``keep`` columns and a score of the text in column ``at``, null as empty."""
    forget()
    vectors = Vectors(names)
    for part in (part.slice(i, 1000) for part in sliced(batches, at) for i in range(0, part.num_rows, 1000)):
        texts = pc.fill_null(part.column(at), "")
        z = vectors.matrix(texts) @ weights[:-1] + weights[-1] if len(weights) else np.full(part.num_rows, steady)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        yield pa.RecordBatch.from_arrays([*part.columns[:keep], pa.array(score)], names=[*part.schema.names[:keep], "score"])


class Toxicity:
    """A fitted scorer: feature names and averaged weights, a bounded number of values."""

    def __init__(self, names: list[str], weights: np.ndarray, prior: float):
        self.names, self.weights, self.prior = names, weights, prior

    def scored(self, docs: DataFrame, keep: list[Column], text: Column | int) -> DataFrame:
        """``keep`` columns and a ``score`` of the whole ``text`` of each row, null as empty.

        A number as ``text`` means the column of that place in ``keep``, whose
        texts then are not sent to the workers a second time.
        """
        at, more = (text, []) if isinstance(text, int) else (len(keep), [text.alias("text_scored")])
        chosen = docs.select(*keep, *more)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keep)])
        steady = float(np.log(max(self.prior, 1e-6) / max(1 - self.prior, 1e-6)))
        work = partial(_score, names=self.names, weights=self.weights, steady=min(steady, -1e-6), at=at, keep=len(keep))
        return chosen.mapInArrow(work, f"{schema}, score double")


def _sample(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of ``df``, those with the smallest hashes of doc_id; all rows if there are fewer."""
    n = df.count()
    return df if n <= most else df.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / n))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, n_features: int = N_FEATURES) -> Toxicity:
    """Fit on known toxic documents and documents without label.

    Labels are read only where crc32(doc_id as text) mod 5 is not 0. The sample
    of toxic rows and that of unlabelled rows are each bounded (in expectation)
    by a parameter; the class prior and the sizes are counted over all labels.
    Unlabelled rows are documents whose label was not read, other than the held
    out ones; repeated labels of a document count as toxic if one of them is.
    Null labels, ids and texts are left out of the fit. Without a toxic row,
    any unlabelled row or any telling feature, every score is below 0.5.
    """
    known = (
        labels.select("doc_id", "toxic")
        .filter("doc_id is not null and toxic is not null")
        .filter(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = stored(known, "labels")
    share = known.agg(F.avg("toxic")).first()[0]
    prior = float(share or 0.0)
    texts = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    positives = F.broadcast(_sample(known.filter("toxic = 1").select("doc_id"), max_positive))
    # the unlabelled rows are a sample of all, the known toxic ones included: their labels are not looked at
    others = texts.select("doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT != 0)
    unlabelled = F.broadcast(_sample(others, max_unlabelled).distinct())
    sample = texts.join(positives.withColumn("positive", F.lit(True)).union(unlabelled.withColumn("positive", F.lit(False))).hint("broadcast"), "doc_id")
    sample = stored(sample.select("text", "positive", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CLASSIFIERS)).alias("part")), "sample")

    counts = sample.mapInArrow(_counted, "feature string, texts long, positives long").groupBy("feature").agg(F.sum("texts").alias("texts"), F.sum("positives").alias("positives"))
    n_pos, n_un = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_pos or not n_un:
        return Toxicity([], np.zeros(0), prior)
    rate_pos, rate_un = F.col("positives") / n_pos, (F.col("texts") - F.col("positives")) / n_un
    both = F.col("texts") / (n_pos + n_un)
    excess = (rate_pos - rate_un) / F.sqrt(both * (1 - both) * (1 / n_pos + 1 / n_un) + 1e-9)
    best = counts.filter(F.col("positives") >= MIN_TEXTS).select("feature", excess.alias("excess")).filter(F.col("excess") > MIN_EXCESS).orderBy(F.desc("excess"), "feature").limit(n_features)
    names = [r[0] for r in best.collect()]  # at most n_features names
    if not names:
        return Toxicity([], np.zeros(0), prior)
    vectors = sample.mapInArrow(partial(_vectors, names=names), "positive boolean, part long, x binary")
    fitted = vectors.groupBy("part").applyInPandas(partial(_train, prior=prior), "weights array<double>").collect()
    return Toxicity(names, np.mean([r[0] for r in fitted], axis=0), prior)


def score_documents(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``.

    A null or empty text gets the score of a text without words. Repeated rows
    are scored each by itself; a null doc_id counts as not held out; an empty
    table gives no rows. Columns other than doc_id and text are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT == 0, F.lit(False)).alias("held_out")
    scored = fit(docs, labels, **bounds).scored(docs, [F.col("doc_id"), held_out], text_or_empty())
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def non_toxic(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """Rows of ``docs`` that are not predicted to be toxic, all columns as they are."""
    columns = docs.columns
    text = columns.index("text") if docs.schema["text"].dataType == StringType() else text_or_empty()
    kept = fit(docs, labels, **bounds).scored(docs, [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], text)
    return kept.filter("score < 0.5").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def op2_nn_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
