"""Language of web pages by fusing evidence.

Four kinds of evidence are combined by Bayes' rule: the likelihood of the text
under models of character trigrams, the language that the markup declares, the
last part of the host's name, and a prior of the host. Host priors, and how
often a declaration or a suffix goes with a language, are summed over all pages
by grouped aggregation of the text's own probabilities; hosts lean on their
domain, domains on their suffix, and suffixes on all pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import sliced, small, stored, table, text_or_empty
from furlens.llm.html_text import main_text

MAX_TRAINING = 20_000  # expected bound of the sample of labelled documents
MAX_LANGUAGES = 200  # bound of the languages that are told apart, a part of the model's size
BUCKETS = 1 << 15
SMOOTHING = 0.5
EVIDENCE = 200  # trigrams of one text do not count as more than this many
PRIOR_WEIGHT = 5.0  # pages that a parent counts for

DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([a-z]{2,3})\b"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def trigram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of all texts in a row, and the bounds of each text."""
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    empty = pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(empty, low, empty, pa.scalar(" ", pa.large_string()))
    spaced = spaced.combine_chunks() if isinstance(spaced, pa.ChunkedArray) else spaced
    offsets = np.frombuffer(spaced.buffers()[1], dtype=np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint32) if len(spaced) and offsets[-1] > offsets[0] else np.zeros(0, np.uint32)
    gram = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) if len(data) > 2 else np.zeros(0, np.uint32)
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(32 - 15)
    bounds = offsets - offsets[0]
    ends = np.maximum(bounds[1:] - 2, bounds[:-1])
    return bucket, np.stack([bounds[:-1], np.minimum(ends, len(bucket))], axis=1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 0):
        languages = batch.column(1).to_pylist()
        bucket, bounds = trigram_buckets(batch.column(0))
        totals: dict[str, np.ndarray] = {}
        for language, (a, b) in zip(languages, bounds.tolist()):
            if b > a:
                totals[language] = totals.get(language, 0) + np.bincount(bucket[a:b], minlength=BUCKETS)
        for language, counts in totals.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], names=["lang", "bucket", "n"]
            )


def _likelihoods(batches: Iterator[pa.RecordBatch], model, evidence: int) -> Iterator[pa.RecordBatch]:
    """Log likelihood of each page's text under each language, at most ``evidence`` trigrams strong; ``model`` is a broadcast variable."""
    model = model.value
    for batch in (part for whole in batches for part in sliced([whole], whole.num_columns - 1)):
        texts = pa.array([main_text(page) for page in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
        bucket, bounds = trigram_buckets(texts)
        scores = np.zeros((len(texts), len(model)))
        for i, (a, b) in enumerate(bounds.tolist()):
            if b > a:
                scores[i] = model[:, bucket[a:b]].sum(1) * (min(b - a, evidence) / (b - a))
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(scores.tolist(), pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "likelihood"])


def train(docs: DataFrame, max_training: int = MAX_TRAINING, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities of trigram buckets, from a bounded sample of labelled documents."""
    labelled = docs.select("doc_id", text_or_empty().alias("text"), F.col("lang").alias("lang")).filter("lang is not null")
    n = labelled.count()
    if n > max_training:
        labelled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_training / n))
    sums = stored(labelled.select("text", "lang").mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    # the most frequent languages of the sample, a bounded number
    languages = sorted(r[0] for r in sums.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect())
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    rows = sums.filter(F.col("lang").isin(languages)).toPandas() if languages else None  # at most BUCKETS values each
    if rows is not None:
        np.add.at(counts, (np.searchsorted(languages, rows["lang"]), rows["bucket"]), rows["n"])
    return languages, np.log(counts / counts.sum(1, keepdims=True))


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _softmax(logs: Column) -> Column:
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def identified(pages: DataFrame, docs: DataFrame, max_training: int = MAX_TRAINING, max_languages: int = MAX_LANGUAGES, evidence: int = EVIDENCE) -> DataFrame:
    """page_id, url, host, declared, suffix, lang and confidence of each row of ``pages``.

    A page without text, declaration or host rests on what is left; with nothing
    at all it gets the most likely language of all pages. A page's own text does
    not count towards its priors. Null addresses have the empty host. Ties go to
    the first language in the alphabet. Repeated rows count each. Without any
    labelled document, lang and confidence are null; without pages there are no
    rows. ``max_languages``, the most frequent ones of the sample, are told apart.
    The whole text is read, and its mean log likelihood counts for ``evidence``
    trigrams at most, because neighbouring trigrams are no independent evidence.
    Only page_id, url and html, and doc_id, text and lang, are read.
    """
    languages, model = train(docs, max_training, max_languages)
    k = len(languages)
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), page.alias("html")).select(
        "page_id", "url", _host(F.col("url")).alias("host"), F.lower(F.regexp_extract("html", DECLARED, 1)).alias("declared"), "html"
    )
    if not k:
        return rows.select("page_id", "url", "host", "declared", F.substring_index("host", ".", -1).alias("suffix"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    rows = rows.mapInArrow(partial(_likelihoods, model=pages.sparkSession.sparkContext.broadcast(model), evidence=evidence), "page_id long, url string, host string, declared string, likelihood array<double>")
    rows = rows.withColumns({"suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2), "p": _softmax(F.col("likelihood"))})
    rows = stored(rows, "likelihoods")

    def sums(*by: str) -> DataFrame:
        total = F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(k)])
        return stored(rows.groupBy(*by).agg(total.alias("n_" + (by[-1] if by else "all"))), "sums")

    found = rows
    for by in ("host", "domain", "suffix", "declared"):
        found = found.join(small(sums(by)), by)
    everything = list(sums().first()[0])
    found = found.withColumn("n_all", F.array(*[F.lit(float(x)) for x in everything]))

    def but_own(name: str, i: int) -> Column:
        return F.greatest(F.get(name, F.lit(i)) - F.get("p", F.lit(i)), F.lit(0.0))

    def total(name: str) -> Column:
        return sum((but_own(name, i) for i in range(1, k)), but_own(name, 0))

    prior = F.array(*[(but_own("n_all", i) + 1) / (total("n_all") + k) for i in range(k)])
    for level in ("suffix", "domain", "host"):
        found = found.withColumn("above", prior)
        prior = F.array(*[(but_own(f"n_{level}", i) + PRIOR_WEIGHT * F.get("above", F.lit(i))) / (total(f"n_{level}") + PRIOR_WEIGHT) for i in range(k)])
        found = found.withColumn(f"prior_{level}", prior)
        prior = F.col(f"prior_{level}")
    # how often pages of a language have this declaration or this suffix
    logs = []
    for i in range(k):
        parts = [F.get("likelihood", F.lit(i)), F.log(F.get("prior_host", F.lit(i)))]
        for name in ("declared", "suffix"):
            share = (but_own(f"n_{name}", i) + 1) / (but_own("n_all", i) + k)
            parts.append(F.when(F.col(name) != "", F.log(share)).otherwise(0.0))
        logs.append(sum(parts[1:], parts[0]))
    found = found.withColumn("logs", F.array(*logs)).withColumn("posterior", _softmax(F.col("logs")))
    names = F.array(*[F.lit(x) for x in languages])
    return found.select("page_id", "url", "host", "declared", "suffix", F.get(names, F.array_position("logs", F.array_max("logs")).cast("int") - 1).alias("lang"), F.array_max("posterior").alias("confidence"))


def op6_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
