"""License scan by MinHash over overlapping windows.

Templates are whole license texts, and notices and sentences that stand for one.
Those of fewer words than a shingle are searched as they are. The others are
grouped by length. For each group, the text's word shingles are
covered by overlapping windows, so that every run as long as a template lies in
one window. MinHash values of the windows, in bands, retrieve templates that
share a band; the number of bands is set so that a window with enough of a
template collides with it with at least the required probability. What was
retrieved is verified by exact shingle containment.

Templates are a bounded parameter list; everything else is built-in functions.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.functions.once import with_columns_once
from furlens.llm.common import table, text_or_empty

WORDS = 5  # words of a shingle
CONTAINMENT = 0.8
COLLISION = 0.999
MASK_SEED = "license band"
TOKEN = r"[\p{L}\p{N}]+"

# Texts of license notices, fixed values.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MIT-distributed": "Distributed under the MIT License",
    "MIT-licensed": "Licensed under the MIT License",
    "Apache-2.0-compliance": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-redistribution": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-redistribution": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "ISC-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "All-rights-reserved": "All rights reserved.",
}
# Whole license texts, without the lines that name a holder.
TEXTS = {
    f"{f.name.removesuffix('.txt')}-text": f.read_text(encoding="utf-8")
    for f in sorted(resources.files("furlens.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name)
    if f.name.endswith(".txt")
}
TEMPLATES = {**NOTICES, **TEXTS}


def _template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


class Group:
    """Templates of similar length with the windows and bands that find them."""

    def __init__(self, templates: dict[str, list[str]], containment: float, collision: float):
        self.templates = templates
        counts = [len(self.shingles(w)) for w in templates.values()]
        shortest, longest = min(counts), max(counts)
        self.step = max(1, shortest // 4)
        self.window = longest + self.step - 1
        # the least likeness of a window that contains enough of a template: it has nothing else in common
        likeness = min((n_found := math.ceil(containment * n)) / (self.window + n - n_found) for n in counts)
        self.bands = 1 if likeness >= 1 else math.ceil(math.log(1 - collision) / math.log(1 - likeness))

    @staticmethod
    def shingles(words: list[str]) -> list[str]:
        return list(dict.fromkeys(" ".join(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))))


def grouped(templates: dict[str, str], containment: float = CONTAINMENT, collision: float = COLLISION) -> list[Group]:
    by_length: dict[int, dict[str, list[str]]] = defaultdict(dict)
    for name, text in sorted(templates.items()):
        words = _template_words(text)
        if len(words) < WORDS:
            continue  # see short
        n = len(Group.shingles(words))
        by_length[n if n < 8 else 8 * 2 ** int(math.log2(n / 8))][name] = words
    return [Group(by_length[n], containment, collision) for n in sorted(by_length)]


def short(templates: dict[str, str]) -> dict[str, list[str]]:
    """The templates of fewer words than a shingle: each is one shingle, and its windows are as long."""
    found = {name: words for name, text in sorted(templates.items()) if len(words := _template_words(text)) < WORDS}
    for name, words in found.items():
        if not words:
            raise ValueError(f"template {name} has no words")
    return found


def _short_found(rows: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """doc_id, license, start and share of the places of short templates in rows of doc_id and text."""
    gap = r"[^\p{L}\p{N}]+"
    rows = rows.filter(F.lower("text").rlike("|".join(gap.join(words) for words in templates.values())))
    rows = with_columns_once(rows, {"words": F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))})

    def places(name: str, words: list[str]) -> Column:
        def here(i: Column) -> Column:
            equal = [F.get("words", i + j) == F.lit(word) for j, word in enumerate(words)]
            for more in equal[1:]:
                equal[0] = equal[0] & more
            return equal[0]

        starts = F.when(F.size("words") >= len(words), F.sequence(F.lit(0), F.size("words") - len(words))).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(starts, here), lambda i: F.struct(F.lit(name).alias("license"), i.alias("start")))

    found = rows.select("doc_id", F.explode(F.concat(*[places(*t) for t in templates.items()])).alias("at"))
    return found.select("doc_id", "at.*", F.lit(1.0).alias("share")).dropDuplicates(["doc_id", "license", "start"])


def _mask(band: int) -> int:
    """A fixed number whose bitwise difference to a hash is the band's order of hashes."""
    low, high = zlib.crc32(f"{MASK_SEED} {band}".encode()), zlib.crc32(f"{band} {MASK_SEED}".encode())
    value = (high << 32 | low) if band else 0
    return value - 2**64 if value >= 2**63 else value


def _ordered(band: int) -> Column:
    """The shingle hashes as numbers in the order of a band."""
    return F.transform("h", lambda x: x.bitwiseXOR(F.lit(_mask(band))))


def _shingle_hashes(words: Column) -> Column:
    starts = F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get("hashed", i + j) for j in range(WORDS)]))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, collision: float = COLLISION) -> DataFrame:
    """doc_id, license, n_windows, containment and first_word for each license found in a row of ``docs``.

    Words are runs of letters and digits in lower case. n_windows counts the
    windows that contain at least ``containment`` of the template's shingles,
    containment is the largest share, first_word the place where the first such
    window begins. A null, empty or short text has no match. Repeated rows are
    scanned as one document if their doc_id is equal, null included. A template
    of fewer words than a shingle is found where all of it stands. An empty table
    gives no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    groups, brief = grouped(templates, containment, collision), short(templates)
    parts = ([_long_found(spark, texts, groups, containment)] if groups else []) + ([_short_found(texts, brief)] if brief else [])
    verified = reduce(DataFrame.unionByName, parts)
    return verified.groupBy("doc_id", "license").agg(F.count("*").alias("n_windows"), F.max("share").alias("containment"), F.min("start").cast("long").alias("first_word"))


def _long_found(spark: SparkSession, texts: DataFrame, groups: list[Group], containment: float) -> DataFrame:
    """doc_id, license, start and share of the windows of texts that hold enough of a template."""
    most = max(g.bands for g in groups)

    listed = [(g, name, i, Group.shingles(words)) for g, group in enumerate(groups) for i, (name, words) in enumerate(group.templates.items())]
    known = spark.createDataFrame([(g, name, shingles) for g, name, _, shingles in listed], "group int, license string, shingles array<string>")
    hashes = F.transform("shingles", lambda s: F.xxhash64(*[F.get(F.transform(F.split(s, " "), lambda w: F.xxhash64(w)), F.lit(j)) for j in range(WORDS)]))
    minima = F.transform(F.array(*[F.lit(_mask(b)) for b in range(most)]), lambda m: F.array_min(F.transform("hashes", lambda h: h.bitwiseXOR(m))))
    known = known.withColumn("hashes", hashes).withColumn("minima", minima)
    values: dict[tuple[int, int], list[int]] = defaultdict(list)
    for g, row_minima in known.select("group", "minima").collect():  # the parameter list, hashed
        for b in range(groups[g].bands):
            values[g, b].append(row_minima[b])

    rows = with_columns_once(texts, {"words": F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))}).drop("text")
    rows = with_columns_once(rows, {"hashed": F.transform("words", lambda w: F.xxhash64(w))})
    rows = with_columns_once(rows, {"h": _shingle_hashes(F.col("words"))}).drop("hashed")
    # a window collides in a band only if it holds the shingle that is the template's minimum there
    least_shingles = [sorted({v ^ _mask(b) for (of, b), found in values.items() if of == g for v in found}) for g in range(len(groups))]
    rows = rows.filter(F.arrays_overlap("h", F.array(*[F.lit(v).cast("long") for v in sorted(set().union(*least_shingles))])))
    places = F.sequence(F.lit(0), F.size("h") - 1)

    def held(least: list[int]) -> Column:
        return F.filter(places, lambda i: F.get("h", i).isin(least))

    rows = with_columns_once(rows, {f"near{g}": held(least) for g, least in enumerate(least_shingles)})
    rows = with_columns_once(rows, {"orders": F.array(*[_ordered(b) for b in range(most)])})

    def starts(g: int, group: Group) -> Column:
        """Where windows begin that share a band with a template of the group."""
        last = F.ceil(F.greatest(F.size("h") - group.window, F.lit(0)) / group.step).cast("int")
        every = F.when(F.size("h") > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

        def hit(i: Column) -> Column:
            least = [F.array_min(F.slice(F.get("orders", F.lit(b)), i * group.step + 1, F.lit(group.window))).isin(values[g, b]) for b in range(group.bands)]
            any_band = least[0]
            for more in least[1:]:
                any_band = any_band | more
            return any_band

        def near(i: Column) -> Column:
            return F.exists(f"near{g}", lambda at: (at >= i * group.step) & (at < i * group.step + group.window))

        return F.transform(F.filter(F.filter(every, near), hit), lambda i: F.struct(F.lit(g).alias("group"), (i * group.step).alias("start"), F.lit(group.window).alias("window")))

    hits = rows.select("doc_id", "words", "h", "orders", F.explode(F.concat(*[starts(g, group) for g, group in enumerate(groups)])).alias("hit"))
    own = F.transform("orders", lambda o: F.array_min(F.slice(o, F.col("hit.start") + 1, F.col("hit.window"))))
    window_words = F.slice("words", F.col("hit.start") + 1, F.col("hit.window") + WORDS - 1)
    hits = hits.select("doc_id", "hit.*", window_words.alias("words"), own.alias("own"))
    banded = F.broadcast(known.select("group", "license", F.posexplode("minima").alias("band", "value")))
    found = hits.select("doc_id", "group", "start", "words", F.posexplode("own").alias("band", "value")).join(banded, ["group", "band", "value"])
    found = found.select("doc_id", "license", "start", "words").dropDuplicates(["doc_id", "license", "start"])
    found = found.join(F.broadcast(known.select("license", "shingles")), "license")
    there = F.transform(F.sequence(F.lit(0), F.size("words") - WORDS), lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(WORDS)]))
    share = F.size(F.array_intersect(there, F.col("shingles"))) / F.size("shingles")
    return with_columns_once(found, {"share": share}).filter(F.col("share") >= containment).select("doc_id", "license", "start", "share")


def op1_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Every window against every template, without bands."""
    listed = []
    for group in grouped(TEMPLATES):
        for name, words in group.templates.items():
            listed.append((name, group.window, group.step, WORDS, words))
    listed += [(name, 1, 1, len(words), words) for name, words in short(TEMPLATES).items()]
    rows = ",\n  ".join(f"('{name}', {window}, {step}, {k}, '{' '.join(words)}')" for name, window, step, k, words in listed)
    return rf"""
WITH listed(license, w, step, k, words) AS (VALUES
  {rows}
), templates AS (
  SELECT license, w, step, k, list_distinct(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS t
  FROM (SELECT *, string_split(words, ' ') AS ws FROM listed)
), words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS ws FROM documents
), s AS (
  SELECT doc_id, k, list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' ')) AS sh
  FROM words, (SELECT DISTINCT k FROM templates) WHERE len(ws) >= k
), candidates AS (
  SELECT doc_id, license, w, step, t, sh FROM s JOIN templates ON s.k = templates.k AND list_has_any(sh, t)
), windows AS (
  SELECT doc_id, license, t, i * step AS start, sh[i * step + 1 : i * step + w] AS part
  FROM (SELECT *, unnest(range(0, CAST(ceil(greatest(len(sh) - w, 0) / step) AS BIGINT) + 1)) AS i FROM candidates)
), shares AS (
  SELECT doc_id, license, start, len(list_intersect(list_distinct(part), t)) / len(t) AS share FROM windows
)
SELECT doc_id, license, count(*) AS n_windows, max(share) AS containment, min(start) AS first_word
FROM shares WHERE share >= {CONTAINMENT} GROUP BY doc_id, license
"""


OP1_SQL = _oracle()
