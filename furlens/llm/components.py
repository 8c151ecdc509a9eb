"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlens.llm.common import discard, stored


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Large and small stars in turn (Kiveris et al. 2014): only links are
    shuffled, minima are combined before each shuffle, and a node with very
    many links is split by the skew handling of the join.
    """
    links = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while before != (now := _fingerprint(links)):
        before = now
        both = links.union(links.select("b", "a"))
        mins = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(mins, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stored(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "large")
        mins = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(mins, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = stored(hung.union(mins.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(links, large)
        links = following
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b"), F.col("b"))).distinct()
