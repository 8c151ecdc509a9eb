"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of a fixed number of characters. The distinct
blocks are sorted and numbered; a number is the name of its block. Then
adjacent names are paired, the distinct pairs are numbered in turn, and so on
until each document has one name. Equal names at the same number of blocks mean
equal texts, because every number stands for exactly one content.

Content is shuffled once, after duplicates were merged inside each map task;
all other shuffles carry integers. Between the passes a block is looked up by a
128-bit hash; that no two contents share a hash is verified each time on the
sorted contents, and another seed is taken if it ever happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlens.llm.common import WHITE, by_place, discard, free_shuffles, stored, table, text_or_empty, with_row_keys, without_rows

BLOCK_CHARS = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def _blocks(text: Column, chars: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % chars), F.lit(0))


def _hashes(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + i), block) for i in range(2)]


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Each row gets an integer of its own: its place in the sorted rows of its task."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _block_names(keyed: DataFrame, chars: int) -> tuple[DataFrame, int]:
    """(h0, h1, name) for each distinct block, and the seed under which the hashes are unique."""
    seed = 0
    while True:
        block = F.explode(_blocks(normalised(text_or_empty()), chars)).alias("block")
        distinct = keyed.select(block).select(*[h.alias(f"h{i}") for i, h in enumerate(_hashes(F.col("block"), seed))], "block").distinct()
        names = stored(_numbered(distinct, "block").select("h0", "h1", "name"), "names")
        clashes = names.groupBy("h0", "h1").count().filter("count > 1")
        if clashes.isEmpty():
            free_shuffles(keyed.sparkSession)
            return names, seed
        discard(names)
        seed += 1


def name_documents(keyed: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Row keys, doc_id, n_chars_text, text_sha256 and the identity (n_blocks, name) of each row."""
    names, seed = _block_names(keyed, block_chars)
    text = normalised(text_or_empty())
    rows = stored(
        keyed.select("row_file", "row_index", "doc_id", F.char_length(text_or_empty()).cast("long").alias("n_points"), text.alias("norm"))
        .select("row_file", "row_index", "doc_id", "n_points", F.sha2("norm", 256).alias("text_sha256"), _blocks(F.col("norm"), block_chars).alias("blocks"))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "row_file",
            "row_index",
            "doc_id",
            "n_points",
            "text_sha256",
            F.size("blocks").alias("n_blocks"),
            F.transform("blocks", lambda b: F.struct(*[h.alias(f"h{i}") for i, h in enumerate(_hashes(b, seed))])).alias("hashes"),
        ),
        "rows",
    )
    level = stored(
        rows.select("row", "n_blocks", F.posexplode("hashes").alias("pos", "h"))
        .select("row", F.col("n_blocks").alias("left"), "pos", "h.h0", "h.h1")
        .join(names, ["h0", "h1"])
        .select("row", "left", "pos", "name"),
        "level",
    )
    discard(names)
    done = [level]
    named = level.filter("left = 1").select("row", "name")
    level = level.filter("left > 1")
    while not level.isEmpty():
        pairs = level.groupBy("row", "left", F.expr("pos div 2").alias("pos")).agg(
            F.max(F.when(F.expr("pos % 2 = 0"), F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.expr("pos % 2 = 1"), F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = stored(pairs, "pairs")
        names = stored(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "names")
        level = stored(pairs.join(names, ["a", "b"]).select("row", F.expr("cast((left + 1) div 2 as int)").alias("left"), "pos", "name"), "level")
        named = named.union(level.filter("left = 1").select("row", "name"))
        level = level.filter("left > 1")
    # an empty text has no block; its number of blocks, 0, is its identity
    ids = stored(rows.drop("hashes").join(named, "row", "left").withColumn("name", F.coalesce("name", F.lit(-1))), "ids")
    discard(rows, *done)
    return ids


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The decision for each row of ``docs``.

    Texts are equal when they are identical without white space. Of equal
    texts the row with the most code points stays, then the one with the
    smallest doc_id, then the first in the files. A null text counts as empty,
    and empty texts are equal; a null doc_id comes after all others. Repeated
    rows are separate members of their group. An empty table gives no rows.
    Other columns of ``docs``, whatever their names, are not read.
    """
    keyed = with_row_keys(docs.select("doc_id", "text"))
    ids = name_documents(keyed, block_chars)
    first = F.struct(
        (-F.col("n_points")).alias("order_points"),
        F.col("doc_id").isNull().alias("order_null"),
        F.col("doc_id").alias("keep_id"),
        F.col("row").alias("keep_row"),
    )
    # both sides of the last join are tables, so that a group of very many copies can be split
    groups = stored(ids.groupBy("n_blocks", "name").agg(F.min(first).alias("keep"), F.count("*").alias("group_size")), "groups")
    return ids.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("keep.keep_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.keep_row")).alias("kept"),
        "text_sha256",
        "row_file",
        "row_index",
    )


def deduplicated(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are, whatever their names."""
    keyed, texts = by_place(docs)
    decisions = stored(exact_duplicates(texts, block_chars), "decisions")
    return without_rows(keyed, decisions.filter("not kept"), docs.columns)


def op3_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("row_file", "row_index")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""
