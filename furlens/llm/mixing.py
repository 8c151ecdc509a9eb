"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power alpha, normalised. At
alpha = 1 the sources keep their shares, at 0 all weigh the same. Alpha is
bisected to the flattest mix that repeats no source more than a limit, or to a
target entropy. The weights then become token budgets: whole passes over a
source, and for the rest a prefix of one more pass. Each pass of a source is a
permutation of its own, by blocks: the first hex digits of a hash of seed, pass
and document are the block, the whole hash orders a block's documents.

The end of a prefix is found by sums over blocks: first over the 4,096 blocks of
each source, then over 4,096 parts of the one block in which the budget ends,
and so on. No source is ever sorted as a whole or gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furlens.llm.common import WORD, discard, small, stored, table, text_or_empty

MAX_REPEATS = 1.25
SEED = "mix"
HALVINGS_PER_PASS = 5
PASSES = 8
ALPHA_DIGITS = 6
LEVEL_DIGITS = (3, 6, 9, 12)  # hex digits that name a block at each level
KEY_DIGITS = 32


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def pass_key(number: Column, doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), number.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _measure(sources: DataFrame, alphas: list[float], what: str) -> list[float]:
    """For each alpha, the entropy of the weights or the most passes over any source.

    Every document is used at least once: the source that is weighted down most
    makes one pass, so the most passes are (largest share / smallest share) ** (1 - alpha).
    """
    share = F.col("share")
    if what == "repeats":
        low, high = sources.agg(F.min(share), F.max(share)).first()
        return [(high / low) ** (1 - a) for a in alphas]
    sums = []
    for a in alphas:
        power = F.pow(share, F.lit(a))
        sums += [F.sum(power), F.sum(power * F.log(share) * a)]
    row = sources.agg(*sums).first()
    return [math.log(row[2 * i]) - row[2 * i + 1] / row[2 * i] for i in range(len(alphas))]


def temperature(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None) -> float:
    """The bisected exponent, rounded to ALPHA_DIGITS; ``sources`` has positive shares that sum to 1.

    Five halvings are answered by one pass over the sources, so only 31 numbers
    reach the driver each time. ``entropy`` is a share of the largest possible
    one; it goes before ``max_repeats``.
    """
    target = entropy * math.log(sources.count()) if entropy is not None else max_repeats
    what = "entropy" if entropy is not None else "repeats"
    low, high = 0.0, 1.0  # both measures fall as alpha grows
    for _ in range(PASSES):
        n = 2**HALVINGS_PER_PASS
        inner = [low + (high - low) * i / n for i in range(1, n)]
        beyond = sum(m > target for m in _measure(sources, inner, what))
        low, high = low + (high - low) * beyond / n, low + (high - low) * (beyond + 1) / n
    return round(high, ALPHA_DIGITS)


def _cuts(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(source, cut): the largest key of the partial pass whose prefix of tokens is within the budget ``rest``.

    Equal keys stay together. A source without room for its first key has no row.
    """
    open_rows, budgets = rows, plans.select(F.col("source").alias("s"), "rest")
    cuts = None
    for digits in (*LEVEL_DIGITS, KEY_DIGITS):
        blocks = open_rows.groupBy("source", F.substring("key", 1, digits).alias("block")).agg(F.sum("tokens").alias("tokens"))
        up_to = F.sum("tokens").over(Window.partitionBy("source").orderBy("block"))
        # at most 16 ** 3 blocks of a source are in one window
        sums = blocks.withColumn("up_to", up_to).join(budgets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        sums = stored(sums, "sums")
        whole = sums.filter("up_to <= rest").groupBy("source").agg(F.max("block").alias("block"))
        cuts = whole.select("source", F.rpad("block", KEY_DIGITS, "f").alias("cut")) if cuts is None else cuts.union(whole.select("source", F.rpad("block", KEY_DIGITS, "f").alias("cut")))
        if digits == KEY_DIGITS:
            break
        ends = sums.filter("up_to > rest").groupBy("source").agg(F.min(F.struct("block", (F.col("rest") - F.col("up_to") + F.col("tokens")).alias("rest"))).alias("end"))
        ends = stored(ends.select("source", "end.*"), "ends")
        joined = open_rows.join(small(ends.select(F.col("source").alias("s"), F.col("block").alias("end"))), F.col("source").eqNullSafe(F.col("s")) & (F.substring("key", 1, digits) == F.col("end")))
        inside = stored(joined.select("source", "key", "tokens"), "block")
        discard(open_rows)
        open_rows, budgets = inside, ends.select(F.col("source").alias("s"), "rest")
    return cuts.groupBy("source").agg(F.max("cut").alias("cut"))


def mixed(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with ``mix_pass`` and ``mix_block``: a row for each time a row is used.

    Tokens are runs of characters other than ASCII white space. The budget is
    the smallest with which every source makes at least one whole pass, so no
    row is dropped; the other sources are repeated up to ``max_repeats`` times.
    A null source is a source of its own; columns
    mix_pass and mix_block that ``docs`` already has are replaced. Rows without tokens cost nothing and
    follow their key; a source without any token makes one pass. Rows with the
    same doc_id share their key and are used or left together; a null doc_id is
    keyed like an empty one. An empty table gives no rows. A source with a third
    of the rows is only ever summed by blocks.
    """
    text = text_or_empty()
    totals = docs.select("source", tokens(text).alias("tokens")).groupBy("source").agg(F.sum("tokens").alias("total"))
    filled = stored(totals.filter("total > 0"), "totals")
    n, all_tokens = filled.agg(F.count("*"), F.sum("total")).first()
    # own names for the columns that are carried, so that none of theirs can clash
    carried = [c for c in docs.columns if c not in ("mix_pass", "mix_block")]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)], F.col("doc_id").alias("id"), F.col("source").alias("origin"))
    if n:
        shares = filled.withColumn("share", F.col("total") / F.lit(all_tokens))
        alpha = temperature(shares, max_repeats, entropy)
        largest = shares.agg(F.max("share")).first()[0]
        # passes of a source in millionths: weight x budget / tokens, one for the largest source
        micro = F.round(F.pow(F.col("share") / F.lit(largest), F.lit(alpha - 1.0)) * 1e6).cast("long")
        plans = shares.withColumn("micro", micro).select(
            "source", F.expr("micro div 1000000").alias("whole"), F.expr("cast(cast(micro % 1000000 as decimal(20, 0)) * total div 1000000 as bigint)").alias("rest")
        )
        plans = stored(plans, "plans")
        partial_pass = small(plans.select(F.col("source").alias("s"), (F.col("whole") + 1).alias("number")))
        keyed = docs.select("source", "doc_id", tokens(text).alias("tokens")).join(partial_pass, F.col("source").eqNullSafe(F.col("s")))
        cuts = _cuts(stored(keyed.select("source", pass_key(F.col("number"), F.col("doc_id"), seed).alias("key"), "tokens"), "keys"), plans)
        cuts = cuts.withColumnRenamed("source", "s")
        plan = plans.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "whole", "cut")
        used = inner.join(small(stored(plan, "mix")), F.col("origin").eqNullSafe(F.col("source")), "left")
    else:
        used = inner.withColumns({"whole": F.lit(1).cast("long"), "cut": F.lit(None).cast("string")})
    once_more = pass_key(F.col("whole") + 1, F.col("id"), seed) <= F.col("cut")
    times = F.coalesce(F.col("whole"), F.lit(1)) + F.coalesce(once_more.cast("long"), F.lit(0))
    used = used.withColumn("mix_pass", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    block = F.substring(pass_key(F.col("mix_pass"), F.col("id"), seed), 1, LEVEL_DIGITS[0]).alias("mix_block")
    return used.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "mix_pass", block)


def op9_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "source", tokens(text_or_empty()).alias("tokens"), "mix_pass", "mix_block")


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
), totals AS (
  SELECT source, CAST(sum(tokens) AS BIGINT) AS total FROM d GROUP BY source HAVING sum(tokens) > 0
), shares AS (
  SELECT source, total, total / (SELECT sum(total) FROM totals) AS share FROM totals
), bisect(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1,
         CASE WHEN (SELECT max(share) / min(share) FROM shares) ** (1 - (low + high) / 2) > 1.25 THEN (low + high) / 2 ELSE low END,
         CASE WHEN (SELECT max(share) / min(share) FROM shares) ** (1 - (low + high) / 2) > 1.25 THEN high ELSE (low + high) / 2 END
  FROM bisect WHERE i < 40
), plans AS (
  SELECT source, micro // 1000000 AS whole,
         CAST(((micro % 1000000)::HUGEINT * total) // 1000000 AS BIGINT) AS rest
  FROM (SELECT source, total, CAST(round(pow(share / (SELECT max(share) FROM shares), (SELECT round(high, 6) FROM bisect WHERE i = 40) - 1.0) * 1e6) AS BIGINT) AS micro FROM shares)
), keyed AS (
  SELECT d.source, d.doc_id, d.tokens, p.whole, p.rest, md5('mix|' || CAST(p.whole + 1 AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source
), used AS (
  SELECT doc_id, source, tokens, whole + CAST(sum(tokens) OVER (PARTITION BY source ORDER BY k) <= rest AS BIGINT) AS times FROM keyed
  UNION ALL
  SELECT doc_id, source, tokens, 1 FROM d WHERE NOT EXISTS (SELECT 1 FROM plans p WHERE p.source IS NOT DISTINCT FROM d.source)
)
SELECT doc_id, source, tokens, mix_pass, substr(md5('mix|' || CAST(mix_pass AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3) AS mix_block
FROM (SELECT doc_id, source, tokens, unnest(range(1, times + 1)) AS mix_pass FROM used)
"""
