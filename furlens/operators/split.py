"""Stratified train/test split with exact quotas, without sorting the rows.

Each row gets a pseudo-random key, a hash of its id and a seed. The test set of
a label is its q rows with the smallest keys. Sorting all rows of a label to
number them would put half of the data into one task, so the q-th smallest key
is found by counting: count the rows per key prefix, find the prefix in which
the quota runs out, and go on inside it with the next digits. Counts combine in
the map tasks and only one boundary per label reaches the driver, so the rows
are never shuffled; the split itself is a filter.

Rows with equal ids share the first half of the key; a hash over the whole row
is its second half. Rows that are equal altogether are interchangeable: the
quota decides how many copies go to each side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

# Key digits added per counting level: four levels of id hash, four of row hash,
# so that a level counts at most 65,536 prefixes of a label.
_LEVELS = (4, 4, 4, 4, 4, 4, 4, 4)
_MAX_LABELS = 1000


def bounded_rows(df: DataFrame, id_column: str, most: int | None) -> DataFrame:
    """About ``most`` rows, those with the smallest hashes of their id; all rows if there are fewer or ``most`` is None.

    The share is computed from one count, so nothing is sorted or gathered. No
    query and no model uses it: all learn from all rows.
    """
    rows = df.count() if most is not None else 0
    if most is None or rows <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(id_column), F.lit(1 << 40)) < int((1 << 40) * most / rows))


@dataclass(frozen=True)
class Boundary:
    """Rows of ``label`` whose key starts below or with ``prefix`` are test rows.

    ``need`` of the ``inside`` rows that start with the prefix are wanted; the
    boundary is final when they are all wanted.
    """

    label: int
    prefix: str
    need: int
    inside: int

    @property
    def final(self) -> bool:
        return self.need == self.inside


ID_DIGITS = 16


def _id_key(id_column: str, seed: int) -> Column:
    return F.substring(F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f"|{seed}"))), 1, ID_DIGITS)


def _row_key(df: DataFrame, id_column: str, seed: int) -> Column:
    row_hash = F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), 16, "0"))
    return F.concat(_id_key(id_column, seed), row_hash)


def quotas(class_rows: dict, test_fraction: float) -> dict:
    """Test rows per label: ceil(fraction * rows) in all, shared out in proportion.

    Seats left over after rounding down go to the largest remainders, then to
    the smaller label.
    """
    rows = sum(class_rows.values())
    wanted = math.ceil(round(rows * test_fraction, 9))
    exact = {label: n * wanted / rows for label, n in class_rows.items()}
    quota = {label: math.floor(q) for label, q in exact.items()}
    by_remainder = sorted(exact, key=lambda label: (quota[label] - exact[label], label))
    for label in by_remainder[: wanted - sum(quota.values())]:
        quota[label] += 1
    return quota


def _narrow(keyed: DataFrame, open_: list[Boundary], digits: int) -> list[Boundary]:
    """Extend each open boundary by ``digits``; one aggregation, one row per label back."""
    inside = F.lit(False)
    need = F.lit(None).cast("bigint")
    for b in open_:
        here = (F.col("_label") == b.label) & F.startswith("_key", F.lit(b.prefix))
        inside = inside | here
        need = F.when(F.col("_label") == b.label, F.lit(b.need)).otherwise(need)
    start = len(open_[0].prefix)
    counts = (
        keyed.filter(inside)
        .groupBy("_label", F.substring("_key", 1, start + digits).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("_label").orderBy("prefix"))
    reached = (
        counts.withColumn("upto", upto)
        .withColumn("need", need)
        .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
    )
    return [
        Boundary(r["_label"], r["prefix"], r["need"] - (r["upto"] - r["n"]), r["n"])
        for r in reached.collect()
    ]


def boundaries(
    df: DataFrame, label: str, id_column: str, test_fraction: float, seed: int
) -> list[Boundary]:
    """The key up to which each label's rows are test rows."""
    # the first half of the key needs the id alone; other columns are read only if equal ids are at the boundary
    by_id = df.select(F.col(label).alias("_label"), _id_key(id_column, seed).alias("_key"))
    by_row = df.select(F.col(label).alias("_label"), _row_key(df, id_column, seed).alias("_key"))
    sizes = by_id.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).limit(_MAX_LABELS + 1).collect()
    if len(sizes) > _MAX_LABELS:
        raise ValueError(f"{label} has more than {_MAX_LABELS} distinct values")
    class_rows = {r["_label"]: r["n"] for r in sizes}
    if not class_rows:
        return []
    quota = quotas(class_rows, test_fraction)
    done = [Boundary(c, "", 0, 0) for c, q in quota.items() if q == 0]
    open_ = [Boundary(c, "", q, class_rows[c]) for c, q in quota.items() if q > 0]
    for level, digits in enumerate(_LEVELS):
        keyed = by_id if sum(_LEVELS[: level + 1]) <= ID_DIGITS else by_row
        done += [b for b in open_ if b.final]
        open_ = [b for b in open_ if not b.final]
        if open_:
            open_ = _narrow(keyed, open_, digits)
    return done + open_


def stratified_split(
    df: DataFrame,
    label: str = "label",
    id_column: str = "image_id",
    test_fraction: float = 0.3,
    seed: int = 42,
    out: str = "is_test",
) -> DataFrame:
    """Add a boolean ``out`` that is true for exactly the quota of test rows of each label.

    The counting reads label and id, a few times, when this is called; persist
    or store ``df`` first.
    """
    flag = F.lit(False)
    cut = F.lit(False)
    bounds = boundaries(df, label, id_column, test_fraction, seed)
    for b in bounds:
        mine = F.col(label) == b.label
        if b.inside:
            flag = F.when(mine, F.substring("_key", 1, len(b.prefix)) <= b.prefix).otherwise(flag)
        if not b.final:
            cut = cut | (mine & (F.col("_key") == b.prefix))
    keyed = df.withColumn("_key", _row_key(df, id_column, seed))
    plain = keyed.filter(~cut).withColumn(out, flag).drop("_key")
    halves = [b for b in bounds if not b.final]
    for b in halves:
        copies = keyed.filter((F.col(label) == b.label) & (F.col("_key") == b.prefix)).drop("_key")
        plain = plain.unionByName(_divide_copies(copies, b, out))
    return plain


def _divide_copies(copies: DataFrame, b: Boundary, out: str, chunk: int = 100_000) -> DataFrame:
    """Write ``b.need`` of ``b.inside`` equal rows as test rows and the others as train rows.

    One copy is kept and written out again in chunks that spread over tasks.
    """
    chunks = (
        copies.limit(1)
        .withColumn("_from", F.explode(F.sequence(F.lit(1), F.lit(b.inside), F.lit(chunk))))
        .repartition("_from")
    )
    last = F.least(F.lit(b.inside), F.col("_from") + F.lit(chunk - 1))
    numbered = chunks.withColumn("_i", F.explode(F.sequence(F.col("_from"), last)))
    return numbered.withColumn(out, F.col("_i") <= b.need).drop("_from", "_i")
