"""Compute costly columns exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose expressions a later filter cannot pull in again.

    Catalyst moves a filter below a projection by copying the projected
    expressions into it, which runs a regular expression or a JSON parse twice,
    and more often when projections are stacked. It does not move filters on
    generated columns, so the columns are generated from a one-element array.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
