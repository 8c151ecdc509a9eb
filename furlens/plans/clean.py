"""Clean stage: raw lines to valid records and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from furlens.operators import cleaning as C, counts
from furlens.sources.readers import read_lines
from furlens.sources.writers import write_table


def valid_records(lines: DataFrame, min_chars: int = C.MIN_ARRAY_CHARS, mode: str = "regex", fields: tuple[str, ...] = C.FIELDS) -> DataFrame:
    """Extract, filter, cast, filter: one map-side pass."""
    return (
        C.extract_fields(lines, mode=mode, fields=fields)
        .transform(C.keep_clean, min_chars)
        .transform(C.cast_label)
        .transform(C.keep_label_domain)
    )


def run(spark: SparkSession, lines_path: str, out: str, fmt: str = "parquet", stats_fmt: str = "json") -> dict:
    """Write valid records, category and keyword counts under ``out``; return the totals.

    Each raw line is read once. The totals are observed during that write; the
    grouped counts then read two narrow columns of the written records.
    """
    seen, kept = Observation(), Observation()
    lines = read_lines(spark, lines_path).observe(seen, F.count("value").alias("total_lines"))
    valid = valid_records(lines).observe(kept, F.count("image_id").alias("valid_records"))
    write_table(valid, f"{out}/valid", fmt)
    stored = spark.read.schema(valid.schema).format(fmt).load(f"{out}/valid")
    write_table(counts.category_stats(stored), f"{out}/category_stats", stats_fmt)
    write_table(counts.keyword_stats(stored), f"{out}/keyword_stats", stats_fmt)
    totals = {**seen.get, **kept.get}
    totals["summary"] = f"{counts.SUMMARY_PREFIX}{totals['valid_records']}"
    return totals
