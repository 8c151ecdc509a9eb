"""The feature vector, its parts, and the checks on it.

The part queries run the native expressions over every image text;
``feat_vector`` runs the Arrow form over the same texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from furlens.functions import kernel, tensors
from furlens.functions.kernel import FEATURE_NAMES, N_FEATURES
from furlens.operators import counts
from furlens.operators import features as X
from furlens.sources.readers import parse_feature_lines
from furlens_suite import derived as D


def _named(vector: str = "image_features", names=FEATURE_NAMES):
    return [D.rounded(F.get(vector, F.lit(FEATURE_NAMES.index(n)))).alias(n) for n in names]


def _named_sql(names=FEATURE_NAMES) -> str:
    return ", ".join(f"{D.rounded(n)} as {n}" for n in names)


def feat_vector(spark, sf_dir):
    rows = X.keep_extracted(X.with_features(D.arrays(spark, sf_dir)))
    return rows.select("image_id", *_named())


def feat_vector_native(spark, sf_dir):
    rows = X.keep_extracted(X.with_features(D.arrays(spark, sf_dir), engine="native"))
    return rows.select("image_id", *_named())


def _part(*names):
    """A query for some named features, and its SQL."""

    def query(spark, sf_dir):
        rows = X.keep_extracted(X.with_features(D.arrays(spark, sf_dir), engine="native", names=names))
        return rows.select("image_id", *[D.rounded(F.get("image_features", F.lit(i))).alias(n) for i, n in enumerate(names)])

    return query, D.ctes(D.ARRAY_VECTORS) + f"select image_id, {_named_sql(names)} from vectors"


def _rgb(stat):
    return _part(*[f"{c}_{stat}" for c in ("red", "green", "blue")])


def feat_parse(spark, sf_dir):
    rows = kernel.with_tensor(D.arrays(spark, sf_dir))
    t = F.col("tensor")
    return rows.select(
        "image_id",
        t.isNotNull().alias("parsed"),
        F.when(t.isNotNull(), tensors.height(t)).alias("height"),
        F.when(t.isNotNull(), tensors.width(t)).alias("width"),
        F.when(t.isNotNull(), tensors.channels(t)).alias("channels"),
    )


FEAT_PARSE = D.ctes(D.ARRAYS, D.TENSORS.format(source="arrays")) + """
select a.image_id, t is not null as parsed, cast(len(t) as int) as height, cast(len(t[1]) as int) as width,
  cast(len(t[1][1]) as int) as channels
from arrays a left join tensors using (image_id)"""


def feat_channel(spark, sf_dir):
    rows = kernel.with_tensor(D.arrays(spark, sf_dir)).filter("tensor is not null")
    return rows.select(
        "image_id", F.md5(F.to_json(tensors.channel(F.col("tensor"), 0))).alias("channel")
    )


FEAT_CHANNEL = D.ctes(D.ARRAYS, D.TENSORS.format(source="arrays")) + """
select image_id, md5(cast(to_json(list_transform(flatten(t), lambda p: cast(trunc(p[1]) as int))) as varchar)) as channel
from tensors"""


def feat_single_channel(spark, sf_dir):
    """Images with one or two channels: the three colours have the same statistics."""
    rows = kernel.with_tensor(D.arrays(spark, sf_dir)).filter(tensors.channels(F.col("tensor")) < 3)
    names = ("red_mean", "green_mean", "blue_mean", "red_p75", "blue_p75", "gray_mean")
    return kernel.with_feature_vector(rows).select("image_id", *_named(names=names))


FEAT_SINGLE_CHANNEL = D.ctes(D.ARRAY_VECTORS) + f"""
select image_id, {_named_sql(("red_mean", "green_mean", "blue_mean", "red_p75", "blue_p75", "gray_mean"))}
from vectors where image_id in (select image_id from tensors where len(t[1][1]) < 3)"""


def feat_gray(spark, sf_dir):
    rows = kernel.with_channels(kernel.with_tensor(D.arrays(spark, sf_dir)).filter("tensor is not null"))
    return rows.select(
        "image_id",
        F.size("_gray").alias("n"),
        F.round(F.aggregate("_gray", F.lit(0.0), lambda a, g: a + g), 6).alias("total"),
    )


FEAT_GRAY = D.ctes(D.ARRAY_VECTORS) + """
select image_id, cast(count(*) as int) as n, round(sum(gray), 6) as total from grays group by image_id"""


def filt_nonempty_features(spark, sf_dir):
    return X.keep_extracted(D.features(spark, sf_dir)).select("image_id", "label")


FILT_NONEMPTY = D.ctes(D.VALID_VECTORS) + "select image_id, label from valid join vectors using (image_id)"


def _parsed(spark, sf_dir):
    return parse_feature_lines(D.feature_lines(spark, sf_dir))


def filt_feature_rows(spark, sf_dir):
    kept = X.keep_trainable(_parsed(spark, sf_dir).filter("parsed"))
    return kept.select("image_id", F.col("label").cast("int").alias("label"), F.size("image_features").alias("n"))


FILT_FEATURE_ROWS = D.ctes(D.FEATURE_LINES) + """
select image_id, cast(label as int) as label, n from parsed_lines where parsed and n > 10 and label in (0, 1)"""


def agg_extract_outcome(spark, sf_dir):
    return X.extract_outcome(D.features(spark, sf_dir))


AGG_EXTRACT_OUTCOME = D.ctes(D.VALID_VECTORS) + f"""
select count(*) as total, count(red_mean) as ok, count(*) - count(red_mean) as failed,
  case when count(red_mean) > 0 then {N_FEATURES} end as dim
from valid left join vectors using (image_id)"""


def agg_quality_report(spark, sf_dir):
    return X.quality_report(_parsed(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


AGG_QUALITY_REPORT = D.ctes(D.FEATURE_LINES) + """
select valid, invalid, round(valid / (valid + invalid) * 100, 6) as pct, valid < 10 as few from (
  select count_if(good) as valid, count_if(not good) as invalid
  from (select coalesce(parsed and n > 10 and label in (0, 1), false) as good from parsed_lines))"""


def agg_class_distribution(spark, sf_dir):
    return counts.class_distribution(D.feature_rows(spark, sf_dir))


AGG_CLASS_DISTRIBUTION = D.ctes(D.VALID_VECTORS) + """
select label, count(*) as count from valid join vectors using (image_id) group by label order by label"""


def agg_matrix_stats(spark, sf_dir):
    stats = X.matrix_stats(D.feature_rows(spark, sf_dir))
    return stats.select(
        "samples", "features", *[F.round(c, 6).alias(c) for c in ("feature_min", "feature_max", "feature_mean")]
    )


_CELLS = """,
long as (select image_id, value as v from (
  unpivot (select vectors.* from vectors join valid using (image_id)) on columns(* exclude image_id) into name name value value))"""
AGG_MATRIX_STATS = D.ctes(D.VALID_VECTORS + _CELLS) + f"""
select count(distinct image_id) as samples, {N_FEATURES} as features, round(min(v), 6) as feature_min,
  round(max(v), 6) as feature_max, round(avg(v), 6) as feature_mean from long"""


def chk_hardcoded(spark, sf_dir):
    return X.hardcoded_check(D.feature_rows(spark, sf_dir)).select("image_id", "status")


_STATUS = """select image_id, case when count_if(abs(v) >= 1e-6) = 0 then 'suspicious'
  when max(v) - min(v) > 1.0 and count_if(abs(v) > 1e-6) > 0 then 'normal' else 'narrow' end as status
from long group by image_id"""
CHK_HARDCODED = D.ctes(D.VALID_VECTORS + _CELLS) + _STATUS


def chk_row_stats(spark, sf_dir):
    stats = X.row_stats(D.feature_rows(spark, sf_dir))
    return stats.select(
        "image_id", "n", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "nonzero"
    )


CHK_ROW_STATS = D.ctes(D.VALID_VECTORS + _CELLS) + """
select image_id, cast(count(*) as int) as n, round(min(v), 6) as min, round(max(v), 6) as max, round(avg(v), 6) as mean,
  round(stddev_pop(v), 6) as std, cast(count_if(abs(v) > 1e-6) as int) as nonzero
from long group by image_id"""


def chk_report(spark, sf_dir):
    return X.feature_report(D.features(spark, sf_dir))


CHK_REPORT = D.ctes(D.VALID_VECTORS + _CELLS) + f"""
select (select count(*) from ({_STATUS}) where status = 'suspicious') = 0 as no_hardcoding,
  (select count(*) from valid) as original, (select count(distinct image_id) from long) as valid, {N_FEATURES} as dim"""

_ALL_SQL = D.ctes(D.ARRAY_VECTORS) + f"select image_id, {_named_sql()} from vectors"

QUERIES = {
    "feat_vector": (feat_vector, _ALL_SQL),
    "feat_vector_native": (feat_vector_native, _ALL_SQL),
    "feat_parse": (feat_parse, FEAT_PARSE),
    "feat_channel": (feat_channel, FEAT_CHANNEL),
    "feat_color_mean": _rgb("mean"),
    "feat_color_std": _rgb("std"),
    "feat_color_median": _rgb("median"),
    "feat_color_p25": _rgb("p25"),
    "feat_color_p75": _rgb("p75"),
    "feat_single_channel": (feat_single_channel, FEAT_SINGLE_CHANNEL),
    "feat_gray": (feat_gray, FEAT_GRAY),
    "feat_gray_mean": _part("gray_mean"),
    "feat_gray_std": _part("gray_std"),
    "feat_gray_var": _part("gray_var"),
    "feat_entropy": _part("entropy"),
    "feat_contrast": _part("contrast"),
    "feat_gray_min": _part("gray_min"),
    "feat_gray_max": _part("gray_max"),
    "feat_gray_p10": _part("gray_p10"),
    "feat_gray_p90": _part("gray_p90"),
    "filt_nonempty_features": (filt_nonempty_features, FILT_NONEMPTY),
    "filt_feature_rows": (filt_feature_rows, FILT_FEATURE_ROWS),
    "agg_extract_outcome": (agg_extract_outcome, AGG_EXTRACT_OUTCOME),
    "agg_quality_report": (agg_quality_report, AGG_QUALITY_REPORT),
    "agg_class_distribution": (agg_class_distribution, AGG_CLASS_DISTRIBUTION),
    "agg_matrix_stats": (agg_matrix_stats, AGG_MATRIX_STATS),
    "chk_hardcoded": (chk_hardcoded, CHK_HARDCODED),
    "chk_row_stats": (chk_row_stats, CHK_ROW_STATS),
    "chk_report": (chk_report, CHK_REPORT),
}
