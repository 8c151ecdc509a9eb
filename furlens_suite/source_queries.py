"""Sources, sinks and read-back checks. Sinks write below the shared folder and read the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from furlens.functions.kernel import FEATURE_NAMES
from furlens.functions import tensors
from furlens.operators import acquisition as A, counts, performance
from furlens.operators import features as X
from furlens.plans import clean, load
from furlens.session import shared_dir
from furlens.sources import images as I, readers as R, schemas as S, writers as W
from furlens_suite import bitmaps, derived as D

ARRAY_DOCUMENT_ROWS = 50


def _written_text(spark: SparkSession, df: DataFrame, purpose: str, **options) -> str:
    path = shared_dir(spark, purpose)
    df.write.options(**options).text(path)
    return path


def src_listing_hits(spark, sf_dir):
    path = _written_text(spark, D.responses(spark, sf_dir), "listing")
    hits = A.listing_hits(R.read_listing_responses(spark, path, multi_line=False))
    return hits.withColumn("tags", F.md5("tags"))


LABEL_SQL = """case when cats > dogs then 0 when dogs > cats then 1 else -1 end"""


def tag_label_sql(source: str, columns: str) -> str:
    side = " + ".join
    t = "lower({c})"
    cats = side(f"cast(contains(lower(tags), '{w}') as int)" for w in ("cat", "kitten", "feline"))
    dogs = side(f"cast(contains(lower(tags), '{w}') as int)" for w in ("dog", "puppy", "canine"))
    return f"select {columns}, {LABEL_SQL} as label from (select *, {cats} as cats, {dogs} as dogs from {source})"


SRC_LISTING_HITS = D.ctes(D.LISTING) + tag_label_sql(
    "hits", "api_id, page_url, image_url, md5(tags) as tags, views, downloads, user"
)


def _metadata(spark, sf_dir) -> DataFrame:
    return D.pixels(spark, sf_dir).select(
        F.concat(F.lit("img_"), "vec_id").alias("image_id"),
        F.col("px").alias("image_array"),
        (F.col("label") % 2).cast("int").alias("label"),
        F.when(F.col("label") % 2 == 0, "cat").otherwise("dog").alias("keyword"),
        tensors.shape(F.col("px")).alias("original_shape"),
        F.concat(F.lit("t"), "label").alias("tags"),
        F.col("vec_id").alias("views"),
        "vec_id",
    )


def _array_documents(spark, sf_dir) -> str:
    """Files of one JSON array with at most ARRAY_DOCUMENT_ROWS records each."""
    record = F.to_json(F.struct("image_id", "image_array", "label", "keyword", "original_shape", "tags", "views"))
    bucket = F.expr(f"vec_id div {ARRAY_DOCUMENT_ROWS}").alias("bucket")
    documents = (
        _metadata(spark, sf_dir)
        .groupBy(bucket)
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ", "), F.lit("]")).alias("value"))
        .select("value")
    )
    return _written_text(spark, documents, "array", maxRecordsPerFile=1)


def src_json_array(spark, sf_dir):
    rows = R.read_json_array(spark, _array_documents(spark, sf_dir))
    return rows.select("image_id", "label", "keyword", "views", F.md5(F.to_json("image_array")).alias("pixels"))


SRC_JSON_ARRAY = D.ctes(D.PIXELS) + """
select concat('img_', vec_id) as image_id, cast(label % 2 as int) as label,
  case when label % 2 = 0 then 'cat' else 'dog' end as keyword, vec_id as views, md5(cast(to_json(px) as varchar)) as pixels
from pixels"""


def agg_count_array(spark, sf_dir):
    rows = R.read_json_array(spark, _array_documents(spark, sf_dir))
    return counts.count_all(rows, "image_id", "records")


AGG_COUNT_ARRAY = "select count(*) as records from embeddings having count(*) > 0"


def sink_ndjson(spark, sf_dir):
    path = shared_dir(spark, "ndjson")
    docs = D.table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("lang")
    )
    W.write_ndjson(docs, path)
    raw = R.read_lines(spark, path)
    back = raw.select(
        F.contains("value", F.lit('"lang":')).alias("has_lang"),
        F.from_json("value", docs.schema.simpleString()).alias("r"),
    )
    return back.select("r.doc_id", F.md5("r.text").alias("text"), "r.lang", "has_lang")


SINK_NDJSON = """select doc_id, md5(text) as text, case when doc_id % 3 > 0 then lang end as lang, true as has_lang
from documents"""


def src_text_lines(spark, sf_dir):
    path = _written_text(spark, D.lines(spark, sf_dir).select("value"), "lines")
    return R.read_lines(spark, path).select(F.md5("value").alias("line"))


SRC_TEXT_LINES = D.ctes(D.LINES) + "select md5(value) as line from lines"


def src_image_files(spark, sf_dir):
    """Bitmap files written from the image table, then decoded by Spark's image source."""
    folder = shared_dir(spark, "images")
    rgb = D.pixels(spark, sf_dir).select(
        F.concat(F.lit("img_"), "vec_id").alias("name"),
        F.transform("px", lambda row: F.transform(row, tensors.to_rgb)).alias("tensor"),
    )
    bitmaps.write_bitmaps(rgb, folder)
    decoded = I.read_images(spark, folder)
    return decoded.select("name", "height", "width", "channels", F.md5(F.to_json("tensor")).alias("pixels"))


SRC_IMAGE_FILES = D.ctes(D.PIXELS) + """
select concat('img_', vec_id) as name, 16 as height, 16 as width, 3 as channels,
  md5(cast(to_json(list_transform(px, lambda r: list_transform(r, lambda p:
    case when ch < 3 then [p[1], p[1], p[1]] else p[1:3] end))) as varchar)) as pixels
from pixels"""


def _records(spark, sf_dir) -> DataFrame:
    accepted = _metadata(spark, sf_dir).select(
        F.when(F.col("vec_id") % 5 > 0, F.col("vec_id")).alias("api_id"),
        F.col("vec_id").alias("position"),
        "keyword",
        F.concat(F.lit("https://example.com/"), "tags", F.lit(".jpg")).alias("image_url"),
        F.col("image_array").alias("tensor"),
        F.when(F.col("vec_id") % 2 == 0, F.lit(-1)).otherwise(F.col("label")).alias("label"),
        F.when(F.col("vec_id") % 7 > 0, F.col("tags")).alias("tags"),
        F.when(F.col("vec_id") % 3 > 0, F.col("views")).alias("views"),
        F.lit(None).cast("bigint").alias("downloads"),
        F.lit("someone").alias("user"),
    )
    resized = A.resize(accepted)
    return A.image_record(resized, "Example", F.lit("2024-01-02 03:04:05").cast("timestamp"))


def _record_view(records: DataFrame) -> DataFrame:
    return records.select(
        "image_id",
        F.md5(F.to_json("image_array")).alias("pixels"),
        "source_url",
        "description",
        "download_timestamp",
        "label",
        "keyword",
        F.array_join(F.col("original_shape").cast("array<string>"), "x").alias("original_shape"),
        "tags",
        "views",
        "downloads",
        "user",
    )


def resized_sql(column: str, source_side: str, side: int) -> str:
    """Nearest-neighbour RGB copy in DuckDB."""
    at = "cast(floor(({i} + 0.5) * {n} / " + str(side) + ") as int) + 1"
    row = f"{column}[{at.format(i='i', n=f'len({column})')}]"
    cell = f"{row}[{at.format(i='j', n=f'len({column}[1])')}]"
    return (
        f"list_transform(range(0, {side}), lambda i: list_transform(range(0, {side}), lambda j: "
        f"case when len({column}[1][1]) < 3 then [{cell}[1], {cell}[1], {cell}[1]] else {cell}[1:3] end))"
    )


PROJ_IMAGE_RECORD = D.ctes(D.PIXELS) + f"""
select concat(keyword, '_', vec_id) as image_id, md5(cast(to_json({resized_sql("px", "16", 64)}) as varchar)) as pixels,
  concat('https://example.com/t', label, '.jpg') as source_url, concat('Example ', keyword, ' image') as description,
  '2024-01-02 03:04:05' as download_timestamp,
  cast(case when vec_id % 2 = 0 then case keyword when 'cat' then 0 else 1 end else label % 2 end as int) as label, keyword,
  concat('16x16x', ch) as original_shape, case when vec_id % 7 > 0 then concat('t', label) else '' end as tags,
  case when vec_id % 3 > 0 then vec_id else 0 end as views, 0::bigint as downloads, 'someone' as user
from (select *, case when label % 2 = 0 then 'cat' else 'dog' end as keyword from pixels)"""


def proj_image_record(spark, sf_dir):
    return _record_view(_records(spark, sf_dir))


def sink_metadata_json(spark, sf_dir):
    path = shared_dir(spark, "metadata")
    W.write_table(_records(spark, sf_dir), path, "json")
    return _record_view(spark.read.schema(S.IMAGE_METADATA).json(path))


def _clean_outputs(spark, sf_dir) -> str:
    raw = _written_text(spark, D.lines(spark, sf_dir).select("value"), "lines")
    out = shared_dir(spark, "clean")
    clean.run(spark, raw, out, fmt="json")
    return out


def sink_clean_json(spark, sf_dir):
    out = _clean_outputs(spark, sf_dir)
    rows = R.read_clean(spark, f"{out}/valid").agg(F.count(F.lit(1)).alias("count"))
    by_label = spark.read.schema(S.CATEGORY_STATS).json(f"{out}/category_stats")
    by_word = spark.read.schema(S.KEYWORD_STATS).json(f"{out}/keyword_stats")
    return (
        rows.select(F.lit("valid").alias("output"), F.lit("").alias("key"), "count")
        .unionByName(by_label.select(F.lit("category").alias("output"), F.col("label").cast("string").alias("key"), "count"))
        .unionByName(by_word.select(F.lit("keyword").alias("output"), F.col("keyword").alias("key"), "count"))
    )


SINK_CLEAN_JSON = D.ctes(D.VALID) + """
select 'valid' as output, '' as key, count(*) as count from valid
union all select 'category', cast(label as varchar), count(*) from valid group by label
union all select 'keyword', keyword, count(*) from valid group by keyword"""


def src_clean_json(spark, sf_dir):
    rows = R.read_clean(spark, f"{_clean_outputs(spark, sf_dir)}/valid")
    return rows.select("image_id", "label", "keyword", "tags", F.md5("image_array").alias("image_array"), "original_shape")


SRC_CLEAN_JSON = D.ctes(D.VALID) + """
select image_id, label, keyword, tags, md5(image_array) as image_array, original_shape from valid"""


def sink_features_json(spark, sf_dir):
    path = shared_dir(spark, "features")
    W.write_features(D.feature_rows(spark, sf_dir), path, "json")
    rows = R.read_features(spark, path)
    values = [D.rounded(F.get("image_features", F.lit(i))).alias(n) for i, n in enumerate(FEATURE_NAMES)]
    return rows.select("image_id", "label", "keyword", "tags", *values, "original_shape")


SINK_FEATURES_JSON = D.ctes(D.VALID_VECTORS) + f"""
select image_id, label, keyword, tags, {", ".join(f"{D.rounded(n)} as {n}" for n in FEATURE_NAMES)}, original_shape
from valid join vectors using (image_id)"""


def chk_readback_count(spark, sf_dir):
    path = shared_dir(spark, "features")
    seen = Observation()
    rows = D.feature_rows(spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("written"))
    W.write_features(rows, path)
    return W.readback_count(spark, path, schema=rows.schema).withColumn("written", F.lit(seen.get["written"]).cast("bigint"))


CHK_READBACK_COUNT = D.ctes(D.VALID_VECTORS) + """
select count(*) as saved, count(*) as written from valid join vectors using (image_id)"""


def chk_input_files(spark, sf_dir):
    path = _written_text(spark, D.lines(spark, sf_dir).select("value").repartition(5), "lines")
    return R.input_files(R.read_lines(spark, path))


def src_feature_lines(spark, sf_dir):
    path = _written_text(spark, D.feature_lines(spark, sf_dir), "feature_lines")
    rows = R.parse_feature_lines(R.read_lines(spark, path))
    return rows.select(
        F.when(F.col("parsed"), F.col("image_id")).alias("image_id"),
        "parsed",
        F.when(F.col("parsed"), F.col("label")).otherwise(-1.0).alias("label"),
        F.when(F.col("parsed"), F.size("image_features")).otherwise(0).alias("n"),
    )


SRC_FEATURE_LINES = D.ctes(D.FEATURE_LINES) + "select image_id, parsed, label, n from parsed_lines"


def _loaded(spark, sf_dir) -> tuple[dict, str]:
    path = shared_dir(spark, "loaded")
    return load.load(D.feature_lines(spark, sf_dir), path), path


def src_feature_rejects(spark, sf_dir):
    """Every rejected line with its reason."""
    return load.rejected_lines(spark, _loaded(spark, sf_dir)[1])


def src_feature_valid(spark, sf_dir):
    """Every valid row with all its values, as text of whole numbers."""
    rows = load.valid_rows(spark, _loaded(spark, sf_dir)[1])
    return rows.select("image_id", "label", F.to_json(F.col("image_features").cast("array<bigint>")).alias("image_features"))


def agg_load_outcomes(spark, sf_dir):
    """Lines per outcome, as observed during the write."""
    counts_ = _loaded(spark, sf_dir)[0]
    return spark.createDataFrame(list(counts_.items()), "outcome string, lines bigint")


_REASONS = D.FEATURE_LINES.replace("select json_extract_string(j, '$.image_id')", "select value, j, json_extract_string(j, '$.image_id')").replace(
    "(select try_cast(trim(value) as json) as j from feature_lines)", "(select value, try_cast(trim(value) as json) as j from feature_lines)"
) + """,
told as (
  select *, case when not parsed then 'malformed' when n = 0 then 'no features' when n <= 10 then 'few features'
    when label not in (0, 1) then 'label' end as reason
  from parsed_lines)"""
SRC_FEATURE_REJECTS = D.ctes(_REASONS) + "select value as line, reason from told where reason is not null"
SRC_FEATURE_VALID = D.ctes(_REASONS) + """
select image_id, cast(label as int) as label, replace(cast(json_extract(j, '$.image_features') as varchar), ' ', '') as image_features
from told where reason is null"""
AGG_LOAD_OUTCOMES = D.ctes(_REASONS) + """
select outcome, count(told.value) as lines
from (select unnest(['valid', 'malformed', 'no features', 'few features', 'label']) as outcome)
left join told on outcome = coalesce(reason, 'valid') group by outcome"""


def sink_runs_csv(spark, sf_dir):
    path = shared_dir(spark, "runs")
    W.write_runs_csv(D.model_runs(spark, sf_dir), path)
    schema = "config string, model string, accuracy double, f1_score double, training_time double"
    return spark.read.schema(schema).option("header", True).csv(path)


SINK_RUNS_CSV = D.ctes(D.RUNS) + """
select config, model_name as model, accuracy, f1_score, training_time from model_runs where success"""


def sink_report_json(spark, sf_dir):
    path = shared_dir(spark, "report")
    info = X.data_info(D.rows(spark, sf_dir), "driver tables", "features")
    report = performance.full_report(
        D.model_runs(spark, sf_dir), D.config_runs(spark, sf_dir), info, "driver tables", [1, 2, 4, 6]
    )
    W.write_table(report, path, "json")
    return spark.read.schema(report.schema).json(path)


def sink_report_simple(spark, sf_dir):
    path = shared_dir(spark, "report")
    report = performance.simple_report(D.model_runs(spark, sf_dir), D.config_runs(spark, sf_dir))
    W.write_table(report, path, "json")
    back = spark.read.schema(report.schema).json(path)
    return back.withColumn("avg_accuracy", F.round("avg_accuracy", 6))


CONFIG_SUMMARY = D.ctes(D.RUNS) + """
select m.config, round(avg(accuracy), 6) as avg_accuracy, first(total_time) as total_time, count(*) as successful_models
from model_runs m join config_runs c on m.config = c.config where success group by m.config"""

QUERIES = {
    "src_listing_hits": (src_listing_hits, SRC_LISTING_HITS),
    "src_json_array": (src_json_array, SRC_JSON_ARRAY),
    "agg_count_array": (agg_count_array, AGG_COUNT_ARRAY),
    "sink_ndjson": (sink_ndjson, SINK_NDJSON),
    "src_text_lines": (src_text_lines, SRC_TEXT_LINES),
    "src_image_files": (src_image_files, SRC_IMAGE_FILES),
    "proj_image_record": (proj_image_record, PROJ_IMAGE_RECORD),
    "sink_metadata_json": (sink_metadata_json, PROJ_IMAGE_RECORD),
    "sink_clean_json": (sink_clean_json, SINK_CLEAN_JSON),
    "src_clean_json": (src_clean_json, SRC_CLEAN_JSON),
    "sink_features_json": (sink_features_json, SINK_FEATURES_JSON),
    "chk_readback_count": (chk_readback_count, CHK_READBACK_COUNT),
    "chk_input_files": (chk_input_files, "select least(5, count(*)) as files from embeddings"),
    "src_feature_lines": (src_feature_lines, SRC_FEATURE_LINES),
    "src_feature_rejects": (src_feature_rejects, SRC_FEATURE_REJECTS),
    "src_feature_valid": (src_feature_valid, SRC_FEATURE_VALID),
    "agg_load_outcomes": (agg_load_outcomes, AGG_LOAD_OUTCOMES),
    "sink_runs_csv": (sink_runs_csv, SINK_RUNS_CSV),
    "sink_report_json": (sink_report_json, None),
    "sink_report_simple": (sink_report_simple, CONFIG_SUMMARY),
}
