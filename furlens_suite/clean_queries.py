"""Extraction, filters, labels, counts and per-keyword limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from furlens.functions import labels
from furlens.operators import acquisition as A, cleaning as C, counts
from furlens_suite import derived as D
from furlens_suite.source_queries import resized_sql, tag_label_sql


def _short(df):
    """Hash the long array text, keep the other columns."""
    return df.withColumn("image_array", F.md5("image_array"))


def proj_regex_fields(spark, sf_dir):
    return _short(D.extracted(spark, sf_dir))


def proj_json_fields(spark, sf_dir):
    """The parsed form of every line; a value that does not fit its type is NULL, the line's other fields stay."""
    return _short(C.extract_fields(D.lines(spark, sf_dir), mode="json"))


_WHOLE = "('BIGINT', 'UBIGINT', 'NULL')"
_NONE_BUT = "len(list_filter(json_extract(j, '{path}'), lambda x: json_type(x) not in {types})) = 0"
PROJ_JSON_FIELDS = D.ctes(D.LINES) + f"""
select json_extract_string(j, '$.image_id') as image_id,
  case when json_type(j, '$.label') in {_WHOLE} then cast(try_cast(json_extract_string(j, '$.label') as integer) as varchar) end as label,
  json_extract_string(j, '$.keyword') as keyword, json_extract_string(j, '$.tags') as tags,
  case when {_NONE_BUT.format(path='$.image_array[*]', types="('ARRAY', 'NULL')")}
    and {_NONE_BUT.format(path='$.image_array[*][*]', types="('ARRAY', 'NULL')")}
    and {_NONE_BUT.format(path='$.image_array[*][*][*]', types=_WHOLE)}
    then md5(cast(json_extract(j, '$.image_array') as varchar)) end as image_array,
  cast(json_extract(j, '$.original_shape') as varchar) as original_shape
from (select cast(value as json) as j from lines)"""


def proj_cast_label(spark, sf_dir):
    return C.cast_label(D.extracted(spark, sf_dir, ("image_id", "label")))


def filt_clean(spark, sf_dir):
    return _short(C.keep_clean(D.extracted(spark, sf_dir)))


def filt_label_domain(spark, sf_dir):
    typed = C.cast_label(C.keep_clean(D.extracted(spark, sf_dir)))
    return _short(C.keep_label_domain(typed))


def filt_http_response(spark, sf_dir):
    return A.keep_image_responses(D.fetch_log(spark, sf_dir)).select("page_id", "url", "content_type")


def filt_image_format(spark, sf_dir):
    return A.keep_image_formats(D.fetch_log(spark, sf_dir)).select("page_id", "format", "mode", "width", "height")


def filt_image_url(spark, sf_dir):
    """Page addresses, every fourth with an image suffix put on its path."""
    pages = D.table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "case when page_id % 4 = 0 then concat('https://img.example.com/A', page_id, '.JPG?x=1') "
        "when page_id % 4 = 1 then '  ' else url end as url",
    )
    return A.keep_image_urls(pages, "example.net")


FILT_IMAGE_URL = """select * from (
  select page_id, case when page_id % 4 = 0 then concat('https://img.example.com/A', page_id, '.JPG?x=1')
    when page_id % 4 = 1 then '  ' else url end as url from pages)
where trim(url) <> '' and (
  regexp_matches(lower(regexp_extract(url, '^[^/]*//[^/?#]*([^?#]*)', 1)), '[.](jpg|jpeg|png|webp)$')
  or contains(regexp_extract(url, '^[^/]*//([^/?#]*)', 1), 'example.net'))"""


def filt_image_content(spark, sf_dir):
    return A.keep_content(D.images(spark, sf_dir)).select("vec_id", "label")


CONTENT_SQL = "len({t}) >= 10 and len({t}[1]) >= 10 and len(list_distinct(flatten({t}))) >= 10"
FILT_IMAGE_CONTENT = D.ctes(D.PIXELS, D.TENSOR_IMAGES) + (
    f"select vec_id, label from images where {CONTENT_SQL.format(t='tensor')}"
)


def filt_content_twice(spark, sf_dir):
    kept = A.keep_content_twice(D.images(spark, sf_dir))
    return kept.select("vec_id", F.md5(F.to_json("resized")).alias("resized"))


FILT_CONTENT_TWICE = D.ctes(D.PIXELS, D.TENSOR_IMAGES) + f"""
select vec_id, md5(cast(to_json(r) as varchar)) as resized from (
  select vec_id, {resized_sql("tensor", "16", 64)} as r from images where {CONTENT_SQL.format(t='tensor')})
where {CONTENT_SQL.format(t='r')}"""


def proj_resize(spark, sf_dir):
    return A.resize(D.images(spark, sf_dir)).select("vec_id", F.md5(F.to_json("resized")).alias("resized"))


PROJ_RESIZE = D.ctes(D.PIXELS, D.TENSOR_IMAGES) + f"""
select vec_id, md5(cast(to_json({resized_sql("tensor", "16", 64)}) as varchar)) as resized from images"""


def proj_preview(spark, sf_dir):
    tagged = D.tagged(spark, sf_dir)
    return counts.preview(tagged.select("doc_id", "tags", "keyword"), ["doc_id", "tags", "keyword"])


PROJ_PREVIEW = D.ctes(D.TAGGED) + """
select doc_id, case when length(tags) > 30 then concat(tags[1:27], '...') else tags end as tags, keyword
from tagged order by doc_id limit 5"""


def proj_array_length(spark, sf_dir):
    return C.array_length_sample(D.extracted(spark, sf_dir, ("image_id", "image_array")))


def limit_sample(spark, sf_dir):
    return counts.sample_rows(D.extracted(spark, sf_dir, ("image_id", "label")), 10, ["image_id"])


def label_from_tags(spark, sf_dir):
    return D.tagged(spark, sf_dir).select("doc_id", labels.tag_label(F.col("tags")).alias("label"))


def label_assign(spark, sf_dir):
    assigned = labels.assigned_label(F.col("url"), F.col("keyword"))
    by_link = labels.assigned_label(F.col("url"))
    return D.tagged(spark, sf_dir).select("doc_id", assigned.alias("label"), by_link.alias("label_by_url"))


_LINK_SQL = """case when contains(lower(url), 'cat') then 0 when contains(lower(url), 'dog') then 1
    else cast(contains('13579bdf', substr(md5(concat(lower(url), '|42')), 1, 1)) as int) end"""
_ASSIGN_SQL = f"""case when contains(lower(keyword), 'cat') then 0 when contains(lower(keyword), 'dog') then 1
    else {_LINK_SQL} end"""
LABEL_ASSIGN = D.ctes(D.TAGGED) + f"""
select doc_id, {_ASSIGN_SQL} as label, {_LINK_SQL} as label_by_url from tagged"""


def label_effective(spark, sf_dir):
    tag = labels.tag_label(F.col("tags"))
    return D.tagged(spark, sf_dir).select(
        "doc_id", labels.effective_label(tag, F.col("url"), F.col("keyword")).alias("label")
    )


LABEL_EFFECTIVE = D.ctes(D.TAGGED) + f"""
select doc_id, case when label = -1 then {_ASSIGN_SQL} else label end as label
from ({tag_label_sql("tagged", "doc_id, url, keyword")})"""


def agg_count_lines(spark, sf_dir):
    return counts.line_count(D.lines(spark, sf_dir))


def agg_valid_count(spark, sf_dir):
    return counts.valid_count(D.valid(spark, sf_dir, C.COUNTED_FIELDS))


def agg_category_stats(spark, sf_dir):
    return counts.category_stats(D.valid(spark, sf_dir, C.COUNTED_FIELDS))


def agg_keyword_stats(spark, sf_dir):
    return counts.keyword_stats(D.valid(spark, sf_dir, C.COUNTED_FIELDS))


def agg_summary_text(spark, sf_dir):
    return counts.summary_text(D.valid(spark, sf_dir, C.COUNTED_FIELDS))


def agg_label_counts(spark, sf_dir):
    return counts.label_counts(D.valid(spark, sf_dir, C.COUNTED_FIELDS))


def agg_keyword_success(spark, sf_dir):
    kept = A.keep_content(D.images(spark, sf_dir))
    return counts.keyword_success(kept.withColumn("keyword", F.concat(F.lit("k"), "label")))


AGG_KEYWORD_SUCCESS = D.ctes(D.PIXELS, D.TENSOR_IMAGES) + f"""
select concat('k', label) as keyword, count(*) as downloads from images
where {CONTENT_SQL.format(t='tensor')} group by label"""


def topk_per_keyword(spark, sf_dir):
    """First four events per type by value; of those, the ones above 1 that are no multiple of 3."""
    events = D.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("keyword"), "value")
    rank = [F.desc("value"), F.col("event_id")]
    candidates = A.top_candidates(events, rank)
    return A.top_candidates(candidates.filter("event_id % 3 <> 0"), rank)


TOPK_PER_KEYWORD = """with candidates as (
  select event_id, event_type as keyword, value from events
  qualify row_number() over (partition by event_type order by value desc, event_id) <= 4)
select * from candidates where event_id % 3 <> 0
qualify row_number() over (partition by keyword order by value desc, event_id) <= 4"""


def scalar_text(spark, sf_dir):
    """Regular expression, JSON and text scalars over the event properties."""
    props = F.col("props")
    return D.table(spark, sf_dir, "events").select(
        "event_id",
        F.regexp_extract(props, r"(\d+)", 1).try_cast("int").alias("by_regex"),
        F.from_json(props, "k int")["k"].alias("by_json"),
        F.length(props).alias("n"),
        F.startswith(props, F.lit("{")).alias("opens"),
        F.concat(F.lower("event_type"), F.lit("-"), F.col("event_id").cast("string")).alias("tag"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


SCALAR_TEXT = r"""select event_id, try_cast(regexp_extract(props, '(\d+)', 1) as int) as by_regex,
  cast(json_extract(props, '$.k') as int) as by_json, length(props) as n, starts_with(props, '{') as opens,
  concat(lower(event_type), '-', event_id) as tag, strftime(ts, '%Y-%m-%d %H:%M:%S') as at from events"""

_FIELDS = "image_id, label, keyword, tags, md5(image_array) as image_array"
_ALL = _FIELDS + ", original_shape"

QUERIES = {
    "proj_regex_fields": (proj_regex_fields, D.ctes(D.EXTRACTED) + f"select {_ALL} from extracted"),
    "proj_json_fields": (proj_json_fields, PROJ_JSON_FIELDS),
    "proj_cast_label": (
        proj_cast_label,
        D.ctes(D.EXTRACTED) + "select image_id, try_cast(label as integer) as label from extracted",
    ),
    "filt_clean": (filt_clean, D.ctes(D.CLEANED) + f"select {_ALL} from cleaned"),
    "filt_label_domain": (filt_label_domain, D.ctes(D.VALID) + f"select {_ALL} from valid"),
    "filt_http_response": (
        filt_http_response,
        D.ctes(D.FETCH_LOG)
        + """select page_id, url, content_type from fetch_log where status = 200 and starts_with(lower(content_type), 'image/')
        and (content_length is null or content_length = '' or try_cast(content_length as bigint) >= 10000)""",
    ),
    "filt_image_format": (
        filt_image_format,
        D.ctes(D.FETCH_LOG)
        + """select page_id, format, mode, width, height from fetch_log where format in ('JPEG', 'PNG', 'GIF', 'WEBP')
        and mode in ('L', 'RGB', 'RGBA') and width >= 100 and height >= 100""",
    ),
    "filt_image_url": (filt_image_url, FILT_IMAGE_URL),
    "filt_image_content": (filt_image_content, FILT_IMAGE_CONTENT),
    "filt_content_twice": (filt_content_twice, FILT_CONTENT_TWICE),
    "proj_resize": (proj_resize, PROJ_RESIZE),
    "proj_preview": (proj_preview, PROJ_PREVIEW),
    "proj_array_length": (
        proj_array_length,
        D.ctes(D.EXTRACTED)
        + "select image_id, cast(length(image_array) as int) as array_length from extracted order by image_id limit 5",
    ),
    "limit_sample": (
        limit_sample,
        D.ctes(D.EXTRACTED) + "select image_id, label from extracted order by image_id limit 10",
    ),
    "label_from_tags": (label_from_tags, D.ctes(D.TAGGED) + tag_label_sql("tagged", "doc_id")),
    "label_assign": (label_assign, LABEL_ASSIGN),
    "label_effective": (label_effective, LABEL_EFFECTIVE),
    "agg_count_lines": (agg_count_lines, "select count(*) as total_lines from embeddings having count(*) > 0"),
    "agg_valid_count": (
        agg_valid_count,
        D.ctes(D.VALID) + "select count(*) as valid_records from valid having count(*) > 0",
    ),
    "agg_category_stats": (
        agg_category_stats,
        D.ctes(D.VALID) + "select label, count(*) as count from valid group by label",
    ),
    "agg_keyword_stats": (
        agg_keyword_stats,
        D.ctes(D.VALID) + "select keyword, count(*) as count from valid group by keyword",
    ),
    "agg_summary_text": (
        agg_summary_text,
        D.ctes(D.VALID)
        + f"select concat('{counts.SUMMARY_PREFIX}', count(*)) as summary from valid having count(*) > 0",
    ),
    "agg_label_counts": (
        agg_label_counts,
        D.ctes(D.VALID) + "select count_if(label = 0) as cat, count_if(label = 1) as dog from valid",
    ),
    "agg_keyword_success": (agg_keyword_success, AGG_KEYWORD_SUCCESS),
    "topk_per_keyword": (topk_per_keyword, TOPK_PER_KEYWORD),
    "scalar_text": (scalar_text, SCALAR_TEXT),
}
