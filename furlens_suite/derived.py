"""Input tables of the queries, derived row by row from the driver tables.

The driver tables hold no images. Every ``embeddings`` row becomes one image
line; fixed shares of the rows carry the malformed shapes the engine has to
handle. Each table exists twice, as a DataFrame and as DuckDB CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from furlens.functions.once import with_columns_once
from furlens.operators import features as X
from furlens.operators.cleaning import FIELDS, extract_fields
from furlens.plans import clean, evaluate, extract
from furlens.session import shared_dir
from furlens.sources import readers as R, writers as W


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table of fewer scan tasks than cores one task per core.

    An embedding grows into an image text many times its size, so the small
    row is moved before that. Tables with enough scan tasks stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _select(spark: SparkSession, columns: str, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(f"select {columns} from parquet.`{sf_dir}/{name}.parquet`")


def rounded(column):
    """Six decimals, the same in both engines.

    Means of gray values often end exactly in a half of the sixth decimal, where
    the last bit would decide; the small shift moves them off it.
    """
    if isinstance(column, str):
        return f"round({column} + 1e-9::double, 6)"
    return F.round(column + F.lit(1e-9), 6)


def ctes(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- image lines

_CHANNELS = "case vec_id % 43 when 0 then 1 when 1 then 2 when 2 then 4 else 3 end"
_LABEL = (
    "case vec_id % 29 when 0 then '-1' when 1 then '\"1\"' when 2 then '1.7' "
    "when 3 then '99999999999999' else cast(label % 3 as {text}) end"
)
_KEYWORD = (
    "case vec_id % 31 when 0 then '\"keyword\": \"\", ' when 1 then '' "
    "else concat('\"keyword\": \"', case when label % 2 = 0 then 'cat' else 'dog' end, '\", ') end"
)
_TAGS = (
    "case vec_id % 37 when 0 then concat('a ', chr(92), '\"q', chr(92), '\" b') "
    "else concat('t', cast(label as {text})) end"
)
_ARRAY = """case vec_id % 41
    when 0 then '[]'
    when 1 then '[[[]]]'
    when 2 then concat('[', repeat('[1,2],', 300), '[1,2]]')
    when 3 then concat('[', arr, ']')
    when 4 then '[[[1,2,3],[4,5,6]]]'
    when 5 then regexp_replace(arr, '^.....[0-9]*,', '[[[')
    when 6 then regexp_replace(arr, '^...[0-9]+', '[[[300')
    when 7 then regexp_replace(arr, '^...[0-9]+', '[[[2.7')
    when 8 then regexp_replace(arr, '^...[0-9]+', '[[[null')
    when 9 then regexp_replace(arr, '^...[0-9]+', '[[[-3')
    else arr end"""
_LINE = (
    "concat('{{\"image_id\": \"img_', vec_id, '\", \"label\": ', " + _LABEL + ", ', ', " + _KEYWORD
    + ", '\"tags\": \"', " + _TAGS + ", '\", \"image_array\": ', " + _ARRAY
    + ", ', \"original_shape\": [16, 16, ', ch, ']}}')"
)
_PIXEL = (
    "cast(greatest(0, least(255, floor(128 + (c+1)*150*cast(embedding[{at}] as double) + (h-8)*c))) as int)"
)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, ch, px: a 16x16 image per embedding."""
    px = (
        "transform(sequence(0,15), h -> transform(sequence(0,15), w -> transform(sequence(0, ch - 1), c -> "
        + _PIXEL.format(at="(h*16+w)%64")
        + ")))"
    )
    return (
        _spread(table(spark, sf_dir, "embeddings"), "vec_id")
        .withColumn("ch", F.expr(_CHANNELS))
        .transform(with_columns_once, {"px": F.expr(px)})
        .select("vec_id", "label", "ch", "px")
    )


PIXELS = f"""pixels as (
  select vec_id, label, ch,
    list_transform(range(0,16), lambda h: list_transform(range(0,16), lambda w: list_transform(range(0, ch), lambda c:
      {_PIXEL.format(at="cast((h*16+w)%64+1 as bigint)")}))) as px
  from (select *, {_CHANNELS} as ch from embeddings))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, value: one raw text line per image."""
    arr = pixels(spark, sf_dir).select("vec_id", "label", "ch", F.to_json("px").alias("arr"))
    return arr.select("vec_id", F.expr(_LINE.format(text="string")).alias("value"))


LINES = (
    PIXELS
    + f""",
lines as (
  select vec_id, {_LINE.format(text="varchar")} as value
  from (select vec_id, label, ch, cast(to_json(px) as varchar) as arr from pixels))"""
)


def _captured(pattern: str) -> str:
    return f"case when regexp_matches(value, '{pattern}') then regexp_extract(value, '{pattern}', 1) end"


EXTRACTED = LINES + r""",
extracted as (
  select {image_id} as image_id, {label} as label, {keyword} as keyword, {tags} as tags,
    {image_array} as image_array, {original_shape} as original_shape
  from lines)""".format(
    image_id=_captured(r'"image_id":\s*"([^"]*)"'),
    label=_captured(r'"label":\s*(\d+)'),
    keyword=_captured(r'"keyword":\s*"([^"]*)"'),
    tags=_captured(r'"tags":\s*"([^"]*)"'),
    image_array=_captured(r'"image_array":\s*(\[\s*\[\s*\[.*?\]\s*\]\s*\])'),
    original_shape=_captured(r'"original_shape":\s*(\[\d+,\s*\d+,\s*\d+\])'),
)

CLEANED = (
    EXTRACTED
    + """,
cleaned as (
  select * from extracted
  where image_id is not null and image_id <> '' and label is not null and keyword is not null
    and image_array is not null and image_array not in ('[]', '[[[]]]') and length(image_array) > 1000)"""
)
VALID = (
    CLEANED
    + """,
valid as (
  select * from (select * replace (try_cast(label as integer) as label) from cleaned) where label in (0, 1))"""
)


def extracted(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    return extract_fields(lines(spark, sf_dir), fields=fields)


def valid(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    return clean.valid_records(lines(spark, sf_dir), fields=fields)


# ------------------------------------------------------------------- features

# Image texts of all lines that have one, whatever their label.
ARRAYS = EXTRACTED + ",\narrays as (select image_id, image_array from extracted where image_array is not null)"
TENSORS = """tensors as (
  select image_id, t from (select image_id, try_cast(try_cast(image_array as json) as double[][][]) as t from {source})
  where len(t) > 0 and len(t[1]) > 0 and len(t[1][1]) > 0
    and len(list_filter(t, lambda r: len(r) is distinct from len(t[1]))) = 0
    and len(list_filter(flatten(t), lambda p: len(p) is distinct from len(t[1][1]))) = 0
    and len(list_filter(flatten(flatten(t)), lambda v: v is null or v <= -1 or v >= 256)) = 0)"""
_PIXEL_ROWS = """cells as (
  select image_id, len(p) as ch, trunc(p[1]) as c0, trunc(p[case when len(p) >= 3 then 2 else 1 end]) as c1,
    trunc(p[case when len(p) >= 3 then 3 else 1 end]) as c2
  from (select image_id, unnest(flatten(t)) as p from tensors)),
grays as (
  select *, case when ch >= 3 then c0 * 0.2989::double + c1 * 0.5870::double + c2 * 0.1140::double else c0 end as gray
  from cells)"""


def _channel_stats(column: str, prefix: str) -> str:
    return (
        f"avg({column}) as {prefix}_mean, stddev_pop({column}) as {prefix}_std, "
        f"quantile_cont({column}, 0.5) as {prefix}_median, quantile_cont({column}, 0.25) as {prefix}_p25, "
        f"quantile_cont({column}, 0.75) as {prefix}_p75"
    )


_STATS = f"""stats as (
  select image_id, {_channel_stats("c0", "red")}, {_channel_stats("c1", "green")}, {_channel_stats("c2", "blue")},
    avg(gray) as gray_mean, stddev_pop(gray) as gray_std, var_pop(gray) as gray_var, stddev_pop(gray) as contrast,
    min(gray) as gray_min, max(gray) as gray_max,
    quantile_cont(gray, 0.1) as gray_p10, quantile_cont(gray, 0.9) as gray_p90
  from grays group by image_id),
bins as (
  select image_id, least(floor(gray * 64 / 255), 63) as bin, count(*) as n from grays group by all),
entropies as (
  select image_id,
    -(sum((n + 1e-8) / mass * log2((n + 1e-8) / mass)) + (64 - count(*)) * (1e-8 / mass * log2(1e-8 / mass))) as entropy
  from (select *, sum(n) over (partition by image_id) + 64 * 1e-8::double as mass from bins) group by image_id, mass),
vectors as (select * from stats join entropies using (image_id))"""


def vector_ctes(source: str) -> str:
    """``vectors``: one row per readable image of ``source`` with the 24 named features."""
    return TENSORS.format(source=source) + ",\n" + _PIXEL_ROWS + ",\n" + _STATS


ARRAY_VECTORS = ARRAYS + ",\n" + vector_ctes("arrays")
VALID_VECTORS = VALID + ",\n" + vector_ctes("valid")


def arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark, sf_dir).filter("image_array is not null").select("image_id", "image_array")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records with their vectors, unreadable images included with an empty vector."""
    return X.with_features(valid(spark, sf_dir))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.feature_rows(valid(spark, sf_dir))


_shared: dict = {}


def once(spark: SparkSession, sf_dir: str, name: str, make):
    """One copy per application and data folder, shared by the learning queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, label, features of all usable images, read from a table in the shared folder.

    As between the stages of the engine itself, learning starts from stored
    features: later jobs have a short plan and survive lost executors without
    extracting anything again.
    """

    def stored() -> DataFrame:
        path = shared_dir(spark, "rows")
        W.write_features(feature_rows(spark, sf_dir), path)
        return evaluate.training_rows(R.read_features(spark, path, "parquet"))

    return once(spark, sf_dir, "rows", stored)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return once(
        spark, sf_dir, "split", lambda: evaluate.prepared_split(rows(spark, sf_dir))
    )


# Same split in SQL: number the rows of a label by key, first q are test rows.
SPLIT = (
    VALID_VECTORS
    + """,
ranked as (
  select v.image_id, v.label, row_number() over (partition by v.label order by md5(concat(v.image_id, '|42'))) as rk
  from valid v join vectors using (image_id)),
sizes as (select label, count(*) as n, sum(count(*)) over () as total from ranked group by label),
shares as (
  select label, n * ceil(round(total * 0.3, 9)) / total as exact, ceil(round(total * 0.3, 9)) as wanted from sizes),
quotas as (
  select label, floor(exact) + case when row_number() over (order by floor(exact) - exact, label)
    <= wanted - sum(floor(exact)) over () then 1 else 0 end as q from shares),
flagged as (select image_id, r.label, rk <= q as is_test from ranked r join quotas using (label))"""
)


# ------------------------------------------------------------------ run tables

_RUN_KEYS = """select event_id, event_type, value,
    case event_id % 4 when 0 then 1 when 1 then 2 when 2 then 4 else 6 end as cores from {source}"""
RUNS = f"""keyed as ({_RUN_KEYS.format(source="events")}),
model_runs as (
  select concat(cores, '_cores') as config, event_type as model_name,
    round(avg(case when value > 10 then 1e0 else 0e0 end), 1) as accuracy,
    round(avg(case when value > 20 then 1e0 else 0e0 end), 6) as f1_score,
    round(sum(value), 2) as training_time,
    sum(event_id) % 7 <> 0 as success, cast(null as varchar) as error, cast(length(event_type) as int) as model_order
  from keyed group by cores, event_type),
config_runs as (
  select concat(cores, '_cores') as config, cores, round(sum(value), 2) as total_time,
    case when cores = 1 then 'sequential' else concat('parallel_', cores, 'cores') end as method
  from keyed group by cores)"""


def _runs(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = f"parquet.`{sf_dir}/events.parquet`"
    body = RUNS.replace("from events", f"from {source}").replace("varchar", "string")
    return spark.sql(f"with {body} select * from {name}")


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per worker count and event type, in the shape of model results."""
    return _runs(spark, sf_dir, "model_runs")


def config_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir, "config_runs")


# ------------------------------------------------------------ acquisition side

_TAGGED = (
    "case doc_id % 7 when 0 then '' when 1 then concat(text, ' Kitten, feline') when 2 then concat(text, ' puppy') "
    "when 3 then concat(text, ' cat dog') when 4 then concat(text, ' DOG canine') else text end"
)
_LINK = (
    "concat('https://', source, '.example.com/', case doc_id % 5 when 0 then 'cat' when 1 then 'dog' else 'img' end, "
    "'/', doc_id, '.jpg')"
)
_WORD = "case doc_id % 6 when 0 then 'bobcat' when 1 then 'Hot Dog' when 2 then '' else lang end"
TAGGED_COLUMNS = f"doc_id, {_TAGGED} as tags, {_LINK} as url, {_WORD} as keyword"
TAGGED = f"tagged as (select {TAGGED_COLUMNS} from documents)"


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tags, url, keyword: whole document texts with some tag words added."""
    return _select(spark, TAGGED_COLUMNS, sf_dir, "documents")


FETCH_COLUMNS = """page_id, url,
  case when page_id % 11 = 0 then 404 else 200 end as status,
  case page_id % 7 when 0 then 'text/html' when 1 then 'IMAGE/PNG' else 'image/jpeg' end as content_type,
  case page_id % 13 when 0 then null when 1 then '' when 2 then 'many' else cast(length(html) * 2 as {text}) end as content_length,
  case page_id % 5 when 0 then 'BMP' when 1 then 'PNG' when 2 then 'GIF' when 3 then 'WEBP' else 'JPEG' end as format,
  case page_id % 8 when 0 then 'P' when 1 then 'L' when 2 then 'RGBA' else 'RGB' end as mode,
  cast(length(html) % 400 as int) as width, cast(length(url) * 7 % 300 as int) as height"""
FETCH_LOG = f"fetch_log as (select {FETCH_COLUMNS.format(text='varchar')} from pages)"


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id and one fetch-log row per page."""
    return _select(spark, FETCH_COLUMNS.format(text="string"), sf_dir, "pages")


# Images for the content checks: every 7th has few colours, every 9th is a sliver.
_FEW = "floor(v / 128) * 128"
TENSOR_IMAGES = f"""images as (
  select vec_id, label,
    case when vec_id % 9 = 0 then px[1:5]
      when vec_id % 7 = 0 then list_transform(px, lambda r: list_transform(r, lambda p: list_transform(p, lambda v: cast({_FEW} as int))))
      else px end as tensor
  from pixels)"""


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, tensor (array of arrays of arrays of ints)."""
    tensor = F.expr(
        "case when vec_id % 9 = 0 then slice(px, 1, 5) when vec_id % 7 = 0 then "
        f"transform(px, r -> transform(r, p -> transform(p, v -> cast({_FEW} as int)))) else px end"
    )
    made = with_columns_once(pixels(spark, sf_dir), {"tensor": tensor})
    return made.select("vec_id", "label", "tensor")


# Listing responses: 50 documents each; after every fifth page comes one more response without hits.
RESPONSE_SIZE = 50
_HIT = {
    "id": "doc_id",
    "pageURL": "concat('https://example.com/photos/', doc_id)",
    "webformatURL": "url",
    "tags": "case when doc_id % 9 = 0 then null else tags end",
    "views": "case when doc_id % 4 = 0 then null else length(tags) end",
    "downloads": "case when doc_id % 10 = 0 then null else doc_id * 3 end",
    "user": "case when doc_id % 8 = 0 then null else keyword end",
}
LISTING = TAGGED + f""",
hits as (
  select doc_id as api_id, {_HIT["pageURL"]} as page_url, url as image_url,
    coalesce({_HIT["tags"]}, '') as tags, coalesce({_HIT["views"]}, 0) as views,
    coalesce({_HIT["downloads"]}, 0) as downloads, coalesce({_HIT["user"]}, '') as user
  from tagged)"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per response of at most RESPONSE_SIZE hits, and the empty ones; absent values are absent keys."""
    hit = F.struct(*[F.expr(e).alias(n) for n, e in _HIT.items()])
    page = F.expr(f"doc_id div {RESPONSE_SIZE}")
    grouped = tagged(spark, sf_dir).groupBy(page.alias("page")).agg(F.collect_list(hit).alias("hits"))
    full = F.to_json(F.struct(F.size("hits").alias("total"), "hits"))
    texts = F.when(F.col("page") % 5 == 0, F.array(full, F.lit('{"total": 0}'))).otherwise(F.array(full))
    return grouped.select(F.explode(texts).alias("value"))


# Feature lines: whole numbers, so that both engines print the same text.
_NUMBERS = "transform(embedding, v -> cast(floor(v * 100) as int))"
_FEATURE_LINE = """case vec_id % 17
    when 0 then 'not json' when 1 then concat('{{"image_id": "img_', vec_id, '", "label": 1')
    when 2 then concat('{{"image_id": "img_', vec_id, '", "image_features": ', {arr}, '}}')
    when 3 then concat('{{"image_id": "img_', vec_id, '", "label": ', label, '}}')
    when 4 then concat('{{"image_id": "img_', vec_id, '", "label": 1, "image_features": [1,2,3,4,5,6,7,8,9,10]}}')
    when 5 then concat('  {{"image_id": "img_', vec_id, '", "label": 0.0, "image_features": ', {arr}, '}}  ')
    else concat('{{"image_id": "img_', vec_id, '", "label": ', label % 3, ', "image_features": ', {arr}, '}}') end"""
FEATURE_LINES = f"""feature_lines as (select {_FEATURE_LINE.format(arr="arr")} as value from (
  select vec_id, label, cast(to_json(list_transform(embedding, lambda v: cast(floor(v * 100) as int))) as varchar) as arr
  from embeddings)),
parsed_lines as (
  select json_extract_string(j, '$.image_id') as image_id, j is not null as parsed,
    coalesce(cast(json_extract(j, '$.label') as double), -1) as label,
    coalesce(json_array_length(j, '$.image_features'), 0) as n
  from (select try_cast(trim(value) as json) as j from feature_lines))"""


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.to_json(F.expr(_NUMBERS)).alias("arr")
    )
    return base.select(F.expr(_FEATURE_LINE.format(arr="arr")).alias("value"))
