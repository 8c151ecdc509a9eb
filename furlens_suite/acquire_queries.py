"""Image files: headers, bicubic copies and the acquire stage from listing to records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlens.operators import acquisition as A
from furlens.plans import acquire
from furlens.session import shared_dir
from furlens.sources import images as I
from furlens_suite import bitmaps, derived as D
from furlens_suite.clean_queries import CONTENT_SQL

SIDE = 64


def kernel_sql(name: str, source: int, target: int) -> str:
    """A CTE with one row: the bicubic weights of ``resample.weights`` as a list of lists."""
    scale = source / target
    wide = max(scale, 1.0)
    x = f"abs((j - center + 0.5) / {wide!r}::double)"
    kernel = f"case when {x} < 1 then (1.5 * {x} - 2.5) * {x} * {x} + 1 when {x} < 2 then -0.5 * ((({x} - 5) * {x} + 8) * {x} - 4) else 0 end"
    return f"""{name} as (select list(w order by i) as k from (
  select i, list_transform(raw, lambda v: trunc(v / total * 4194304 + case when v < 0 then -0.5 else 0.5 end)) as w from (
    select i, raw, list_sum(raw) as total from (
      select i, list_transform(range(0, {source}), lambda j: case when j >= greatest(0, trunc(center - {2 * wide!r} + 0.5))
        and j < least({source}, trunc(center + {2 * wide!r} + 0.5)) then {kernel} else 0::double end) as raw
      from (select i, (i + 0.5::double) * {scale!r}::double as center from range(0, {target}) t(i))))))"""


def bicubic_sql(source: str, out: str, side: int, target: int, repeat: int = 1) -> str:
    """CTEs that resize the square ``px`` of ``source``, each cell taken ``repeat`` times, to ``out.resized``."""
    byte = "least(255, greatest(0, floor((list_inner_product({cells}, {w}) + 2097152) / 4194304)))"
    cell = f"(case when len(px[1][1]) < 3 then px[y // {repeat} + 1][x // {repeat} + 1][1] else px[y // {repeat} + 1][x // {repeat} + 1][c] end)::double"
    n = side * repeat
    across = byte.format(cells=f"list_transform(range(0, {n}), lambda x: {cell})", w="w")
    down = byte.format(cells="list_transform(t[c], lambda line: line[j])", w="w")
    return f"""{kernel_sql(out + "_kernel", n, target)},
{out}_across as (select s.*, list_transform(range(1, 4), lambda c: list_transform(range(0, {n}), lambda y:
    list_transform(k, lambda w: {across}))) as t from {source} s, {out}_kernel),
{out} as (select * exclude (t, k), list_transform(k, lambda w: list_transform(range(1, {target + 1}), lambda j:
    list_transform(range(1, 4), lambda c: cast({down} as int)))) as resized from {out}_across, {out}_kernel)"""


def _bicubic(spark, sf_dir, side: int) -> DataFrame:
    resized = A.resize(D.pixels(spark, sf_dir).withColumnRenamed("px", "tensor"), side=side, filter="bicubic")
    return resized.select("vec_id", F.md5(F.to_json("resized")).alias("resized"))


def proj_resize_bicubic(spark, sf_dir):
    return _bicubic(spark, sf_dir, SIDE)


def proj_resize_shrink(spark, sf_dir):
    """16 cells to 10: the kernel is widened and covers parts of cells."""
    return _bicubic(spark, sf_dir, 10)


def _resize_sql(side: int) -> str:
    return D.ctes(D.PIXELS, bicubic_sql("pixels", "small", 16, side)) + "select vec_id, md5(cast(to_json(resized) as varchar)) as resized from small"


HEADER_SQL = """case when vec_id % 17 = 0 or vec_id % 19 = 0 or vec_id % 23 = 0 then null when vec_id % 37 = 0 then 'JPEG'
    when vec_id % 41 = 0 then 'GIF' when vec_id % 43 = 0 then 'WEBP' when vec_id % 47 = 0 then 'none' else 'PNG' end"""
SRC_IMAGE_HEADERS = D.ctes(D.PIXELS) + f"""
select concat('img_', vec_id) as name, format, reason,
  case when reason is null then case format when 'BMP' then 'RGB' when 'GIF' then 'P'
    when 'JPEG' then case when ch < 3 then 'L' when ch = 3 then 'RGB' else 'CMYK' end
    when 'WEBP' then case when ch = 4 then 'RGBA' else 'RGB' end
    else case ch when 1 then 'L' when 2 then 'LA' when 3 then 'RGB' else 'RGBA' end end end as mode,
  case when reason is null then case when format in ('JPEG', 'GIF', 'WEBP') then 300 when small then 16 else 112 end end as width,
  case when reason is null then case when format in ('JPEG', 'GIF', 'WEBP') then 200 when small then 16 else 112 end end as height
from (select vec_id, ch, kind = 'small' as small,
    case kind when 'cut' then null when 'none' then null when 'small' then 'PNG' else kind end as format,
    case kind when 'cut' then 'bad header' when 'none' then 'unknown format' end as reason
  from (select vec_id, ch, case when vec_id % 17 = 0 then 'cut' when vec_id % 19 = 0 then 'BMP' when vec_id % 23 = 0 then 'small'
    else {HEADER_SQL} end as kind from pixels))"""


def src_image_headers(spark, sf_dir):
    """Every file's header from its own bytes, with the reason where there is none."""
    folder = shared_dir(spark, "files")
    bitmaps.write_files(bitmaps.as_files(D.pixels(spark, sf_dir)), folder)
    return I.read_headers(spark, folder).select("name", "format", "mode", "width", "height", "reason")


LISTING = """concat('k', label, '_', vec_id % 6) as keyword, vec_id as position, case when vec_id % 4 > 0 then vec_id end as api_id,
  case when vec_id % 31 = 0 then null when vec_id % 53 = 0 then '' else concat('https://img.example.com/', vec_id, '.png') end as image_url,
  concat('t', label) as tags, cast(label % 2 as int) as label, vec_id as views, case when vec_id % 3 > 0 then vec_id * 2 end as downloads,
  'someone' as user"""
FETCHED = """concat('https://img.example.com/', vec_id, '.png') as url, case when vec_id % 11 = 0 then 404 else 200 end as status,
  case when vec_id % 7 = 0 then 'text/html' else 'image/png' end as content_type,
  case when vec_id % 13 = 0 then '9000' else '20000' end as content_length"""


def _landed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The listing and the stored table of fetched files of all rows but some that were never fetched."""
    listing = D.table(spark, sf_dir, "embeddings").selectExpr(*_columns(LISTING))
    path = shared_dir(spark, "fetched")
    files = bitmaps.as_files(D.pixels(spark, sf_dir).filter("vec_id % 29 > 0"))
    files.selectExpr(*_columns(FETCHED), "content").write.parquet(path)
    return listing, spark.read.parquet(path)


def _columns(text: str) -> list[str]:
    """The expressions of a select list; none holds a comma outside of brackets."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


def acquire_outcomes(spark, sf_dir):
    found = acquire.outcomes(*_landed(spark, sf_dir))
    return found.select("keyword", "position", F.coalesce("reason", F.lit("accepted")).alias("outcome"))


def acquire_records(spark, sf_dir):
    made = acquire.records(*_landed(spark, sf_dir), "Example").drop("download_timestamp")
    shape = F.array_join(F.col("original_shape").cast("array<string>"), "x")
    return made.withColumns({"image_array": F.md5(F.to_json("image_array")), "original_shape": shape})


def acquire_summary(spark, sf_dir):
    return acquire.summary(*_landed(spark, sf_dir))


OUTCOMES = f"""listing as (select vec_id, ch, px, {LISTING} from pixels),
candidates as (select * from listing qualify row_number() over (partition by keyword order by position) <= 4),
checked as (select *, case when coalesce(image_url, '') = '' then 'no address' when vec_id % 29 = 0 then 'not fetched'
    when vec_id % 11 = 0 or vec_id % 7 = 0 or vec_id % 13 = 0 then 'response' when vec_id % 17 = 0 then 'bad header'
    when vec_id % 19 = 0 or vec_id % 23 = 0 then 'format'
    when vec_id % 37 = 0 then case when ch = 4 then 'format' else 'no decoder' end
    when vec_id % 41 = 0 then 'format' when vec_id % 43 = 0 then 'no decoder' when vec_id % 47 = 0 then 'unknown format'
    when ch = 2 then 'format'
    when len(list_distinct(flatten(case when vec_id % 5 = 0 then list_transform(px, lambda r: list_transform(r, lambda p: list_transform(p, lambda v: v // 128 * 128))) else px end))) < 10 then 'content' end as refused
  from candidates),
to_resize as (select * from checked where refused is null),
{bicubic_sql("to_resize", "done", 16, SIDE, 7)},
outcomes as (select keyword, position, refused as outcome from checked where refused is not null
  union all select keyword, position, case when {CONTENT_SQL.format(t="resized")} then 'accepted' else 'content after resize' end from done)"""
ACQUIRE_OUTCOMES = D.ctes(D.PIXELS, OUTCOMES) + "select * from outcomes"
ACQUIRE_SUMMARY = D.ctes(D.PIXELS, OUTCOMES) + """
select keyword, f.found, o.tried, o.downloads from (select keyword, count(*) as found from listing group by keyword) f
join (select keyword, count(*) as tried, count_if(outcome = 'accepted') as downloads from outcomes group by keyword) o using (keyword)"""
ACQUIRE_RECORDS = D.ctes(D.PIXELS, OUTCOMES) + f"""
select concat(keyword, '_', coalesce(api_id, position)) as image_id, md5(cast(to_json(resized) as varchar)) as image_array, image_url as source_url,
  concat('Example ', keyword, ' image') as description, label, keyword, case when ch = 1 then '112x112' else concat('112x112x', ch) end as original_shape,
  tags, coalesce(views, 0) as views, coalesce(downloads, 0) as downloads, "user"
from done where {CONTENT_SQL.format(t="resized")}"""

QUERIES = {
    "proj_resize_bicubic": (proj_resize_bicubic, _resize_sql(SIDE)),
    "proj_resize_shrink": (proj_resize_shrink, _resize_sql(10)),
    "src_image_headers": (src_image_headers, SRC_IMAGE_HEADERS),
    "acquire_outcomes": (acquire_outcomes, ACQUIRE_OUTCOMES),
    "acquire_records": (acquire_records, ACQUIRE_RECORDS),
    "acquire_summary": (acquire_summary, ACQUIRE_SUMMARY),
}
