"""Registered sources, row builders, joins on archives, and sinks.

Files are written by Spark from the given tables into the shared scratch folder and read back.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark import schemas
from tidemark import vocabulary as V
from tidemark.operators.filters import collected_within
from tidemark.operators.latest import last_per_key
from tidemark.operators.metrics import monthly_rollup
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.post_queries import KEYS, mean4
from tidemark.plans.text_queries import BASE, ENTITIES, _bounded_hits, _phrase_sql, bounded, q
from tidemark.plans.views import INDICATORS, LABELS, POSTS, RAW, ctes
from tidemark.registry import SOURCES, SourceSpec
from tidemark.session import scratch_dir
from tidemark.sources import archives as AR
from tidemark.sources import indicators as IN
from tidemark.sources import sinks as K
from tidemark.sources import social as SO
from tidemark.sources import store as ST
from tidemark.sources import streams as SR

TSF = "yyyy-MM-dd HH:mm:ss"


# --------------------------------------------------------------------- stores
@query("s01_json_store", "select o_orderkey, o_orderstatus, o_orderpriority from orders")
def json_store(spark, d):
    """Orders written as JSON arrays of at most 500 documents, then scanned with a fixed schema."""
    path = scratch_dir(spark, "json-store")
    chunks = views.table(spark, d, "orders").groupBy((F.col("o_orderkey") / 500).cast("bigint").alias("c")).agg(
        F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))).alias("value")
    )
    chunks.select("value").write.text(path)
    return ST.read_json_store(spark, path, "o_orderkey bigint, o_orderstatus string, o_orderpriority string")


@query("s02_table_scan", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '1998-01-01' and l_returnflag in ('A', 'R')")
def table_scan(spark, d):
    """Filter and columns reach the Parquet scan."""
    rows = ST.read_table(spark, f"{d}/lineitem.parquet")
    return rows.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & F.col("l_returnflag").isin("A", "R")).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "s03_windowed_scan",
    ctes(POSTS, RAW) + """select id from raw_posts where harvested_at >= timestamp '2001-08-10' - interval 20000 hours
  and created_at >= timestamp '1999-06-01' and created_at < timestamp '2001-02-01'""",
)
def windowed_scan(spark, d):
    rows = views.raw_posts(spark, d).withColumnRenamed("harvested_at", "collected_at")
    return collected_within(rows, views.as_of(), lookback_hours=20000, start="1999-06-01", end="2001-01-31").select("id")


MANIFEST = """manifest as (select strftime(ts, '%Y%m%d%H%M%S') as archive_id, date_trunc('second', ts) as archive_time, event_id as file_size,
  md5(cast(event_id as varchar)) as md5, concat('http://data.example.org/gdeltv2/', strftime(ts, '%Y%m%d%H%M%S'), '.gkg.csv.zip') as url
  from events where event_id % 5 <> 0 and event_id % 7 <> 0)"""


def _manifest(spark, d):
    path = scratch_dir(spark, "manifest")
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    kind = F.when(F.col("event_id") % 5 == 0, ".export.CSV.zip").otherwise(".gkg.csv.zip")
    url = F.concat(F.lit("http://data.example.org/gdeltv2/"), stamp, kind)
    line = F.concat_ws(" ", F.col("event_id").cast("string"), F.upper(F.md5(F.col("event_id").cast("string"))), url)
    cut = F.when(F.col("event_id") % 7 == 0, F.concat(line, F.lit(" extra"))).otherwise(line)
    views.table(spark, d, "events").select(cut.alias("value")).write.text(path)
    return AR.read_manifest(spark, path)


@query(
    "s04_archive_manifest",
    ctes(MANIFEST) + "select archive_id, file_size, md5, url, strftime(archive_time, '%Y-%m-%d %H:%M:%S') as archive_time from manifest "
    "where archive_time > timestamp '2024-01-05' and archive_time <= timestamp '2024-01-20'",
)
def archive_manifest(spark, d):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-05", "2024-01-20"))
    rows = AR.archives_between(_manifest(spark, d), start, end)
    return rows.withColumn("archive_time", F.date_format("archive_time", TSF))


@query("j07_remaining_archives", ctes(MANIFEST) + "select archive_id, md5 from manifest where archive_id not in (select strftime(ts, '%Y%m%d%H%M%S') from events where event_id % 3 = 0)")
def remaining_archives(spark, d):
    done = views.table(spark, d, "events").where("event_id % 3 = 0").select(F.date_format("ts", "yyyyMMddHHmmss").alias("archive_id"))
    return AR.remaining_archives(_manifest(spark, d), done).select("archive_id", "md5")


# ------------------------------------------------------------------- archives
@F.pandas_udf(BinaryType())
def _zip(names: pd.Series, bodies: pd.Series) -> pd.Series:
    """Test archives: one member, fixed date, so that the bytes are reproducible."""

    def one(name: str, body: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(zipfile.ZipInfo(name, (2025, 1, 1, 0, 0, 0)), body)
        return out.getvalue()

    return pd.Series([one(n, b) for n, b in zip(names, bodies)], dtype="object")


def _archive_files(spark, d):
    """(archive_id, content): documents as 27-column records, twenty per archive."""
    text = F.regexp_replace("text", r"[\t\r\n\x0B\x0C\x1C-\x1F\x85  ]+", " ")
    fields = {0: F.col("id"), 3: F.concat(F.col("source"), F.lit(".example.org")), 4: F.col("url"), 7: F.col("lang"), 15: F.lit("-2.5"), 23: text}
    record = F.concat_ws("\t", *[fields.get(i, F.lit("")) for i in range(27)])
    rows = views.text_posts(spark, d).select(F.floor(F.col("doc_id") / 20).cast("bigint").alias("a"), "doc_id", record.alias("line"))
    grouped = rows.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("doc_id", "line"))).alias("l"))
    archive_id = F.date_format(F.timestamp_seconds(F.lit(1735689600) + F.col("a") * 900), "yyyyMMddHHmmss")
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return grouped.select(archive_id.alias("archive_id"), body.alias("body")).select(
        "archive_id", _zip(F.concat("archive_id", F.lit(".gkg.csv")), "body").alias("content")
    )


def _archives(spark, d):
    """(manifest, files); every ninth archive has a wrong checksum in the manifest."""
    path = scratch_dir(spark, "archives")
    _archive_files(spark, d).write.parquet(path)  # bytes are made once; manifest and contents both read them
    files = spark.read.parquet(path)
    return archive_manifest_of(files), files


def archive_manifest_of(files):
    bad = F.col("archive_id").cast("bigint") % 9 == 0
    return files.select(
        "archive_id", F.to_timestamp("archive_id", "yyyyMMddHHmmss").alias("archive_time"),
        F.concat(F.lit("http://data.example.org/"), F.col("archive_id"), F.lit(".gkg.csv.zip")).alias("url"),
        F.when(bad, F.lit("0" * 32)).otherwise(F.md5("content")).alias("md5"),
    )


ARCHIVED = BASE + """, arch as (select *, strftime(timestamp '2025-01-01' + to_minutes(cast(15 * (doc_id // 20) as int)), '%Y%m%d%H%M%S') as archive_id from text_posts),
ok_arch as (select * from arch where cast(archive_id as bigint) % 9 <> 0),
low as (select *, trim(regexp_replace(lower(concat_ws(' ', concat(source, '.example.org'), nullif(url, ''), lang, text)), '\\s+', ' ', 'g')) as t from ok_arch)"""


@query("s05_archive_lines", ARCHIVED + " select archive_id, count(*) as lines from ok_arch group by 1")
def archive_lines(spark, d):
    manifest, files = _archives(spark, d)
    counts = AR.archive_lines(files).groupBy("archive_id", "actual_md5").agg(F.count(F.lit(1)).alias("lines"))
    return AR.keep_verified(counts, manifest).select("archive_id", "lines")


@query("s06_checksum_rejects", ARCHIVED + " select distinct archive_id, 'md5 mismatch' as error from arch where cast(archive_id as bigint) % 9 = 0")
def checksum_rejects(spark, d):
    return AR.rejected(AR.verify_archives(*_archives(spark, d))).select("archive_id", "error")


@query("j13_manifest_content_join", ARCHIVED + " select cast(archive_id as bigint) % 9 <> 0 as valid, count(distinct archive_id) as archives from arch group by 1")
def manifest_content_join(spark, d):
    return AR.verify_archives(*_archives(spark, d)).groupBy("valid").agg(F.count(F.lit(1)).alias("archives"))


def _category_rows() -> str:
    entries = []
    for category, terms in V.NEWS_CATEGORY_TERMS.items():
        blocked = V.BLOCKED_TERMS.get(category)
        stop = f" and not {bounded(blocked, 't')}" if blocked else ""
        entries.append(
            f"select *, {q(category)} as cat, array_to_string(list_sort(list_distinct(list_concat(list_concat({_bounded_hits(terms)}, cost), local))), '|') as hits"
            f" from gated where {bounded(terms, 't')}{stop}"
        )
    return (
        f", hit as (select * exclude (category), {_bounded_hits(V.NEWS_LOCAL_TERMS)} as local, {_bounded_hits(V.NEWS_COST_TERMS)} as cost from low),\n"
        "gated as (select * from hit where len(local) > 0 and len(cost) > 0),\nrows_of as (" + "\nunion all ".join(entries) + ")"
    )


@query(
    "p05_archive_documents",
    ARCHIVED + _category_rows() + f""" select concat(id, ':', cat) as _id, cat as category, {_phrase_sql().replace('category', 'cat')} as search_term, id as source_id, url,
  concat(source, '.example.org') as domain, sha1(t) as text_key, archive_id as gkg_file_id, hits as matched_terms, '-2.5' as tone from rows_of""",
)
def archive_documents(spark, d):
    manifest, files = _archives(spark, d)
    rows = AR.archive_documents(AR.archive_lines(files), manifest, collected_at=views.as_of())
    return rows.select(
        "_id", "category", "search_term", "source_id", "url", "domain", F.sha1("text").alias("text_key"), "gkg_file_id",
        F.array_join("matched_terms", "|").alias("matched_terms"), "tone",
    )


@query("p06_search_text", ARCHIVED + " select id, sha1(t) as text_key from low")
def search_text(spark, d):
    manifest, files = _archives(spark, d)
    fields = F.split("line", "\t")
    texts = AR.archive_lines(files).select("archive_id", "actual_md5", fields[0].alias("id"), F.sha1(AR.search_text(fields)).alias("text_key"))
    return AR.keep_verified(texts, manifest).select("id", "text_key")


# ----------------------------------------------------------------- indicators
@query(
    "s07_indicator_csv",
    ctes(INDICATORS) + """, c as (select *, case measure when 'Index numbers' then '1' else '3' end as mc,
  case item_name when 'Rents' then '30014' when 'Electricity' then '40055' else '40081' end as ic from indicators)
select concat('abs-cpi-', sha1(concat('abs-cpi|CPI|', mc, '|', ic, '|10|50|M|', period))) as id, concat_ws('.', mc, ic, '10', '50', 'M') as series_key,
  mc as measure_code, measure, ic as item_code, item_name, 'Australia' as region, period, concat(period, '-01') as period_start, round(value, 6) as value, 'Monthly' as frequency,
  '' as unit from c where value is not null""",
)
def indicator_csv(spark, d):
    """The indicators view as labelled CSV with a header per file, then parsed."""
    return _parsed_indicators(spark, d).select(
        "id", "series_key", "measure_code", "measure", "item_code", "item_name", "region", "period",
        F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), F.round("value", 6).alias("value"), "frequency", "unit",
    )


def _parsed_indicators(spark, d):
    path = scratch_dir(spark, "indicator-csv")
    view = views.indicators(spark, d)
    item = F.expr("case item_name when 'Rents' then '30014' when 'Electricity' then '40055' else '40081' end")
    label = lambda code, text: F.concat(code, F.lit(': '), text)
    view.select(
        F.lit("CPI").alias("DATAFLOW"),
        label(F.when(F.col("measure") == "Index numbers", "1").otherwise("3"), F.col("measure")).alias("MEASURE: Measure"),
        label(item, F.col("item_name")).alias("INDEX: Index"),
        F.lit("10: Original").alias("TSEST: Adjustment Type"),
        F.lit("50: Australia").alias("REGION: Region"),
        F.lit("M: Monthly").alias("FREQ: Frequency"),
        F.col("period").alias("TIME_PERIOD"),
        F.col("value").cast("string").alias("OBS_VALUE"),
        F.lit("").alias("UNIT_MEASURE: Unit of Measure"),
    ).write.option("header", True).csv(path)
    return IN.parse_indicators(IN.read_labelled_csv(spark, path), harvested_at=views.as_of())


@query("p08_indicator_rows", ctes(INDICATORS) + "select item_name, measure, count(*) as observations, min(period) as first_period from indicators group by 1, 2")
def indicator_rows(spark, d):
    return _parsed_indicators(spark, d).groupBy("item_name", "measure").agg(
        F.count(F.lit(1)).alias("observations"), F.min("period").alias("first_period")
    )


# --------------------------------------------------------------- social files
def _search_pages(spark, d):
    rows = views.text_posts(spark, d)
    post = F.struct(
        F.when(F.col("doc_id") % 10 != 9, F.concat(F.lit("at://"), F.col("id"))).alias("uri"),
        F.when(F.col("doc_id") % 20 != 19, F.concat(F.lit("cid-"), F.col("doc_id").cast("string"))).alias("cid"),
        F.struct(F.col("text").alias("text"), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt")).alias("record"),
        F.struct(F.col("source").alias("handle"), F.col("lang").alias("displayName")).alias("author"),
        F.col("like_count").alias("likeCount"), F.col("reply_count").alias("replyCount"),
    )
    return rows.select(
        F.coalesce("category", F.lit("housing")).alias("category"), F.lit("rent prices").alias("query"),
        F.lit("2026-01-01T00:00:00Z").alias("collected_at"), post.alias("post"),
    )


LOCAL = bounded(V.SOCIAL_LOCAL_TERMS["bluesky"], "lower(concat(text, ' ', source))")


@query(
    "s08_social_search",
    BASE + f""", n as (select *, trim(regexp_replace(text, '\\s+', ' ', 'g')) as t, case when doc_id % 10 <> 9 then concat('at://', id) when doc_id % 20 <> 19 then concat('cid-', doc_id) end as sid from text_posts)
select concat('bluesky:', sid) as _id, coalesce(category, 'housing') as category, sid as source_id, source as author_handle, lang as author_display_name, sha1(t) as text_key,
  strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at, like_count, cast(0 as bigint) as quote_count, case when category = 'fuel' then 'fuel terms' else 'rent prices' end as search_term
  from n where sid is not null and {LOCAL}""",
)
def social_search(spark, d):
    path = scratch_dir(spark, "social-search")
    _search_pages(spark, d).write.json(path)
    pages = ST.read_json_store(spark, path, schemas.SOCIAL_SEARCH)
    rows = SO.search_rows(pages, expressions={"fuel": "fuel terms"})
    return rows.select(
        "_id", "category", "source_id", "author_handle", "author_display_name", F.sha1("text").alias("text_key"),
        "created_at", "like_count", "quote_count", "search_term",
    )


STATUS_LOCAL = bounded(V.SOCIAL_LOCAL_TERMS["mastodon"], "lower(concat_ws(' ', t, 'rents', lang, u))")
STATUS_SQL = "with pg as (select *, regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g') as t0 from pages), " + (
    "tx as (select *, trim(regexp_replace(" + ENTITIES.replace("replace(t,", "replace(t0,") + ", '\\s+', ' ', 'g')) as t, case when page_id % 3 = 0 then 'https://aus.social/@x/' || page_id else url end as u, "
    "case when page_id % 4 = 0 then 'fr' else 'perth' end as lang, timestamp '2025-03-01' + to_hours(cast(page_id as int)) as c from pg)"
)


@query(
    "s09_social_status",
    STATUS_SQL + f""" select concat('mastodon:mastodon:', page_id) as _id, cast(page_id as varchar) as source_id, u as url, sha1(t) as text_key, '#rents' as api_query,
  strftime(c, '%Y-%m-%dT%H:%M:%SZ') as created_at, page_id % 5 as like_count from tx where c >= timestamp '2025-03-02' and c <= timestamp '2025-03-09' and t <> '' and {STATUS_LOCAL}""",
)
def social_status(spark, d):
    """Pages as statuses with HTML content; the interval is a filter of the source."""
    return _social_status(spark, d, F.col("page_id"))


@query(
    "s09_social_status_spread",
    STATUS_SQL.replace("to_hours(cast(page_id as int))", "to_hours(cast(page_id % 200 as int))")
    + f""" select concat('mastodon:mastodon:', page_id) as _id, cast(page_id as varchar) as source_id, u as url, sha1(t) as text_key, '#rents' as api_query,
  strftime(c, '%Y-%m-%dT%H:%M:%SZ') as created_at, page_id % 5 as like_count from tx where c >= timestamp '2025-03-02' and c <= timestamp '2025-03-09' and t <> '' and {STATUS_LOCAL}""",
)
def social_status_spread(spark, d):
    """The same with a clock that has 169 of each 200 pages inside the interval, at every scale."""
    return _social_status(spark, d, F.col("page_id") % 200)


def _social_status(spark, d, hours):
    path = scratch_dir(spark, "social-status")
    created = F.timestamp_seconds(F.lit(1740787200) + hours * 3600)
    status = F.struct(
        F.col("page_id").cast("string").alias("id"),
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://aus.social/@x/"), F.col("page_id").cast("string"))).otherwise(F.col("url")).alias("url"),
        F.col("html").alias("content"), F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(F.when(F.col("page_id") % 4 == 0, "fr").otherwise("perth").alias("acct")).alias("account"),
        (F.col("page_id") % 5).alias("favourites_count"),
    )
    views.table(spark, d, "pages").select(
        F.lit("housing").alias("category"), F.lit("rents").alias("query"), F.lit("2026-01-01T00:00:00Z").alias("collected_at"), status.alias("status")
    ).write.json(path)
    pages = ST.read_json_store(spark, path, schemas.SOCIAL_STATUS)
    since, until = (F.lit(t).cast("timestamp") for t in ("2025-03-02", "2025-03-09"))
    return SO.status_rows(pages, since=since, until=until).select(
        "_id", "source_id", "url", F.sha1("text").alias("text_key"), "api_query", "created_at", "like_count"
    )


@query("s10_taxonomy_csv", "select concat(p_brand, '-', p_partkey) as topic, w as keyword, i - 1 as keyword_rank from (select p_brand, p_partkey, unnest(string_split(p_type, ' ')) as w, generate_subscripts(string_split(p_type, ' '), 1) as i from part)")
def taxonomy_csv(spark, d):
    path = scratch_dir(spark, "taxonomy")
    views.table(spark, d, "part").select(
        F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string")).alias("topic"),
        F.concat(F.replace("p_type", F.lit(" "), F.lit("; ")), F.lit(";")).alias("keywords"), F.lit("why?").alias("example_question"),
    ).write.option("header", True).csv(path)
    rows = ST.read_taxonomy(spark, path)
    return rows.withColumn("keyword_rank", F.col("keyword_rank").cast("bigint"))


# ----------------------------------------------------------------- unified rows
def _streams(spark, d):
    rows = views.text_posts(spark, d).withColumn("_id", F.col("id")).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    rows = rows.withColumn("collected_at", F.lit("2026-01-01T00:00:00Z")).drop("id", "source", "source_index")
    out = {}
    for p in ("bluesky", "mastodon", "gdelt"):
        part = rows.where(F.col("platform") == p)
        out[p] = part.withColumn("platform", F.lit("gdelt_gkg")) if p == "gdelt" else part
    return out


UNIFIED = BASE + """, u as (select *, case platform when 'gdelt' then 'gdelt_gkg_raw' else concat(platform, '_raw_stream') end as idx from text_posts),
unified as (select concat('unified-', sha1(concat(idx, '|', id))) as id, platform, idx as source_index, id as source_es_id, source_id, coalesce(category, '') as category,
  coalesce(category, '') as harvested_query, 'unknown' as author, sha1(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as text_key, url, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at,
  case when platform <> 'gdelt' then like_count end as like_count, case when platform <> 'gdelt' then coalesce(repost_count, 0) end as repost_count,
  platform <> 'gdelt' as has_engagement_metrics, 'pending' as analysis_status, 'raw' as stage from u)"""
UNIFIED_COLUMNS = ("id", "platform", "source_index", "source_es_id", "source_id", "category", "harvested_query", "author", "url",
                   "like_count", "repost_count", "has_engagement_metrics", "analysis_status", "stage")


def _unified(spark, d):
    return SR.unify_all(_streams(spark, d), imported_at=views.as_of())


@query("p01_unified_rows", UNIFIED + " select * from unified")
def unified_rows(spark, d):
    return _unified(spark, d).select(*UNIFIED_COLUMNS, F.sha1("text").alias("text_key"), F.date_format("created_at", TSF).alias("created_at"))


@query("s11_multi_source_scan", UNIFIED + " select platform, count(*) as n from unified group by 1")
def multi_source_scan(spark, d):
    return _unified(spark, d).groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x01_source_registry",
    UNIFIED + " select platform, count(*) as n from unified where platform = 'bluesky' group by 1 union all select 'forum', count(*) from text_posts where platform = 'mastodon'",
)
def source_registry(spark, d):
    """A further source with its own normaliser, added by one registry entry."""
    forum = SourceSpec("forum", "social", "forum_raw", normaliser=lambda df: df.withColumn("platform", F.lit("forum")))
    streams = _streams(spark, d)
    frames = {"bluesky": streams["bluesky"], "forum": streams["mastodon"]}
    out = SR.unify_all(frames, (*SOURCES, forum), imported_at=views.as_of())
    return out.groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p02_raw_records",
    BASE + """select concat('mastodon-', sha1(concat('mastodon|', source_id, '|', url, '|', strftime(created_at, '%Y-%m-%d'), '|', text))) as id,
  like_count, reply_count, repost_count, cast(null as bigint) as quote_count, 'unknown' as author, coalesce(category, '') as location_hint from text_posts""",
)
def raw_records(spark, d):
    rows = views.text_posts(spark, d).select(
        "source_id", "text", F.col("lang").alias("query"), F.date_format("created_at", "yyyy-MM-dd").alias("created_at"),
        F.lit("").alias("author"), F.col("category").alias("location_hint"), "url",
        F.struct("like_count", F.col("reply_count").alias("replies_count"), F.col("repost_count").alias("reblogs_count")).alias("engagement"),
    )
    return SR.raw_record(rows, platform="mastodon", source="feed", harvested_at=views.as_of()).select(
        "id", "like_count", "reply_count", "repost_count", "quote_count", "author", "location_hint"
    )


@query("p10_provenance", UNIFIED + """ select source_index, source_es_id, 'category|collected_at|created_at|doc_id|lang|like_count|platform|quote_count|reply_count|repost_count|source_id|text|url' as source_fields from unified""")
def provenance(spark, d):
    return _unified(spark, d).select(
        "payload.source_index", "payload.source_es_id", F.array_join("payload.source_fields", "|").alias("source_fields")
    )


@query("p12_author_and_query", BASE + """select id, case when lang = 'en' then 'handle' when lang = 'fr' then lang else concat(source, '.org') end as author, concat_ws(' | ', category, nullif(lang, 'en')) as harvested_query, concat(source, '.org') as location_hint from text_posts""")
def author_and_query(spark, d):
    rows = views.text_posts(spark, d).select(
        F.col("id").alias("_id"), "text", "category", F.when(F.col("lang") != "en", F.col("lang")).alias("search_term"), F.lit(" ").alias("api_query"),
        F.when(F.col("lang") == "en", " handle ").alias("author_handle"), F.when(F.col("lang") == "fr", F.col("lang")).alias("author_display_name"),
        F.concat("source", F.lit(".org")).alias("domain"),
    )
    return SR.unify(rows, SOURCES[2], imported_at=views.as_of()).select(F.col("source_es_id").alias("id"), "author", "harvested_query", "location_hint")


@query("f15_usable_rows", BASE + "select id from text_posts where url <> '' and category is not null and created_at >= timestamp '2025-01-10' and created_at <= timestamp '2025-01-30'")
def usable_rows(spark, d):
    from tidemark.operators.filters import is_usable

    since, until = (F.lit(t).cast("timestamp") for t in ("2025-01-10", "2025-01-30"))
    return views.text_posts(spark, d).where(is_usable(F.col("url"), F.col("category"), F.col("created_at"), since, until)).select("id")


# ---------------------------------------------------------------------- sinks
VERSIONS = ctes(POSTS) + """, first_batch as (select raw_id as id, platform, created_at, harvested_at, 1 as version, k from all_posts where k % 3 <> 0),
second_batch as (select raw_id as id, platform, created_at + to_days(cast(k % 40 as int)) as created_at, harvested_at + to_hours(1) as harvested_at, 2 as version, k from all_posts where k % 2 = 0)"""


def _versions(spark, d):
    rows = views.posts(spark, d).selectExpr("raw_id as id", "platform", "created_at", "harvested_at", "cast(substring(raw_id, 5) as bigint) as k")
    first = rows.where("k % 3 <> 0").withColumn("version", F.lit(1))
    second = rows.where("k % 2 = 0").withColumn("version", F.lit(2)).withColumn("created_at", F.expr("timestampadd(DAY, cast(k % 40 as int), created_at)")).withColumn(
        "harvested_at", F.expr("timestampadd(HOUR, 1, harvested_at)")
    )
    return K.with_month(first), K.with_month(second)


OUT = "select id, version, strftime(created_at, '%Y-%m') as created_month"


@query("k01_insert_if_absent", VERSIONS + OUT + " from first_batch union all " + OUT + " from second_batch where id not in (select id from first_batch)")
def insert_if_absent(spark, d):
    """Two overlapping batches with copies inside; the second one is written twice."""
    path = scratch_dir(spark, "insert")
    first, second = _versions(spark, d)
    K.insert_if_absent(first.unionByName(first), path)
    for _ in range(2):
        K.insert_if_absent(second, path)
    return spark.read.parquet(path).select("id", "version", F.col("created_month").cast("string").alias("created_month"))


@query("j06_only_new_ids", VERSIONS + "select id from second_batch where id not in (select id from first_batch)")
def only_new_ids(spark, d):
    first, second = _versions(spark, d)
    return second.select("id").join(first.select("id"), "id", "left_anti")


UPSERTED = VERSIONS + OUT + " from second_batch union all " + OUT + " from first_batch where id not in (select id from second_batch)"


@query("k02_upsert", UPSERTED)
def upsert(spark, d):
    """Later versions move rows to other months; written twice without change."""
    path = scratch_dir(spark, "upsert")
    first, second = _versions(spark, d)
    K.upsert(first, path)
    for _ in range(2):
        K.upsert(second, path)
    return spark.read.parquet(path).select("id", "version", F.col("created_month").cast("string").alias("created_month"))


@query("w07_last_write_wins", UPSERTED)
def last_write_wins(spark, d):
    first, second = _versions(spark, d)
    return last_per_key(first.unionByName(second), ["id"], [F.col("harvested_at"), F.col("version")]).select("id", "version", "created_month")


@query("u04_dedupe_by_id", "select doc_key, min(doc_id) as doc_id from (select sha1(text) as doc_key, doc_id from documents) group by 1")
def dedupe_by_id(spark, d):
    rows = views.table(spark, d, "documents").select(F.sha1("text").alias("doc_key"), "doc_id")
    return last_per_key(rows, ["doc_key"], [F.col("doc_id")], first=True)


@query(
    "k03_status_write_back",
    ctes(POSTS, RAW) + """select coalesce(case when k % 4 = 0 then 'processed' when k % 4 = 1 then 'discarded' end, analysis_status) as analysis_status,
  k % 4 < 2 as stamped, count(*) as n from raw_posts group by 1, 2""",
)
def status_write_back(spark, d):
    raw = views.raw_posts(spark, d)
    results = raw.where("k % 4 < 2").select("id", F.when(F.col("k") % 4 == 0, "processed").otherwise("discarded").alias("status"), views.as_of().alias("processed_at"))
    out = K.with_results(raw, results)
    return out.groupBy("analysis_status", F.col("analysis_processed_at").isNotNull().alias("stamped")).agg(F.count(F.lit(1)).alias("n"))


@query("k04_replace_table", VERSIONS + OUT + " from second_batch")
def replace_table(spark, d):
    path = scratch_dir(spark, "replace")
    first, second = _versions(spark, d)
    K.replace_table(first, path)
    K.replace_table(second, path)
    return spark.read.parquet(path).select("id", "version", F.col("created_month").cast("string").alias("created_month"))


ROLLUP = ctes(POSTS, LABELS) + f""", placed as (select *, unnest(['all', source_group]) as grp from posts where clean)
select strftime(created_at, '%Y-%m') as period, grp as source_group, topic as cost_category, {KEYS}, {mean4()} as avg_sentiment from placed group by 1, 2, 3"""


@query("k05_rollup_write", ROLLUP)
def rollup_write(spark, d):
    """Written by period, then the later periods are written again over themselves."""
    path = scratch_dir(spark, "rollup")
    rollup = monthly_rollup(views.posts(spark, d))
    K.replace_partitions(rollup, path, partition="period")
    K.replace_partitions(rollup.where(F.col("period") >= "1998-01"), path, partition="period")
    return spark.read.parquet(path).select(
        F.col("period").cast("string").alias("period"), "source_group", "cost_category", "document_count", "unique_document_count", "duplicate_ratio", "avg_sentiment"
    )


@query("k06_stable_view", VERSIONS + "select platform, count(*) as n from first_batch where created_at >= timestamp '1997-01-01' and created_at < timestamp '1997-03-01' group by 1")
def stable_view(spark, d):
    path = scratch_dir(spark, "view")
    first, _ = _versions(spark, d)
    K.replace_table(first, path)
    posts = K.stable_view(spark, path, "posts_current")
    return posts.where(F.col("created_month").isin("1997-01", "1997-02")).groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query("k07_write_accounting", VERSIONS + """, n as (select count(*) as a, count(*) filter (where id not in (select id from first_batch)) as w from second_batch)
select 2 * a + 1 as attempted, w as written, 2 * a - w as skipped, 1 as rejected from n""")
def write_accounting(spark, d):
    """Every row of the batch comes twice, and one has no id."""
    path = scratch_dir(spark, "accounting")
    first, second = _versions(spark, d)
    K.insert_if_absent(first, path)
    unnamed = second.orderBy("id").limit(1).withColumn("id", F.lit(None).cast("string"))
    return K.insert_if_absent(second.unionByName(second).unionByName(unnamed), path)


