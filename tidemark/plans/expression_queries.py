"""Registered scalar expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import matching as MT
from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions import times as TM
from tidemark.functions.matching import HybridMatcher, WordMatcher
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.text_queries import BASE, CLEAN, bounded, hybrid, sql_list
from tidemark.plans.views import POSTS, REQUESTS, ctes

W = r"[^\pL\pM\pN_]"


def expression(name: str, table: str, key: str, build, sql: str, sql_from: str | None = None, prefix: str = ""):
    """Register one expression over one table: (key, value)."""

    @query(name, f"{prefix}select {key}, {sql} as value from {sql_from or table}")
    def run(spark, d):
        source = {
            "text_posts": views.text_posts, "posts": views.posts, "requests": views.requests,
        }.get(table)
        frame = source(spark, d) if source else views.table(spark, d, table)
        return frame.select(key, build().alias("value"))

    return run


def text(name, build, sql):
    return expression(name, "text_posts", "doc_id", build, sql, prefix=BASE)


T = lambda: F.col("text")
SQUEEZED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"

text("e01_clean_markup", lambda: S.clean_markup(T()), CLEAN)
text("e02_fold", lambda: F.sha1(S.fold(T())), "sha1(lower(text))")
SPELLED = "lower(text)"
for letter, folded in S.LONG_FOLDINGS.items():
    SPELLED = f"replace({SPELLED}, '{letter}', '{folded}')"
FOLDED = f"translate({SPELLED}, '{''.join(S.LETTER_FOLDINGS)}', '{''.join(S.LETTER_FOLDINGS.values())}')"
text("e02_casefold", lambda: F.sha1(S.casefold(T())), f"sha1({FOLDED})")
text("e03_compact", lambda: F.sha1(S.compact(T())), f"sha1({SQUEEZED})")
text("e05_squeeze", lambda: F.length(S.squeeze(T())).cast("bigint"), f"length({SQUEEZED})")
text(
    "e06_hybrid_match",
    lambda: HybridMatcher.over(T()).any(["rent", "the", "cost-of-living", "power bill"]),
    hybrid(["rent", "the", "cost-of-living", "power bill"]),
)
text(
    "e07_word_match",
    lambda: WordMatcher.over(T()).any(["public transport", "cost-of-living"]),
    bounded(["public transport", "cost-of-living"], "lower(text)"),
)
TERMS = ["rent", "and", "que", "washing machine", "cost-of-living"]
text(
    "e08_matching_terms",
    lambda: F.array_join(F.array_sort(WordMatcher.over(T()).hits(TERMS)), "|"),
    "array_to_string(list_sort(list_filter(["
    + ", ".join(f"case when {bounded([t], 'lower(text)')} then '{t}' end" for t in TERMS)
    + "], lambda x: x is not null)), '|')",
)
text(
    "e09_substring_any",
    lambda: MT.contains_term(F.lower("text"), V.PROMOTION_TERMS),
    "(" + " or ".join(f"contains(lower(text), '{t}')" for t in V.PROMOTION_TERMS) + ")",
)
text(
    "e10_phrase_count",
    lambda: MT.count_phrase(F.lower("text"), F.lit("of the")),
    "(length(lower(text)) - length(replace(lower(text), 'of the', ''))) // 6",
)
text(
    "e11_word_count",
    lambda: MT.count_word(F.lower("text"), "the"),
    rf"len(list_filter(string_split_regex(lower(text), '{W}+'), lambda x: x = 'the'))",
)
text(
    "e12_tokens",
    lambda: F.size(MT.without_stopwords(MT.letter_tokens(F.lower("text")), V.STOPWORDS)),
    rf"cast(len(list_filter(string_split_regex(lower(text), '{W}+'), lambda x: regexp_full_match(x, '[a-z]{{3,}}') and not list_contains({sql_list(V.STOPWORDS)}, x))) as int)",
)
text("e13_char_count", lambda: S.count_char(T(), ";"), "cast(length(text) - length(replace(text, ';', '')) as int)")
text(
    "e36_sha1_identity",
    lambda: S.unified_id(F.col("source_index"), F.col("id")),
    "concat('unified-', sha1(concat(source_index, '|', id)))",
)
text(
    "e36_raw_record_identity",
    lambda: S.raw_record_id(F.col("platform"), F.col("source_id"), F.col("url"), F.col("category"), T()),
    "concat(platform, '-', sha1(concat(platform, '|', source_id, '|', url, '|', coalesce(category, ''), '|', text)))",
)
text("e37_md5_of_binary", lambda: F.md5(F.encode(T(), "UTF-8")), "md5(text)")
text(
    "e38_sorted_set",
    lambda: F.array_join(S.sorted_set(F.array("lang", "source", "platform", "lang")), "|"),
    "array_to_string(list_sort(list_distinct([lang, source, platform, lang])), '|')",
)
text(
    "e43_fallback_chain",
    lambda: S.first_filled(F.col("url"), F.col("category"), F.col("source_id")),
    "coalesce(nullif(url, ''), nullif(category, ''), nullif(source_id, ''))",
)
text(
    "e18_join_filled",
    lambda: S.join_filled(" | ", F.col("category"), F.col("url"), F.col("lang")),
    "concat_ws(' | ', nullif(category, ''), nullif(url, ''), lang)",
)
text(
    "e34_integer_or_null",
    lambda: N.whole_number(F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit("x")).otherwise(F.lit(" ")), F.col("doc_id").cast("string"))),
    "case when doc_id % 3 = 0 then null else doc_id end",
)
text(
    "e34_social_counter",
    lambda: N.social_count(F.when(F.col("doc_id") % 2 == 0, F.col("like_count")), F.col("platform") != "gdelt"),
    "case when platform <> 'gdelt' then case when doc_id % 2 = 0 then like_count else 0 end end",
)
text(
    "e41_nested_with_fallback",
    lambda: F.coalesce(
        F.struct(F.col("category").alias("a"), F.col("lang").alias("b")).getField("a"), F.lit("none")
    ),
    "coalesce(category, 'none')",
)

expression(
    "e04_trimmed", "part", "p_partkey",
    lambda: S.trimmed(F.concat(F.lit("  "), F.nullif(F.col("p_brand"), F.lit("Brand#11")), F.lit("\t "))),
    "case when p_brand = 'Brand#11' then '' else p_brand end",
)


@query("e14_column_by_prefix", "select s_suppkey, s_name as value, cast(null as varchar) as missing from supplier")
def column_by_prefix(spark, d):
    """Columns named `CODE` or `CODE: label`, resolved once against the schema."""
    from tidemark.sources.indicators import optional_column, required_column

    rows = views.table(spark, d, "supplier").withColumnRenamed("s_name", "NAME: Name of supplier")
    return rows.select(
        "s_suppkey", required_column(rows, "NAME").alias("value"), optional_column(rows, "UNIT").alias("missing")
    )


expression(
    "e15_code_part", "part", "p_partkey", lambda: S.label_code(F.concat(F.col("p_brand"), F.lit(': "'), F.col("p_type"), F.lit(': x"'))), "p_brand",
)
expression(
    "e15_label_part", "part", "p_partkey", lambda: S.label_text(F.concat(F.col("p_brand"), F.lit(': "'), F.col("p_type"), F.lit(': x"'))),
    "concat(p_type, ': x')",
)
expression(
    "e16_split_list", "part", "p_partkey",
    lambda: F.array_join(S.split_list(F.concat(F.col("p_brand"), F.lit(" , ,"), F.col("p_type"), F.lit(" "))), "|"),
    "concat(p_brand, '|', p_type)",
)
expression(
    "e17_title_case", "orders", "o_orderkey", lambda: S.title_of(F.regexp_replace(F.lower("o_orderpriority"), "[ -]+", "_")),
    "case o_orderpriority when '1-URGENT' then '1 Urgent' when '2-HIGH' then '2 High' when '3-MEDIUM' then '3 Medium' when '4-NOT SPECIFIED' then '4 Not Specified' else '5 Low' end",
)

# ------------------------------------------------------------------------ time
FMT = "yyyy-MM-dd HH:mm:ss"


def stamp(build):
    return lambda: F.date_format(build(), FMT)


def event(name, build, sql):
    return expression(name, "events", "event_id", build, sql)


TS = lambda pattern: F.date_format("ts", pattern)
SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
event(
    "e20_iso_time",
    stamp(lambda: TM.iso_time(
        F.when(F.col("event_id") % 3 == 0, TS("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 3 == 1, TS("yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.concat(F.lit("bad "), TS("yyyy"))))),
    f"case when event_id % 3 = 2 then null else {SECOND} end",
)
event(
    "e21_compact_time",
    stamp(lambda: TM.any_time(F.when(F.col("event_id") % 2 == 0, TS("yyyyMMdd'T'HHmmss'Z'")).otherwise(
        F.concat(TS("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))))),
    SECOND,
)
event("e22_stamp_time", stamp(lambda: TM.stamp_time(TS("yyyyMMddHHmmss"))), SECOND)
event("e23_period", lambda: F.concat_ws("|", TM.period_of(F.col("ts"), "day"), TM.period_of(F.col("ts"), "month")), "strftime(ts, '%Y-%m-%d|%Y-%m')")
expression(
    "e24_period_start", "orders", "o_orderkey",
    lambda: F.date_format(
        TM.period_start(
            F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM"))
            .when(F.col("o_orderkey") % 3 == 1, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-Q"), F.quarter("o_orderdate")))
            .otherwise(F.date_format("o_orderdate", "yyyy"))),
        "yyyy-MM-dd"),
    "strftime(date_trunc(case o_orderkey % 3 when 0 then 'month' when 1 then 'quarter' else 'year' end, o_orderdate), '%Y-%m-%d')",
)
event(
    "e25_day_edges",
    lambda: F.concat_ws("|", *[F.date_format(TM.day_edge(TS("yyyy-MM-dd"), end), FMT) for end in (False, True)]),
    "strftime(ts, '%Y-%m-%d 00:00:00|%Y-%m-%d 23:59:59')",
)
event(
    "e26_months_back", lambda: F.date_format(TM.months_back(F.col("ts").cast("timestamp"), 3), FMT),
    "strftime(ts - interval 91 days, '%Y-%m-%d %H:%M:%S')",
)
event(
    "e27_minutes_since",
    lambda: TM.minutes_since(F.col("ts").cast("timestamp"), F.lit("2024-02-01 00:00:00").cast("timestamp")),
    "round_even((epoch_us(timestamp '2024-02-01') - epoch_us(ts)) / 6e7 * 100, 0) / 100",
)

# --------------------------------------------------------------------- numbers
event("e28_round4", lambda: N.round4(F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value") / 7)),
      "case when event_id % 5 = 0 then null else round_even(value / 7 * 1e4, 0) / 1e4 end")
event("e29_safe_ratio", lambda: N.ratio(F.col("user_id"), F.col("event_id") % 4),
      "coalesce(round_even(cast(user_id as double) / nullif(event_id % 4, 0) * 1e4, 0) / 1e4, 0)")
event("e32_clamp", lambda: N.clamp(F.col("event_id"), 100, 5000), "least(greatest(event_id, 100), 5000)")
event("e33_batches_needed", lambda: N.batches_needed(F.col("event_id"), 250, 50), "least(50, cast(ceil(event_id / 250.0) as bigint))")


@query("e30_population_deviation", "select event_type, round(stddev_pop(user_id), 6) as deviation from events group by 1")
def population_deviation(spark, d):
    return views.table(spark, d, "events").groupBy("event_type").agg(F.round(F.stddev_pop("user_id"), 6).alias("deviation"))


@query(
    "e35_min_max_scaling",
    """with g as (select user_id, event_type, count(*) as n from events group by 1, 2)
select user_id, event_type, coalesce(round_even(cast(n - min(n) over w as double) / nullif(max(n) over w - min(n) over w, 0) * 1e4, 0) / 1e4, 0) as scaled
from g window w as (partition by user_id)""",
)
def min_max_scaling(spark, d):
    from tidemark.operators.metrics import min_max_scaled

    counts = views.table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return min_max_scaled(counts, "user_id", "n", "scaled").drop("n")


# ----------------------------------------------------------------------- arrays
@query("e39_flag_intersection", ctes(POSTS) + "select list_has_any(quality_flags, ['metadata_heavy']) as flagged, count(*) as n from all_posts group by 1")
def flag_intersection(spark, d):
    from tidemark.operators.filters import carries_flag

    flags = F.when(F.size("quality_flags") > 0, F.col("quality_flags"))  # empty arrays as null
    rows = views.posts(spark, d).withColumn("quality_flags", flags)
    return rows.groupBy(carries_flag(["metadata_heavy"]).alias("flagged")).agg(F.count(F.lit(1)).alias("n"))


@query("e40_array_expansion", ctes(POSTS) + "select raw_id, unnest(quality_flags) as flag from all_posts")
def array_expansion(spark, d):
    return views.posts(spark, d).select("raw_id", F.explode("quality_flags").alias("flag"))


@query("e19_html_to_text", "select page_id, concat(url, ' <&> ', chr(233)) as text from pages")
def html_text(spark, d):
    """Tags, breaks and named, numeric and unterminated entities around each link."""
    markup = F.concat(F.lit("<p>\n"), F.col("url"), F.lit("</p><BR />&lt;&amp&#62; <i>&eacute;</i>"))
    return views.table(spark, d, "pages").select("page_id", S.html_to_text(markup).alias("text"))


@query("e31_nearest_rank", ctes(REQUESTS) + """, r as (select route, duration_ms, row_number() over (partition by route order by duration_ms) - 1 as i, count(*) over (partition by route) as n from requests)
select route, max(duration_ms) as p95 from r where i = cast(round_even((n - 1) * 0.95, 0) as bigint) group by 1""")
def nearest_rank(spark, d):
    from tidemark.operators.profile import nearest_rank as rank_of

    return rank_of(views.requests(spark, d), ["route"], "duration_ms", 0.95).select("route", F.col("value").alias("p95"))
