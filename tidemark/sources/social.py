"""Landed social pages to raw stream rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.functions.labels import mentions_place
from tidemark.functions.staging import staged
from tidemark.operators.filters import is_usable


def _search_term(expressions: Mapping[str, str] | None) -> Column:
    """Search expression of the category, else the query itself."""
    term = F.col("query")
    for category, expression in (expressions or {}).items():
        term = F.when(F.col("category") == category, F.lit(expression)).otherwise(term)
    return term


def search_rows(df: DataFrame, *, platform: str = "bluesky", instance: str = "bluesky",
                expressions: Mapping[str, str] | None = None) -> DataFrame:
    """Search hits (`schemas.SOCIAL_SEARCH`) to rows. Hits without id, text or local context are dropped."""
    post = F.col("post")
    text = S.squeeze_or_empty(post["record"]["text"])
    rows = staged(df, {"_text": text, "_id": S.first_filled(post["uri"], post["cid"])})
    local = mentions_place(
        F.col("_text"), F.col("query"), post["author"]["handle"], terms=V.SOCIAL_LOCAL_TERMS["bluesky"]
    )
    zero = F.lit(0).cast("bigint")
    return rows.where(is_usable(F.col("_id"), F.col("_text")) & local).select(
        F.concat(F.lit(f"{platform}:"), F.col("_id")).alias("_id"),
        F.lit(platform).alias("platform"), F.lit(instance).alias("instance"), F.lit("raw").alias("stage"),
        "category", _search_term(expressions).alias("search_term"), F.col("query").alias("api_query"),
        F.col("_id").alias("source_id"), post["cid"].alias("cid"),
        F.coalesce(post["author"]["handle"], F.lit("")).alias("author_handle"),
        post["author"]["displayName"].alias("author_display_name"),
        F.col("_text").alias("text"), post["record"]["createdAt"].alias("created_at"),
        *[
            F.coalesce(post[source], zero).alias(name)
            for source, name in (("likeCount", "like_count"), ("replyCount", "reply_count"),
                                 ("repostCount", "repost_count"), ("quoteCount", "quote_count"))
        ],
        F.lit("").alias("url"), "collected_at",
    )


def status_rows(df: DataFrame, *, since: Column, until: Column, platform: str = "mastodon",
                instance: str = "mastodon", base_url: str = "",
                expressions: Mapping[str, str] | None = None) -> DataFrame:
    """Statuses with HTML content (`schemas.SOCIAL_STATUS`) inside [since, until] to rows."""
    status = F.col("status")
    created = times.iso_time(status["created_at"])
    inside = F.coalesce(created.between(since, until), F.lit(False))
    url = F.coalesce(S.first_filled(status["url"], status["uri"]), F.lit(""))
    source_id = S.first_filled(status["uri"], status["id"])
    handle = F.coalesce(S.first_filled(status["account"]["acct"], status["account"]["username"]), F.lit(""))
    # the cheap interval test comes first, so only rows inside it are stripped of HTML
    rows = staged(df.where(inside), {"_text": S.html_to_text(status["content"]), "_sid": source_id, "_url": url})
    local = mentions_place(
        F.col("_text"), F.col("query"), status["account"]["acct"], F.col("_url"), F.lit(base_url),
        terms=V.SOCIAL_LOCAL_TERMS["mastodon"],
    )
    zero = F.lit(0).cast("bigint")
    return rows.where(is_usable(F.col("_sid"), F.col("_text")) & local).select(
        F.concat(F.lit(f"{platform}:{instance}:"), F.col("_sid")).alias("_id"),
        F.lit(platform).alias("platform"), F.lit(instance).alias("instance"), F.lit("raw").alias("stage"),
        "category", _search_term(expressions).alias("search_term"),
        F.concat(F.lit("#"), F.col("query")).alias("api_query"),
        F.col("_sid").alias("source_id"), F.coalesce(status["id"], F.lit("")).alias("post_id"),
        handle.alias("author_handle"), status["account"]["display_name"].alias("author_display_name"),
        F.col("_text").alias("text"),
        F.date_format(times.iso_time(status["created_at"]), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
        *[
            F.coalesce(status[source], zero).alias(name)
            for source, name in (("favourites_count", "like_count"), ("replies_count", "reply_count"),
                                 ("reblogs_count", "repost_count"))
        ],
        zero.alias("quote_count"), F.col("_url").alias("url"), "collected_at",
    )
