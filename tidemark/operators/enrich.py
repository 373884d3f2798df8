"""Raw rows to processed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import labels as L
from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions.matching import HybridMatcher
from tidemark.functions.sentiment import Scorer, sentiment_label, with_scores
from tidemark.functions.staging import staged
from tidemark.registry import group_of

MODEL_NAME = "vader"
MODEL_VERSION = "lexicon_topic_sentiment_1"
COUNTERS = ("like_count", "reply_count", "repost_count", "quote_count")
OPTIONAL = ("source_index", "source_es_id", "source_id", "url", "gkg_url", "category", "created_at", "harvested_at", "collected_at", *COUNTERS)


def label_rows(raw: DataFrame, *, taxonomy: L.Taxonomy = V.TAXONOMY) -> DataFrame:
    """All columns that need the row alone: cleaning, topic, keywords, relevance, flags, status.

    Each costly column is made once and read by the later ones.
    """
    types = {c: "bigint" for c in COUNTERS} | {"created_at": "timestamp", "harvested_at": "timestamp", "collected_at": "timestamp"}
    for name in OPTIONAL:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast(types.get(name, "string")))
    rows = staged(
        raw, {"_clean": S.clean_markup(F.col("text")), "_eng": N.engagement_total(*[F.col(c) for c in COUNTERS])}
    )
    clean = F.col("_clean")
    rows, matcher = HybridMatcher.attach(rows, clean, "_c")
    news = F.when(F.lower("platform") == "gdelt", F.col("text"))  # local context is asked of news rows only
    rows, raw_matcher = HybridMatcher.attach(rows, news, "_n")
    rows = staged(
        rows,
        {
            "_score": L.relevance_score(clean, F.col("platform"), F.col("_eng")),
            "_kw": L.keywords_of(matcher, taxonomy),
            "_local": L.has_local_context(raw_matcher),
        },
    )
    topic = L.topic_of_keywords(F.col("_kw"), taxonomy)
    return rows.withColumns(
        {
            "_topic": L.resolved_topic(topic, F.col("category")),
            "_flags": L.quality_flags(
                F.col("text"), clean, F.col("platform"), F.col("url"), F.col("_eng"), F.col("_score"),
                F.col("_local"),
            ),
            "_status": L.outcome_of(F.col("_score"), F.col("id").isNull()),
        }
    )


def enrich(
    raw: DataFrame,
    scorer: Scorer | DataFrame,
    *,
    taxonomy: L.Taxonomy = V.TAXONOMY,
    processed_at: Column | None = None,
    model: tuple[str, str] = (MODEL_NAME, MODEL_VERSION),
    keep: Sequence[str] = (),
) -> DataFrame:
    """`raw_posts` rows to `posts` rows; `scorer` may also be a lexicon table of any size.

    Rows with a relevance below -2 are discarded and get no score. Every step is row-wise: nothing is
    shuffled, and the cost grows with the number of rows alone (but for a lexicon too large for an expression).
    The columns of `raw` in `keep` go along as a struct `_raw`.
    """
    rows = label_rows(raw, taxonomy=taxonomy)
    wanted = F.when(F.col("_status") == "processed", F.col("_clean"))
    if isinstance(scorer, DataFrame):
        rows = with_scores(rows, wanted, scorer, "_compound")
    else:
        rows = rows.withColumn("_compound", scorer(wanted))
    score = F.when(F.col("_status") == "processed", F.rint(F.col("_compound") * 10_000) / 10_000)
    rows = rows.withColumn("_sentiment", score)
    score = F.col("_sentiment")
    return rows.select(
        F.col("id").alias("raw_id"),
        S.canonical_id(
            F.col("platform"), url=F.col("url"), archive_url=F.col("gkg_url"), source_id=F.col("source_id"),
            source_es_id=F.col("source_es_id"), raw_id=F.col("id"),
        ).alias("canonical_id"),
        "source_index", "source_es_id", "platform",
        group_of(F.col("platform")).alias("source_group"),
        "created_at", F.coalesce("harvested_at", "collected_at").alias("harvested_at"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
        F.col("_clean").alias("text"),
        F.col("text").alias("raw_text"),
        "category",
        F.col("category").alias("harvest_category"),
        "_topic.topic", "_topic.topic_source",
        F.col("_kw").alias("matched_keywords"),
        sentiment_label(score).alias("sentiment_label"),
        score.alias("sentiment_score"),
        F.lit(model[0]).alias("model_name"),
        F.lit(model[1]).alias("model_version"),
        F.lit(model[1]).alias("processor_version"),
        F.col("_status").alias("processing_status"),
        *COUNTERS,
        "url",
        F.col("_score").alias("relevance_score"),
        F.col("_flags").alias("quality_flags"),
        *([F.struct(*keep).alias("_raw")] if keep else []),
    )
