"""Keyword frequency per topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions.labels import Taxonomy
from tidemark.functions.matching import count_phrase, count_word, letter_tokens, without_stopwords
from tidemark.functions.staging import staged
from tidemark.operators.filters import PostFilter, filter_posts, split_csv
from tidemark.registry import topic_label


def bounded_sample(df: DataFrame, size: int, key: str) -> DataFrame:
    """Sampling operator: the first `size` rows in key order (a top-k, no full sort)."""
    if size < 1:
        raise ValueError("a sample needs a positive size")
    return df.orderBy(key).limit(size)


def _keyword_counts(text: Column, terms: Sequence[str]) -> Column:
    """array<struct(keyword, n)> of the terms found in one text.

    A term with a blank is counted as a substring, a term of one word among the word tokens, any other
    term (hyphen, apostrophe) by regex.
    """
    phrases = [t for t in terms if " " in t]
    words = [t for t in terms if " " not in t and t.isalnum()]
    others = [t for t in terms if " " not in t and not t.isalnum()]
    parts = []
    if words:
        tokens = F.filter(
            F.split(text, r"(?U)[^\w]+"), lambda w: F.array_contains(F.array(*[F.lit(t) for t in words]), w)
        )
        parts.append(
            F.transform(tokens, lambda w: F.struct(w.alias("keyword"), F.lit(1).cast("bigint").alias("n")))
        )
    counted = [(t, count_phrase(text, F.lit(t))) for t in phrases] + [(t, count_word(text, t)) for t in others]
    if counted:
        parts.append(
            F.filter(
                F.array(*[F.struct(F.lit(t).alias("keyword"), n.alias("n")) for t, n in counted]),
                lambda entry: entry["n"] > 0,
            )
        )
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def category_keywords(
    df: DataFrame,
    f: PostFilter = PostFilter(),
    *,
    category: str | None = None,
    limit: int = 20,
    sample_size: int | None = None,
    sample_key: str = "raw_id",
    taxonomy: Taxonomy = V.TAXONOMY,
    stopwords: Sequence[str] = V.STOPWORDS,
    processed_only: bool = True,
) -> DataFrame:
    """Top keywords per topic: (cost_category, category_label, keyword, frequency, rank).

    Counts cover all rows unless a sample size is asked for. Topics whose texts hold none of their
    taxonomy terms list their most frequent plain tokens instead. Ties follow taxonomy order, tokens
    the alphabet. Counting is a partial sum per (topic, keyword); the top-k keeps `limit` rows per task
    before the shuffle.
    """
    topics = split_csv(category) or sorted(taxonomy)
    rows = filter_posts(df, f, processed_only=processed_only).where(F.col("topic").isin(topics))
    if sample_size is not None:
        rows = bounded_sample(rows, sample_size, sample_key)
    has_raw = "raw_text" in rows.columns
    text = F.coalesce(F.nullif(F.col("text"), F.lit("")), F.col("raw_text")) if has_raw else F.col("text")
    texts = staged(rows.select("topic", text.alias("_raw")), {"_text": F.lower(F.coalesce("_raw", F.lit("")))}).drop("_raw")

    found = F.lit(None)
    rank = F.lit(None)
    for topic in topics:
        terms = [t.casefold() for t in taxonomy.get(topic, ())]
        if not terms:
            continue
        found = F.when(F.col("topic") == topic, _keyword_counts(F.col("_text"), terms)).otherwise(found)
        rank = F.when(
            F.col("topic") == topic, F.array_position(F.array(*[F.lit(t) for t in terms]), F.col("keyword"))
        ).otherwise(rank)
    counts = (
        texts.select("topic", F.inline(found))
        .groupBy("topic", "keyword").agg(F.sum("n").alias("frequency"))
        .withColumn("_rank", rank.cast("bigint"))
    )
    # at most len(topics) rows; summing the frequency keeps the plan below equal, so its shuffle is reused
    covered = counts.groupBy("topic").agg(F.sum("frequency").alias("_f")).where("_f > 0").select("topic")
    missing = texts.join(F.broadcast(covered), "topic", "left_anti")
    tokens = (
        missing.select("topic", F.explode(without_stopwords(letter_tokens(F.col("_text")), stopwords)).alias("keyword"))
        .groupBy("topic", "keyword").agg(F.count(F.lit(1)).alias("frequency"))
        .withColumn("_rank", F.lit(0).cast("bigint"))
    )
    order = Window.partitionBy("topic").orderBy(F.col("frequency").desc(), "_rank", "keyword")
    return (
        counts.unionByName(tokens)
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= limit)
        .select(
            F.col("topic").alias("cost_category"), topic_label(F.col("topic")).alias("category_label"),
            "keyword", "frequency", "rank",
        )
    )
