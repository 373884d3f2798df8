"""Text labels: topic, keywords, relevance, quality flags, news categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions.matching import HybridMatcher, WordMatcher, _literals, contains_term, let, overlaps, plain_tokens
from tidemark.functions.staging import staged
from tidemark.registry import social_platforms

Taxonomy = Mapping[str, Sequence[str]]


def first_of(options: Sequence[tuple[Column, str]]) -> Column:
    """Value of the first condition that holds, else null."""
    result = F.lit(None).cast("string")
    for condition, value in reversed(options):
        result = F.when(condition, F.lit(value)).otherwise(result)
    return result


def all_terms(taxonomy: Taxonomy) -> list[str]:
    return [term for terms in taxonomy.values() for term in terms]


def topic_of(matcher: HybridMatcher, taxonomy: Taxonomy = V.TAXONOMY, default: str = V.DEFAULT_TOPIC) -> Column:
    """First topic in taxonomy order with any matching term."""
    return let(
        keywords_of(matcher, taxonomy), lambda found: F.coalesce(topic_of_keywords(found, taxonomy), F.lit(default))
    )


def keywords_of(matcher: HybridMatcher, taxonomy: Taxonomy = V.TAXONOMY) -> Column:
    """All matching taxonomy terms, sorted and distinct."""
    return matcher.hits(all_terms(taxonomy))


def topic_of_keywords(keywords: Column, taxonomy: Taxonomy = V.TAXONOMY) -> Column:
    """Topic from an array made by `keywords_of`: cheaper than matching the text again. Null if empty."""
    return first_of(
        [
            (overlaps(keywords, [t.casefold() for t in terms]), topic)
            for topic, terms in taxonomy.items()
        ]
    )


def resolved_topic(text_topic: Column, harvest_category: Column, default: str = V.DEFAULT_TOPIC) -> Column:
    """struct(topic, topic_source): from the text, else the harvesting category, else the default."""
    category = F.nullif(harvest_category, F.lit(""))
    known = F.nullif(text_topic, F.lit(default))
    return F.struct(
        F.coalesce(known, category, F.lit(default)).alias("topic"),
        F.when(known.isNotNull(), F.lit("text_keywords"))
        .when(category.isNotNull(), F.lit("harvest_category_fallback"))
        .otherwise(F.lit("default"))
        .alias("topic_source"),
    )


def topic_of_seed(seed: Column, taxonomy: Taxonomy = V.TAXONOMY, default: str = V.DEFAULT_TOPIC) -> Column:
    """Topic hint of a search seed; null for generic seeds and for seeds that match nothing."""
    lowered = F.lower(F.coalesce(seed, F.lit("")))
    plain = F.replace(S.strip_text(lowered), F.lit("_"), F.lit(" "))
    named = first_of([(plain == topic.replace("_", " "), topic) for topic in taxonomy])
    both = F.struct(lowered.alias("low"), plain_tokens(lowered).alias("tok"))
    matched = let(both, lambda s: topic_of(HybridMatcher(s["low"], s["tok"]), taxonomy, default))
    hint = F.coalesce(named, F.nullif(matched, F.lit(default)))
    return F.when(~plain.isin(*V.GENERIC_SEEDS), hint)


def has_local_context(matcher: HybridMatcher, terms: Sequence[str] = V.LOCAL_CONTEXT_TERMS) -> Column:
    return matcher.any(terms)


def mentions_place(*parts: Column, terms: Sequence[str]) -> Column:
    """Any local term, standing alone, in the joined parts."""
    return WordMatcher.over(S.join_filled(" ", *parts)).any(terms)


def with_relevance(
    df: DataFrame,
    text: str = "text",
    *,
    hint: Column | None = None,
    trust_hint: Column | bool = False,
    name: str = "relevant",
    taxonomy: Taxonomy = V.TAXONOMY,
    default: str = V.DEFAULT_TOPIC,
    blocked: Mapping[str, Sequence[str]] = V.BLOCKED_TERMS,
    strict: Sequence[str] = V.STRICT_TOPICS,
    local_name: str | None = None,
) -> DataFrame:
    """Add a boolean: is the text about the scenario? And, under `local_name`, if it has local context.

    Noise, blocked terms of its topic, and foreign places without a local one rule a text out. Strict
    topics need a keyword and a cost signal (a trusted hint equal to the topic replaces the signal);
    all other topics need either. The text is tokenised and searched once; later steps read the
    resulting small columns.
    """
    hint = F.lit(None).cast("string") if hint is None else F.nullif(hint, F.lit(""))
    trust = F.lit(trust_hint) if isinstance(trust_hint, bool) else F.coalesce(trust_hint, F.lit(False))
    df = staged(df, {"_hint": hint, "_trust": trust})
    df, m = HybridMatcher.attach(df, F.col(text), "_r")
    cost_terms = [*V.COVERAGE_TERMS, *V.COMPLAINT_TERMS]
    lists = [*taxonomy.values(), *blocked.values(), cost_terms, V.FOREIGN_TERMS, V.LOCAL_CONTEXT_TERMS, V.NOISE_TEXTS]
    df = staged(df, {"_hits": m.hits([term for terms in lists for term in terms])})
    found = lambda terms: overlaps(F.col("_hits"), [t.casefold() for t in terms])

    hint_found, is_blocked = F.lit(False), F.lit(False)
    for topic, terms in taxonomy.items():
        hint_found = F.when(F.col("_hint") == topic, found(terms)).otherwise(hint_found)
    text_topic = F.coalesce(topic_of_keywords(F.col("_hits"), taxonomy), F.lit(default))
    df = staged(df, {"_topic": F.when(hint_found, F.col("_hint")).otherwise(text_topic)})
    for topic, terms in blocked.items():
        is_blocked = F.when(F.col("_topic") == topic, found(terms)).otherwise(is_blocked)

    keyword = F.col("_topic") != default  # the chosen topic is one whose terms were found
    trusted = F.col("_trust") & F.coalesce(F.col("_topic") == F.col("_hint"), F.lit(False))
    cost = found(cost_terms)
    verdict = F.when(F.col("_topic").isin(*strict), keyword & (trusted | cost)).otherwise(keyword | cost)
    blank = ~F.rlike(m.lowered, F.lit(r"(?U)\S"))
    foreign_only = found(V.FOREIGN_TERMS) & ~found(V.LOCAL_CONTEXT_TERMS)
    stopped = found(V.NOISE_TEXTS) | is_blocked | foreign_only
    added = {name: ~blank & ~stopped & verdict, **({local_name: found(V.LOCAL_CONTEXT_TERMS)} if local_name else {})}
    return df.withColumns(added).drop(
        "_hint", "_trust", "_r_low", "_r_tok", "_hits", "_topic"
    )


def relevance_score(
    cleaned: Column,
    platform: Column,
    engagement: Column,
    *,
    complaints: Sequence[str] = V.SCORING_COMPLAINT_TERMS,
    promotions: Sequence[str] = V.PROMOTION_TERMS,
) -> Column:
    """+2 complaint, -3 promotion (both plain substrings), -2 short, -1 social without engagement."""
    social = F.coalesce(F.lower(platform).isin(*social_platforms()), F.lit(False))
    return (
        F.when(contains_term(cleaned, complaints), 2).otherwise(0)
        + F.when(contains_term(cleaned, promotions), -3).otherwise(0)
        + F.when(F.length(cleaned) < 10, -2).otherwise(0)
        + F.when(social & (engagement == 0), -1).otherwise(0)
    ).cast("int")


def outcome_of(relevance: Column, failed: Column) -> Column:
    """Processing status of a row."""
    return (
        F.when(failed, F.lit("error")).when(relevance < -2, F.lit("discarded")).otherwise(F.lit("processed"))
    )


def quality_flags(
    raw_text: Column,
    cleaned: Column,
    platform: Column,
    url: Column,
    engagement: Column,
    relevance: Column,
    local: Column,
    *,
    news_platform: str = "gdelt",
) -> Column:
    """Sorted flags that explain how far a row can be trusted. `local` is only read for news rows."""
    name = F.lower(F.coalesce(platform, F.lit("")))
    lowered = F.lower(F.coalesce(raw_text, F.lit("")))
    news = name == news_platform
    social = name.isin(*social_platforms())
    no_url = F.coalesce(url == "", F.lit(True))
    heavy = (
        (N.clamp(S.count_char(lowered, ";"), 0, 6) >= 6)
        | F.contains(lowered, F.lit("tax_"))
        | F.contains(lowered, F.lit("wb_"))
    )
    rules = [  # alphabetical, so the array comes out sorted
        (F.coalesce(relevance < 0, F.lit(False)), "low_relevance"),
        (news & heavy, "metadata_heavy"),
        (news & no_url, "missing_url"),
        (F.length(F.coalesce(cleaned, F.lit(""))) < 30, "short_text"),
        (news & ~no_url & ~F.coalesce(local, F.lit(False)), "weak_australia_context"),
        (social & (engagement == 0), "zero_engagement"),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(flag)) for rule, flag in rules]))


# ------------------------------------------------------------------ news rows
def news_categories(
    matcher: WordMatcher,
    *,
    local_terms: Sequence[str] = V.NEWS_LOCAL_TERMS,
    cost_terms: Sequence[str] = V.NEWS_COST_TERMS,
    category_terms: Taxonomy = V.NEWS_CATEGORY_TERMS,
    blocked: Mapping[str, Sequence[str]] = V.BLOCKED_TERMS,
) -> Column:
    """array<struct(category, hits)>: every category the text belongs to.

    A text needs a local and a general cost term; a category then needs a keyword and none of its
    blocked terms. `hits` is the sorted union of the three hit lists.
    """
    lists = [local_terms, cost_terms, *category_terms.values(), *blocked.values()]

    def matches(found: Column) -> Column:
        shared = [*local_terms, *cost_terms]
        entries = []
        for category, terms in category_terms.items():
            allowed = overlaps(found, terms) & ~overlaps(found, blocked.get(category, ()))
            hits = F.array_sort(F.array_intersect(found, _literals(dict.fromkeys([*terms, *shared]))))
            entries.append(F.when(allowed, F.struct(F.lit(category).alias("category"), hits.alias("hits"))))
        eligible = overlaps(found, local_terms) & overlaps(found, cost_terms)
        return F.when(eligible, F.array_compact(F.array(*entries)))

    found = let(matcher.hits([term for terms in lists for term in terms]), matches)
    return F.when(matcher.any(local_terms), found)  # the cheap test first: most texts stop here


def best_phrase(matcher: WordMatcher, category: Column, phrases: Taxonomy = V.NEWS_SEARCH_PHRASES) -> Column:
    """First search phrase of the category whose words all occur; else its first phrase.

    A category without phrases stands for itself.
    """
    result = category
    for name, options in phrases.items():
        hit = first_of([(matcher.all_words(phrase), phrase) for phrase in options])
        result = F.when(category == name, F.coalesce(hit, F.lit(options[0]))).otherwise(result)
    return result
