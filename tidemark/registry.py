"""Source registry: one `SourceSpec` per raw stream, and small dimension tables built from it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import vocabulary as V


@dataclass(frozen=True)
class SourceSpec:
    """Static description of one source, plus the projection that makes its rows uniform."""

    name: str
    group: str
    label: str
    has_engagement: bool = False
    aliases: tuple[str, ...] = ()
    normaliser: Callable[[DataFrame], DataFrame] | None = None


SOURCES: tuple[SourceSpec, ...] = (
    SourceSpec("bluesky", "social", "bluesky_raw_stream", has_engagement=True),
    SourceSpec("mastodon", "social", "mastodon_raw_stream", has_engagement=True),
    SourceSpec("gdelt", "media", "gdelt_gkg_raw", aliases=("gdelt_gkg",)),
)


def group_platforms(sources: Iterable[SourceSpec] = SOURCES) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for source in sources:
        groups.setdefault(source.group, []).append(source.name)
    return groups


def social_platforms(sources: Iterable[SourceSpec] = SOURCES) -> list[str]:
    return [source.name for source in sources if source.has_engagement]


def _lookup(key: Column, pairs: Iterable[tuple[str, str]], default: Column) -> Column:
    result = default
    for name, value in reversed(list(pairs)):
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def group_of(platform: Column, sources: Iterable[SourceSpec] = SOURCES) -> Column:
    """Source group of a platform; `unknown` for platforms outside the registry."""
    return _lookup(F.lower(platform), [(s.name, s.group) for s in sources], F.lit("unknown"))


def canonical_platform(platform: Column, sources: Iterable[SourceSpec] = SOURCES) -> Column:
    """Registry name of a platform that may be written with an alias."""
    return _lookup(platform, [(a, s.name) for s in sources for a in s.aliases], platform)


def topic_label(topic: Column, labels: dict[str, str] | None = None) -> Column:
    """Display label: the known one, else the key in title case, else `Unknown`."""
    known = _lookup(
        topic,
        (labels or V.TOPIC_LABELS).items(),
        F.initcap(F.replace(topic, F.lit("_"), F.lit(" "))),
    )
    return F.when(topic.isNull() | (topic == ""), F.lit("Unknown")).otherwise(known)


def local_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A local relation from Python lists (its size is known to the planner)."""
    return spark.createDataFrame(pa.table(columns))


def dimension(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A dimension table: a local relation of known size, so the planner chooses how it is joined."""
    return local_table(spark, columns)


def source_dimension(spark: SparkSession, sources: Iterable[SourceSpec] = SOURCES) -> DataFrame:
    items = list(sources)
    return dimension(
        spark,
        {
            "platform": [s.name for s in items],
            "registry_group": [s.group for s in items],
            "source_label": [s.label for s in items],
            "has_engagement": [s.has_engagement for s in items],
        },
    )


def label_dimension(spark: SparkSession, labels: dict[str, str] | None = None) -> DataFrame:
    labels = labels or V.TOPIC_LABELS
    return dimension(spark, {"topic": list(labels), "known_label": list(labels.values())})


def taxonomy_dimension(spark: SparkSession, taxonomy: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(topic, topic_rank, keyword, keyword_rank), ranks in list order."""
    rows = [
        (topic, i, keyword, j)
        for i, (topic, keywords) in enumerate((taxonomy or V.TAXONOMY).items())
        for j, keyword in enumerate(keywords)
    ]
    names = ("topic", "topic_rank", "keyword", "keyword_rank")
    return dimension(spark, {name: [row[k] for row in rows] for k, name in enumerate(names)})


def candidate_dimension(spark: SparkSession, items: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(cost_category, candidate_rank, item_name): official items per topic, best first."""
    rows = [
        (topic, rank, item)
        for topic, names in (items or V.OFFICIAL_ITEMS).items()
        for rank, item in enumerate(names)
    ]
    names = ("cost_category", "candidate_rank", "item_name")
    return dimension(spark, {name: [row[k] for row in rows] for k, name in enumerate(names)})
