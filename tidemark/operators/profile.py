"""Table profiles and latency summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import strings as S
from tidemark.operators.latest import newest_per_group

DATE_FIELDS = ("created_at", "collected_at", "harvested_at", "processed_at", "period_start")
TERM_FIELDS = (
    "platform", "stage", "category", "analysis_status", "sentiment_label", "topic", "source", "source_index",
    "domain", "has_engagement_metrics",
)
# Rank accuracy of the sketch, and the distances from the target at which it cuts: the range around the target of a
# large group holds about 8 / ACCURACY of its rows.
ACCURACY = 100_000
BRACKETS = (-0.02, -4 / ACCURACY, 4 / ACCURACY, 0.02)


def profile_summary(df: DataFrame, date_fields: Sequence[str] = DATE_FIELDS) -> DataFrame:
    """Row count, sorted field names and the range of every date field present: (item, value, low, high)."""
    dates = [c for c in date_fields if c in df.columns]
    aggregates = [F.count(F.lit(1)).alias("_n")]
    for c in dates:
        aggregates += [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")]
    none_n, none_t = F.lit(None).cast("bigint"), F.lit(None).cast("timestamp")

    def entry(item: str, n, low, high):
        return F.struct(F.lit(item).alias("item"), n.alias("value"), low.alias("low"), high.alias("high"))

    entries = [entry("rows", F.col("_n"), none_t, none_t)]
    entries += [entry(f"field:{c}", F.lit(i).cast("bigint"), none_t, none_t) for i, c in enumerate(sorted(df.columns))]
    entries += [
        entry(f"range:{c}", none_n, F.col(f"_lo_{c}").cast("timestamp"), F.col(f"_hi_{c}").cast("timestamp"))
        for c in dates
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def top_terms(df: DataFrame, fields: Sequence[str] = TERM_FIELDS, *, top_n: int = 12) -> DataFrame:
    """Most frequent values per field: (field, value, document_count). One scan, one partial count."""
    present = [c for c in fields if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in present])
    counts = (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull())
        .groupBy("field", "value").agg(F.count(F.lit(1)).alias("document_count"))
    )
    return newest_per_group(counts, ["field"], [F.col("document_count").desc(), F.col("value")], top_n)


def samples(df: DataFrame, fields: Sequence[str], size: int, key: str) -> DataFrame:
    """A few rows for display, text shortened. A bounded report."""
    columns = [
        S.shorten(F.col(c)).alias(c) if dict(df.dtypes)[c] == "string" else F.col(c) for c in fields if c in df.columns
    ]
    return df.orderBy(key).limit(size).select(*columns)


def _slot(value, bounds) -> Column:
    """Number of the range between bounds that holds a value; each bound is a range of its own."""
    steps = [(value >= bounds[i]).cast("int") + (value > bounds[i]).cast("int") for i in range(len(BRACKETS))]
    return sum(steps[1:], steps[0])


def _with_group(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their group; null keys are a group."""
    named = groups.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *[c for c in groups.columns if c not in keys])
    same = [rows[k].eqNullSafe(named[f"_g{i}"]) for i, k in enumerate(keys)]
    return rows.join(named, same).drop(*[f"_g{i}" for i in range(len(keys))])


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, fraction: float) -> DataFrame:
    """Exact value at sorted index round((n - 1) * fraction) per group, without sorting whole groups.

    One method for groups of every size. A sketch cuts the values of a group into ranges, the narrowest of them around
    the target; rows are counted per range, and the counts say which range holds the target, whatever the error of the
    sketch. Only the values of that range are counted one by one and ranked. All steps aggregate partially, so a hot
    group costs each task one small table, and a value that makes up most of a group is a range of its own. Null
    values are left out, null keys are a group; a group without values has no row.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    points = [min(max(fraction + d, 0.0), 1.0) for d in BRACKETS]
    bounds = rows.groupBy(*keys).agg(F.percentile_approx("_v", points, ACCURACY).alias("_b"))
    counts = (
        _with_group(rows, bounds, keys).groupBy(*keys, _slot(F.col("_v"), F.col("_b")).alias("_slot"))
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_b").alias("_b"))
    )
    group = Window.partitionBy(*keys)
    upto = F.sum("_c").over(group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.rint((F.sum("_c").over(group) - 1) * F.lit(fraction)).cast("bigint")
    ranges = counts.select(*keys, "_slot", "_b", "_c", upto.alias("_to"), target.alias("_target"))
    holding = ranges.where((F.col("_to") > F.col("_target")) & (F.col("_to") - F.col("_c") <= F.col("_target"))).select(
        *keys, "_b", F.col("_slot").alias("_wanted"), (F.col("_target") - F.col("_to") + F.col("_c")).alias("_index")
    )
    inside = _with_group(rows, holding, keys).where(_slot(F.col("_v"), F.col("_b")) == F.col("_wanted"))
    values = inside.groupBy(*keys, "_v", "_index").agg(F.count(F.lit(1)).alias("_c"))
    running = F.sum("_c").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = values.select("*", running.alias("_to"))
    hit = hit.where((F.col("_to") > F.col("_index")) & (F.col("_to") - F.col("_c") <= F.col("_index")))
    return hit.select(*keys, F.col("_v").alias("value"))


def latency_summary(df: DataFrame, *, key: str = "route", duration: str = "duration_ms", status: str = "status") -> DataFrame:
    """Per key: count, mean, max and nearest-rank p95 of the durations (three decimals), failures."""
    units = F.rint(F.col(duration) * 1e6).cast("bigint")  # whole units: the sum does not depend on order
    basic = df.groupBy(key).agg(
        F.count(duration).alias("count"),
        F.sum(units).alias("_u"),
        F.max(duration).alias("_max"),
        F.count_if(F.col(status) >= 400).alias("failure_count"),
    )
    p95 = nearest_rank(df, [key], duration, 0.95).withColumnRenamed("value", "_p95")
    three = lambda c: F.rint(c * 1000) / 1000
    p95 = p95.withColumnRenamed(key, "_key")
    return basic.join(p95, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key, "count", "failure_count",
        three(F.col("_u") / F.lit(1e6) / F.col("count")).alias("average_duration"),
        three(F.col("_p95")).alias("p95_duration"),
        three(F.col("_max")).alias("max_duration"),
    )


def status_counts(df: DataFrame, *, key: str = "route", status: str = "status") -> DataFrame:
    return df.groupBy(key, F.col(status).cast("string").alias("status")).agg(F.count(F.lit(1)).alias("count"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(left, right, correlation) for every pair of numeric columns, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"_{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*entries)))
