"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_SCALE = 10_000  # scores carry four decimals


def round4(value: Column) -> Column:
    """Four decimals, half to even; null for null, NaN and infinity."""
    value = value.cast("double")
    usable = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(usable, F.rint(value * SCORE_SCALE) / SCORE_SCALE)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole at four decimals; 0 when the whole is 0."""
    share = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")
    return F.coalesce(round4(share), F.lit(0.0))


def duplicate_ratio(documents: Column, unique_documents: Column) -> Column:
    """Share of documents beyond the first of each key."""
    extra = F.greatest(documents - unique_documents, F.lit(0))
    return F.when(documents > 0, ratio(extra, documents)).otherwise(F.lit(0.0))


def score_units(score: Column) -> Column:
    """A four-decimal score as a whole number, so that sums are exact in any order."""
    return F.rint(score * SCORE_SCALE).cast("bigint")


def mean_score(units_sum: Column, count: Column) -> Column:
    """Mean of `score_units` back at four decimals; null when nothing was counted."""
    mean = units_sum.cast("double") / F.nullif(count, F.lit(0)).cast("double")
    return F.rint(mean) / SCORE_SCALE


def clamp(value: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def batches_needed(rows: Column, batch: int, cap: int) -> Column:
    """Ceiling division, capped."""
    return F.least(F.lit(cap).cast("bigint"), F.ceil(rows / F.lit(batch)))


def whole_number(value: Column) -> Column:
    """Integer or null. Decimal text is not an integer."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def social_count(value: Column, is_social: Column) -> Column:
    """Counters of social rows default to 0; other sources have none."""
    return F.when(is_social, F.coalesce(whole_number(value), F.lit(0).cast("bigint")))


def engagement_total(*counters: Column) -> Column:
    total = F.lit(0).cast("bigint")
    for counter in counters:
        total = total + F.coalesce(counter, F.lit(0))
    return total
