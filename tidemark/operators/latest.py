"""Keep one or a few rows per key without gathering a key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, first: bool = False) -> DataFrame:
    """The row with the largest (or smallest) `order` per key.

    `max_by` is aggregated inside each task first, so a key with very many copies costs one row per
    task in the shuffle. `order` should end in a unique column to make the choice definite.
    """
    pick = F.min_by if first else F.max_by
    whole = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(pick(whole, F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def first_with_copies(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The row with the smallest `order` per key, and how many rows have that key, in one aggregation."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    grouped = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return grouped.agg(F.min_by(whole, F.struct(*order)).alias("_row"), F.count(F.lit(1)).alias(name)).select("_row.*", name)


def newest_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """Top `count` rows per group. Spark keeps the top rows of every task before the shuffle, so a hot
    group sends at most `count` rows per task."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")
