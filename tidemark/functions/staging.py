"""Evaluate costly columns once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read but never repeat.

    A plain projection may be copied into every filter and expression above it, so that a text is
    tokenised again for each use. A one-element `inline` keeps the expressions where they are.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
