"""Sharding along a Hilbert curve.

Several metadata columns are quantised to cells, the cells are ordered by their index on a Hilbert curve and the
ordered rows are cut into runs of equal count. Rows that are near in all columns meet in one shard, so each shard
covers small ranges of every column and files can be skipped by minimum and maximum in any of them.

The law is `rows`: counts of shards differ by one at most. Only ids, sizes and checksums are sorted, never texts.
Null texts have size 16 and the checksum of nothing; null metadata have a cell of their own. Ties in cell are
ordered by text checksum and id; rows that are equal in all of these are interchangeable. An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ordered_positions, text_or_empty

ROW_BYTES = 16  # what a row takes beside its text


def hilbert_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of points given as rows of integer coordinates below 2 ** bits."""
    x = coordinates.T.astype(np.uint64).copy()
    n, one = len(x), np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > 1:  # undo the rotations from the largest cube down
        p = q - one
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << one) | ((x[i] >> np.uint64(bit)) & one)
    return index.astype(np.int64)


def category_cell(column: Column, bits: int) -> Column:
    """Cell of a category: equal values meet; null has cell 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % ((1 << bits) - 1) + 1, F.lit(0)).cast("int")


def number_cell(column: Column, bits: int, largest: float = 2.0**40) -> Column:
    """Cell of a size on a logarithmic scale; null has cell 0."""
    scale = ((1 << bits) - 2) / float(np.log2(largest))
    cell = 1 + F.floor(F.log2(F.greatest(column.cast("double"), F.lit(0.0)) + 1) * scale)
    return F.coalesce(F.least(cell, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def with_hilbert(df: DataFrame, cells: Sequence[Column], bits: int, name: str = "hilbert") -> DataFrame:
    """Add the curve index of the cells."""
    if bits * len(cells) > 62:
        raise ValueError("the curve index must fit in 62 bits")

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns], axis=1), bits))

    return df.withColumn(name, index(*cells))


def assign_shards(docs: DataFrame, n_shards: int = 40, bits: int = 16) -> DataFrame:
    """Shard and slot of every document, ordered by source, language and size along the curve."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        category_cell(F.col("source"), bits).alias("_source"),
        category_cell(F.col("lang"), bits).alias("_lang"),
        number_cell(F.octet_length(text), bits).alias("_size"),
    )
    cells = [F.col("_source"), F.col("_lang"), F.col("_size")]
    keyed = with_hilbert(rows, cells, bits).select("doc_id", "size", "text_crc32", "hilbert")
    placed = ordered_positions(keyed, ["hilbert", "text_crc32", "doc_id"], "hilbert")
    total = placed.count()
    return cut_rows(placed, total, n_shards)


def cut_rows(placed: DataFrame, total: int, n_shards: int) -> DataFrame:
    """Cut rows numbered by `position` into runs whose counts differ by one at most."""
    low, longer = divmod(total, n_shards)  # the first `longer` shards hold one row more
    edge = longer * (low + 1)
    position = F.col("position")
    early = position < edge
    rest = F.lit(max(low, 1))
    shard = F.when(early, F.floor(position / (low + 1))).otherwise(longer + F.floor((position - edge) / rest))
    slot = F.when(early, position % (low + 1)).otherwise((position - edge) % rest)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """Write whole documents into one folder per shard, in slot order; expects unique ids."""
    placed = docs.join(shards.select("doc_id", "shard", "slot"), "doc_id")
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
