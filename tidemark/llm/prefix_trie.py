"""Prefix trie of conversations: who shares which first turns, and what storing shared turns once would save.

A conversation is a row of positional turn-id columns, `BLOCK` turns a row. `ROLLUP` over these columns aggregates all
prefixes of a block together and `grouping_id` tells their depth. A longer conversation goes on in a further row, which
is keyed by the node its prior block ended in, so that all blocks are aggregated at once, whatever their number.

A node is named by 128 bits: the exclusive or of hashes of its turns with their places. A block's key and a node's parent
follow from that without a walk down the trie. Totals of subtrees come from owners: a
node is owned by its smallest member, and a member that does not own the top owns a whole subtree or nothing below it.

Null roles and texts are empty. Turns are in order of `turn`, nulls first, ties by role, then by the text's digest;
repeated rows are turns of their own. Rows with a null conversation id belong to no conversation and are left out.
Conversations without turns are members of the root. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.staging import staged
from tidemark.llm.common import ordered_positions, saved, shuffle_width

BLOCK = 8  # turns of a row
SLICE = 1024  # rows of one conversation that one window sees
CHUNK_IDS = 4096  # ids that are joined before they are sent to be hashed
_ID = ["id1", "id2"]


def turn_id(role: Column, text: Column) -> Column:
    """Digest of a turn, then the bytes of its text."""
    octets = F.octet_length(text).cast("string")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(whole.cast("binary")), F.lit(" "), octets)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `place` (from 0) and `turn_id` of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = saved(conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), turn_id(role, text).alias("turn_id")), "turns")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "turn_id"]
    numbered = ordered_positions(rows, order, "turn-order").select("conv_id", "turn_id", "position")
    first = numbered.groupBy("conv_id").agg(F.min("position").alias("first"))
    return saved(numbered.join(first, "conv_id").select("conv_id", (F.col("position") - F.col("first")).alias("place"), "turn_id"), "placed-turns")


def rebuilt_turns(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first h turns of another one: (`conv_id`, `n_turns`) and their placed turns.

    Conversation c starts with the first h = crc32(c) % `most` turns of c - c % `family`, then has its own behind its first h.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = own.select("conv_id", "n_own", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = saved(convs.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns")), "rebuilt")
    starts = turns.filter(F.col("place") < most - 1).select(F.col("conv_id").alias("base"), "place", "turn_id")
    taken = convs.join(starts, "base").filter("place < m").select("conv_id", "place", "turn_id")
    kept = turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "turn_id")
    return convs.select("conv_id", "n_turns"), taken.unionByName(kept)


def _running(df: DataFrame, key: str, at: str, values: dict[str, str], total: Callable[[str], Column] = F.sum,
             add: Callable[[Column, Column], Column] = Column.__add__) -> DataFrame:
    """Add totals of `values` over the rows of the same key before a row (by `at`, unique).

    Slices of `SLICE` places have totals of their own, to which those of the slices before are added, so that no window
    sees all rows of a key.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(at) / SLICE))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(key, "_slice").agg(*[total(c).alias(f"_s_{n}") for n, c in values.items()])
    shifts = totals.select(key, "_slice", *[F.coalesce(total(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in values])
    inside = Window.partitionBy(key, "_slice").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.select("*", *[F.coalesce(total(c).over(inside), F.lit(0)).alias(f"_i_{n}") for n, c in values.items()])
    joined = local.join(shifts, [key, "_slice"])
    return joined.select(*df.columns, *[add(F.col(f"_b_{n}"), F.col(f"_i_{n}")).alias(n) for n in values])


def _names(block: int) -> list[str]:
    return [f"t{i}" for i in range(1, block + 1)]


def _turn_hash(which: int, turn: Column, place: Column) -> Column:
    return F.xxhash64(turn, place) if which == 1 else F.xxhash64(place, F.lit("#"), turn)


def positional(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation and block: `conv_id`, `n_turns`, `block`, the key `k1`, `k2` of the prior block's node, `t1`..."""
    spread = [F.max(F.when(F.pmod("place", F.lit(block)) == i, F.col("turn_id"))).alias(t) for i, t in enumerate(_names(block))]
    blocks = turns.groupBy("conv_id", F.floor(F.col("place") / block).cast("long").alias("block")).agg(*spread)
    # a conversation without turns has one row of nulls
    rows = convs.join(blocks, "conv_id", "left").withColumn("block", F.coalesce("block", F.lit(0).cast("long")))
    parts = {f"_h{w}": _name_of(_names(block), w, block) for w in (1, 2)}
    hashed = rows.select("*", *[c.alias(n) for n, c in parts.items()])
    return saved(_running(hashed, "conv_id", "block", {"k1": "_h1", "k2": "_h2"}, F.bit_xor, Column.bitwiseXOR), "positional")


def _name_of(turns: list[str], which: int, block: int) -> Column:
    total = F.lit(0).cast("long")
    for i, t in enumerate(turns, 1):
        place = F.col("block") * block + i
        total = total.bitwiseXOR(F.when(F.col(t).isNotNull(), _turn_hash(which, F.col(t), place)).otherwise(F.lit(0)))
    return total


def _rolled(rows: DataFrame, aggregates: str, block: int) -> DataFrame:
    """All prefixes of all blocks: the node `id1`, `id2`, its `depth`, its last turn, its parent, and the aggregates."""
    names = _names(block)
    listed = ", ".join(names)
    rolled = rows.sparkSession.sql(
        f"SELECT block, k1, k2, {listed}, {block} - bit_count(grouping_id()) AS k, {aggregates} "
        f"FROM {{rows}} GROUP BY block, k1, k2, ROLLUP({listed})", rows=rows,
    )
    last = F.get(F.array(*names), F.col("k") - 1)
    # a null turn ends the conversation; the empty prefix of a further block is the last node of the block before
    nodes = rolled.withColumn("last", last).filter("(k = 0 and block = 0) or last is not null")
    depth = F.col("block") * block + F.col("k")
    own = [F.col(f"k{w}").bitwiseXOR(_name_of(names, w, block)) for w in (1, 2)]
    placed = nodes.select("*", depth.alias("depth"), own[0].alias("id1"), own[1].alias("id2"))
    parents = [F.when(F.col("depth") > 0, F.col(f"id{w}").bitwiseXOR(_turn_hash(w, F.col("last"), F.col("depth")))).alias(f"parent{w}") for w in (1, 2)]
    return placed.select("*", *parents).drop("block", "k1", "k2", "k", *names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(`id1`, `id2`, `ends_sha256`): digest of the comma-joined ids of conversations that end in a node, ascending.

    Ids are sorted by ranges over all tasks and joined to chunks where they lie. A digest reads its chunks in order and
    holds one at a time, so a node where most conversations end costs time in one task but no memory.
    """
    order = [*_ID, "conv_id"]
    ranged = ends.select(*order).repartitionByRange(shuffle_width(ends), *order).sortWithinPartitions(*order)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            starts = [s for x, y in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]) for s in range(x, y, CHUNK_IDS)]
            stops = [*starts[1:], len(ids)]
            chunks = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(starts, stops)]
            yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]), pa.array(chunks, pa.large_string())],
                                             names=["id1", "id2", "first", "chunk"])

    chunks = ranged.mapInArrow(join, "id1 long, id2 long, first long, chunk string")
    dealt = chunks.repartition(shuffle_width(ends), *_ID).sortWithinPartitions(*_ID, "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        out: list[tuple[int, int, str]] = []
        for batch in batches:
            for a, b, chunk in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if key == (a, b):
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256()
                state.update(chunk.encode())
            yield _digest_rows(out)
            out = []
        if key:
            yield _digest_rows([(*key, state.hexdigest())])

    return dealt.mapInArrow(digest, "id1 long, id2 long, ends_sha256 string")


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = [[r[i] for r in rows] for i in range(3)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                      names=["id1", "id2", "ends_sha256"])


def prefix_trie(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """All nodes of the trie of `convs` (`conv_id`, `n_turns`) with their placed `turns`.

    Per node: `id1`, `id2`, `depth`, `conv_id` (smallest member), `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens` (see the module and `op13`) and `ends_sha256`.
    """
    rows = positional(convs, turns, block)
    counted = saved(_rolled(rows, "count(*) AS n_convs, min(conv_id) AS conv_id", block), "trie-nodes")
    families = counted.filter("depth > 0").groupBy("parent1", "parent2").agg(F.count("*").alias("n_children"))
    above = counted.select(F.col("id1").alias("parent1"), F.col("id2").alias("parent2"), F.col("conv_id").alias("parent_conv_id"))
    linked = counted.join(above, ["parent1", "parent2"], "left").join(
        families.toDF(*_ID, "n_children"), _ID, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    octets = F.coalesce(F.split_part(F.col("last"), F.lit(" "), F.lit(2)).cast("long"), F.lit(0))
    valued = linked.select(
        *_ID, "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("_leaf"), ((F.col("n_convs") - 1) * octets).alias("_saved"),
    )
    nodes = saved(_running(valued, "conv_id", "depth", {"_leaves_above": "_leaf", "_saved_above": "_saved"}), "trie-values")
    # all that a conversation owns, added up over the members of a node, less what its owner owns above it
    owned = nodes.groupBy("conv_id").agg(F.sum("_leaf").alias("_leaf"), F.sum("_saved").alias("_saved"))
    totals = _rolled(rows.join(owned, "conv_id"), "sum(_leaf) AS _all_leaves, sum(_saved) AS _all_saved", block)
    summed = nodes.join(totals.select(*_ID, "_all_leaves", "_all_saved"), _ID)
    end = F.ceil(F.col("n_turns") / block).cast("long") - 1
    ends = rows.filter(F.col("block") == F.greatest(end, F.lit(0))).select(
        F.col("k1").bitwiseXOR(F.col("_h1")).alias("id1"), F.col("k2").bitwiseXOR(F.col("_h2")).alias("id2"), "conv_id")
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(ends_digests(ends), _ID, "left").select(
        *_ID, "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
        (F.col("_all_leaves") - F.col("_leaves_above")).alias("n_leaves"),
        (F.col("_all_saved") - F.col("_saved_above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations (see `rebuilt_turns`)."""
    convs, turns = rebuilt_turns(placed_turns(conversations))
    return prefix_trie(convs, turns, block)
