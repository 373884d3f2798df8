"""Merkle manifest of a dataset: one tree per source, one above the sources, with proofs and tamper checks.

A leaf is the digest of a row's fields. Nodes of a level are dealt to parents by runs of `FANOUT`; conditional
aggregates spread the children of a parent into as many columns, one per slot. Concatenating the columns and hashing
gives the parent, and leaving out one's own column gives the siblings, so that proofs need no second look at the rows.
Paths go down parent by parent; only the last step opens runs of leaves, so no path is stored per leaf.

Null fields are written `-`, so they differ from empty ones. A null source is a source of its own and sorts first.
Leaves of a source ascend by id, null ids first; rows with equal ids are ordered by leaf digest, and repeated rows are
leaves of their own. A source of one row has that leaf as its subroot, and a single subroot is the root. Other columns
of the input are not part of a leaf. An empty table has no leaves and no root: the result is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import staged
from tidemark.llm.common import ordered_positions, saved

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SLOTS = [f"_c{k}" for k in range(FANOUT)]
_STEP = "struct<before:string,after:string>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex sha256 of the inputs' concatenation; absent (null) inputs add nothing."""
    return F.sha2(F.concat_ws("", *inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it is hashed: `-` if null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def leaves(docs: DataFrame, tampered: Column | None = None, changed: Column | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """`doc_id`, `source`, `leaf` and `seen`: the leaf of the row as it is found now.

    Where `tampered` is true the last field is found as `changed`; texts are hashed where they are read.
    """
    head = [field(F.col(c)) for c in fields[:-1]]
    last = F.col(fields[-1])
    leaf = digest(*head, field(last))
    seen = leaf if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), digest(*head, field(changed))).otherwise(leaf)
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf.alias("leaf"), seen.alias("seen"))


def _spread(nodes: DataFrame, group: str, value: str) -> DataFrame:
    """Parents (`group`, `at`, `n` of their level) with their children in one column per slot.

    `nodes` has the group, the number `at` of a node among the `n` nodes of its level, and the child's value.
    """
    slot = F.pmod(F.col("at"), F.lit(FANOUT))
    spread = [F.max(F.when(slot == k, F.col(value))).alias(name) for k, name in enumerate(_SLOTS)]
    parent = F.floor(F.col("at") / FANOUT).cast("long")
    return nodes.groupBy(group, parent.alias("parent")).agg(F.max("n").alias("n_below"), *spread).select(
        group, F.col("parent").alias("at"), F.ceil(F.col("n_below") / FANOUT).cast("long").alias("n"), "n_below", *_SLOTS,
    )


def _opened(values: Sequence[Column]) -> Column:
    """Per filled slot its number `k` and the columns before and after its own, which are the siblings."""
    slots = F.array(*values)

    def one(own: Column, k: Column) -> Column:
        before, after = F.slice(slots, F.lit(1), k), F.slice(slots, k + 2, F.lit(FANOUT))
        step = F.struct(F.concat_ws("", before).alias("before"), F.concat_ws("", after).alias("after"))
        return F.struct(k.alias("k"), own.isNotNull().alias("filled"), step.alias("step"))

    return F.filter(F.transform(slots, one), lambda slot: slot["filled"])


def _fold(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda h, step: digest(step["before"], h, step["after"]))


def _levels(nodes: DataFrame, group: str, most: int) -> list[DataFrame]:
    """Stored levels above `nodes` (`group`, `at`, `n`, `hash`), as many as the group of `most` nodes needs."""
    out = []
    while most > 1:
        spread = _spread(nodes.filter("n > 1"), group, "hash")
        nodes = saved(spread.withColumn("hash", digest(*[F.col(c) for c in _SLOTS])), "merkle-level")
        out.append(nodes)
        most = -(-most // FANOUT)
    return out


def _paths(levels: Sequence[DataFrame], tops: DataFrame, group: str, bottom: DataFrame) -> DataFrame:
    """(`group`, `at`, `path`) of all `bottom` nodes; `tops` has the path above each group's last node."""
    heights = [bottom, *levels]

    def ended(nodes: DataFrame) -> DataFrame:
        return nodes.filter("n = 1").select(group, "at").join(tops, tops["_group"].eqNullSafe(nodes[group])).select(group, "at", "path")

    path = ended(heights[-1])
    for height in range(len(levels), 0, -1):
        above = heights[height]
        known = above.join(path.select(F.col(group).alias("_g"), F.col("at").alias("_at"), "path"),
                           above[group].eqNullSafe(F.col("_g")) & (above["at"] == F.col("_at")))
        opened = known.select(group, "at", "path", F.explode(_opened([F.col(c) for c in _SLOTS])).alias("c"))
        below = opened.select(group, (F.col("at") * FANOUT + F.col("c.k")).alias("at"),
                              F.concat(F.array(F.col("c.step")), F.col("path")).alias("path"))
        path = below.unionByName(ended(heights[height - 1]))
    return path


def manifest(rows: DataFrame) -> DataFrame:
    """Roots, proofs and folded roots of the leaves `doc_id`, `source`, `leaf`, `seen`.

    `at` is the leaf's number in its source; its slots on the way up are the digits of that number to base `FANOUT`.
    """
    stored = saved(rows, "merkle-leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("seen")]
    placed = ordered_positions(stored, order, "merkle-order")
    sizes = saved(placed.groupBy("source").agg(F.min("position").alias("first"), F.count("*").alias("n")), "merkle-sources")
    most = sizes.agg(F.max("n")).first()[0] or 0
    sized = placed.join(sizes.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    numbered = sized.select("source", (F.col("position") - F.col("first")).alias("at"), "n",
                            F.struct("leaf", "doc_id", "seen").alias("row"))
    runs = _spread(numbered, "source", "row")
    leaf_columns = [F.col(c)["leaf"] for c in _SLOTS]
    lone = F.col("n_below") == 1
    # a lone leaf is a subroot as it is
    bottom = saved(runs.withColumn("hash", F.when(lone, F.col(_SLOTS[0])["leaf"]).otherwise(digest(*leaf_columns))), "merkle-runs")
    levels = _levels(bottom, "source", -(-most // FANOUT))

    # the tree above the sources: one group, its leaves are the subroots
    subroots = bottom.filter("n = 1").select("source", F.col("hash").alias("subroot"))
    for level in levels:
        subroots = subroots.unionByName(level.filter("n = 1").select("source", F.col("hash").alias("subroot")))
    ranked = ordered_positions(subroots, [F.col("source").asc_nulls_first()], "merkle-subroots")
    n_sources = ranked.count()
    top = saved(ranked.select(F.lit(0).alias("all"), F.col("position").alias("at"), F.lit(n_sources).cast("long").alias("n"),
                              F.col("subroot").alias("hash"), "source"), "merkle-top")
    top_levels = _levels(top, "all", n_sources)
    root = (top_levels[-1] if top_levels else top).select(F.col("hash").alias("root"), F.lit(0).alias("_all"))
    none = F.array().cast(f"array<{_STEP}>")
    over_root = top.sparkSession.range(1).select(F.lit(0).alias("_group"), none.alias("path"))
    top_paths = _paths(top_levels, over_root, "all", top).select(F.col("at").alias("_at"), "path")
    tops = saved(
        top.join(top_paths, top["at"] == top_paths["_at"]).join(root, F.col("all") == F.col("_all"))
        .select(F.col("source").alias("_group"), F.col("hash").alias("subroot"), "root", "path"), "merkle-tops")

    paths = _paths(levels, tops.select("_group", "path"), "source", bottom)
    runs_with_paths = bottom.join(paths.select(F.col("source").alias("_g"), F.col("at").alias("_at"), "path"),
                                  bottom["source"].eqNullSafe(F.col("_g")) & (bottom["at"] == F.col("_at")))
    known = runs_with_paths.join(tops.drop("path"), F.col("source").eqNullSafe(F.col("_group")))
    opened = known.select(
        "source", (F.col("at") * FANOUT).alias("base"), F.col("n_below").alias("n_leaves"), "subroot", "root", "path",
        F.array(*_SLOTS).alias("rows"), F.explode(_opened(leaf_columns)).alias("c"),
    ).withColumn("own", F.get("rows", F.col("c.k"))).drop("rows")
    whole = F.when(F.col("n_leaves") == 1, F.col("path")).otherwise(F.concat(F.array(F.col("c.step")), F.col("path")))
    walked = staged(opened, {"_path": whole})
    proof = F.array_join(F.transform("_path", lambda step: F.concat(step["before"], step["after"])), "")
    folded = staged(walked, {"folded_root": _fold(F.col("own.seen"), F.col("_path"))})
    return folded.select(
        F.col("own.doc_id").alias("doc_id"), "source", (F.col("base") + F.col("c.k")).alias("at"), "n_leaves",
        F.col("own.leaf").alias("leaf"), "subroot", "root", digest(proof).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def tamper_check(docs: DataFrame) -> DataFrame:
    """The manifest of `docs`, checked against texts of which every fifth (by crc32 of the id) lost its capitals."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(leaves(docs, chosen, lower_ascii(F.col("text"))))
