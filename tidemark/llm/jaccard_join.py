"""Size-aware heavy-light join of shingle sets by Jaccard similarity, returned as components.

Which texts can have a partner is found by document frequencies of shingles: in any order of all shingles, two sets
of similarity t or more share one of their first `n - ceil(t * n) + 1`; with rare ones first, a text that has that
many shingles of its own has no partner, and only few of the others' shingles are needed as keys. Texts that meet
on a key form families. A family is joined in one task, or, if it is large, in one task for each pair of its
blocks: light (small) sets meet on pairs of shingles taken from their prefixes and are then compared, heavy
(large) sets have their overlaps with all others counted by a scan of the inverted lists. The boundary between
them is the size at which all sets together cost least.

Equal texts are one node throughout. Shingles in the texts of many documents are learned from a bounded sample
(this orders shingles and never decides a link) and stay with their document, so no list of a hot shingle is
gathered. Links are decided on 64-bit shingle hashes.

Null and empty texts and texts without words have an empty set and are linked with nothing, not even with each
other. Texts with fewer words than a shingle has are one shingle. Repeated rows and repeated ids are nodes by their
text; a null id takes part and gets its component's least id (null if there is none). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, shuffle_width, text_or_empty, text_slices
from tidemark.llm.components import components
from tidemark.llm.pretokens import gather
from tidemark.llm.shingles import shingle_sets

SAMPLE_TEXTS = 20_000  # bound on the sample from which frequent shingles are learned
FREQUENT_SHARE = 0.002  # of the sampled texts
BLOCK = 1_500  # texts of a family's block
BLOCK_SHINGLES = 1_000_000  # and their shingles
PAIRS_AT_ONCE = 4_000_000  # pairs of shingles that are held in memory, some 32 bytes each
DENSE_SHARE = 8  # shingles in more than one of so many sets are counted by a matrix product
DENSE_SETS = 64  # in families of fewer sets, those in more than an eighth of this number
MEETING = 40.0  # cost of a meeting of two light sets, in scan steps
PERCENT = 80
_CHUNK = 16_000_000  # bytes of text whose shingles are sent together


def keyed_texts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, its 128-bit `digest` and a 64-bit `tid`."""
    text = text_or_empty()
    digest = F.unhex(F.md5(text.cast("binary")))
    rows = docs.select("doc_id", text.alias("text"), digest.alias("digest"))
    return rows.withColumn("tid", F.xxhash64("digest"))


def _keys(sets: np.ndarray) -> np.ndarray:
    """48 bits of a shingle as its key: two shingles on one key cost time but no link."""
    return (sets >> np.uint64(16)).astype(np.int64)


def frequent_keys(texts: DataFrame, size: int) -> list[int]:
    """Keys of shingles in many of the sampled texts, rarest first. The list is bounded by the sample."""
    n = texts.count()
    every = -(-n // SAMPLE_TEXTS) if n else 1
    sampled = texts.filter(F.pmod(F.xxhash64("digest", F.lit(7)), F.lit(every)) == 0).select("tid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                sets = shingle_sets(part.column(1), size)
                keys = _keys(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
                owner = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
                # copies in one slice count once; those elsewhere only make a shingle look more frequent
                pair = np.unique(np.stack([keys, owner], axis=1), axis=0) if len(keys) else np.zeros((0, 2), np.int64)
                key, count = np.unique(pair[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], names=["key", "n"])

    least = max(20, int(FREQUENT_SHARE * min(n, SAMPLE_TEXTS)))
    counted = sampled.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return [r["key"] for r in counted.orderBy("n", "key").collect()]


def describe(texts: DataFrame, frequent: list[int], size: int) -> DataFrame:
    """Per row: `doc_id`, `tid`, `digest`, `n` (set size) and `common`, its frequent keys in their order."""
    shared = texts.sparkSession.sparkContext.broadcast(np.array(frequent, np.int64))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "tid", "digest", "n", "common"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.sort(shared.value)
        rank = np.argsort(shared.value, kind="stable")
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                sets = shingle_sets(part.column(3), size)
                common = [_ranked(_keys(s), known, rank, shared.value) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([len(s) for s in sets], pa.int32()), pa.array(common, pa.list_(pa.int64()))],
                    names=names,
                )

    schema = f"doc_id {id_type}, tid long, digest binary, n int, common array<long>"
    return texts.select("doc_id", "tid", "digest", "text").mapInArrow(run, schema)


def _ranked(keys: np.ndarray, known: np.ndarray, rank: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(known):
        return known
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return ordered[np.sort(rank[at[known[at] == keys]])]


def repeated_keys(texts: DataFrame, frequent: list[int], size: int) -> DataFrame:
    """(tid, key, df) of every key in more than one text, frequent ones apart.

    The keys of many texts are sent as one packed row per target part (six bytes a key), each part is sorted on its
    own, and only keys that occur again come back.
    """
    shared = texts.sparkSession.sparkContext.broadcast(np.array(frequent, np.int64))
    width = shuffle_width(texts)
    parts = 4 * width

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.sort(shared.value)
        seen: set[int] = set()  # texts of this task; copies are sent once
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            key, owner = np.concatenate(keys), np.concatenate(owners)
            part = key % parts
            order = np.argsort(part, kind="stable")
            key, owner, part = key[order], owner[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            blobs = [_packed(key[a:b], owner[a:b]) for _, a, b in rows]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in rows], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

        for batch in batches:
            for piece in text_slices(batch, "text", 2_000_000):
                tids = piece.column(0).to_pylist()
                fresh = [i for i, t in enumerate(tids) if not (t in seen or seen.add(t))]
                if len(seen) > 1_000_000:
                    seen.clear()
                texts_ = piece.column(1).take(pa.array(fresh, pa.int64()))
                for i, found in zip(fresh, shingle_sets(texts_, size)):
                    own = np.unique(_keys(found))
                    if len(known):
                        own = own[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] != own]
                    keys.append(own)
                    owners.append(np.full(len(own), tids[i], np.int64))
                held += piece.column(1).nbytes
                if held >= _CHUNK:
                    yield flush()
                    keys, owners, held = [], [], 0
        if keys:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != part and blobs:
                    yield _repeated(blobs)
                    blobs = []
                part = p
                blobs.append(blob)
        if blobs:
            yield _repeated(blobs)

    sent = texts.select("tid", "text").mapInArrow(pack, "part int, blob binary")
    return sent.repartition(width, "part").sortWithinPartitions("part").mapInArrow(count, "tid long, key long, df long")


def _packed(key: np.ndarray, owner: np.ndarray) -> bytes:
    """Counts, owners, then each owner's number of keys and the keys' six bytes."""
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    counts = np.diff(np.append(cuts, len(owner))).astype("<u4")
    head = np.array([len(cuts), len(key)], "<u4").tobytes()
    low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return head + owner[cuts].astype("<i8").tobytes() + counts.tobytes() + low.tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    owners, n = np.frombuffer(blob, "<u4", 2).tolist()
    owner = np.frombuffer(blob, "<i8", owners, 8)
    counts = np.frombuffer(blob, "<u4", owners, 8 + 8 * owners)
    key = np.zeros((n, 8), np.uint8)
    key[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 8 + 12 * owners).reshape(-1, 6)
    return key.reshape(-1).view("<i8"), np.repeat(owner, counts)


def _repeated(blobs: list[bytes]) -> pa.RecordBatch:
    both = [_unpacked(b) for b in blobs]
    key, owner = (np.concatenate(x) for x in zip(*both))
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
    key, owner = key[fresh], owner[fresh]
    opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    df = np.repeat(np.diff(np.append(opens, len(key))), np.diff(np.append(opens, len(key))))
    keep = df > 1
    return pa.RecordBatch.from_arrays([pa.array(owner[keep]), pa.array(key[keep]), pa.array(df[keep].astype(np.int64))], names=["tid", "key", "df"])


def prefix_length(n: Column, percent: int = PERCENT) -> Column:
    """Shingles of a set of size n among which a partner must share one."""
    return n - F.ceil(n * percent / 100) + 1


def families(described: DataFrame, repeated: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(tid, digest, n, family) of the texts that may have a partner."""
    texts = described.filter("n > 0").groupBy("tid", "digest").agg(F.max("n").alias("n"), F.first("common").alias("common"))
    counts = repeated.groupBy("tid").agg(F.count("*").alias("shared"))
    shared = F.coalesce("shared", F.lit(0))
    # of the first keys, those of the text alone come first and can't meet another's
    wanted = prefix_length(F.col("n"), percent) - (F.col("n") - shared - F.size("common"))
    able = texts.join(counts, "tid", "left").withColumn("shared", shared).withColumn("wanted", wanted)
    able = saved(able.filter("wanted > 0 and shared + size(common) > 0"), "able")
    place = F.row_number().over(Window.partitionBy("tid").orderBy("df", "key"))
    rare = repeated.join(able.groupBy("tid").agg(F.max("wanted").alias("wanted")), "tid")
    rare = rare.withColumn("place", place).filter("place <= wanted").select("tid", "key")
    rest = able.filter("wanted > shared").select("tid", F.explode(F.slice("common", 1, F.greatest(F.lit(1), F.col("wanted") - F.col("shared")).cast("int"))).alias("key"))
    keys = saved(rare.unionByName(rest).distinct(), "keys")
    stars = keys.groupBy("key").agg(F.min("tid").alias("least"), F.count("*").alias("n")).filter("n > 1").select("key", "least")
    links = keys.join(stars, "key").filter("tid != least").select("tid", "least").distinct()
    grouped = components(links, "tid", "least")
    return able.select("tid", "digest", "n").join(grouped.withColumnsRenamed({"node": "tid", "root": "family"}), "tid")


def _similar(overlap: np.ndarray, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    return (overlap > 0) & (100 * overlap >= percent * (a + b - overlap))


def _light_costs(element: np.ndarray, first: np.ndarray, df: np.ndarray, percent: int) -> np.ndarray:
    """What each set costs as a light one: its pairs of rare shingles, and the sets that may be met on each."""
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((element, df[element], owner))
    place = np.arange(len(element)) - first[owner]
    follow = np.maximum((sizes - -(-sizes * percent // 100) + 2)[owner] - place - 1, 0)
    met = df[element[order]]
    # a pair is made, sorted and compared, a meeting is a look at two sets; a scan step is an array element
    return np.bincount(owner, np.where(met > 1, follow * (4.0 + MEETING * met), 0.0), len(sizes))


def boundary(sizes: np.ndarray, lights: np.ndarray, scans: np.ndarray) -> int:
    """The size up to which sets are light: enumerating pairs for those below and scanning lists above costs least."""
    order = np.argsort(sizes, kind="stable")
    light = np.concatenate([[0.0], np.cumsum(lights[order])])
    heavy = np.concatenate([[0.0], np.cumsum(scans[order][::-1])])[::-1]
    ends = np.append(np.flatnonzero(np.diff(sizes[order])) + 1, len(sizes))  # sets of one size are on one side
    cuts = np.concatenate([[0], ends])
    cut = int(cuts[np.argmin((light + heavy)[cuts])])
    return int(sizes[order[cut - 1]]) if cut else 0


def join_sets(sets: list[np.ndarray], side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that span the components of the sets; with sides (0 and 1), only links across them are looked for.

    Shingles in many of the sets are columns of a matrix of zeros and ones, and products of its rows count them; lists
    of the others are scanned.
    """
    n = len(sets)
    if not n:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, element, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    dense = df * DENSE_SHARE > max(n, DENSE_SETS)
    columns = int(dense.sum())
    by_list = np.argsort(element, kind="stable")
    members = owner[by_list]  # inverted lists on end
    list_first = np.cumsum(df) - df
    listed = (df > 1) & ~dense
    scans = np.bincount(owner, np.where(listed[element], df[element], 0).astype(float), n) + n * columns / 16 + 100
    edge = boundary(sizes, _light_costs(element, first, df, percent), scans)
    component = np.arange(n)
    links: list[tuple[int, int]] = []

    def link(i: int, others: np.ndarray) -> None:
        """Link i with one of the given sets (all similar to it) from each component but its own."""
        roots, at = np.unique(component[others], return_index=True)
        for root, j in zip(roots.tolist(), others[at].tolist()):
            if root != component[i]:
                low, high = min(root, component[i]), max(root, component[i])
                component[component == high] = low
                links.append((i, j))

    def open_to(i: int) -> np.ndarray:
        out = component != component[i]
        return out if side is None else out & (side != side[i])

    heavy = np.flatnonzero(sizes > edge)  # against all
    if len(heavy) and columns:
        grid = np.zeros((n, columns), np.float32)
        many = dense[element]
        grid[owner[many], (np.cumsum(dense) - 1)[element[many]]] = 1
    for at in range(0, len(heavy), 256):
        rows = heavy[at : at + 256]
        counted = grid[rows] @ grid.T if columns else np.zeros((len(rows), n), np.float32)
        for i, common in zip(rows.tolist(), counted):
            wanted = open_to(i)
            if not wanted.any():
                continue
            own = element[first[i] : first[i + 1]]
            own = own[listed[own]]
            overlap = common.astype(np.int64) + np.bincount(gather(members, list_first[own], df[own]), minlength=n)
            link(i, np.flatnonzero(wanted & _similar(overlap, sizes[i], sizes, percent)))
    light = np.flatnonzero((sizes <= edge) & (sizes > 0))
    if not len(light):
        return links
    tried = np.zeros((n, n), bool)
    for met in _meetings([element[first[i] : first[i + 1]] for i in light.tolist()], df, percent):
        group = light[met]
        if (component[group] == component[group[0]]).all():
            continue
        for at, i in enumerate(group[:-1].tolist()):
            rest = group[at + 1 :]
            for j in rest[open_to(i)[rest] & ~tried[i, rest]].tolist():
                if component[i] == component[j]:
                    continue
                tried[i, j] = tried[j, i] = True
                overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if overlap and 100 * overlap >= percent * (sizes[i] + sizes[j] - overlap):
                    link(i, np.array([j]))
    return links


def _meetings(sets: list[np.ndarray], df: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Groups of (light) sets that share a pair of shingles among their rare ones; sets of one shingle share that.

    Pairs are sorted numbers, made and met in chunks of `PAIRS_AT_ONCE`: those of one rarer shingle after the other.
    """
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
    prefixes = [np.sort(rank[own])[: len(own) + 2 - -(-len(own) * percent // 100)] for own in sets]
    sizes = np.array([len(p) for p in prefixes], np.int64)
    if not len(sizes):
        return
    flat, owner = np.concatenate(prefixes), np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat))
    ends = np.repeat(np.cumsum(sizes), sizes)
    ones = flat[np.array([len(own) == 1 for own in sets])[owner]]  # a set of one shingle has no pair
    if len(ones):
        yield from _runs(flat[np.isin(flat, ones)], owner[np.isin(flat, ones)])
    by_shingle = np.argsort(flat, kind="stable")
    opens = np.flatnonzero(np.concatenate([[True], np.diff(flat[by_shingle]) != 0]))
    shared = np.repeat(np.diff(np.append(opens, len(flat))) > 1, np.diff(np.append(opens, len(flat))))
    by_shingle = by_shingle[shared]  # a pair whose rarer shingle no other set has meets nothing
    follow = ends[by_shingle] - at[by_shingle] - 1
    start = 0
    while start < len(by_shingle):
        stop = int(np.searchsorted(np.cumsum(follow[start:]), PAIRS_AT_ONCE, "right")) + start
        stop = max(stop, start + 1)
        while stop < len(by_shingle) and flat[by_shingle[stop]] == flat[by_shingle[stop - 1]]:
            stop += 1  # all pairs of one shingle together; no more than the sets' prefixes hold
        entries = by_shingle[start:stop]
        second = gather(flat, at[entries] + 1, follow[start:stop])
        pair = np.repeat(flat[entries], follow[start:stop]) << np.int64(32) | second
        yield from _runs(pair, np.repeat(owner[entries], follow[start:stop]))
        start = stop


def _runs(keys: np.ndarray, owner: np.ndarray) -> Iterator[np.ndarray]:
    """Owners of every key that more than one owner has; equal groups that follow each other come once."""
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    opens = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(opens, len(keys)))
    last = None
    for a, m in zip(opens[counts > 1].tolist(), counts[counts > 1].tolist()):
        group = owner[a : a + m]
        if last is None or len(last) != m or not np.array_equal(last, group):
            yield group
        last = group


def family_links(texts: DataFrame, family: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) digests of similar texts that span the components of every family."""
    counts = family.groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("shingles")).filter("m > 1")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = family.join(counts, "family").select(
        "tid", "digest", "family", blocks.alias("blocks"), F.pmod(F.xxhash64("digest", F.lit(3)), blocks).cast("int").alias("block")
    )
    found = texts.select("tid", "digest", "text").join(placed, ["tid", "digest"])
    once = found.groupBy("digest", "family", "blocks", "block").agg(F.first("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = once.withColumn("other", other).select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "digest", "text"
    )

    def joined(group: list[tuple[int, bytes, np.ndarray]], i: int, j: int) -> Iterator[tuple[bytes, bytes]]:
        side = None if i == j else np.array([b for b, _, _ in group])
        for a, b in join_sets([s for _, _, s in group], side, percent):
            yield group[a][1], group[b][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, group = None, []
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for part in text_slices(batch, "text", 4_000_000):
                sets = shingle_sets(part.column(5), size)
                keys = zip(*(part.column(k).to_pylist() for k in range(3)))
                for key, block, digest, own in zip(keys, part.column(3).to_pylist(), part.column(4).to_pylist(), sets):
                    if key != task and group:
                        out.extend(joined(group, *task[1:]))
                        group = []
                    task = key
                    group.append((block, digest, own))
            yield _links(out)
        if group:
            yield _links(list(joined(group, *task[1:])))

    dealt = tasks.repartition(shuffle_width(texts), "family", "i", "j").sortWithinPartitions("family", "i", "j")
    return dealt.mapInArrow(run, "a binary, b binary")


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def component_rows(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, and `digest` and `root` (the component's least digest) of every row."""
    texts = keyed_texts(docs)
    frequent = frequent_keys(texts, size)
    described = saved(describe(texts, frequent, size), "described")
    repeated = saved(repeated_keys(texts, frequent, size), "repeated")
    links = saved(family_links(texts, families(described, repeated, percent), size, percent), "near-links")
    roots = components(links, "a", "b").withColumnsRenamed({"node": "digest", "root": "root"})
    rooted = described.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = rooted.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rooted.join(least, "root", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"), "digest", "root")


def keep_one_per_component(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns: the least id, and among its rows the least text digest.

    Rows without words are no copies of each other and all stay. A component without any id keeps one row.
    """
    rows = component_rows(docs, size, percent).filter("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("digest").alias("d"))
    chosen = rows.groupBy("root").agg(F.min(order).alias("o")).select(F.col("o.i").alias("_chosen"), F.col("o.d").alias("_chosen_digest"))
    names = docs.columns
    digest = F.unhex(F.md5(text_or_empty().cast("binary")))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id").alias("_id"), digest.alias("_digest"), text_or_empty().alias("_text"))
    wordless = F.col("_text").rlike(r"\A[\x20\x09-\x0D]*\z")
    same = (F.col("_digest") == F.col("_chosen_digest")) & F.col("_id").eqNullSafe(F.col("_chosen"))
    kept = marked.filter(~wordless).join(chosen, same, "left_semi")
    # rows that are repeated with their id
    unique = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_digest", "_id").orderBy(F.lit(0)))).filter("_n = 1")
    return unique.select("_row").unionByName(marked.filter(wordless).select("_row")).select("_row.*")
