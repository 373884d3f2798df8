"""Best-fit packing of token documents into sequences of fixed length, with swap-based local search.

Documents longer than a sequence are cut into full pieces and a rest. Full pieces are sequences of their own. All
other pieces are dealt to tasks, each of which packs its pieces best fit in decreasing length and then improves
the sequences that are not full: pieces move to fuller sequences, or are exchanged one for one or two for one, so
that the sum of squared fills grows, until sequences run empty. The sequences that stay less than full are opened
again and packed with those of other tasks, in fewer tasks each time, until one task can hold what is left or
a round no longer halves it.

Only lengths, checksums and ids are sent, never tokens. A null text has its end token only. Repeated rows and null
ids are packed as they are, one set of pieces per row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, text_or_empty, text_slices
from tidemark.llm.library_tokens import word_table
from tidemark.llm.pretokens import encode_all

ROWS_PER_TASK = 40_000  # pieces that one task packs
END_ID = 1


def pieces_of(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """Pieces of every whole text: `doc_id`, `piece`, `start`, `length`, `ids_crc32`."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(path)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for part in text_slices(batch, "text", 4_000_000):
                for first, ids, bounds in encode_all(table, part.column(1).to_pylist()):
                    rows: list[tuple[int, int, int, int, int]] = []
                    raw = ids.astype("<u4")
                    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                        own = np.concatenate([raw[a:b], end])
                        for piece, start in enumerate(range(0, len(own), capacity)):
                            cut = own[start : start + capacity]
                            rows.append((i, piece, start, len(cut), zlib.crc32(cut.tobytes())))
                    index, piece, start, length, crc = (pa.array(c, pa.int64()) for c in zip(*rows))
                    doc_ids = part.column(0).slice(first, len(bounds) - 1).take(index)
                    yield pa.RecordBatch.from_arrays([doc_ids, piece.cast(pa.int32()), start, length, crc], names=names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    )


class Bins:
    """Sequences under construction; those with room are found by their free space."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: dict[int, set[int]] = {}
        self.frees: list[int] = []  # free spaces that occur, in order

    def _list(self, b: int) -> None:
        space = self.free[b]
        if space not in self.by_free:
            self.by_free[space] = set()
            insort(self.frees, space)
        self.by_free[space].add(b)

    def _unlist(self, b: int) -> None:
        space = self.free[b]
        self.by_free[space].discard(b)
        if not self.by_free[space]:
            del self.by_free[space]
            self.frees.pop(bisect_left(self.frees, space))

    def best_fit(self, item: int, length: int) -> None:
        at = bisect_left(self.frees, length)
        if at < len(self.frees):
            b = min(self.by_free[self.frees[at]])
            self._unlist(b)
        else:
            b = len(self.items)
            self.items.append([])
            self.free.append(self.capacity)
        self.items[b].append(item)
        self.free[b] -= length
        self._list(b)

    def change(self, b: int, out: list[int], into: list[int], lengths: list[int]) -> None:
        self._unlist(b)
        for item in out:
            self.items[b].remove(item)
        self.items[b].extend(into)
        self.free[b] += sum(lengths[i] for i in out) - sum(lengths[i] for i in into)
        self._list(b)


def _step(bins: Bins, lengths: list[int], full: int, spare: int) -> bool:
    """One change that fills `full` at the cost of the emptier `spare`; false if there is none.

    Tried in order: a move, the exchange of one piece for a longer one, of one for two, of two for one. Each makes
    the sum of squared fills grow, as what the fuller sequence gains the emptier one loses.
    """
    room = bins.free[full]
    if not room:
        return False
    theirs = sorted(((lengths[i], i) for i in bins.items[spare]), reverse=True)
    ours = sorted((lengths[i], i) for i in bins.items[full])
    moved = next((i for n, i in theirs if n <= room), None)
    if moved is not None:
        bins.change(spare, [moved], [], lengths)
        bins.change(full, [], [moved], lengths)
        return True
    best: tuple[int, list[int], list[int]] | None = None
    sizes = [n for n, _ in ours]

    def offer(gain: int, out: list[int], into: list[int]) -> None:
        nonlocal best
        if 0 < gain <= room and (best is None or gain > best[0]):
            best = (gain, out, into)

    for n, i in theirs:  # one for one: the shortest of ours that leaves room for theirs
        at = bisect_left(sizes, n - room)
        if at < len(ours):
            offer(n - ours[at][0], [ours[at][1]], [i])
    if best is None or best[0] < room:
        few = theirs[:24]
        for x in range(len(few)):  # two of theirs for one of ours
            for y in range(x + 1, len(few)):
                both = few[x][0] + few[y][0]
                at = bisect_left(sizes, both - room)
                if at < len(ours):
                    offer(both - ours[at][0], [ours[at][1]], [few[x][1], few[y][1]])
        mine = ours[:24]
        theirs_sizes = sorted((n, i) for n, i in theirs)
        for x in range(len(mine)):  # one of theirs for two of ours
            for y in range(x + 1, len(mine)):
                both = mine[x][0] + mine[y][0]
                at = bisect_left(theirs_sizes, (both + room + 1, -1)) - 1
                if at >= 0:
                    offer(theirs_sizes[at][0] - both, [mine[x][1], mine[y][1]], [theirs_sizes[at][1]])
    if best is None:
        return False
    _, out, into = best
    bins.change(spare, into, out, lengths)
    bins.change(full, out, into, lengths)
    return True


def improve(bins: Bins, lengths: list[int], partners: int = 16) -> None:
    """Empty the emptiest sequences into the fuller ones as long as a change is found.

    A sequence is tried with the `partners` fullest and the `partners` least full others. Every change makes the
    sum of squared fills grow, so the search ends.
    """
    while True:
        under = sorted((b for b in range(len(bins.items)) if bins.items[b] and bins.free[b]), key=lambda b: (-bins.free[b], b))
        changed = False
        for spare in under[: 4 * partners]:
            others = [b for b in under if b != spare and bins.items[b] and 0 < bins.free[b] <= bins.free[spare]]
            near = others[-partners:] + others[:partners] if len(others) > 2 * partners else others
            for full in near:
                while bins.items[spare] and bins.free[full] <= bins.free[spare] and _step(bins, lengths, full, spare):
                    changed = True
                if not bins.items[spare]:
                    break
        if not changed:
            return


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of indices into `lengths`."""
    bins = Bins(capacity)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        bins.best_fit(item, lengths[item])
    improve(bins, lengths)
    return [items for items in bins.items if items]


def _pack_round(rows: DataFrame, tasks: int, capacity: int, last: bool, round_no: int) -> DataFrame:
    """Pack each task's rows; sequences that are not full get no id unless it is the last round."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns) + ", sequence_id long, offset long"

    def packed(table: pa.Table, first: int) -> tuple[pa.Table, int]:
        lengths = table.column("length").to_pylist()
        order, sequence, offset = [], [], []
        sequences = pack(lengths, capacity)
        for number, items in enumerate(sequences, first):
            room = capacity - sum(lengths[i] for i in items)
            at = 0
            for i in items:
                order.append(i)
                sequence.append(number if last or room <= capacity // 512 else None)
                offset.append(at)
                at += lengths[i]
        out = table.take(pa.array(order, pa.int64())).append_column("sequence_id", pa.array(sequence, pa.int64()))
        return out.append_column("offset", pa.array(offset, pa.int64())), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (round_no << 56) + (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * ROWS_PER_TASK:
                out, number = packed(pa.Table.from_batches(held), number)
                yield from out.to_batches()
                held = []
        if held:
            yield from packed(pa.Table.from_batches(held), number)[0].to_batches()

    dealt = rows.select(*columns).repartition(tasks, F.xxhash64(F.monotonically_increasing_id(), F.lit(round_no)))
    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """All pieces with `sequence_id` and `offset`."""
    rows = saved(pieces_of(docs, path, capacity, end_id), "pieces")
    return pack_pieces(rows, capacity)


def pack_pieces(rows: DataFrame, capacity: int) -> DataFrame:
    """Pack a stored table of pieces in rounds."""
    whole = F.col("length") == capacity
    own = F.lit(255 << 55) + F.monotonically_increasing_id()
    done = [rows.filter(whole).withColumn("sequence_id", own).withColumn("offset", F.lit(0).cast("long"))]
    left, round_no, before = rows.filter(~whole), 1, None
    while True:
        count = left.count()
        tasks = max(1, -(-count // ROWS_PER_TASK))
        # lengths that do not fit together stay as many: a further round would gain nothing
        last = tasks == 1 or (before is not None and 2 * count > before)
        packed = saved(_pack_round(left, tasks, capacity, last, round_no), f"packed-{round_no}")
        done.append(packed.filter("sequence_id is not null"))
        if last:
            break
        left, round_no, before = packed.filter("sequence_id is null"), round_no + 1, count
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
