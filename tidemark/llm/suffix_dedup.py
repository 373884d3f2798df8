"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

A byte is removed if a string of `length` bytes that covers it also starts anywhere else, in any text. Texts that
hold such a string agree on its sampled positions (minimisers: places whose `GRAM` bytes hash least among all that
fit into the string), so only texts around places whose grams occur again are looked at, and each string only at its
least gram. The surroundings of equal grams meet in one task. There a suffix array is built: suffixes smaller than
their successors are sorted directly, all others are induced by scans over the buckets of first bytes; neighbours that
agree on `length` bytes are repeats, if they start at different places.

Within a text, equal surroundings (periodic text has many) are settled where it is read and stand for one place.
Surroundings of one gram that are too many for one array are dealt by longer common cores for eight ranges of offsets.
Those of grams at very many places (`HOT_PLACES`) are reduced to distinct ones first and dealt by their cores over all
tasks. Where a passage is longer than a core, its edges still give one core very many distinct surroundings: those of
a core with too many bytes are dealt by each of their strings of `length` bytes, whose first and last place are
aggregated. So no passage, however common, gathers all its texts in one task (`HOT_PLACES` bounds it), and no suffix
array is built over more than a few megabytes.

Null texts are empty; nothing is removed from texts shorter than `length`. Repeated rows are texts that start
elsewhere: all their bytes go, like those of all copies. Nulls in other columns do no harm. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, shuffle_width, text_or_empty, text_slices
from tidemark.llm.shingles import mixed, text_buffer

LENGTH = 200
GRAM = 40
HOT_PLACES = 50_000  # places of one gram beyond which its surroundings are dealt by longer cores
GROUP_BYTES = 1 << 21  # bytes of the surroundings of one core beyond which they are dealt by their strings
_CLASSES = 8
_SALTS = 16
_CHUNK = 1 << 19  # bytes of surroundings in one suffix array
_END = 0xFF  # is in no UTF-8 text
_RANDOM = np.random.default_rng(7919)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = 0xD6E8FEB86659FD93


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of every `gram` bytes on end, by doubling."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    level, size = _BYTE[data], 1
    total, done = None, 0
    while True:
        if gram & size:  # append this power of two
            n = len(data) - (done + size) + 1
            if total is None:
                total = level[:n].copy()
            else:
                total = total[:n] * np.uint64(pow(_STEP, size, 1 << 64)) + level[done : done + n]
            done += size
        if done == gram:
            return mixed(total)
        level = level[:-size] * np.uint64(pow(_STEP, size, 1 << 64)) + level[size:]
        size *= 2


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of every `width` values on end."""
    pick = np.minimum if least else np.maximum
    n = len(values) - width + 1
    fill = np.uint64(0xFFFFFFFFFFFFFFFF if least else 0)
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, fill, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    left = pick.accumulate(grid, axis=1).ravel()
    right = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(right[:n], left[width - 1 : width - 1 + n])


def sampled_places(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position, gram hash) of the minimisers of all strings of `length` bytes, in overlapping pieces of the text."""
    places, hashes = [], []
    step = 1 << 20
    for at in range(0, max(len(data) - length + 1, 0), step):
        piece = data[at : at + step + length - 1]
        h = gram_hashes(piece, gram)
        width = length - gram + 1
        least = _sliding(h, width, True)
        # a place is sampled if it is the least of some string that covers it
        edge = np.zeros(width - 1, np.uint64)
        most = _sliding(np.concatenate([edge, least, edge]), width, False)
        own = np.flatnonzero(most == h)
        places.append(own + at)
        hashes.append(h[own])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _needed(wanted: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """The wanted suffixes and those that they are induced from: all up to the next one that is sorted directly."""
    n = len(wanted)
    starts = np.flatnonzero(wanted)
    stops = np.append(np.flatnonzero(smaller), n - 1)
    ends = stops[np.searchsorted(stops[:-1], starts)]
    opened = np.bincount(starts, minlength=n + 1) - np.bincount(ends + 1, minlength=n + 1)
    return np.cumsum(opened)[:n] > 0


def two_stage_suffix_array(text: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """The suffixes in the order of their first `depth` bytes at least.

    With a mask of wanted suffixes, others are left out unless a wanted one is induced from them.
    """
    n = len(text)
    cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    run = np.diff(np.append(cuts, n))
    after = np.append(text[cuts[1:]], 0).astype(np.int16)
    rises = text[cuts] < after  # the suffixes of the last run are greater than the empty one
    rises[-1] = False
    smaller = np.repeat(rises, run)  # suffix smaller than its successor
    needed = np.ones(n, bool) if wanted is None else _needed(wanted, smaller)
    induce = needed & ~smaller
    direct = np.flatnonzero(needed & smaller)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").ravel(), kind="stable")]
    del rows
    direct_cut = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if induce[-1]:
        induced[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        wave = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        waves = [wave]
        while len(wave):  # those of the bucket that precede a member of it
            before = wave[wave > 0] - 1
            wave = before[(text[before] == c) & induce[before]]
            waves.append(wave)
        bucket = np.concatenate([*waves, direct[direct_cut[c] : direct_cut[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & induce[before]]
        order = np.argsort(text[before], kind="stable")
        before = before[order]
        first = text[before]
        marks = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
        for a, b in zip(marks, [*marks[1:], len(first)]):
            induced[first[a]].append(before[a:b])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def equal_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix (but the first) shares `length` bytes with the one before it in order."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    word, size = padded, 1
    while size < 8:
        word = (word[:-size] << np.uint64(8 * size)) | word[size:]
        size *= 2
    same = np.arange(1, len(order))
    for at in [length - 8, *range(0, length - 8, 8)]:
        same = same[word[order[same] + at] == word[order[same - 1] + at]]
    out = np.zeros(len(order), bool)
    out[same] = True
    return out


def repeated_starts(strings: list[bytes], base: np.ndarray, many: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Offsets in each string at which a string of `length` bytes starts that also starts elsewhere.

    `base` places the strings: two starts are the same if base + offset are. `many` marks strings that stand for
    several places.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    end = bytes([_END])
    text = np.frombuffer(end.join(strings) + end, np.uint8)
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), sizes)
    offset = np.arange(len(text)) - first[owner]
    whole = offset + length <= sizes[owner] - 1  # suffixes of `length` bytes or more in their string
    order = two_stage_suffix_array(text, length, whole)
    order = order[whole[order]]
    if not len(order):
        return [np.zeros(0, np.int64)] * len(strings)
    opens = np.flatnonzero(~equal_neighbours(text, order, length))
    place = base[owner[order]] + offset[order]
    twice = np.minimum.reduceat(place, opens) != np.maximum.reduceat(place, opens)
    twice |= np.logical_or.reduceat(many[owner[order]], opens)
    found = np.sort(order[np.repeat(twice, np.diff(np.append(opens, len(order))))])
    cuts = np.searchsorted(found, np.append(first, len(text)))
    return [offset[found[a:b]] for a, b in zip(cuts, cuts[1:])]


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs covered by intervals sorted by their start; touching ones are one."""
    if not len(low):
        return low, high
    reach = np.maximum.accumulate(high)
    opens = np.concatenate([[True], low[1:] > reach[:-1]])
    at = np.flatnonzero(opens)
    return low[at], reach[np.append(at[1:], len(low)) - 1]


def keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def _around(data: bytes, pos: int, length: int) -> tuple[int, bytes]:
    """(start, bytes) of all strings of `length` bytes that cover the gram at a position."""
    base = max(0, pos - (length - GRAM))
    return base, data[base : pos + length]


def _narrowed(pos: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For places in ascending order: the range of bytes of the strings in which no place given has a smaller gram hash.

    Equal strings have equal least grams, so each string is needed at its least gram only.
    """
    reach = length - GRAM
    low, high = np.maximum(pos - reach, 0), pos + length
    left, right = np.zeros(len(pos), bool), np.zeros(len(pos), bool)
    for k in range(1, len(pos)):
        near = pos[k:] - pos[:-k] <= reach
        if not near.any():
            break
        down, up = near & (hashes[:-k] < hashes[k:]) & ~left[k:], near & (hashes[k:] < hashes[:-k]) & ~right[:-k]
        low[k:][down] = pos[:-k][down] + 1
        high[:-k][up] = pos[k:][up] + GRAM - 1
        left[k:] |= down
        right[:-k] |= up
    return low, high


def _settled(data: bytes, where: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(kept indices, whether each stands for several places, runs covered by surroundings that occur again here)."""
    _, group, count = np.unique(hashes, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[group] > 1)
    keep, twice = np.ones(len(where), bool), np.zeros(len(where), bool)
    seen: dict[bytes, tuple[int, int]] = {}
    runs: set[tuple[int, int]] = set()
    for i in again.tolist():
        base, around = _around(data, int(where[i]), length)
        first, at = seen.setdefault(around, (i, base))
        if first == i or len(around) < length:
            continue
        keep[i] = False  # the same strings as those around the first place
        if at != base:
            twice[first] = True
            runs.update(((at, at + len(around)), (base, base + len(around))))
    if runs:
        low, high = merged(*np.array(sorted(runs)).T)
        return np.flatnonzero(keep), twice[keep], list(zip(low.tolist(), high.tolist()))
    return np.flatnonzero(keep), twice[keep], []


def places(texts: DataFrame, length: int) -> DataFrame:
    """(hash, digest, pos, twice, high) of the sampled places of every text; copies in one task are read once.

    Rows without a hash are runs from `pos` to `high` that are known to be repeated inside the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in text_slices(batch, "text", 4_000_000):
                data, offsets = text_buffer(part.column(0))
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for i, digest in enumerate(part.column(1).to_pylist()):
                    if digest in seen:
                        continue
                    seen.add(digest)
                    own = data[offsets[i] : offsets[i + 1]]
                    where, h = sampled_places(own, length)
                    kept, twice, runs = _settled(own.tobytes(), where, h, length)
                    low, high = np.array(runs, np.int64).reshape(-1, 2).T
                    blank = np.zeros(len(runs), np.int64)
                    n = len(kept)
                    for column, values in zip(columns, (
                        np.concatenate([h[kept].view(np.int64), blank]), np.full(n + len(runs), i), np.concatenate([where[kept], low]),
                        np.concatenate([twice, blank.astype(bool)]), np.concatenate([np.full(n, -1), high]),
                    )):
                        column.append(values)
                if len(seen) > 1_000_000:
                    seen.clear()
                if columns[0]:
                    h, owner, pos, twice, high = (np.concatenate(c) for c in columns)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h, mask=high >= 0), part.column(1).take(pa.array(owner)), pa.array(pos), pa.array(twice), pa.array(high, mask=high < 0)],
                        names=["hash", "digest", "pos", "twice", "high"],
                    )

    return texts.select("text", "digest").mapInArrow(run, "hash long, digest binary, pos long, twice boolean, high long")


def surroundings(texts: DataFrame, found: DataFrame, length: int, hot: int) -> DataFrame:
    """(digest, base, key, around, at, twice, hot) of the places whose gram occurs at another place too.

    `around` holds all strings of `length` bytes of which the gram is the least; the gram is at `at` in it, and it starts at byte `base`; `twice` marks those
    that stand for several places of their text, `hot` those whose gram is at more than `hot` places.
    """
    grams = found.filter("hash is not null")
    marks = grams.select("hash", "twice", F.xxhash64("digest", "pos").alias("m"))
    again = marks.groupBy("hash").agg(F.min("m").alias("a"), F.max("m").alias("b"), F.count("*").alias("n"), F.max("twice").alias("t"))
    again = again.filter("a != b or t").select("hash", (F.col("n") > hot).alias("hot"))
    of_text = grams.join(again, "hash").groupBy("digest").agg(F.collect_set(F.struct("pos", "hash", "twice", "hot")).alias("places"))
    once = texts.groupBy("digest").agg(F.first("text").alias("text"))
    names = ["digest", "base", "key", "around", "at", "twice", "hot"]
    types = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for digest, text, listed in zip(*(batch.column(k) for k in range(3))):
                data, own = text.as_py().encode(), digest.as_py()
                found = sorted(listed.as_py(), key=lambda p: p["pos"])
                limits = _narrowed(np.array([p["pos"] for p in found]), np.array([p["hash"] for p in found]).view(np.uint64), length)
                for p, base, stop in zip(found, *(x.tolist() for x in limits)):
                    if min(stop, len(data)) - base >= length:
                        rows.append((own, base, p["hash"], data[base:stop], p["pos"] - base, p["twice"], p["hot"]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    joined = once.join(of_text, "digest").select("digest", "text", "places")
    return joined.mapInArrow(run, "digest binary, base long, key long, around binary, at long, twice boolean, hot boolean")


def _place(row: tuple, shift: int = 0) -> int:
    """A number for the byte of a text at which a row's surroundings (and a shift) start."""
    return (int.from_bytes(row[2][:8], "little", signed=True) * 2 + row[3] + shift + (1 << 63)) % (1 << 64) - (1 << 63)


def _offset_ranges(length: int) -> list[tuple[int, int]]:
    """Ranges of the offsets that a gram may have in its strings."""
    last = length - GRAM
    span = -(-(last + 1) // _CLASSES)
    return [(low, min(low + span - 1, last)) for low in range(0, last + 1, span)]


def _sharing(strings: list[tuple], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(low, high, members) of strings (row, members' rows, several) that agree on all bytes that their strings of
    `length` bytes with the gram at an offset of a range have in common: only these can share such a string."""
    for low, high in _offset_ranges(length):
        cores: dict[bytes, list[int]] = {}
        for i, (row, _, _) in enumerate(strings):
            around, at = row[1], row[7]
            if at >= low and at + length - high <= len(around):
                cores.setdefault(around[at - low : at + length - high], []).append(i)
        for members in cores.values():
            if len(members) > 1 and not all(strings[i][2] for i in members):
                yield low, high, members


def _equal_strings(strings: list[tuple], members: list[int], low: int, high: int, length: int) -> dict[int, list[int]]:
    """Repeated starts of very many members, an offset of the gram after the other."""
    out: dict[int, list[int]] = {}
    for offset in range(low, high + 1):
        found: dict[bytes, list[int]] = {}
        for i in members:
            row = strings[i][0]
            start = row[7] - offset
            if start >= 0 and start + length <= len(row[1]):
                found.setdefault(row[1][start : start + length], []).append(i)
        for same in found.values():
            if len(same) > 1 and (any(strings[i][2] for i in same) or len({_place(strings[i][0], strings[i][0][7]) for i in same}) > 1):
                for i in same:
                    out.setdefault(i, []).append(strings[i][0][7] - offset)
    return out


def _starts_of(group: list[tuple], length: int) -> tuple[list[int], list[int], list[int]]:
    """(row, low, high) of the repeated runs of rows (key, around, digest, base, twice, code, shift, at)."""
    keys: dict[int, dict[tuple, list[int]]] = {}
    for i, row in enumerate(group):
        if len(row[1]) >= length:
            keys.setdefault(row[0], {}).setdefault((row[1], row[7]), []).append(i)
    out: tuple[list[int], list[int], list[int]] = ([], [], [])

    def add(rows: list[int], low: list[int], high: list[int]) -> None:
        for i in rows:
            out[0].extend([i] * len(low))
            out[1].extend(low)
            out[2].extend(high)

    units: list[tuple[bytes, int, bool, list[int], int]] = []  # bytes, their place, several places, rows, start in `around`
    held = 0

    def sort() -> None:
        found = repeated_starts([u[0] for u in units], np.array([u[1] for u in units], np.int64), np.array([u[2] for u in units]), length)
        for (_, _, _, rows, shift), starts in zip(units, found):
            low, high = merged(starts + shift, starts + shift + length)
            add(rows, low.tolist(), high.tolist())

    for index in keys.values():
        strings = []
        for (around, _), rows in index.items():
            first = group[rows[0]]
            several = first[4] or any(group[i][2:4] != first[2:4] or group[i][4] for i in rows)
            if several:  # all of it is repeated
                add(rows, [0], [len(around)])
            strings.append((first, rows, several))
        if len(strings) == 1:
            continue
        if sum(len(row[1]) for row, _, _ in strings) <= _CHUNK:
            parts = [[(i, 0, None) for i in range(len(strings))]]
        else:  # too much for one array: by what they agree on
            parts = []
            for low, high, members in _sharing(strings, length):
                cut = [(i, max(0, strings[i][0][7] - high), strings[i][0][7] + length - low) for i in members]
                if len(members) * (length + high - low) <= GROUP_BYTES:
                    parts.append(cut)
                    continue
                for i, starts in _equal_strings(strings, members, low, high, length).items():
                    where = np.array(sorted(starts))
                    runs = merged(where, where + length)
                    add(strings[i][1], runs[0].tolist(), runs[1].tolist())
        for part in parts:
            for i, start, stop in part:
                row, rows, several = strings[i]
                units.append((row[1][start:stop], _place(row, start), several, rows, start))
                held += len(units[-1][0])
            if held >= _CHUNK:  # an array holds whole parts
                sort()
                units.clear()
                held = 0
    if units:
        sort()
    return out


def _sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    """Repeated runs of rows (key, around, digest, base, twice, code, shift, at), by groups of one key.

    Returns (digest, code, low, high); low and high are offsets in `around` plus `shift`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size, key = 0, None

        def flush() -> pa.RecordBatch:
            at, low, high = _starts_of(group, length)
            shift = np.array([group[i][6] for i in at], np.int64)
            arrays = [pa.array([group[i][2] for i in at], pa.binary()), pa.array([group[i][5] for i in at], pa.binary()),
                      pa.array(np.array(low, np.int64) + shift), pa.array(np.array(high, np.int64) + shift)]
            return pa.RecordBatch.from_arrays(arrays, names=["digest", "code", "low", "high"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if row[0] != key and size >= _CHUNK:  # an array holds whole groups
                    yield flush()
                    group, size = [], 0
                key = row[0]
                group.append(row)
                size += len(row[1])
        if group:
            yield flush()

    columns = ["key", "around", "digest", "base", "twice", "code", "shift", "at"]
    dealt = rows.select(*columns).repartition(shuffle_width(rows), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "digest binary, code binary, low long, high long")


def _by_cores(once: DataFrame, length: int) -> DataFrame:
    """Distinct surroundings of hot grams (code, around, digest, base, twice, at: the gram's offset) as one row for
    each range of offsets that their strings may have, keyed by the bytes that all strings of the range share."""
    ranges = _offset_ranges(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64())
        for batch in batches:
            rows: list[tuple] = []
            for code, around, digest, base, twice, pos in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for place, (low, high) in enumerate(ranges):
                    if pos - low < 0 or pos + length - high > len(around):
                        continue  # no string of this range fits into the text
                    core = hashlib.blake2b(around[pos - low : pos + length - high], digest_size=8, key=bytes([place]))
                    start = max(0, pos - high)
                    key = int.from_bytes(core.digest(), "little", signed=True)
                    rows.append((key, around[start : pos + length - low], digest, base + start, twice, code, start, pos - start))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["key", "around", "digest", "base", "twice", "code", "shift", "at"])

    return once.select("code", "around", "digest", "base", "twice", "at").mapInArrow(
        run, "key long, around binary, digest binary, base long, twice boolean, code binary, shift long, at long"
    )


def _by_strings(rows: DataFrame, length: int) -> DataFrame:
    """Repeated runs (code, low, high) of rows of cores too large for one suffix array, by each string of `length` bytes.

    A string is repeated if its least and its greatest place differ. Strings of one row overlap, so that the first and
    the last repeated one make its run. Finding the strings again is salted, as one may be in most rows.
    """
    types = (pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.int64())
    names = ["string", "digest", "pos", "twice", "code", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for around, digest, base, twice, code, shift in zip(*(batch.column(i).to_pylist() for i in range(6))):
                for at in range(len(around) - length + 1):
                    string = hashlib.blake2b(around[at : at + length], digest_size=16).digest()
                    made.append((string, digest, base + at, twice, code, shift + at))
                if len(made) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    strings = rows.select("around", "digest", "base", "twice", "code", "shift").mapInArrow(
        run, "string binary, digest binary, pos long, twice boolean, code binary, low long"
    )
    strings = saved(strings, "strings")
    place = F.struct("digest", "pos")
    seen = strings.groupBy("string").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("twice").alias("t"))
    again = seen.filter("a != b or t").select("string", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    salted = strings.select("string", "code", "low", F.pmod(F.hash("code"), F.lit(_SALTS)).alias("salt"))
    found = salted.join(again, ["string", "salt"])
    return found.groupBy("code").agg(F.min("low").alias("low"), (F.max("low") + length).alias("high"))


def _hot_runs(once: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """Repeated runs (code, low, high) of distinct surroundings of hot grams."""
    cores = saved(_by_cores(once, length), "cores")
    sizes = cores.groupBy("key").agg(F.sum(F.octet_length("around")).alias("bytes"))
    # one row for each `group_bytes` of surroundings at most
    large = F.broadcast(sizes.filter(F.col("bytes") > group_bytes).select("key"))
    small_runs = _sorted_groups(cores.join(large, "key", "left_anti"), length).select("code", "low", "high")
    return small_runs.unionByName(_by_strings(cores.join(large, "key", "left_semi"), length))


def repeated_runs(docs: DataFrame, length: int = LENGTH, hot: int = HOT_PLACES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """`digest` of each text with repeats and lists of its covered `runs` (low, high), not yet merged."""
    texts = keyed(docs)
    found = saved(places(texts, length), "places")
    around = saved(surroundings(texts, found, length, hot), "around")
    listed = F.collect_set(F.struct("low", "high")).alias("runs")
    plain = around.filter("not hot").withColumn("code", F.lit(None).cast("binary")).withColumn("shift", F.col("base"))
    runs = _sorted_groups(plain, length).groupBy("digest").agg(listed)
    # distinct surroundings of hot grams are sorted once each, and their runs go to all their places
    common = around.filter("hot").withColumn("code", F.unhex(F.md5(F.concat(F.col("around"), F.encode(F.concat_ws(":", "key", "at"), "utf-8")))))
    place = F.struct("digest", "base")
    once = common.groupBy("code").agg(
        F.first("around").alias("around"), F.min(place).alias("o"), F.max(place).alias("p"), F.max("twice").alias("t"), F.first("at").alias("at")
    ).select("code", "around", "o.*", (F.col("t") | (F.col("o") != F.col("p"))).alias("twice"), "at")
    of_code = _hot_runs(once, length, group_bytes).groupBy("code").agg(listed.alias("rel"))
    moved = F.transform("rel", lambda r: F.struct((r["low"] + F.col("base")).alias("low"), (r["high"] + F.col("base")).alias("high")))
    hot_runs = common.select("code", "digest", "base").join(of_code, "code").select("digest", moved.alias("runs"))
    copies = texts.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).cast("long").alias("size"))
    span = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("size").alias("high")))
    whole = copies.filter((F.col("n") > 1) & (F.col("size") >= length)).select("digest", span.alias("runs"))
    inside = found.filter("hash is null").groupBy("digest").agg(F.collect_set(F.struct(F.col("pos").alias("low"), "high")).alias("runs"))
    every = runs.unionByName(hot_runs).unionByName(whole).unionByName(inside)
    return saved(every.groupBy("digest").agg(F.flatten(F.collect_set("runs")).alias("runs")), "runs")


def cut_rows(docs: DataFrame, runs: DataFrame, columns: list[str], make: Callable[[bytes, np.ndarray, np.ndarray], tuple], schema: str) -> DataFrame:
    """Rows of `columns` (as a struct) and what `make` gives for each text and its merged runs."""
    digest = F.unhex(F.md5(text_or_empty().cast("binary")))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = docs.select(kept, F.col("text").cast("string").alias("text"), digest.alias("digest")).join(runs, "digest", "left").select("row", "text", "runs")
    fields = [part.strip().split(" ")[0] for part in schema.split(",")]
    types = {"string": pa.string(), "long": pa.int64()}
    kinds = [types[part.strip().split(" ")[1]] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                made = []
                for text, listed in zip(batch.column(1), batch.column(2)):
                    pairs = np.array(sorted((r["low"], r["high"]) for r in listed.as_py() or []), np.int64).reshape(-1, 2)
                    value = text.as_py()
                    made.append(make(None if value is None else value.encode(), *merged(pairs[:, 0], pairs[:, 1])))
                columns_ = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns_], names=["row", *fields])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {schema}")


def _rest(data: bytes, low: np.ndarray, high: np.ndarray) -> bytes:
    edges = [0, *np.stack([low, high], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removed_digests(docs: DataFrame, length: int = LENGTH, hot: int = HOT_PLACES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept_sha256` of every row."""
    def make(data: bytes | None, low: np.ndarray, high: np.ndarray) -> tuple:
        data = data or b""
        return len(data), int((high - low).sum()), len(low), hashlib.sha256(_rest(data, low, high)).hexdigest()

    out = cut_rows(docs, repeated_runs(docs, length, hot, group_bytes), ["doc_id"], make, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT_PLACES) -> DataFrame:
    """The rows with the repeated bytes taken out of `text`; `n_chars` is counted anew where it is there.

    A character that is cut through goes as a whole. Null texts stay null.
    """
    def make(data: bytes | None, low: np.ndarray, high: np.ndarray) -> tuple:
        return (None if data is None else _rest(data, low, high).decode("utf-8", "ignore"),)

    names = docs.columns
    out = cut_rows(docs, repeated_runs(docs, length, hot), names, make, "cut_text string")
    new = {"text": F.col("cut_text").alias("text"), "n_chars": F.length("cut_text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in names else None}
    return out.select(*[new.get(c) if new.get(c) is not None else F.col("row").getField(c).alias(c) for c in names])
