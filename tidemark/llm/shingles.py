"""Word shingles of texts as 64-bit hashes, computed on Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)  # fixed by its seed on every worker
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(0, 1 << 64, 8, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
SEGMENT = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts on end, and the offset of each and the end; nulls are empty."""
    large = array.cast(pa.large_string())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = large.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segments(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SEGMENT bytes that end before white space."""
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data) and not _IS_SPACE[data[end]]:
            step = np.flatnonzero(_IS_SPACE[data[end : end + SEGMENT]])
            end = end + int(step[0]) if len(step) else min(end + SEGMENT, len(data))
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, index of the first word of each text and the end)."""
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    hashes, starts = [], []
    for a, b in _segments(data):
        part = data[a:b]
        letter = ~_IS_SPACE[part]
        first = letter.copy()
        first[1:] &= ~letter[:-1]
        first |= letter & opens[a:b]
        start = np.flatnonzero(first)
        if not len(start):
            continue
        at = np.flatnonzero(letter)
        word = np.cumsum(first)[at] - 1
        place = at - start[word]
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), _BASE)]), dtype=np.uint64)
        value = _BYTE[_LOWER[part[at]]] * power[place]
        bounds = np.searchsorted(at, start)
        hashes.append(mixed(np.add.reduceat(value, bounds)))
        starts.append(start + a)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(where, offsets)


def shingle_sets(array: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words make one shingle, none make none."""
    words, bounds = word_hashes(*text_buffer(array))
    n = len(words)
    joined = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        joined += words[k : n - size + 1 + k] * _PLACE[k] if len(joined) else 0
    joined = mixed(joined)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(joined[a : b - size + 1]))
        elif b > a:
            total = np.add.reduce(words[a:b] * _PLACE[: b - a], dtype=np.uint64, keepdims=True)
            out.append(mixed(total + _PLACE[7:] * np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
