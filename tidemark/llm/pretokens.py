"""Vectorised pre-tokenisation and word-table encoding of Arrow text batches.

A text is cut into pre-tokens by character classes with numpy; equal pre-tokens of a batch are found by Arrow's
dictionary encoding, each distinct one is encoded once by a given function (a bounded cache keeps it for later
batches) and its ids are gathered back. Texts that the classes do not describe exactly go to a slower function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_BLANK, _QUOTE = 0x20, 0x27
_CODE_POINTS = 0x110000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(_CODE_POINTS, np.uint8)
    points = np.arange(_CODE_POINTS, dtype="<u4")
    points[0xD800:0xE000] = 0x21  # surrogates cannot be in a text
    every = points.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    table[0xD800:0xE000] = OTHER
    table[0x1C:0x20] = OTHER  # separators of the file era are not white space here
    return table


@dataclass(frozen=True)
class Points:
    """The code points of some texts on end."""

    code: np.ndarray
    first: np.ndarray  # index of each text's first code point, and the end
    byte: np.ndarray  # byte offset of each code point, and the end


def points_of(texts: Sequence[str]) -> tuple[Points, bytes]:
    joined = "".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=first[1:])
    width = 1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
    byte = np.zeros(len(code) + 1, np.int64)
    np.cumsum(width, out=byte[1:])
    return Points(code, first, byte), joined.encode("utf-8")


def _cut_contractions(p: Points, starts: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Make 's 't 'm 'd 're 've 'll tokens of their own where a token opens with the quote."""
    code = p.code
    at = np.flatnonzero(opens & (code == _QUOTE))
    if not len(at):
        return starts
    one = code[np.minimum(at + 1, len(code) - 1)]
    two = code[np.minimum(at + 2, len(code) - 1)]
    length = np.zeros(len(at), np.int64)
    length[np.isin(one, [ord(c) for c in "stmd"])] = 2
    for a, b in ("re", "ve", "ll"):
        length[(one == ord(a)) & (two == ord(b))] = 3
    text_end = p.first[np.searchsorted(p.first, at, "right")]
    fits = (length > 0) & (at + length <= text_end)
    at, ends = at[fits], (at + length)[fits]
    starts[at + 1] = False
    starts[ends[ends < len(starts)]] = True
    return starts


def byte_level_starts(p: Points) -> np.ndarray:
    """Where the pre-tokens of a byte-level tokenizer start: words with one leading blank, white space apart."""
    n = len(p.code)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = classes()[p.code]
    text_start = np.zeros(n + 1, bool)
    text_start[p.first] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    before[text_start[:n]] = 255
    starts = kind != before
    space = kind == SPACE
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = 255, kind[1:]
    after[text_start[1:]] = 255
    last_space = space & (after != SPACE) & (after != 255)  # the last of a run that a word follows
    starts |= last_space
    joins = last_space & (p.code == _BLANK)
    follows = np.zeros(n, bool)
    follows[1:] = joins[:-1]
    opens = starts & (kind == OTHER) & ~follows
    starts &= ~follows
    return np.flatnonzero(_cut_contractions(p, starts, opens))


def lower_word_starts(p: Points) -> np.ndarray:
    """Starts of the pre-tokens of a lower-casing word tokenizer; white space (which it drops) starts one too."""
    n = len(p.code)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = classes()[p.code]
    text_start = np.zeros(n + 1, bool)
    text_start[p.first] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    starts = (kind != before) | (kind == NUMBER) | text_start[:n]
    return np.flatnonzero(_cut_contractions(p, starts, starts & (kind == OTHER)))


def gather(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs values[first[i] : first[i] + count[i]] on end."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(first - (ends - count), count)
    return values[shift + np.arange(total)]


class WordTable:
    """Encodes texts word by word; `encode_words` gives the ids of each of some distinct pre-tokens."""

    def __init__(
        self,
        starts: Callable[[Points], np.ndarray],
        encode_words: Callable[[list[str]], list[Sequence[int]]],
        simple: Callable[[str], bool],
        encode_text: Callable[[str], Sequence[int]],
        prepare: Callable[[str], str] = lambda text: text,
        drop_spaces: bool = False,
        cache_words: int = 500_000,
        encode_joined: Callable[[list[str]], tuple[np.ndarray, np.ndarray] | None] | None = None,
    ) -> None:
        """`encode_joined`, where given, is tried first: the ids of some words on end and their number for each word."""
        self.starts, self.encode_words, self.simple, self.encode_text = starts, encode_words, simple, encode_text
        self.prepare, self.drop_spaces, self.cache_words, self.encode_joined = prepare, drop_spaces, cache_words, encode_joined
        self._afresh()

    def _afresh(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.seen = np.zeros(0, np.uint8)  # batches that held a known word
        self.flat = np.zeros(0, np.int32)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)  # where a known word's ids start, and their number

    def _forget(self) -> None:
        """Keep the words of two batches or more, or none if they are many: a bound on memory, not on results."""
        keep = np.flatnonzero(self.seen > 1)
        if len(keep) > self.cache_words // 2:
            return self._afresh()
        self.known, self.seen = self.known.take(pa.array(keep)), np.ones(len(keep), np.uint8)
        self.flat, self.count = gather(self.flat, self.first[keep], self.count[keep]), self.count[keep]
        self.first = np.cumsum(self.count) - self.count

    def _encode_distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words on end, and their number for each word."""
        found = self.encode_joined(words) if self.encode_joined else None
        if found is None:
            lists = self.encode_words(words)
            count = np.fromiter(map(len, lists), np.int64, len(words))
            found = np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum())), count
        ids, count = found
        if self.drop_spaces:
            space = np.array([bool(w) and classes()[ord(w[0])] == SPACE for w in words], bool)
            return ids[~np.repeat(space, count)], np.where(space, 0, count)
        return ids, count

    def _ids_of(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Some ids, and where in them the ids of each word start, and their number."""
        coded = words.dictionary_encode()
        index, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        if len(distinct) * 16 < len(self.known):  # looking through what is known would cost more
            ids, count = self._encode_distinct(distinct.to_pylist())
            return ids, (np.cumsum(count) - count)[index], count[index]
        place = pc.fill_null(pc.index_in(self.known, value_set=distinct), -1).to_numpy(zero_copy_only=False)
        held, row = np.flatnonzero(place >= 0), np.full(len(distinct), -1)
        row[place[held]] = held
        new = np.flatnonzero(row < 0)
        if len(new):
            if len(self.known) and len(self.known) + len(new) > self.cache_words:
                self._forget()
                return self._ids_of(words)
            row[new] = len(self.known) + np.arange(len(new))
            added = distinct.take(pa.array(new))
            ids, count = self._encode_distinct(added.to_pylist())
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
            self.known, self.count = pa.concat_arrays([self.known, added]), np.concatenate([self.count, count])
            self.flat, self.seen = np.concatenate([self.flat, ids]), np.concatenate([self.seen, np.zeros(len(count), np.uint8)])
        self.seen[row] = np.minimum(self.seen[row], 254) + 1
        return self.flat, self.first[row][index], self.count[row][index]

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids on end, offset of each text and the end)."""
        plain = [self.simple(t) for t in texts]
        p, data = points_of([self.prepare(t) if ok else "" for t, ok in zip(texts, plain, strict=True)])
        start = self.starts(p)
        offsets = np.append(p.byte[start], p.byte[-1])
        words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data))
        flat, first, counts = self._ids_of(words)
        out = gather(flat, first, counts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        bounds = ends[np.searchsorted(start, p.first)]
        if all(plain):
            return out, bounds
        parts = [
            out[bounds[i] : bounds[i + 1]] if ok else np.asarray(self.encode_text(texts[i]), np.int32)
            for i, ok in enumerate(plain)
        ]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


_SEAM = regex.compile(r"(?<=\S) (?=\S)")


def pieces(text: str, size: int = 1_000_000) -> Iterator[str]:
    """Cut a long text before single blanks between words; no pre-token crosses such a cut."""
    start = 0
    while len(text) - start > size:
        found = _SEAM.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_long(table: WordTable, text: str) -> np.ndarray:
    """Ids of a text of any length, piece by piece."""
    return np.concatenate([table.encode([piece])[0] for piece in pieces(text)])


def encode_all(table: WordTable, texts: Sequence[str], size: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, ids, offsets) for groups of texts of about `size` code points."""
    start = 0
    while start < len(texts):
        end, total = start, 0
        while end < len(texts) and (end == start or total + len(texts[end]) <= size):
            total += len(texts[end])
            end += 1
        if end == start + 1 and total > size:
            ids = encode_long(table, texts[start])
            yield start, ids, np.array([0, len(ids)])
        else:
            yield (start, *table.encode(texts[start:end]))
        start = end
