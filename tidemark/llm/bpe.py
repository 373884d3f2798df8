"""Byte-level BPE encoding and decoding, with a contiguous rank array per word.

A text is cut into pre-tokens; each distinct one is merged on its own. A word keeps the boundaries of its parts
and the rank of every adjacent pair in one short array; the least rank is found by a scan, the boundary between
its parts is deleted and only the two neighbouring ranks are looked up again. Decoding joins the bytes of the ids.

Null texts are empty: no ids, and the digests of nothing. Repeated rows and null ids are kept as they are. Texts
may be of any length: they are cut at single blanks, which no pre-token crosses. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, text_slices
from tidemark.llm.pretokens import WordTable, byte_level_starts, encode_all, gather

_NO_RANK = 1 << 30
_SPREAD = 0x2545F4914F6CDD1D  # an odd multiplier that spreads pair keys over the slots


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """A byte-level vocabulary read from a tokenizers file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = _byte_letters()
        vocabulary: dict[str, int] = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        raw = {word: bytes(letters[c] for c in word) for word in vocabulary if word not in self.special}
        self.bytes_of: dict[int, bytes] = {vocabulary[w]: b for w, b in raw.items()}
        self.bytes_of.update({i: s.encode() for s, i in self.special.items()})
        self.single = [0] * 256
        for word, data in raw.items():
            if len(data) == 1:
                self.single[data[0]] = vocabulary[word]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocabulary[left] << 20 | vocabulary[right]] = (rank, vocabulary[left + right])
        self._fill_slots()
        size = max(self.bytes_of) + 1
        self.length = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.table = WordTable(byte_level_starts, self._words, self._simple, self._mixed)

    def _fill_slots(self) -> None:
        """An open hash table of the merges in arrays, at most a quarter full."""
        bits = max(4, (4 * len(self.merges)).bit_length())
        self.slot_mask = (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.zeros(1 << bits, np.int32)
        self.slot_id = np.zeros(1 << bits, np.int32)
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        for key, slot in zip(keys.tolist(), (keys * _SPREAD >> 40 & self.slot_mask).tolist()):
            while self.slot_key[slot] >= 0:
                slot = (slot + 1) & self.slot_mask
            self.slot_key[slot] = key
            self.slot_rank[slot], self.slot_id[slot] = self.merges[key]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        single, merges = self.single, self.merges
        parts = [single[b] for b in word]
        if len(parts) < 2:
            return parts
        # ranks[i] and joined[i] belong to the pair of parts i and i + 1
        found = [merges.get(a << 20 | b) for a, b in zip(parts, parts[1:])]
        ranks = [f[0] if f else _NO_RANK for f in found]
        joined = [f[1] if f else 0 for f in found]
        while ranks:
            least = min(ranks)
            if least == _NO_RANK:
                break
            i = ranks.index(least)
            parts[i] = joined[i]
            del parts[i + 1], ranks[i], joined[i]
            if i < len(ranks):
                pair = merges.get(parts[i] << 20 | parts[i + 1])
                ranks[i], joined[i] = pair if pair else (_NO_RANK, 0)
            if i:
                pair = merges.get(parts[i - 1] << 20 | parts[i])
                ranks[i - 1], joined[i - 1] = pair if pair else (_NO_RANK, 0)
        return parts

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of many pre-tokens: those of like length share one block of rank arrays."""
        raw = [word.encode() for word in words]
        out: list = [None] * len(raw)
        groups: dict[int, list[int]] = {}
        for i, data in enumerate(raw):
            if len(data) > 64:
                out[i] = self.merge_long(data) if len(data) > 400 else self.merge(data)
            else:
                groups.setdefault(1 << max(2, (len(data) - 1).bit_length()), []).append(i)
        for width, members in groups.items():
            for i, ids in zip(members, self._merge_block([raw[i] for i in members], width), strict=True):
                out[i] = ids
        return out

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; no part is -1."""
        key = left.astype(np.int64) << 20 | right
        key[(left < 0) | (right < 0)] = -1
        slot = (key * _SPREAD >> 40) & self.slot_mask
        where = np.full(len(key), -1, np.int64)
        open_ = np.flatnonzero(key >= 0)
        while len(open_):
            held = self.slot_key[slot[open_]]
            hit = held == key[open_]
            where[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (held >= 0)]
            slot[open_] = (slot[open_] + 1) & self.slot_mask
        found = where >= 0
        return np.where(found, self.slot_rank[where], _NO_RANK), np.where(found, self.slot_id[where], 0)

    def _merge_block(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """`merge` for a block of words: row r holds the parts of one word and the ranks of its adjacent pairs."""
        count = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        column = np.arange(width)
        parts = np.full((len(words), width + 1), -1, np.int32)
        parts[:, :width] = np.where(column < count[:, None], np.asarray(self.single, np.int32)[data], -1)
        rank, joined = (x.reshape(-1, width).astype(np.int32) for x in self._pairs(parts[:, :-1].ravel(), parts[:, 1:].ravel()))
        row = np.arange(len(words))
        done: list = [None] * len(words)
        while len(row):
            at = rank.argmin(axis=1)
            every = np.arange(len(row))
            more = rank[every, at] < _NO_RANK
            for r, ids in zip(row[~more], parts[~more]):
                done[r] = ids[ids >= 0]
            row, parts, rank, joined, at = row[more], parts[more], rank[more], joined[more], at[more]
            if not len(row):
                break
            every = np.arange(len(row))
            parts[every, at] = joined[every, at]
            gone = at[:, None]
            keep = np.minimum(column + (column > gone), width)
            parts[:, :width] = np.take_along_axis(parts, keep, axis=1)
            keep = np.minimum(column + (column >= gone), width - 1)
            rank, joined = np.take_along_axis(rank, keep, axis=1), np.take_along_axis(joined, keep, axis=1)
            rank[:, -1] = _NO_RANK
            for i in (at, at - 1):
                some = np.flatnonzero(i >= 0)
                rank[some, i[some]], joined[some, i[some]] = self._pairs(parts[some, i[some]], parts[some, i[some] + 1])
        return done

    def merge_long(self, word: bytes) -> list[int]:
        """As `merge` for a long pre-token (a rule of dashes, a run of blanks): a heap in place of the scans."""
        import heapq

        parts = [self.single[b] for b in word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        alive = [True] * len(parts)
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (pair := self.merges.get(parts[i] << 20 | parts[j])):
                heapq.heappush(heap, (pair[0], i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], alive[j], after[i] = self.merges[left << 20 | right][1], False, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part, keep in zip(parts, alive) if keep]

    def _simple(self, text: str) -> bool:
        return not any(s in text for s in self.special)

    def _mixed(self, text: str) -> np.ndarray:
        """A text that holds special tokens: they are ids of their own, and the texts between them stand alone."""
        import regex

        pattern = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        out = [np.zeros(0, np.int32)]
        for part in pattern.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.int32))
            elif part:
                out.extend(ids for _, ids, _ in encode_all(self.table, [part]))
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become the replacement character."""
        return self._text(gather(self.data, self.first[ids], self.length[ids]).tobytes())

    @staticmethod
    def _text(data: bytes) -> bytes:
        try:
            data.decode("utf-8")
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()
        return data

    def decode_many(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        length = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])[bounds]
        data = gather(self.data, self.first[ids], length).tobytes()
        return [self._text(data[a:b]) for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """The vocabulary, read once per Python worker."""
    return BytePairs(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id` and `ids` (array of int) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in batches:
            for part in text_slices(batch, "text", 4_000_000):
                for start, ids, bounds in encode_all(pairs.table, part.column(1).to_pylist()):
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(start, len(lists)), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {_id_type(docs)}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id` and `text` from `ids`; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in batches:
            texts = [None if ids is None else pairs.decode(np.asarray(ids, np.int64)).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_id_type(encoded)}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids and digest of what they decode to, in one pass.

    The ids of a batch are decoded where they were made, so that they need not be written or sent.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in batches:
            for part in text_slices(batch, "text", 4_000_000):
                for start, ids, bounds in encode_all(pairs.table, part.column(1).to_pylist()):
                    raw = ids.astype("<u4")
                    id_digests = [hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(bounds, bounds[1:])]
                    texts = [hashlib.sha256(t).hexdigest() for t in pairs.decode_many(ids, bounds)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(start, len(texts)), pa.array(np.diff(bounds), pa.int64()), pa.array(id_digests), pa.array(texts)],
                        names=names,
                    )

    schema = f"doc_id {_id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()
