"""An adaptive context-mixing range coder for token ids, run on many blocks side by side.

Every block starts from the same state and has its own checksum, so blocks are coded and read independently; here
each block is a lane of numpy arrays and one step codes the next id of all lanes. Three predictions are mixed: the id
that followed the last two ids (order 2), the one that followed the last id (order 1), and the frequencies of all ids
in the segment (order 0, in its head). The weights of the mix are learned in the block for every pair of confidences
of orders 2 and 1. A range of 48 bits gives out 16 bits at a time; carries go into the words given out before.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 1024
LANES = 8192  # blocks coded side by side
_SLOTS = 512  # of the order-1 and order-2 tables of a lane
_WEIGHT, _ORDER0 = 15, 18  # bits of the weights and of the order-0 frequencies
_RARE, _SURE, _RATE = 1200, 31600, 5  # bounds of a learned weight and the speed of learning
_LEAST, _WORD = 1 << 32, 16  # a smaller range gives out a word
_HEAD = struct.Struct("<4sIIIII")  # mark, ids, blocks, distinct ids, size of their table, checksum of what follows in the head
_MARK = b"TID2"


class _Model:
    """What all lanes have learned. `look` gives guesses and the bounds of their shares; `know` is told the ids."""

    def __init__(self, lanes: int) -> None:
        self.last = np.zeros(lanes, np.uint32)
        self.before = np.zeros(lanes, np.uint32)
        self.table = np.zeros(2 * lanes * _SLOTS, np.uint32)  # guess and, in the lowest two bits, how far it is trusted
        self.base = np.arange(2 * lanes).reshape(2, lanes) * _SLOTS
        # by both confidences: weight of order 2, and of order 1 where order 2 is wrong
        start = np.array([[[3000, 11000, 16000, 24000][t // 4] for t in range(16)], [[2000, 5000, 8000, 16000][t % 4] for t in range(16)]])
        self.odds = np.repeat(start.reshape(2, 1, 16), lanes, axis=1).astype(np.int32).ravel()
        self.row = np.arange(2 * lanes).reshape(2, lanes) * 16
        self.slots = np.empty((2, lanes), np.int64)

    def look(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Guesses of orders 2 and 1, and where the share of each ends; order 0 has the rest."""
        one = self.last * np.uint32(40503)
        two = (one ^ self.before * np.uint32(30011)) >> np.uint32(3)
        np.add(self.base[0], two & np.uint32(_SLOTS - 1), out=self.slots[0], casting="unsafe")
        np.add(self.base[1], (one >> np.uint32(4)) & np.uint32(_SLOTS - 1), out=self.slots[1], casting="unsafe")
        self.entry = self.table.take(self.slots)
        self.guess = self.entry >> np.uint32(2)
        self.trust = self.entry & np.uint32(3)
        self.at = self.row + ((self.trust[0] << np.uint32(2)) | self.trust[1])
        self.p = self.odds.take(self.at)
        left = (1 << _WEIGHT) - self.p[0]
        return self.guess, self.p[0].astype(np.int64), (self.p[0] + ((left * self.p[1]) >> _WEIGHT)).astype(np.int64)

    def know(self, ids: np.ndarray) -> None:
        right = self.guess == ids
        step = (right * np.int32(_SURE - _RARE) + np.int32(_RARE) - self.p) >> _RATE
        step[1] *= ~right[0]
        self.odds[self.at] = self.p + step
        held = self.trust > 0
        entry = self.entry + (right & (self.trust < 3)) - (held & ~right)
        np.copyto(entry, (ids << np.uint32(2)) | np.uint32(1), where=~(right | held))
        self.table[self.slots] = entry
        self.before, self.last = self.last, ids


class _Encoder:
    def __init__(self, lanes: int, most: int) -> None:
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, (1 << 48) - 1, np.int64)
        self.room = 2 * most + 8
        self.out = np.zeros(lanes * self.room, np.uint16)
        self.at = np.arange(lanes) * self.room

    def give(self) -> None:
        """Words of the lanes whose range is small."""
        lanes = np.flatnonzero(self.range < _LEAST)
        while len(lanes):
            low = self.low[lanes]
            self._word(lanes, low >> 32)
            self.low[lanes] = (low & (_LEAST - 1)) << _WORD
            width = self.range[lanes] << _WORD
            self.range[lanes] = width
            lanes = lanes[width < _LEAST]

    def _word(self, lanes: np.ndarray, word: np.ndarray) -> None:
        at = self.at[lanes]
        self.out[at] = word.astype(np.uint16)
        self.at[lanes] = at + 1
        at = at[word > 0xFFFF]
        while len(at):
            at = at - 1
            raised = self.out[at] + np.uint16(1)
            self.out[at] = raised
            at = at[raised == 0]

    def end(self) -> None:
        """Two words: whatever follows them, the value stays inside the range."""
        every, low = np.arange(len(self.low)), self.low + (1 << _WORD) - 1
        self._word(every, low >> 32)
        self._word(every, (low >> 16) & 0xFFFF)
        self.at -= every * self.room


def _frequencies(present: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of all ids, at least 1 for each that occurs, and where the shares start."""
    total, shares = 1 << _ORDER0, np.zeros(1 << 16, np.int64)
    shares[present] = 1 + counts * (total - len(counts)) // max(1, counts.sum())
    if len(present):
        shares[np.argmax(shares)] += total - shares.sum()
    return shares.astype(np.int32), (np.cumsum(shares) - shares).astype(np.int32)


def _turned(grid: np.ndarray) -> np.ndarray:
    """Rows as columns, a few at a time: whole columns of a large grid are slow to walk."""
    out = np.empty(grid.shape[::-1], grid.dtype)
    for i in range(0, len(out), 32):
        out[i : i + 32] = grid[:, i : i + 32].T
    return out


def _lengths(total: int) -> np.ndarray:
    blocks = -(-total // BLOCK_IDS)
    sizes = np.full(blocks, BLOCK_IDS, np.int64)
    if blocks:
        sizes[-1] = total - (blocks - 1) * BLOCK_IDS
    return sizes


def compress(ids: np.ndarray) -> bytes:
    """A segment: head, ids that occur with their counts, words and checksum of every block, then the blocks."""
    ids = np.asarray(ids)
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 16):
        raise ValueError("ids must be below 65536")
    ids = ids.astype("<u4")
    sizes = _lengths(len(ids))
    checks = np.array([zlib.crc32(ids[i * BLOCK_IDS : (i + 1) * BLOCK_IDS]) for i in range(len(sizes))], "<u4")
    counts = np.bincount(ids, minlength=1 << 16)
    present = np.flatnonzero(counts)
    share, start = _frequencies(present, counts[present])
    lengths, payload = [], []
    for first in range(0, len(sizes), LANES):
        own = sizes[first : first + LANES]
        grid = np.full((len(own), int(own.max())), ids[-1])  # a shorter last block is filled up; this is cut when read
        grid.ravel()[: own.sum()] = ids[first * BLOCK_IDS : first * BLOCK_IDS + own.sum()]
        model, coder = _Model(len(own)), _Encoder(len(own), grid.shape[1])
        for now in _turned(grid):
            guess, two, one = model.look()
            right = guess == now
            part = coder.range >> _WEIGHT
            begin = np.where(right[0], 0, np.where(right[1], two, one))
            close = np.where(right[0], two, np.where(right[1], one, 1 << _WEIGHT))
            coder.low += part * begin
            coder.range = part * (close - begin)
            rest = np.flatnonzero(~(right[0] | right[1]))
            rare = now[rest]
            part = coder.range[rest] >> _ORDER0
            coder.low[rest] += part * start[rare]
            coder.range[rest] = part * share[rare]
            coder.give()
            model.know(now)
        coder.end()
        lengths.append(coder.at)
        payload.append(coder.out.reshape(len(own), -1)[np.arange(coder.room) < coder.at[:, None]].astype("<u2").tobytes())
    words = (np.concatenate(lengths) if lengths else np.zeros(0, np.int64)).astype("<u4")
    table = zlib.compress(np.diff(present, prepend=0).astype("<u2").tobytes() + counts[present].astype("<u4").tobytes(), 1)
    body = table + words.tobytes() + checks.tobytes()
    return _HEAD.pack(_MARK, len(ids), len(sizes), len(present), len(table), zlib.crc32(body)) + body + b"".join(payload)


def expand(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError where a checksum does not agree."""
    mark, total, blocks, distinct, table_size, check = _HEAD.unpack_from(data)
    table_end = _HEAD.size + table_size
    body_end = table_end + 8 * blocks
    if mark != _MARK or zlib.crc32(data[_HEAD.size : body_end]) != check:
        raise ValueError("damaged segment head")
    table = zlib.decompress(data[_HEAD.size : table_end])
    present = np.cumsum(np.frombuffer(table, "<u2", distinct), dtype=np.int64)
    share, start = _frequencies(present, np.frombuffer(table, "<u4", distinct, 2 * distinct).astype(np.int64))
    holder = np.repeat(np.arange(1 << 16, dtype=np.uint16), share)  # whose share a place of order 0 is in
    words = np.frombuffer(data, "<u4", blocks, table_end).astype(np.int64)
    checks = np.frombuffer(data, "<u4", blocks, table_end + 4 * blocks)
    flat = np.concatenate([np.frombuffer(data, "<u2", int(words.sum()), body_end), np.zeros(2 * BLOCK_IDS + 4, "<u2")])  # a damaged block may read on
    first, sizes = np.cumsum(words) - words, _lengths(total)
    out = np.zeros(total, "<u4")
    for begin in range(0, blocks, LANES):
        own = sizes[begin : begin + LANES]
        grid = np.zeros((int(own.max()), len(own)), np.uint32)
        at, code = first[begin : begin + LANES].copy(), np.zeros(len(own), np.int64)
        for _ in range(3):
            code = code << _WORD | flat[at]
            at += 1
        width, model = np.full(len(own), (1 << 48) - 1, np.int64), _Model(len(own))
        for step in range(len(grid)):
            guess, two, one = model.look()
            part = width >> _WEIGHT
            two, one = part * two, part * one
            past_two, past = code >= two, code >= one
            now = np.where(past_two, guess[1], guess[0])
            low = np.where(past, one, np.where(past_two, two, 0))
            width = np.where(past, part << _WEIGHT, np.where(past_two, one, two)) - low
            code = code - low
            rest = np.flatnonzero(past)
            part, behind = width[rest] >> _ORDER0, code[rest]
            # both are below 2**53, so the quotient is exact; only damage leads out of the table
            found = holder[np.clip((behind / part).astype(np.int64), 0, (1 << _ORDER0) - 1)]
            now[rest] = found
            code[rest] = behind - part * start[found]
            width[rest] = part * share[found]
            lanes = np.flatnonzero(width < _LEAST)
            while len(lanes):
                place = at[lanes]
                code[lanes] = code[lanes] << _WORD | flat[place]
                at[lanes] = place + 1
                wider = width[lanes] << _WORD
                width[lanes] = wider
                lanes = lanes[wider < _LEAST]
            grid[step] = now
            model.know(now)
        out[begin * BLOCK_IDS : begin * BLOCK_IDS + own.sum()] = _turned(grid).ravel()[: own.sum()]
    for i in range(blocks):
        if zlib.crc32(out[i * BLOCK_IDS : (i + 1) * BLOCK_IDS]) != checks[i]:
            raise ValueError(f"damaged block {i}")
    return out
