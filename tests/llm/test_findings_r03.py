"""Findings of the third round on operators for training data."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from tidemark.llm import jaccard_join, library_tokens, range_coder, suffix_dedup
from tidemark.llm.queries import vocabulary

BYTE = vocabulary("byte_bpe_50k.json")


def _near_copies(n, size, share, seed):
    """Sets that keep `share` of one base and have shingles of their own for the rest."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 40, size, dtype=np.uint64)
    return [np.unique(np.where(rng.random(size) < share, base, rng.integers(1 << 40, 1 << 60, size, dtype=np.uint64))) for _ in range(n)]


def _components(n, links):
    of = np.arange(n)
    for a, b in links:
        of[of == max(of[a], of[b])] = min(of[a], of[b])
    return of.tolist()


def _similar(sets):
    codes, at = np.unique(np.concatenate(sets), return_inverse=True)
    grid = np.zeros((len(sets), len(codes)), np.float32)
    grid[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), at] = 1
    sizes, overlap = grid.sum(axis=1), grid @ grid.T
    return [(int(a), int(b)) for a, b in np.argwhere(100 * overlap >= 80 * (sizes[:, None] + sizes - overlap)) if a < b]


def test_near_copies_around_the_threshold_take_no_minutes():
    """op7: sets of one family met on thousands of pairs of shingles, and each meeting was a loop over all its pairs."""
    sets = _near_copies(600, 396, 0.943, 3)
    every = _similar(sets)
    assert 600 < len(every) < 600 * 599 // 2 - 600
    began = time.monotonic()
    links = jaccard_join.join_sets(sets)
    assert time.monotonic() - began < 10
    assert set((min(x), max(x)) for x in links) <= set(every)
    assert _components(600, links) == _components(600, every)


@pytest.mark.parametrize("meeting, share, least", [(0.0, 8, 64), (1e9, 8, 0), (1e9, 0, 64), (40.0, 2, 8)])
def test_light_heavy_and_dense_agree(monkeypatch, meeting, share, least):
    monkeypatch.setattr(jaccard_join, "MEETING", meeting)
    monkeypatch.setattr(jaccard_join, "DENSE_SHARE", share)
    monkeypatch.setattr(jaccard_join, "DENSE_SETS", least)
    sets = _near_copies(40, 60, 0.945, 5) + _near_copies(30, 200, 0.942, 6) + _near_copies(5, 1, 1.0, 7) + [np.zeros(0, np.uint64)] * 2
    every = _similar(sets)
    full = [(a, b) for a, b in every if len(sets[a])]
    assert _components(len(sets), jaccard_join.join_sets(sets)) == _components(len(sets), full)
    side = np.arange(len(sets)) % 2
    across = [(a, b) for a, b in full if side[a] != side[b]]
    assert _components(len(sets), jaccard_join.join_sets(sets, side)) == _components(len(sets), across)


def _letters(rng, n):
    return "".join(rng.choices("abcdefgh ", k=n))


def test_strings_are_looked_at_once(spark):
    """op6: every string was in the surroundings of each sampled gram inside it, two to three on average."""
    rng = random.Random(4)
    passage = _letters(rng, 6_000)
    df = spark.createDataFrame([(i, _letters(rng, 300) + "xyz"[i] + passage + "uvw"[i] + _letters(rng, 300)) for i in range(3)], "doc_id long, text string")
    texts = suffix_dedup.keyed(df)
    found = suffix_dedup.places(texts, 200)
    rows = suffix_dedup.surroundings(texts, found, 200, 50_000).collect()
    assert 3 * 5_801 <= sum(len(r["around"]) - 199 for r in rows) < 1.2 * 3 * 5_801
    assert {r["n_removed"] for r in suffix_dedup.removed_digests(df).collect()} == {6_000}


@pytest.mark.parametrize("chunk, group_bytes", [(1 << 19, 1 << 21), (3_000, 1 << 21), (3_000, 1_000)])
def test_groups_too_large_for_one_array(monkeypatch, chunk, group_bytes):
    """op6: grams at more than 4,000 places made eight rows for each of their surroundings; a task deals them by itself now."""
    monkeypatch.setattr(suffix_dedup, "_CHUNK", chunk)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group_bytes)
    rng = random.Random(8)
    gram, left, right = _letters(rng, 40), _letters(rng, 160), _letters(rng, 160)
    group = []
    for i in range(120):
        a, b = rng.choice([0, 30, 90, 160]), rng.choice([0, 40, 100, 160])
        text = _letters(rng, 160 - a) + left[160 - a :] + gram + right[:b] + _letters(rng, 160 - b)
        base = rng.choice([0, 0, 5])
        group.append((1, text[base:].encode(), bytes([i]) * 16, base, i % 40 == 0, None, base, 160 - base))
    group += [(2, group[3][1], bytes([200]) * 16, 0, False, None, 0, 160)]
    starts: dict[bytes, set[int]] = {}
    for i, row in enumerate(group[:-1]):
        for at in range(len(row[1]) - 199):
            starts.setdefault(row[1][at : at + 200], set()).add(i)
    expected = set()
    for i, row in enumerate(group[:-1]):
        for at in range(len(row[1]) - 199):
            if row[4] or len(starts[row[1][at : at + 200]]) > 1 or any(group[j][4] for j in starts[row[1][at : at + 200]]):
                expected |= {(i, k) for k in range(at, at + 200)}
    got = {(i, k) for i, low, high in zip(*suffix_dedup._starts_of(group, 200)) for k in range(low, high) if i < 120}
    assert expected and got == expected


# op4_token_files: CPU seconds of the coder and of the word table
def test_range_coder_codes_whole_ids_in_order_0():
    ids = np.minimum(np.random.default_rng(4).zipf(1.3, 600_000), 65_535)  # nothing but the frequencies tells the next id
    data = range_coder.compress(ids)
    assert (range_coder.expand(data) == ids).all()
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() / 8
    assert len(data) < 1.15 * entropy * len(ids)


def test_range_coder_time_per_id():
    ids = np.minimum(np.random.default_rng(5).zipf(1.2, 1 << 21), 50_000)

    def seconds(run):
        taken = []
        for _ in range(2):
            start = time.process_time()
            run()
            taken.append(time.process_time() - start)
        return min(taken)

    unit = seconds(lambda: [np.cumsum(ids) for _ in range(100)])
    assert seconds(lambda: range_coder.expand(range_coder.compress(ids))) < 2 * unit


def test_range_coder_carries_and_blocks_of_one_segment():
    for share in (0.9, 0.999, 0.999999):
        rng = np.random.default_rng(6)
        ids = np.where(rng.random(200_001) < share, 7, rng.integers(0, 60_000, 200_001))
        assert (range_coder.expand(range_coder.compress(ids)) == ids).all()


def test_word_table_joins_new_words_and_forgets_rare_ones():
    table = library_tokens.word_table.__wrapped__(BYTE)
    texts = ["don't stop 's\n\n  x\t1\x1c2  ᠎y déjà \n", "", " ", "\n", "a<|endoftext|>\nb"]
    texts += [f"the word{i} of{i % 7} \n" for i in range(300)] * 2
    calls = []
    words, table.cache_words = table.encode_words, 100
    table.encode_words = lambda values: calls.append(values) or words(values)
    for i in range(0, len(texts), 20):
        ids, bounds = table.encode(texts[i : i + 20])
        for k, text in enumerate(texts[i : i + 20]):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == list(table.encode_text(text))
        assert len(table.known) <= 100
    assert not calls  # all words went to the library on end
