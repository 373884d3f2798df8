"""The operators against brute force, the libraries, and the odd rows they must bear."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, hilbert_shards, html_extract, jaccard_join, language_id, packing, quality_rules, range_coder, simhash,
    suffix_dedup, token_files,
)
from tidemark.llm.queries import CHECKS, QUERIES, vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, part int, position long"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def odd_texts() -> list[tuple]:
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]
    base = rng.choices(words, k=400)
    passage = " ".join(rng.choices(words, k=90))
    texts = [None, "", " \n\t", "!!! 123", "one", "<|endoftext|> x <|endoftext|>", "it's we'll  'tis\n\n  end ", "日本語 é Σ İ", "ab " * 4000, "=" * 1500]
    for k in range(6):  # near copies
        copy = list(base)
        copy[k * 60] = "changed"
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 3  # exact copies
    texts += [" ".join(rng.choices(words, k=60)) + " " + passage + " " + " ".join(rng.choices(words, k=60)) for _ in range(3)]
    texts.append(" ".join(rng.choices(words, k=9000)))
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None, "x", 1, 7) for i, t in enumerate(texts)]
    return rows + [rows[10], (None, texts[10], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_texts(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def _multiset(rows):
    return sorted(map(repr, rows))


def test_bpe_agrees_with_the_library(odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE)
    expected = []
    for doc_id, text in _texts(odd):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert _multiset(map(tuple, bpe.digests(odd, BYTE).collect())) == _multiset(expected)


def test_bpe_round_trip(odd):
    back = bpe.decode(bpe.encode(odd, BYTE), BYTE)
    assert _multiset(map(tuple, back.collect())) == _multiset(_texts(odd))


def test_long_words_merge_alike():
    pairs = bpe.byte_pairs(BYTE)
    for word in (b" abcabc" * 70, b"=" * 900, "é".encode() * 300):
        assert pairs.merge(word) == pairs.merge_long(word)


def test_token_files(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    library, path = Tokenizer.from_file(BYTE), str(tmp_path / "tokens")
    token_files.write_token_files(odd, path, BYTE)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    ids_of = {text: library.encode(text, add_special_tokens=False).ids + [0] for _, text in _texts(odd)}
    start = 0
    for row in rows:
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        start += row["n_tokens"]
    known = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert known == sorted(known) and rows[0]["doc_id"] is None
    assert _multiset((r["doc_id"], r["ids"]) for r in rows) == _multiset((d, ids_of[t]) for d, t in _texts(odd))
    checked = token_files.read_token_checksums(spark, path).collect()
    assert _multiset((r["doc_id"], r["ids_crc32"]) for r in checked) == _multiset(
        (d, zlib.crc32(np.array(ids_of[t], "<u4").tobytes())) for d, t in _texts(odd))


def test_range_coder_round_trip_and_damage():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1023, 1024, 1025, 4000):
        for most in (1, 2, 70, 65536):
            ids = rng.integers(0, most, n)
            assert (range_coder.expand(range_coder.compress(ids)) == ids).all()
    data = bytearray(range_coder.compress(rng.integers(0, 300, 3000)))
    data[-40] ^= 4
    with pytest.raises(ValueError):
        range_coder.expand(bytes(data))


def test_packing(odd):
    from tokenizers import Tokenizer

    library, capacity = Tokenizer.from_file(WORD), 256
    rows = packing.pack_documents(odd, WORD, capacity).collect()
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append(r)
    for items in bins.values():
        at = 0
        for r in sorted(items, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    expected = []
    for doc_id, text in _texts(odd):
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start : start + capacity]
            expected.append((doc_id, piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert _multiset((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == _multiset(expected)
    assert len(bins) <= -(-sum(r["length"] for r in rows) // capacity) * 1.05


def test_packing_improves_and_ends():
    rng = random.Random(2)
    for n in (0, 1, 7, 300):
        lengths = [rng.randint(1, 99) for _ in range(n)]
        packed = packing.pack(lengths, 100)
        assert sorted(i for items in packed for i in items) == list(range(n))
        assert all(sum(lengths[i] for i in items) <= 100 for items in packed)
    assert len(packing.pack([51] * 40, 100)) == 40


def test_quality_counts(odd):
    def measures(text):
        words = SPACES.findall(text)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen: dict = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if SPACES.search(line)]
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)

    got = quality_rules.quality(odd).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert _multiset((r["doc_id"], *(r[n] for n in names)) for r in got) == _multiset((d, *measures(t)) for d, t in _texts(odd))
    kept = quality_rules.keep_quality(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r["kept"] for r in got)


def test_ablations(odd):
    entries = quality_rules.ledger(odd)
    rows = {r["rule"]: r for r in quality_rules.ablations(entries, "v2").collect()}
    bits = [r["failed_bits"] for r in entries.collect()]
    for i, rule in enumerate(quality_rules.RULES):
        assert rows[rule.name]["n_failed"] == sum(b >> i & 1 for b in bits)
        assert rows[rule.name]["n_only_this"] == sum(b == 1 << i for b in bits)


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(30):
        text = np.array(rng.choices([97, 98, 255], k=rng.randint(1, 200)), np.uint8)
        raw = text.tobytes()
        assert suffix_dedup.two_stage_suffix_array(text, 300).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize("hot", [4000, 1])
def test_suffix_dedup(odd, hot):
    data = [(d, t.encode()) for d, t in _texts(odd)]
    count: dict = {}
    for _, raw in data:
        for i in range(len(raw) - 199):
            count[raw[i : i + 200]] = count.get(raw[i : i + 200], 0) + 1
    expected = []
    for doc_id, raw in data:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if count[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        expected.append((doc_id, len(raw), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    assert _multiset(map(tuple, suffix_dedup.removed_digests(odd, hot=hot).collect())) == _multiset(expected)


def _without_repeats(data):
    """(id, bytes, bytes removed, digest of the rest) by brute force."""
    count: dict = {}
    for _, raw in data:
        for i in range(len(raw) - 199):
            count[raw[i : i + 200]] = count.get(raw[i : i + 200], 0) + 1
    out = []
    for doc_id, raw in data:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if count[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        out.append((doc_id, len(raw), sum(gone), hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def test_common_passage_is_not_gathered(spark, odd, monkeypatch):
    """A passage in many texts, longer than a core: no group above the bound is sorted, and nothing is lost."""
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = letters(230)
    texts = [(1000 + i, letters(150) + passage + letters(150)) for i in range(60)]
    # the same with equal edges now and then, and a passage too short to be repeated
    edge, short = letters(40), letters(190)
    texts += [(2000 + i, letters(100) + edge + passage + letters(100)) for i in range(5)]
    texts += [(3000 + i, letters(100) + short + letters(100)) for i in range(20)]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    sizes = []
    sort = suffix_dedup._sorted_groups

    def watched(rows, length):
        sizes.append(rows.groupBy("key").agg(F.sum(F.octet_length("around")).alias("n")).agg(F.max("n")).first()[0] or 0)
        return sort(rows, length)

    monkeypatch.setattr(suffix_dedup, "_sorted_groups", watched)
    expected = _multiset(_without_repeats([(d, t.encode()) for d, t in _texts(df)]))
    for bound in (4_000, 0):
        sizes.clear()
        got = suffix_dedup.removed_digests(df, hot=10, group_bytes=bound).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
        assert _multiset(map(tuple, got)) == expected
        assert len(sizes) == 2 and sizes[1] <= bound  # the first call has the grams at few places


def test_remove_repeats_keeps_columns(odd):
    out = suffix_dedup.remove_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out.collect())


def _sets(df):
    out = []
    for doc_id, text in _texts(df):
        words = SPACES.findall(text.translate({i: i + 32 for i in range(65, 91)}))
        out.append((doc_id, frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()))
    return out


def test_jaccard_components(odd):
    rows = _sets(odd)
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            common = len(a & rows[j][1])
            if common and 100 * common >= 80 * len(a | rows[j][1]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    expected = []
    for i, (doc_id, own) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None] if own else [doc_id]
        expected.append((doc_id, len(own), min(ids) if ids else None))
    got = jaccard_join.component_rows(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert _multiset(map(tuple, got)) == _multiset(expected)


@pytest.mark.parametrize("sizes", [(3, 30), (40, 200), (1, 6)])
def test_join_sets_light_and_heavy(sizes):
    rng = random.Random(sum(sizes))
    sets = []
    for _ in range(40):
        base = rng.sample(range(5000), rng.randint(*sizes))
        for _ in range(3):
            sets.append(np.array(sorted(x if rng.random() > 0.08 else 5000 + rng.randrange(5000) for x in base), np.uint64))
    sets = [np.unique(s) for s in sets]

    def groups(links):
        of = list(range(len(sets)))
        for a, b in links:
            old, new = of[a], of[b]
            of = [new if g == old else g for g in of]
        return {frozenset(i for i, g in enumerate(of) if g == k) for k in set(of)}

    every = [(i, j) for i in range(len(sets)) for j in range(i)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert groups(jaccard_join.join_sets(sets)) == groups(every)
    side = np.array([i % 2 for i in range(len(sets))])
    assert groups(jaccard_join.join_sets(sets, side)) == groups([(i, j) for i, j in every if side[i] != side[j]])


def test_large_families_are_cut_into_blocks(odd, monkeypatch):
    whole = jaccard_join.component_rows(odd).select("doc_id", "component_id").collect()
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    cut = jaccard_join.component_rows(odd).select("doc_id", "component_id").collect()
    assert _multiset(map(tuple, whole)) == _multiset(map(tuple, cut))


def test_keep_one_per_component(odd):
    kept = jaccard_join.keep_one_per_component(odd)
    assert kept.columns == odd.columns
    near = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None and 10 <= r["doc_id"] <= 18]
    assert near == [10]


def test_languages_held_out(spark, small_dir):
    rows = QUERIES["op1_language_mixture"](spark, small_dir).join(
        spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_language_mixture_and_odd_rows(spark, odd, small_dir):
    documents = spark.read.parquet(f"{small_dir}/documents.parquet")
    model = language_id.learn(documents.select(F.col("lang").alias("label"), "text"))
    by_lang = {r["lang"]: r["t"] for r in documents.groupBy("lang").agg(F.max_by("text", "n_chars").alias("t")).collect()}
    mixed = " ".join(by_lang["en"].split()[:600] + by_lang["de"].split()[:300])
    row = language_id.predict(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).collect()[0]
    assert row["lang_pred"] == "en" and row["n_languages"] >= 2 and 0.5 < row["score"] < 0.85
    out = language_id.identify(odd).collect()
    assert len(out) == odd.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in out if not any(c.isalpha() for c in r["text"] or ""))
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns


def test_html_pages(spark):
    page = """<html><head><title>T</title></head><body><header class="top"><h1>Site</h1></header><nav><a href=a>Menu</a></nav>
    <div id="cookie-notice"><p>We use cookies, and this line is long enough, truly, to score.</p></div>
    <div class="wrap"><aside class="sidebar"><p>Side</p></aside><div class="content"><h2>Title &amp; more</h2>
    <p>First paragraph, with commas, and a good deal of text so that it gets points, <b>yes</b>.<br>Next
    line<p>Second one, which is also long enough, and has some commas, too.<ul><li>Item one<li>Item two</ul></div></div>
    <section id="comments"><p>Great post, thanks, I liked it, and so on and so on.</p></section>
    <form><input><label>Mail</label></form><script>var a="<p>x</p>"</script><footer>foot</footer>"""
    expected = ("Title & more\nFirst paragraph, with commas, and a good deal of text so that it gets points, yes. Next line\n"
                "Second one, which is also long enough, and has some commas, too.\nItem one\nItem two")
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<p>short", "z")]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    texts = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in out)
    assert texts == sorted([("1", expected, len(expected))] * 2 + [("2", "", 0), ("None", "", 0), ("3", "short", 5)])


PAGE_FORMS = {  # article text by page form; the frame around it is the same
    "formula and label": (
        "<p>where <math><mi>x</mi><annotation>x_1</annotation></math> is <label>seen</label> and counted, at length, in full</p>",
        "where x is seen and counted, at length, in full"),
    "own header": (
        "<header><h1>Own title</h1><p>By a writer, who is named here, in the paper</p><nav><a href=x>Next</a></nav></header>"
        "<p>A paragraph, with commas, long enough to be scored.</p>",
        "Own title\nBy a writer, who is named here, in the paper\nA paragraph, with commas, long enough to be scored."),
    "table": ("<table><tr><td>Cell one, long enough to score, yes<td>Cell two, long enough to score, too</table>",
              "Cell one, long enough to score, yes\nCell two, long enough to score, too"),
    "misnested": ("<p>Some <b>bold <i>both</b> slanted</i> words, and more of them, to the end.</p>",
                  "Some bold both slanted words, and more of them, to the end."),
    "quotes in attributes": ("<p title='a > b' class=\"x\"\">It is, after all, a paragraph like others.</p>",
                             "It is, after all, a paragraph like others."),
    "references": ("<p>Fish &amp; chips, &lt;b&gt; and &#x41;&nbsp;b, all of it, decoded once.</p>",
                   "Fish & chips, <b> and A b, all of it, decoded once."),
    "hidden": ("<p>What is seen, of course, and is long enough to score.</p><div hidden>unseen</div><p style='display: none'>gone</p>",
               "What is seen, of course, and is long enough to score."),
    "definitions": ("<dl><dt>Term<dd>Its meaning, given at length, and with commas.</dl>", "Term\nIts meaning, given at length, and with commas."),
    "breaks": ("<p>One line,<br>a second line,<br/>and a third line.</p>", "One line, a second line, and a third line."),
    "comments in markup": ("<p>Text <!-- not <p>this --> goes on, after the comment, to here.</p>", "Text goes on, after the comment, to here."),
}


@pytest.mark.parametrize("form", PAGE_FORMS)
def test_html_page_forms(form):
    body, expected = PAGE_FORMS[form]
    page = (f"<html><head><title>T</title></head><body><header><a href=/>Home</a></header><nav><ul><li>Menu</ul></nav>"
            f"<main><article>{body}</article></main><aside><p>Aside, with commas, and rather long, to score.</p></aside>"
            f"<div class=comments><p>A comment, with commas, and rather long, to score.</p></div><footer>foot</footer></body></html>")
    assert html_extract.main_text(page) == expected


@pytest.mark.parametrize("page, words", [
    ("<div>" * 100_000 + "<p>the only text", "the only text"),
    ("<b>" * 50_000 + "</i>" * 50_000 + "end", "end"),
    ("<ul><li>" * 50_000 + "item", "item"),
    ('<a =">"' * 20_000 + "'", ""),
    ("<p><label>x" * 30_000, "x"),
    ("".join(f"<div><p>a paragraph, long enough to score, number {i}" for i in range(20_000)), "number 19999"),
])
def test_html_time_grows_with_length(page, words):
    """Deep and broken pages: a walk over all open elements for each tag would take minutes."""
    started = time.process_time()
    text = html_extract.main_text(page)
    assert words in text
    assert time.process_time() - started < 10


def test_simhash_edits_and_likeness(odd):
    rows = simhash.compare_with_edited(odd).collect()
    assert len(rows) == odd.count()
    texts = sorted(_texts(odd), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    expected = []
    for i, (doc_id, text) in enumerate(texts):
        after, third = texts[(i + 1) % len(texts)][1], len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert _multiset((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == _multiset(expected)
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[16] == prints[17] == prints[18]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    plan = simhash.compare_with_edited(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hamming_search_is_exact(spark):
    rng = random.Random(4)
    base = [[rng.getrandbits(63), rng.getrandbits(63)] for _ in range(40)]
    every = list(base)
    for a, b in base:
        for flips in (1, 2, 3, 4):
            x = a
            for bit in rng.sample(range(63), flips):
                x ^= 1 << bit
            every.append([x, b])
    df = spark.createDataFrame([(f,) for f in every], "fp array<long>")
    got = {(tuple(r["query"]), tuple(r["found"])) for r in simhash.neighbours(df, df, 3).collect()}
    far = lambda f, g: sum(bin(x ^ y).count("1") for x, y in zip(f, g))
    assert got == {(tuple(f), tuple(g)) for f in every for g in every if f != g and far(f, g) <= 3}


@pytest.mark.parametrize("hot", [2_000, 5])
def test_hamming_search_at_the_registered_radius(spark, hot, monkeypatch):
    """Bits changed anywhere, up to the radius and beyond; one large group, whose keys are dealt in parts if `hot` is small."""
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = random.Random(6)
    signed = lambda x: [(x >> s & (1 << 64) - 1) - (x >> s + 63 & 1) * (1 << 64) for s in (0, 64)]
    base = [rng.getrandbits(128) for _ in range(12)]
    flipped = [x ^ sum(1 << i for i in rng.sample(range(128), n)) for x in base for n in (1, 7, 14, 19, 20, 21, 22, 30)]
    group = [base[0] ^ sum(1 << i for i in rng.sample(range(128), 4)) for _ in range(60)]
    every = list(dict.fromkeys(base + flipped + group))
    df = spark.createDataFrame([(signed(x),) for x in every + base], "fp array<long>")
    asked = spark.createDataFrame([(signed(x),) for x in base], "fp array<long>")
    got = _multiset((tuple(r["query"]), tuple(r["found"]), r["distance"]) for r in simhash.neighbours(asked, df).collect())
    pairs = [(x, y, bin(x ^ y).count("1")) for x in base for y in every]
    assert got == _multiset((tuple(signed(x)), tuple(signed(y)), n) for x, y, n in pairs if 0 < n <= simhash.RADIUS)


def test_near_copies_are_found(spark):
    """Recall of the registered search on copies that share 0.8 of their five-word shingles, against brute force."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows, near = [], {}
    shingles = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    for i in range(40):
        base = rng.choices(words, k=rng.randint(150, 400))
        rows.append((50 * i, " ".join(base)))
        for k in range(1, 5):
            copy = list(base)
            while len(a := shingles(base)) and len(a & shingles(copy)) / len(a | shingles(copy)) > 0.83:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            a, b = shingles(base), shingles(copy)
            if len(a & b) / len(a | b) >= 0.8:
                near[50 * i] = near.get(50 * i, 0) + 1
            rows.append((50 * i + k, " ".join(copy)))
    out = simhash.with_near_counts(simhash.compare_with_edited(spark.createDataFrame(rows, "doc_id long, text string")))
    got = {r["doc_id"]: r["n_near"] for r in out.filter("n_near is not null").collect()}
    assert sum(near.values()) > 100
    assert sum(min(got[k], n) for k, n in near.items()) >= 0.97 * sum(near.values())


def test_hilbert_neighbours_touch():
    side = 8
    points = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    index = hilbert_shards.hilbert_index(points, 3)
    assert sorted(index.tolist()) == list(range(side**3))
    ordered = points[np.argsort(index)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_shards(odd):
    rows = hilbert_shards.assign_shards(odd, 4).collect()
    assert len(rows) == odd.count()
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(4)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ends = [(min(r["hilbert"] for r in rows if r["shard"] == k), max(r["hilbert"] for r in rows if r["shard"] == k)) for k in range(4)]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_empty_tables(spark, empty, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = str(tmp_path / "none")
    token_files.write_token_files(empty, path, BYTE)
    for df in (
        language_id.identify(empty), language_id.keep_identified(empty), html_extract.extract(pages), bpe.digests(empty, BYTE),
        token_files.read_token_checksums(spark, path), quality_rules.quality(empty), quality_rules.keep_quality(empty),
        suffix_dedup.removed_digests(empty), suffix_dedup.remove_repeats(empty), jaccard_join.component_rows(empty),
        jaccard_join.keep_one_per_component(empty), hilbert_shards.assign_shards(empty), simhash.compare_with_edited(empty),
        packing.pack_documents(empty, WORD),
    ):
        assert df.count() == 0


def test_queries_match_sql(spark, duck, small_dir):
    for name, sql in CHECKS.items():
        df = QUERIES[name](spark, small_dir)
        expected = duck.sql(sql)
        names = sorted(df.columns)
        assert names == sorted(expected.columns)
        order = [expected.columns.index(n) for n in names]
        assert _multiset(tuple(r) for r in df.select(*names).collect()) == _multiset(tuple(r[i] for i in order) for r in expected.fetchall())


def test_pipeline(spark, odd, tmp_path, small_dir):
    import corpus_pipeline

    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small_dir)
        assert out.columns == odd.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() < odd.count()
    rows = corpus_pipeline.run(spark, small_dir).collect()
    assert rows and all(r["length"] <= 4096 for r in rows)
