"""Secret scan, Merkle manifest and prefix trie against brute force, and the odd rows they must bear."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, prefix_trie, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, at long, found string, path string"
CONVERSATIONS = "conv_id long, turn long, role string, text string, block long, place string, id1 string"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _multiset(rows):
    return sorted(map(repr, rows))


def document_rows() -> list[tuple]:
    rng = random.Random(3)
    key = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    prose = lambda n: " ".join("".join(rng.choices("aaeionrstlhd", k=rng.randint(2, 9))) for _ in range(n))
    texts = [
        None, "", " \n", 'é password = "Abc123xyz_987" ü', "token: short", 'token="secret: abcdefghijklmnop"', "API_KEY:abcdefghijkl apikey=1234567890123",
        "AKIA" + "Z9" * 7 + " AKIA123 AKIAAKIA" + "Q" * 12, "ß" * 30 + "0123456789abcdef0 0123456789ABCDEF0", "paſſword=abcdefghijklmnop",
        f"éé {key(40)} and {key(24)}", f"x {'get_name_of_' * 3} token={key(30)}", "= " * 50 + "-" * 90, prose(20_000) + " " + key(32),
    ]
    texts += [prose(80) for _ in range(40)]
    rows = [(i, t, "en" if i % 2 else None, "big" if i % 3 else ("é" if i % 2 else "z"), i, "x", 1, "y", "p") for i, t in enumerate(texts)]
    rows += [(None, "Null Id", None, None, None, None, None, None, None), (7, "Again A", None, "only", 1, None, None, None, None), rows[5], rows[5]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(3)


def test_pattern_spans(docs):
    patterns = (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
    expected = []
    for row in document_rows():
        found = []
        for kind, pattern in enumerate(patterns):
            for m in re.finditer(pattern, row[1] or ""):
                if len(m[2] if kind == 0 else m[0]) >= (12, 18, 16)[kind]:
                    found.append((m.start(), kind, m.end()))
        base = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        expected.append((row[0], *[sum(k == kind for _, k, _ in found) for kind in range(3)], _sha(base)))
    got = secret_scan.digests(secret_scan.find_secrets(docs))
    assert _multiset(tuple(r)[:5] for r in got.collect()) == _multiset(expected)
    assert sum(e[1] for e in expected) == 4 and sum(e[3] for e in expected) >= 1


def test_random_strings_are_told_from_identifiers(docs):
    """Held-out strings that the chains were not trained on, and where the spans lie."""
    model = secret_scan.learn(docs)
    rng = random.Random(11)
    least = np.log(secret_scan.ODDS)
    for alphabet in (string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_uppercase + string.digits):
        keys = ["".join(rng.choices(alphabet, k=32)) for _ in range(200)]
        assert np.mean([secret_scan.ratio_of(model, k) >= least for k in keys]) > 0.95
    words = [w for r in document_rows()[14:] for w in (r[1] or "").split()]
    names = ["_".join(rng.choices(words, k=5)) for _ in range(200)] + ["".join(w.title() for w in rng.choices(words, k=5)) for _ in range(200)]
    assert np.mean([secret_scan.ratio_of(model, n) >= max(least, secret_scan.PER_SYMBOL * len(n)) for n in names if re.fullmatch("[A-Za-z_]+", n)]) < 0.02
    rows = {r["doc_id"]: r for r in secret_scan.scan(docs, model).collect() if r["doc_id"] in (10, 12, 13)}
    for doc in (10, 13):
        spans = [(s["start"], s["end"]) for s in rows[doc]["found"] if s["kind"] == "random"]
        keys = [m.span() for m in re.finditer(r"[A-Za-z0-9]{24,}", rows[doc]["text"])]
        assert spans == keys
    assert rows[12]["found"] == []


def test_scan_keeps_columns_and_redacts(docs):
    scanned = secret_scan.find_secrets(docs)
    assert set(scanned.columns) == set(docs.columns)
    got = {r["doc_id"]: r["out"] for r in scanned.select("doc_id", secret_scan.redacted(F.coalesce("text", F.lit("")), F.col("found")).alias("out")).collect()}
    assert got[3] == 'é [assign]" ü' and got[0] == "" and "[random]" in got[10] and got[2] == " \n"


def _manifest(rows) -> list[tuple]:
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by_source: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        leaf = _sha(head + field(text))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        lowered = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        seen = _sha(head + field(lowered)) if tampered else leaf
        by_source.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, seen, doc_id))

    def climb(level: list[str], i: int, folded: str, proof: str) -> tuple[str, str, str]:
        while len(level) > 1:
            run = level[i // 16 * 16 : i // 16 * 16 + 16]
            proof += "".join(h for k, h in enumerate(run) if k != i % 16)
            folded = _sha("".join(folded if k == i % 16 else h for k, h in enumerate(run)))
            level, i = [_sha("".join(level[k : k + 16])) for k in range(0, len(level), 16)], i // 16
        return level[0], folded, proof

    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subroots = [climb([leaf[2] for leaf in sorted(by_source[s])], 0, "", "")[0] for s in sources]
    out = []
    for n, source in enumerate(sources):
        leafs = sorted(by_source[source])
        for i, (_, _, leaf, seen, doc_id) in enumerate(leafs):
            _, folded, proof = climb([x[2] for x in leafs], i, seen, "")
            root, folded, proof = climb(subroots, n, folded, proof)
            out.append((doc_id, leaf, subroots[n], root, _sha(proof), folded, folded == root))
    return out


NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest(docs):
    got = merkle.tamper_check(docs).select(*NAMES).collect()
    assert _multiset(map(tuple, got)) == _multiset(_manifest(document_rows()))
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("n_sources,n_docs", [(1, 1), (1, 16), (1, 17), (40, 40), (18, 330)])
def test_manifest_of_many_shapes(spark, n_sources, n_docs):
    rows = [(i, f"Text {i}", None, f"s{i % n_sources}" if n_sources > 1 else None, i, None, None, None, None) for i in range(n_docs)]
    rows += [(1000 + i, "A", None, "s0", None, None, None, None, None) for i in range(280 if n_sources == 18 else 0)]
    got = merkle.tamper_check(spark.createDataFrame(rows, SCHEMA)).select(*NAMES).collect()
    assert _multiset(map(tuple, got)) == _multiset(_manifest(rows))


def conversation_rows() -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for c in range(60):
        for t in range(rng.choice((1, 2, 3, 8, 15))):
            text = None if rng.random() < 0.1 else rng.choice(("yes", "no", "é" * 7, ""))
            rows.append((c * 2 if c > 30 else c, t if rng.random() < 0.95 else None, rng.choice(("user", None)), text if t else "hello", 1, "x", "y"))
    rows += [rows[0], rows[0], (None, 1, "user", "x", None, None, None)]
    rows += [(500 + c, t, "user", "same", None, None, None) for c in range(40) for t in range(3)]
    return rows


def _trie(rows) -> list[tuple]:
    own: dict = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, role, prefix_trie_key(role, text), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members: dict = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children: dict = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == path)
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children.get(path, ())),
                    sum(p not in children for p in below), saved, _sha(ends)))
    return out


def prefix_trie_key(role: str, text: str) -> str:
    """Ties of turns and roles go by this digest."""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest() + f" {len(text.encode())}"


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("block,slice_,chunk", [(8, 1024, 4096), (2, 2, 3), (3, 1, 1)])
def test_prefix_trie(spark, monkeypatch, block, slice_, chunk):
    """Conversations of several blocks and slices, and ends that are hashed in several chunks."""
    monkeypatch.setattr(prefix_trie, "SLICE", slice_)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", chunk)
    rows = conversation_rows()
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(3), block).select(*TRIE).collect()
    assert _multiset(map(tuple, got)) == _multiset(_trie(rows))


def test_turnless_conversations(spark):
    """Turns that are all replaced by those of a conversation that is not there."""
    rows = [(c, t, "user", "x", None, None, None) for c in (1, 2, 3, 4, 6, 7) for t in range(2)]
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, CONVERSATIONS)).select(*TRIE).collect()
    assert _multiset(map(tuple, got)) == _multiset(_trie(rows))


def test_empty(spark):
    docs, convs = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], CONVERSATIONS)
    for df in (secret_scan.digests(secret_scan.find_secrets(docs)), merkle.tamper_check(docs), prefix_trie.rebuilt_trie(convs)):
        assert df.count() == 0


def test_language_sets_of_every_size():
    from tidemark.llm.language_id import infer

    for size in range(1, 8):
        scores = np.full((size * 100, 8), -12.0, np.float32)
        scores[np.arange(size * 100), np.arange(size * 100) % size] = -2.0
        shares = infer(scores, np.array([0, size * 100, size * 100]), penalty=2.0)
        assert np.allclose(shares[0, :size], 1 / size, atol=1e-3) and (shares[0] > 0.005).sum() == size
        assert (shares[1] > 0.005).sum() <= 1
