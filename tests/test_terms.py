"""The term join against brute force, with odd rows and long lists; full case folding."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import strings as S
from tidemark.operators.filters import find_indicators, measure_like
from tidemark.operators.terms import term_documents, term_hits


def _words(text):
    return [w for w in re.split("[^a-z0-9]+", (text or "").lower()) if w]


def _brute(texts, terms):
    found = []
    for key, text in texts:
        words = _words(text)
        for topic, keyword in terms:
            run = _words(keyword)
            found += [(key, i, topic, keyword) for i in range(len(words)) if run and words[i : i + len(run)] == run]
    return sorted(found, key=str)


def test_hits_equal_brute_force(spark):
    draw = random.Random(3)
    words = ["a", "b", "ab", "c3", "rent", "x"]
    texts = [(i, " ".join(draw.choices(words, k=draw.randint(0, 30)))) for i in range(60)]
    texts += [(60, None), (61, ""), (62, "--"), (63, "A-b, RENT; a b"), (64, "rent"), (64, "rent " * 5000)]
    terms = [("t", " ".join(draw.choices(words, k=draw.randint(1, 4)))) for _ in range(40)]
    terms = sorted(set(terms + [("u", "a-b"), ("u", "rent"), ("v", "rent"), ("u", ""), ("u", "!"), ("w", None)]), key=str)
    left, right = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(terms, "topic string, keyword string")
    got = sorted((tuple(r) for r in term_hits(left, right, "id").collect()), key=str)
    assert got == _brute(texts, terms)
    counts = {(r["topic"], r["keyword"]): r["documents"] for r in term_documents(left, right.union(right), "id").collect()}
    keys = {}
    for key, _, topic, keyword in got:
        keys.setdefault((topic, keyword), set()).add(key)
    assert counts == {t: len(k) for t, k in keys.items()}


def test_long_lists_make_rows_for_hits_only(spark):
    """100,000 terms, a third of which begin with one word."""
    terms = spark.range(100_000).selectExpr(
        "'t' as topic", "concat(if(id % 3 = 0, 'price', concat('w', id)), ' of thing', id) as keyword")
    texts = spark.createDataFrame([(1, "the price of thing99 and w7 of thing7"), (2, "price of things"), (3, None)], "id long, text string")
    got = {tuple(r) for r in term_documents(texts, terms, "id").collect()}
    assert got == {("t", "price of thing99", 1), ("t", "w7 of thing7", 1)}


def test_empty_sides_and_clashing_names(spark):
    texts = spark.createDataFrame([(1, "rent")], "id long, text string")
    terms = spark.createDataFrame([("t", "rent")], "topic string, keyword string")
    assert term_hits(texts.limit(0), terms, "id").count() == 0
    assert term_hits(texts, terms.limit(0), "id").count() == 0
    with pytest.raises(ValueError):
        term_hits(texts, terms.withColumnRenamed("topic", "id"), "id")


def test_casefold_equals_python(spark):
    texts = ["Straße", "GROẞ", "ΟΔΟΣ Σ ς", "ﬁn ﬂug ﬀ", "ŉ ǰ", "ſtill", "İstanbul", "plain ASCII", "", "Ꭰꭰ", "µ", None]
    texts += [chr(i) for i in range(0x3000) if chr(i).isalpha()]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.casefold(F.col("t")).alias("f")).collect()
    assert [(r["t"], r["f"]) for r in rows if r["f"] != (None if r["t"] is None else r["t"].casefold())] == []


def test_indicators_are_found_whatever_the_case(spark):
    rows = spark.createDataFrame([("Straßenbau", "GROSS"), ("STRASSENBAU", "groß"), ("Rent", None)], "item_name string, measure string")
    rows = rows.selectExpr("*", "'i' as indicator", "date'2024-01-01' as period_start", "uuid() as id")
    for part in ("straßen", "STRASSEN"):
        assert find_indicators(rows, item_name=part).count() == 2
    assert rows.where(measure_like("Groß")).count() == 2
