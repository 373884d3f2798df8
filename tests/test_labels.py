"""Truth cases for topics, relevance, enrichment and sentiment."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import labels as L
from tidemark.functions import sentiment as SE
from tidemark.functions import strings as S
from tidemark.functions.matching import HybridMatcher
from tidemark.operators.enrich import enrich
from tidemark.plans import views
from tidemark.registry import local_table


def one(spark, text, expression):
    return local_table(spark, {"text": [text]}).select(expression.alias("v")).first()["v"]


TOPIC_CASES = [
    ("They raised the rent again", "housing"),
    ("Our electricity bills doubled", "energy"),
    ("HECS indexation hits in June", "debt"),
    ("No bulk billing left in town", "healthcare"),
    ("Nothing of the kind", "cost_of_living"),
]


@pytest.mark.parametrize("text, hits", [
    ("Der Müll bleibt liegen", ["müll"]), ("Müllabfuhr", []), ("zu große Kosten", ["große"]), ("2müll müll9", []), ("", []),
])
def test_terms_with_other_letters(spark, text, hits):
    terms = ("müll", "große")
    m = HybridMatcher.over(F.col("text"))
    assert one(spark, text, m.hits(terms)) == hits
    assert one(spark, text, m.any(terms)) is bool(hits)


def test_topics(spark):
    df = local_table(spark, {"text": [t for t, _ in TOPIC_CASES], "topic": [x for _, x in TOPIC_CASES]})
    got = df.select("topic", L.topic_of(HybridMatcher.over(F.col("text"))).alias("got")).collect()
    assert [(r["got"]) for r in got] == [r["topic"] for r in got]


def test_keywords(spark):
    m = HybridMatcher.over(F.col("text"))
    assert "groceries" in one(spark, "Groceries cost a fortune now", L.keywords_of(m))
    assert one(spark, "Long service leave", L.keywords_of(m)) == []
    assert one(spark, "a rent increase", L.keywords_of(m)) == ["rent", "rent increase"]


RELEVANCE_CASES = [
    ("That song lives rent free in my mind", "housing", False, False),
    ("Australian renters in Melbourne report mortgage stress and higher prices", "housing", False, True),
    ("Staff ask to work from home while fuel costs keep rising", "groceries", False, True),
    ("Europe runs low on jet fuel this summer", "fuel", False, False),
    ("Ten motorhome destinations in Australia for a small budget", "housing", True, False),
    ("Bunnings and Aldi take home customer awards", "", True, False),
    ("Good news for Ampol shares as war fuels demand", "", True, False),
    ("A musical about rent increase in Sydney", "housing", False, False),
    ("   ", "housing", True, False),
]


def test_relevance(spark):
    columns = list(zip(*RELEVANCE_CASES))
    df = local_table(
        spark, {"text": list(columns[0]), "hint": list(columns[1]), "trust": list(columns[2]), "want": list(columns[3])}
    )
    out = L.with_relevance(df, hint=F.col("hint"), trust_hint=F.col("trust")).collect()
    assert [(r["text"], r["relevant"]) for r in out] == [(r["text"], r["want"]) for r in out]


@pytest.mark.parametrize(
    "text, local",
    [
        ("Households in Perth pay more for groceries", True),
        ("Prices at Woolworths upset many customers", True),
        ("Inflation worries weigh on US consumer sentiment", False),
        ("Critics attack the Inflation Reduction Act", False),
    ],
)
def test_local_context(spark, text, local):
    assert one(spark, text, L.has_local_context(HybridMatcher.over(F.col("text")))) is local


def test_clean_markup(spark):
    text = "Rent is TOO expensive! https://example.org/a?b #rent @someone"
    assert one(spark, text, S.clean_markup(F.col("text"))) == "rent is too expensive!"
    assert one(spark, "été #été_x <b>Ü</b>", S.clean_markup(F.col("text"))) == "été ü"


def test_html(spark):
    assert one(spark, "<p>A<br/>B &amp; C&nbsp;&#233; &lt;d&gt;</p>", S.html_to_text(F.col("text"))) == "A B & C é <d>"


def test_labelled_values(spark):
    cases = {"1: Index": ("1", "Index"), '2: "a: b" ': ("2", "a: b"), " plain ": ("plain", "plain")}
    for text, (code, label) in cases.items():
        assert one(spark, text, S.label_code(F.col("text"))) == code
        assert one(spark, text, S.label_text(F.col("text"))) == label


RAW = {
    "id": ["a", "b", "c", "d"],
    "platform": ["mastodon", "bluesky", "gdelt", "gdelt"],
    "text": [
        "Rent keeps rising",
        "Sale",
        "A generic story in Australia about many things in town",
        "TAX_A; WB_1; sale; join now; x; y; z",
    ],
    "category": ["housing", "housing", "groceries", None],
    "url": ["", "", "https://example.org/c", "https://example.org/d"],
    "like_count": [3, 0, None, None],
}


def test_enrichment_cases(spark):
    raw = local_table(spark, RAW)
    rows = {r["raw_id"]: r for r in enrich(raw, SE.lexicon_scorer(V.STARTER_LEXICON)).collect()}
    a, b, c, d = (rows[k] for k in "abcd")
    assert (a["topic"], a["topic_source"], a["source_group"]) == ("housing", "text_keywords", "social")
    assert "rent" in a["matched_keywords"] and a["processing_status"] == "processed"
    assert b["processing_status"] == "discarded" and b["sentiment_score"] is None and b["sentiment_label"] is None
    assert (c["topic"], c["topic_source"], c["source_group"]) == ("groceries", "harvest_category_fallback", "media")
    assert {"metadata_heavy", "low_relevance"} <= set(d["quality_flags"])
    assert d["quality_flags"] == sorted(d["quality_flags"])


def test_sentiment_forms_agree(spark, small_dir):
    """The row-wise scorer and the join give the same score for every text."""
    posts = views.text_posts(spark, small_dir)
    joined = SE.score_texts(posts, "id", "text", SE.starter_lexicon(spark))
    in_row = posts.select("id", SE.lexicon_scorer(V.STARTER_LEXICON)(F.col("text")).alias("row_score"))
    both = joined.join(in_row, "id")
    assert both.count() == posts.count()
    assert both.where(~F.col("compound").eqNullSafe(F.col("row_score"))).count() == 0
    assert both.where("compound <> 0").count() > 10


def test_sentiment_rules(spark):
    score = SE.lexicon_scorer({"good": 1.9, "bad": -2.5})
    texts = ["good", "not good", "very good", "slightly good", "good but bad", "good!!!", "nothing", "", None]
    got = dict(enumerate(r[0] for r in local_table(spark, {"text": texts}).select(score(F.col("text"))).collect()))
    assert got[0] == 0.4404
    assert got[1] < 0 < got[3] < got[0] < got[2]
    assert got[4] < 0
    assert got[5] > got[0]
    assert got[6] == got[7] == got[8] == 0.0


RULE_LEXICON = {"good": 1.9, "bad": -2.5, "no": -1.2, "kind": 2.4, "mustard": 0.5, "very": 1.0, "friend": 2.2}
# text -> sum of valences after the rules, worked out by hand
RULE_CASES = {
    "not good": 1.9 * -0.74,
    "not never good": 1.9 * -0.74 * -0.74,
    "isn't good": 1.9 * -0.74,
    "really good": 1.9 + 0.293,
    "really xx bad": -2.5 - 0.293 * 0.95,
    "really xx yy bad": -2.5 - 0.293 * 0.9,
    "hardly good": 1.9 - 0.293,
    "not really good": (1.9 + 0.293) * -0.74,
    "really not good": 1.9 * -0.74 - 0.293 * 0.95,
    "never so good": (1.9 + 0.293) * 1.5,
    "never this xx good": 1.9 * 1.25,
    "xx yy so good": (1.9 + 0.293) * 1.25,
    "without doubt good": 1.9,
    "without xx good": 1.9 * -0.74,
    "least good": 1.9 * -0.74,
    "at least good": 1.9,
    "xx least good": 1.9 * -0.74,
    "no good": 1.9 * -0.74,
    "no": -1.2,
    "no xx or good": -1.2 + 1.9 * -0.74,
    "no xx yy good": -1.2 + 1.9,
    "good not bad": 1.9 + 2.5 * 0.74,
    "not good bad": 1.9 * -0.74 + -2.5 * -0.74,  # "not" is one before "good" and two before "bad"
    "very": 0.0,
    "it was kind of good": 1.9 - 0.293,
    "kind of good": 1.9,
    "kind friend": 2.4 + 2.2,
    "they cut the mustard": 2.0,
    "cut the mustard": 0.5,
    "good but bad": 1.9 * 0.5 - 2.5 * 1.5,
    "good a but I bad": 1.9 * 0.5 - 2.5 * 1.5,
    "": 0.0,
    "a b c": 0.0,
}


@pytest.mark.parametrize("form", ["row", "join", "large"])
def test_rules_by_hand(spark, monkeypatch, form):
    df = local_table(spark, {"id": list(range(len(RULE_CASES))), "text": list(RULE_CASES)})
    table = SE.starter_lexicon(spark, RULE_LEXICON)
    if form == "row":
        out = df.select("id", SE.lexicon_scorer(RULE_LEXICON)(F.col("text")).alias("compound"))
    elif form == "join":
        out = SE.score_texts(df, "id", "text", table)
    else:
        monkeypatch.setattr(SE, "MAX_DICTIONARY", 2)
        out = SE.with_scores(df, F.col("text"), table, "compound").select("id", "compound")
    got = {r["id"]: r["compound"] for r in out.collect()}
    for i, (text, total) in enumerate(RULE_CASES.items()):
        assert abs(got[i] - round(total / (total * total + 15) ** 0.5, 4)) < 1.1e-4, text


def test_enrich_takes_a_lexicon_of_any_size(spark, monkeypatch):
    raw = local_table(spark, RAW)
    small = enrich(raw, SE.lexicon_scorer(V.STARTER_LEXICON)).select("raw_id", "sentiment_score", "text").collect()
    monkeypatch.setattr(SE, "MAX_DICTIONARY", 2)
    large = enrich(raw, SE.starter_lexicon(spark)).select("raw_id", "sentiment_score", "text").collect()
    assert sorted(small) == sorted(large)


def test_lexicon_bound(spark, monkeypatch):
    monkeypatch.setattr(SE, "MAX_DICTIONARY", 2)
    with pytest.raises(ValueError):
        SE.lexicon_scorer(SE.starter_lexicon(spark))


def test_labels_of_scores(spark):
    df = local_table(spark, {"s": [-0.05, -0.0499, 0.0, 0.05, None]})
    got = [r[0] for r in df.select(SE.sentiment_label(F.col("s"))).collect()]
    assert got == ["negative", "neutral", "neutral", "positive", None]
