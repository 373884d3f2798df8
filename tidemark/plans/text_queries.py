"""Registered text queries: labels, keywords, sentiment and text expressions on whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import labels as L
from tidemark.functions import matching as MT
from tidemark.functions import sentiment as SE
from tidemark.functions import strings as S
from tidemark.functions.matching import HybridMatcher, WordMatcher
from tidemark.functions.numbers import engagement_total
from tidemark.functions.staging import staged
from tidemark.operators.enrich import enrich
from tidemark.operators.keywords import category_keywords
from tidemark.operators.terms import term_documents
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.views import TEXT, ctes
from tidemark.registry import taxonomy_dimension
from tidemark.session import spread

BASE = ctes(TEXT)


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(terms) -> str:
    return "[" + ", ".join(q(t) for t in terms) + "]"


def hybrid(terms, text: str = "lower(text)") -> str:
    """The hybrid rule in DuckDB: one regex for the plain words, substrings for the rest."""
    words = [t for t in terms if t.isalnum()]
    phrases = [t for t in terms if not t.isalnum()]
    parts = [f"contains({text}, {q(p)})" for p in phrases]
    if words:
        parts.append(f"regexp_matches({text}, '(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)')")
    return "(" + " or ".join(parts) + ")"


def hybrid_hits(terms, text: str = "lower(text)") -> str:
    items = ", ".join(f"case when {hybrid([t], text)} then {q(t)} end" for t in terms)
    return f"list_sort(list_filter([{items}], lambda x: x is not null))"


W = r"[^\pL\pM\pN_]"


def bounded(terms, text: str) -> str:
    """The word rule in DuckDB, white space in a term matches any white space."""
    alternatives = "|".join(t.replace("-", r"\-").replace(".", r"\.").replace(" ", r"\s+") for t in terms)
    return f"regexp_matches({text}, {q(f'(^|{W})({alternatives})({W}|$)')})"


def topic_case(text: str = "lower(text)") -> str:
    whens = " ".join(f"when {hybrid(terms, text)} then {q(t)}" for t, terms in V.TAXONOMY.items())
    return f"(case {whens} end)"


ALL_TERMS = L.all_terms(V.TAXONOMY)
CLEAN = (
    r"lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'http\S+', '', 'g'),"
    r" '#[\pL\pN\pM_]+', '', 'g'), '@[\pL\pN\pM_]+', '', 'g'), '<.*?>', '', 'g'), '\s+', ' ', 'g')))"
)
CLEANED = f", cleaned as (select *, {CLEAN} as clean from text_posts)"
ENGAGEMENT = "(like_count + reply_count + coalesce(repost_count, 0) + quote_count)"


def _contains_any(terms, text: str) -> str:
    return "(" + " or ".join(f"contains({text}, {q(t)})" for t in terms) + ")"


SCORE = f"""(case when {_contains_any(V.SCORING_COMPLAINT_TERMS, 'clean')} then 2 else 0 end
  + case when {_contains_any(V.PROMOTION_TERMS, 'clean')} then -3 else 0 end
  + case when length(clean) < 10 then -2 else 0 end
  + case when platform in ('bluesky', 'mastodon') and {ENGAGEMENT} = 0 then -1 else 0 end)"""


def _text(spark, d):
    return views.text_posts(spark, d)


def _matched(spark, d):
    return HybridMatcher.attach(_text(spark, d), F.col("text"))


# --------------------------------------------------------------------- labels
@query("n01_topic_classifier", BASE + f"select id, coalesce({topic_case()}, 'cost_of_living') as topic from text_posts")
def topic_classifier(spark, d):
    rows, m = _matched(spark, d)
    return rows.select("id", L.topic_of(m).alias("topic"))


@query("n02_matched_keywords", BASE + f"select id, array_to_string({hybrid_hits(ALL_TERMS)}, '|') as keywords from text_posts")
def matched_keywords(spark, d):
    rows, m = _matched(spark, d)
    return rows.select("id", F.array_join(L.keywords_of(m), "|").alias("keywords"))


@query(
    "n03_topic_with_source",
    BASE + f""", t as (select id, category, {topic_case()} as t from text_posts)
select id, coalesce(t, category, 'cost_of_living') as topic,
  case when t is not null then 'text_keywords' when category is not null then 'harvest_category_fallback' else 'default' end as topic_source
from t""",
)
def topic_with_source(spark, d):
    rows, m = _matched(spark, d)
    return rows.select("id", "category", L.topic_of(m).alias("t")).select(
        "id", F.inline(F.array(L.resolved_topic(F.col("t"), F.col("category"))))
    )


@query(
    "n04_topic_of_seed",
    BASE + f""", seeds as (select doc_id, case doc_id % 5 when 0 then ' Eating_Out ' when 1 then 'cost-of-living' when 2 then 'rent ' || lang
  when 3 then 'home goods' else text end as seed from text_posts)
select doc_id, case when trim(lower(replace(seed, '_', ' '))) in ('cost of living','cost-of-living','living costs','rising costs','rising prices') then null
  when trim(lower(replace(seed, '_', ' '))) in ({', '.join(q(t.replace('_', ' ')) for t in V.TAXONOMY)}) then replace(trim(lower(replace(seed, '_', ' '))), ' ', '_')
  else {topic_case('lower(seed)')} end as topic from seeds""",
)
def topic_of_seed(spark, d):
    """Topic names, generic phrases, short queries and whole texts as seeds."""
    seeds = _text(spark, d).selectExpr(
        "doc_id",
        "case doc_id % 5 when 0 then ' Eating_Out ' when 1 then 'cost-of-living' when 2 then concat('rent ', lang) "
        "when 3 then 'home goods' else text end as seed",
    )
    return seeds.select("doc_id", L.topic_of_seed(F.col("seed")).alias("topic"))


BLOCKED_CASE = " ".join(f"when {q(t)} then {hybrid(terms)}" for t, terms in V.BLOCKED_TERMS.items())
HINT_CASE = " ".join(f"when {q(t)} then {hybrid(terms)}" for t, terms in V.TAXONOMY.items())
RELEVANT = f""", h as (select *, {topic_case()} as t, case when category is not null and (case category {HINT_CASE} else false end) then category end as hinted from text_posts),
r as (select *, coalesce(hinted, t, 'cost_of_living') as topic, {hybrid(V.COVERAGE_TERMS)} or {hybrid(V.COMPLAINT_TERMS)} as cost,
  {hybrid(V.FOREIGN_TERMS)} as foreign_signal, {hybrid(V.LOCAL_CONTEXT_TERMS)} as local_signal, {hybrid(V.NOISE_TEXTS)} as noise,
  doc_id % 2 = 0 as trust from h),
relevant as (select *, trim(text) <> '' and not noise and not (case topic {BLOCKED_CASE} else false end) and not (foreign_signal and not local_signal)
  and case when topic in ({', '.join(q(t) for t in V.STRICT_TOPICS)}) then topic <> 'cost_of_living' and ((trust and topic = coalesce(category, '')) or cost)
    else topic <> 'cost_of_living' or cost end as relevant from r)"""


def _relevant(spark, d):
    return L.with_relevance(
        _text(spark, d), hint=F.col("category"), trust_hint=F.col("doc_id") % 2 == 0
    )


@query("n05_relevance", BASE + RELEVANT + " select id, relevant from relevant")
def relevance(spark, d):
    return _relevant(spark, d).select("id", "relevant")


@query("f11_relevant_rows", BASE + RELEVANT + " select id from relevant where relevant")
def relevant_rows(spark, d):
    return _relevant(spark, d).where("relevant").select("id")


@query("n06_local_context", BASE + f"select id, {hybrid(V.LOCAL_CONTEXT_TERMS)} as local from text_posts")
def local_context(spark, d):
    rows, m = _matched(spark, d)
    return rows.select("id", L.has_local_context(m).alias("local"))


@query(
    "f12_strict_social",
    BASE + RELEVANT.replace("category", "seed").replace("from text_posts)", "from (select *, case when doc_id % 4 = 0 then 'groceries' when doc_id % 4 = 1 then 'fuel' end as seed from text_posts))", 1)
    .replace("doc_id % 2 = 0 as trust", "seed is not null as trust")
    + " select id from relevant where platform = 'gdelt' or (local_signal and relevant)",
)
def strict_social(spark, d):
    from tidemark.operators.filters import keep_social

    rows = _text(spark, d).withColumn("seed", F.coalesce("category", F.lit("")))
    return keep_social(rows, seed="seed", strict=True).select("id")


@query(
    "f13_context_of_parts",
    BASE + f"select id, {bounded(V.SOCIAL_LOCAL_TERMS['mastodon'], 'lower(concat_ws(chr(32), text, source, url))')} as local from text_posts",
)
def context_of_parts(spark, d):
    return _text(spark, d).select(
        "id",
        L.mentions_place(F.col("text"), F.col("source"), F.col("url"), terms=V.SOCIAL_LOCAL_TERMS["mastodon"]).alias("local"),
    )


@query("n07_relevance_score", BASE + CLEANED + f" select id, {SCORE} as relevance_score from cleaned")
def relevance_score(spark, d):
    rows = staged(_text(spark, d), {"_clean": S.clean_markup(F.col("text"))})
    return rows.select(
        "id",
        L.relevance_score(
            F.col("_clean"), F.col("platform"),
            engagement_total(*[F.col(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")]),
        ).alias("relevance_score"),
    )


FLAGS = f"""list_filter([case when {SCORE} < 0 then 'low_relevance' end,
  case when platform = 'gdelt' and (length(text) - length(replace(text, ';', '')) >= 6 or contains(lower(text), 'tax_') or contains(lower(text), 'wb_')) then 'metadata_heavy' end,
  case when platform = 'gdelt' and url = '' then 'missing_url' end,
  case when length(clean) < 30 then 'short_text' end,
  case when platform = 'gdelt' and url <> '' and not {hybrid(V.LOCAL_CONTEXT_TERMS)} then 'weak_australia_context' end,
  case when platform <> 'gdelt' and {ENGAGEMENT} = 0 then 'zero_engagement' end], lambda x: x is not null)"""


@query("n10_quality_flags", BASE + CLEANED + f" select id, array_to_string({FLAGS}, '|') as flags from cleaned")
def quality_flags(spark, d):
    engagement = engagement_total(*[F.col(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")])
    rows = staged(_text(spark, d), {"_clean": S.clean_markup(F.col("text")), "_e": engagement})
    rows = rows.withColumn("_score", L.relevance_score(F.col("_clean"), F.col("platform"), F.col("_e")))
    rows, m = HybridMatcher.attach(rows, F.col("text"))
    return rows.select(
        "id",
        F.array_join(
            L.quality_flags(F.col("text"), F.col("_clean"), F.col("platform"), F.col("url"), F.col("_e"), F.col("_score"), L.has_local_context(m)), "|"
        ).alias("flags"),
    )


@query(
    "n14_canonical_id",
    BASE + """select id, concat('canonical-', sha1(concat(platform, '|', case when platform = 'gdelt' and url <> '' then url else source_id end))) as canonical_id
  from text_posts""",
)
def canonical_id(spark, d):
    empty = F.lit("")
    return _text(spark, d).select(
        "id",
        S.canonical_id(F.upper("platform"), url=F.col("url"), archive_url=empty, source_id=F.col("source_id"),
                       source_es_id=empty, raw_id=F.col("id")).alias("canonical_id"),
    )


# ------------------------------------------------------------------ sentiment
PUNCT = r"""[!-/:-@\[-`{-~]"""
LEX = ", ".join(f"({q(t)}, {v})" for t, v in V.STARTER_LEXICON.items())
NEG = ", ".join(q(t) for t in V.NEGATIONS)
UP = ", ".join(q(t) for t in V.BOOSTERS_UP)
DOWN = ", ".join(q(t) for t in V.BOOSTERS_DOWN)
DAMPING = ", ".join(q(t) for t in V.DAMPING_PHRASES)
# Words around an entry: w0 is itself, w1 to w3 come before, n1 and n2 after; k1 to k3: there is such a word, no entry
AROUND = ", ".join(
    [f"case when i > {n} then coalesce(w[i - {n}], '') else '' end as w{n}, i > {n} and not list_contains(known, w[i - {n}]) as k{n}" for n in (1, 2, 3)]
    + [f"coalesce(w[i + {n}], '') as n{n}" for n in (1, 2)]
)


def _idiom(phrase: str) -> str:
    return "case " + " ".join(f"when {phrase} = {q(idiom)} then {value!r}" for idiom, value in V.IDIOMS.items()) + " end"


def _negates(word: str) -> str:
    return f"({word} in ({NEG}) or contains({word}, 'n''t'))"


def _raised(v: str, word: str, damping: float) -> str:
    step = f"case when {word} in ({UP}) then {0.293 * damping!r} when {word} in ({DOWN}) then -({0.293 * damping!r}) else 0 end"
    return f"({v} + case when {v} < 0 then -({step}) else {step} end)"


# The rule layer step by step, from the nearest predecessor to the third
RULES = f""", around as (select id, text, w, i, token as w0, v, list_contains(known, coalesce(w[i + 1], '')) as next_known, {AROUND}
  from val, (select list(token) as known from lex) where v <> 0),
r0 as (select *, case when w1 = 'no' or w2 = 'no' or (w3 = 'no' and w1 in ('or', 'nor')) then v * -0.74
  when w0 = 'no' and next_known then 0 else v end as x0 from around),
r1 as (select *, case when k1 then {_raised("x0", "w1", 1.0)} * case when {_negates("w1")} then -0.74 else 1 end else x0 end as x1 from r0),
r2 as (select *, case when k2 then {_raised("x1", "w2", 0.95)} * case when w2 = 'never' and w1 in ('so', 'this') then 1.5
  when w2 = 'without' and w1 = 'doubt' then 1 when {_negates("w2")} then -0.74 else 1 end else x1 end as x2 from r1),
r3 as (select *, case when k3 then {_raised("x2", "w3", 0.9)} * case when (w3 = 'never' and w2 in ('so', 'this')) or w1 in ('so', 'this') then 1.25
  when w3 = 'without' and (w2 = 'doubt' or w1 = 'doubt') then 1 when {_negates("w3")} then -0.74 else 1 end else x2 end as x3 from r2),
r4 as (select *, case when k3 then coalesce({_idiom("w0 || ' ' || n1 || ' ' || n2")}, {_idiom("w0 || ' ' || n1")}, {_idiom("w1 || ' ' || w0")},
  {_idiom("w2 || ' ' || w1 || ' ' || w0")}, {_idiom("w2 || ' ' || w1")}, {_idiom("w3 || ' ' || w2 || ' ' || w1")}, {_idiom("w3 || ' ' || w2")}, x3)
  - case when w3 || ' ' || w2 in ({DAMPING}) or w2 || ' ' || w1 in ({DAMPING}) then 0.293 else 0 end else x3 end as x4 from r3),
r5 as (select id, text, w, i, case when w0 in ({UP}, {DOWN}) or (w0 = 'kind' and n1 = 'of') then 0
  when k1 and w1 = 'least' and w2 not in ('at', 'very') then x4 * -0.74 else x4 end as x from r4),
ruled as (select id, x * (case when coalesce(list_position(w, 'but'), 0) = 0 then 1.0 when i < list_position(w, 'but') then 0.5
  when i > list_position(w, 'but') then 1.5 else 1.0 end) as x from r5),
s0 as (select p.id, coalesce(sum(cast(round_even(x * 1e9, 0) as bigint)), 0) / 1e9 as s, any_value(p.text) as text
  from text_posts p left join ruled r on r.id = p.id group by 1)"""


def _sentiment_sql(rules: bool) -> str:
    base = f""", words as (select id, text, list_filter(list_transform(regexp_split_to_array(lower(text), '\\s+'),
    lambda t: regexp_replace(regexp_replace(t, '^{PUNCT.replace("'", "''")}+', ''), '{PUNCT.replace("'", "''")}+$', '')), lambda t: length(t) > 1) as w from text_posts),
tok as (select id, text, w, unnest(w) as token, generate_subscripts(w, 1) as i from words),
lex as (select * from (values {LEX}) as l(token, valence)),
val as (select id, text, w, i, token, coalesce(cast(valence as double), 0) as v from tok left join lex using (token))"""
    if not rules:
        body = """, s1 as (select id, sum(cast(round_even(v * 1e9, 0) as bigint)) / 1e9 as s from val group by 1),
s as (select p.id, coalesce(s1.s, 0) as s from text_posts p left join s1 on s1.id = p.id)"""
    else:
        body = RULES + """,
e as (select id, s, length(text) - length(replace(text, '!', '')) as b, length(text) - length(replace(text, '?', '')) as q from s0),
s as (select id, case when s > 0 then s + emph when s < 0 then s - emph else s end as s from
  (select id, s, least(b, 4) * 0.292 + case when q <= 1 then 0 when q <= 3 then q * 0.18 else 0.96 end as emph from e))"""
    return BASE + base + body


COMPOUND = "(round_even(s / sqrt(s * s + 15.0) * 1e4, 0) / 1e4)"


@query("n08_sentiment_core", _sentiment_sql(False) + f" select id, {COMPOUND} as compound from s")
def sentiment_core(spark, d):
    return SE.score_texts(_text(spark, d), "id", "text", SE.starter_lexicon(spark), rules=False)


@query("n08_sentiment_rules", _sentiment_sql(True) + f" select id, {COMPOUND} as compound from s")
def sentiment_rules(spark, d):
    return SE.score_texts(_text(spark, d), "id", "text", SE.starter_lexicon(spark))


@query(
    "n09_sentiment_label",
    _sentiment_sql(True) + f" select case when {COMPOUND} <= -0.05 then 'negative' when {COMPOUND} >= 0.05 then 'positive' else 'neutral' end as label, count(*) as n from s group by 1",
)
def sentiment_label(spark, d):
    scored = SE.score_texts(_text(spark, d), "id", "text", SE.starter_lexicon(spark))
    return scored.groupBy(SE.sentiment_label(F.col("compound")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ news rows
LOWER = ", low as (select id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) as t from text_posts)"


def _bounded_hits(terms) -> str:
    return "list_filter([" + ", ".join(f"case when {bounded([t], 't')} then {q(t)} end" for t in terms) + "], lambda x: x is not null)"


def _news_sql() -> str:
    entries = []
    for category, terms in V.NEWS_CATEGORY_TERMS.items():
        blocked = V.BLOCKED_TERMS.get(category)
        stop = f" and not {bounded(blocked, 't')}" if blocked else ""
        entries.append(
            f"select id, t, {q(category)} as category, list_sort(list_distinct(list_concat(list_concat({_bounded_hits(terms)}, cost), local))) as hits"
            f" from gated where {bounded(terms, 't')}{stop}"
        )
    return (
        BASE + LOWER + f", hit as (select *, {_bounded_hits(V.NEWS_LOCAL_TERMS)} as local, {_bounded_hits(V.NEWS_COST_TERMS)} as cost from low),\n"
        "gated as (select * from hit where len(local) > 0 and len(cost) > 0),\nmatched as (" + "\nunion all ".join(entries) + ")"
    )


NEWS = _news_sql()


def _news_rows(spark, d):
    rows = staged(_text(spark, d).select("id", "text"), {"_low": F.lower(S.squeeze(F.col("text")))}).drop("text")
    rows, matcher = WordMatcher.attach(rows, F.col("_low"))
    return rows.select("*", F.inline(L.news_categories(matcher))), matcher


@query("n11_news_categories", NEWS + " select id, category, array_to_string(hits, '|') as hits from matched")
def news_categories(spark, d):
    rows, _ = _news_rows(spark, d)
    return rows.select("id", "category", F.array_join("hits", "|").alias("hits"))


def _phrase_sql() -> str:
    whens = []
    for category, phrases in V.NEWS_SEARCH_PHRASES.items():
        for phrase in phrases:
            words = " and ".join(bounded([w], "t") for w in phrase.split())
            whens.append(f"when category = {q(category)} and {words} then {q(phrase)}")
        whens.append(f"when category = {q(category)} then {q(phrases[0])}")
    return "case " + " ".join(whens) + " else category end"


@query("n12_best_search_phrase", NEWS + f" select id, category, {_phrase_sql()} as search_term from matched")
def best_search_phrase(spark, d):
    rows, matcher = _news_rows(spark, d)
    return rows.select("id", "category", L.best_phrase(matcher, F.col("category")).alias("search_term"))


@query(
    "j11_phrase_containment",
    BASE + LOWER + f", c as (select id, t, c.category from low, (values {', '.join(f'({q(c)})' for c in V.NEWS_SEARCH_PHRASES)}) as c(category))"
    + f" select category, search_term, count(*) as n from (select category, {_phrase_sql()} as search_term from c) group by 1, 2",
)
def phrase_containment(spark, d):
    """Text x search phrases: the first phrase of each category whose words all occur."""
    rows = staged(_text(spark, d).select("text"), {"_low": F.lower(S.squeeze(F.col("text")))}).drop("text")
    rows, m = WordMatcher.attach(rows, F.col("_low"))
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("category"), L.best_phrase(m, F.lit(c), {c: V.NEWS_SEARCH_PHRASES[c]}).alias("search_term"))
            for c in V.NEWS_SEARCH_PHRASES
        ]
    )
    return rows.select(F.inline(pairs)).groupBy("category", "search_term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j12_term_join",
    BASE + f""", k as (select * from (values {', '.join(f'({q(t)}, {q(k)})' for t, ks in V.TAXONOMY.items() for k in ks if k.isalnum())}) as k(topic, keyword)),
tok as (select distinct id, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) as keyword from text_posts)
select topic, keyword, count(*) as documents from tok join k using (keyword) group by 1, 2""",
)
def term_join(spark, d):
    """Table form of the term match for large lists: tokens joined to the term table."""
    terms = taxonomy_dimension(spark).where(F.col("keyword").rlike("^[a-z0-9]+$"))
    tokens = _text(spark, d).select(F.explode(MT.plain_tokens(F.lower("text"))).alias("keyword"))
    return tokens.join(terms, "keyword").groupBy("topic", "keyword").agg(F.count(F.lit(1)).alias("documents"))


TERM_PAIRS = ", ".join(f"({q(t)}, {q(k)})" for t, ks in V.TAXONOMY.items() for k in ks)


@query(
    "j12_term_join_phrases",
    BASE + f""", k as (select topic, keyword, ' ' || trim(regexp_replace(lower(keyword), '[^a-z0-9]+', ' ', 'g')) || ' ' as gram from (values {TERM_PAIRS}) as k(topic, keyword)),
tok as (select id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' as words from text_posts)
select topic, keyword, count(*) as documents from tok join k on contains(words, gram) group by 1, 2""",
)
def term_join_phrases(spark, d):
    """The term join with phrases and hyphenated terms: words of texts meet the terms that begin with them."""
    return term_documents(_text(spark, d), taxonomy_dimension(spark).select("topic", "keyword"), "id")


# ------------------------------------------------------------------- keywords
FIXTURE_TOPIC = "case lang when 'en' then 'housing' when 'fr' then 'fuel' when 'de' then 'healthcare' else 'inflation' end"


def _keyword_sql(topics: dict[str, tuple[str, ...]], limit: int, text: str = "lower(text)") -> str:
    parts = []
    for topic, terms in topics.items():
        for rank, term in enumerate(terms):
            if " " in term:
                n = f"(length(t) - length(replace(t, {q(term)}, ''))) // length({q(term)})"
            elif term.isalnum():
                n = f"len(list_filter(w, lambda x: x = {q(term)}))"
            else:
                n = f"len(regexp_extract_all(concat(' ', replace(t, {q(term)}, {q(term + ' ')}), ' '), {q(W + term + W)}))"
            parts.append(f"select {q(topic)} as topic, {q(term)} as keyword, {rank} as r, sum({n}) as n from tx where topic = {q(topic)}")
    stop = sql_list(V.STOPWORDS)
    return f""", tx as (select {FIXTURE_TOPIC} as topic, {text} as t, string_split_regex({text}, '{W}+') as w from text_posts),
found as (select * from ({' union all '.join(parts)}) where n > 0),
plain as (select topic, token as keyword, 0 as r, count(*) as n from (select topic, unnest(list_filter(w, lambda x: regexp_full_match(x, '[a-z]{{3,}}') and not list_contains({stop}, x))) as token
  from tx where topic in ({', '.join(q(t) for t in topics)}) and topic not in (select topic from found)) group by 1, 2),
ranked as (select topic as cost_category, keyword, cast(n as bigint) as frequency, row_number() over (partition by topic order by n desc, r, keyword) as rank
  from (select * from found union all select topic, keyword, r, n from plain))
select *, case cost_category {' '.join(f"when {q(t)} then {q(V.TOPIC_LABELS[t])}" for t in topics)} end as category_label from ranked where rank <= {limit}"""


KEYWORD_TOPICS = {t: V.TAXONOMY[t] for t in ("housing", "fuel", "inflation")} | {"healthcare": ("nosuchterm", "no such phrase")}


@query("a15_category_keywords", BASE + _keyword_sql(KEYWORD_TOPICS, 20))
def keywords(spark, d):
    """Frequencies over all rows; `healthcare` has no listed term here and falls back to plain tokens."""
    rows = _text(spark, d).withColumn("topic", F.expr(FIXTURE_TOPIC))
    return category_keywords(rows, taxonomy=KEYWORD_TOPICS, processed_only=False)


@query("w04_top_keywords", BASE + _keyword_sql({"housing": V.TAXONOMY["housing"]}, 3))
def top_keywords(spark, d):
    rows = _text(spark, d).withColumn("topic", F.expr(FIXTURE_TOPIC))
    return category_keywords(rows, category="housing", limit=3, processed_only=False)


# ----------------------------------------------------------------- enrichment
ENRICHED = BASE + CLEANED + f""", c2 as (select *, {topic_case('clean')} as t, {SCORE} as score, {FLAGS} as flags, {hybrid_hits(ALL_TERMS, 'clean')} as kw from cleaned)"""
ENRICH_OUT = """ select id as raw_id, platform, clean as text, coalesce(t, category, 'cost_of_living') as topic,
  case when t is not null then 'text_keywords' when category is not null then 'harvest_category_fallback' else 'default' end as topic_source,
  array_to_string(kw, '|') as keywords, score as relevance_score, array_to_string(flags, '|') as flags,
  case when score < -2 then 'discarded' else 'processed' end as processing_status,
  case platform when 'gdelt' then 'media' else 'social' end as source_group from c2"""


def _enriched(spark, d):
    return enrich(_text(spark, d), SE.lexicon_scorer(V.STARTER_LEXICON), processed_at=views.as_of())


@query("p03_processed_rows", ENRICHED + ENRICH_OUT)
def processed_rows(spark, d):
    return _enriched(spark, d).select(
        "raw_id", "platform", "text", "topic", "topic_source", F.array_join("matched_keywords", "|").alias("keywords"),
        "relevance_score", F.array_join("quality_flags", "|").alias("flags"), "processing_status", "source_group",
    )


@query(
    "p04_outcome_routing",
    ENRICHED + " select case when score < -2 then 'discarded' else 'processed' end as processing_status, count(*) as n from c2 group by 1",
)
def outcome_routing(spark, d):
    return _enriched(spark, d).groupBy("processing_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p14_engagement_sum",
    BASE + f"select id, {ENGAGEMENT} as engagement from text_posts",
)
def engagement_sum(spark, d):
    return _text(spark, d).select(
        "id", engagement_total(*[F.col(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")]).alias("engagement")
    )


# --------------------------------------------------------------- HTML to text
ENTITIES = "replace(replace(replace(replace(replace(t, '&copy;', '©'), '&quot;', '\"'), '&middot;', '·'), '&#39;', ''''), '&amp;', '&')"


@query(
    "p07_html_to_text",
    f"""with s as (select page_id, regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g') as t from pages)
select page_id, trim(regexp_replace({ENTITIES}, '\\s+', ' ', 'g')) as text from s""",
)
def html_to_text(spark, d):
    pages = spread(views.table(spark, d, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", S.html_to_text(F.col("html")).alias("text"))


@query(
    "x02_replaceable_scorer",
    ENRICHED + " select id as raw_id, case when score < -2 then null when length(clean) % 2 = 0 then cast(0.5 as double) else cast(-0.5 as double) end as sentiment_score from c2",
)
def replaceable_scorer(spark, d):
    """Any text column -> score column function can take the lexicon's place."""

    def by_length(text):
        return F.when(F.length(text) % 2 == 0, 0.5).otherwise(-0.5)

    return enrich(_text(spark, d), by_length, processed_at=views.as_of()).select("raw_id", "sentiment_score")


@query("n08_sentiment_in_row", _sentiment_sql(True) + f" select id, {COMPOUND} as compound from s")
def sentiment_in_row(spark, d):
    score = SE.lexicon_scorer(V.STARTER_LEXICON)
    return _text(spark, d).select("id", score(F.col("text")).alias("compound"))
