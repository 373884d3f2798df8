"""Lexicon sentiment with the published rule layer, evaluated on the JVM.

A text becomes its list of words and a list of their valences (null for words that are no entry). `rule_total` walks the
entries only; each looks at its three predecessors:

* from the nearest to the farthest, a predecessor that is no entry itself adds its degree (damped by distance) and, if
  it negates, multiplies by the negation factor, so that two negations cancel;
* "never so" and "never this" raise instead, "without doubt" changes nothing;
* "no" before an entry negates it, and "no" before another entry has no valence of its own;
* "least" negates unless it is "at least" or "very least"; idioms replace the valence; "kind of" lowers it;
* "but" halves what comes before and raises what comes after; `!` and `?` add emphasis.

As in the public implementation, idioms and damping phrases are looked up where the third predecessor exists and is no
entry, and there "so" or "this" right before the word raises it by itself. Texts are lower-cased before, so the
capital-letter rule cannot apply. Words of one character are dropped.

The valences come from `lexicon_scorer` (a literal table in the expression: nothing is joined or shuffled) or, for
lexicons of any size, from the join in `score_texts`; `with_scores` picks by the measured size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions.staging import staged
from tidemark.registry import dimension

Scorer = Callable[[Column], Column]
MAX_DICTIONARY = 200_000  # entries an expression may hold


def starter_lexicon(spark: SparkSession, entries: Mapping[str, float] | None = None) -> DataFrame:
    entries = entries or V.STARTER_LEXICON
    return dimension(spark, {"token": list(entries), "valence": [float(v) for v in entries.values()]})


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated `token, mean valence, ...` file."""
    return (
        spark.read.schema("token string, valence double")
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
        .where(F.col("token").isNotNull() & F.col("valence").isNotNull())
    )


_EDGE = r"[!-/:-@\[-`{-~]*"  # ASCII punctuation


def sentiment_tokens(text: Column) -> Column:
    """White-space tokens without surrounding punctuation; those of fewer than two characters dropped.

    Punctuation next to white space is consumed by the separator, so one pass does both.
    """
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.filter(F.split(padded, rf"(?U){_EDGE}\s+{_EDGE}"), lambda token: F.length(token) > 1)


def normalise(total: Column, alpha: float = V.SENTIMENT_ALPHA) -> Column:
    """total / sqrt(total^2 + alpha), four decimals."""
    score = total / F.sqrt(total * total + F.lit(alpha))
    return F.rint(score * 10_000) / 10_000


def sentiment_label(score: Column, cut: float = V.LABEL_CUT) -> Column:
    return (
        F.when(score <= -cut, F.lit("negative"))
        .when(score >= cut, F.lit("positive"))
        .when(score.isNotNull(), F.lit("neutral"))
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside one expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _emphasis(text: Column) -> Column:
    bangs = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    asks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    by_bang = F.least(bangs, F.lit(V.EXCLAMATION_LIMIT)) * V.EXCLAMATION_STEP
    by_ask = (
        F.when(asks <= 1, F.lit(0.0))
        .when(asks <= V.QUESTION_LIMIT, asks * V.QUESTION_STEP)
        .otherwise(F.lit(V.QUESTION_MAX))
    )
    return by_bang + by_ask


def described_words(tokens: Column, valence: Callable[[Column], Column]) -> Column:
    """What the rules ask of each word: itself `w`, its valence `v` (null: no entry), its degree `d`, if it negates `n`."""
    def one(word: Column) -> Column:
        degree = F.when(word.isin(*V.BOOSTERS_UP), F.lit(V.BOOST)).when(word.isin(*V.BOOSTERS_DOWN), F.lit(-V.BOOST)).otherwise(F.lit(0.0))
        negates = word.isin(*V.NEGATIONS) | word.contains("n't")
        return F.struct(word.alias("w"), valence(word).alias("v"), degree.alias("d"), negates.alias("n"))

    return F.transform(tokens, one)


def _first_idiom(phrases: list[Column]) -> Column:
    """Valence of the first phrase that is an idiom, else null."""
    table = F.create_map(*[F.lit(x) for entry in V.IDIOMS.items() for x in entry])
    return F.coalesce(*[F.element_at(table, phrase) for phrase in phrases])


def _entry_value(near: Column) -> Column:
    """Valence of an entry after all rules but contrast and emphasis; `near` is made by `rule_total`."""
    word = {n: near[f"w{n}"] for n in range(4)} | {-n: near[f"f{n}"] for n in (1, 2)}
    plain = {n: near[f"plain{n}"] for n in (1, 2, 3)}
    negates = {n: near[f"negates{n}"] for n in (1, 2, 3)}
    intense = {n: word[n].isin(*V.INTENSE_AFTER_NEVER) for n in (1, 2)}
    phrase = {places: F.concat_ws(" ", *[word[n] for n in places])
              for places in ((1, 0), (2, 1, 0), (2, 1), (3, 2, 1), (3, 2), (0, -1, -2), (0, -1))}

    def raised(v: Column, n: int) -> Column:
        return v + F.when(v < 0, -near[f"degree{n}"]).otherwise(near[f"degree{n}"])

    def nearest(v: Column) -> Column:
        factor = F.when(negates[1], F.lit(V.NEGATION_FACTOR)).otherwise(F.lit(1.0))
        return F.when(plain[1], raised(v, 1) * factor).otherwise(v)

    def second(v: Column) -> Column:
        factor = F.when((word[2] == "never") & intense[1], F.lit(V.NEVER_SO_NEAR)).when(
            negates[2] & (phrase[2, 1] != "without doubt"), F.lit(V.NEGATION_FACTOR)).otherwise(F.lit(1.0))
        return F.when(plain[2], raised(v, 2) * factor).otherwise(v)

    def third(v: Column) -> Column:
        doubtless = (word[3] == "without") & ((word[2] == "doubt") | (word[1] == "doubt"))
        factor = F.when(((word[3] == "never") & intense[2]) | intense[1], F.lit(V.NEVER_SO_FAR)).when(
            negates[3] & ~doubtless, F.lit(V.NEGATION_FACTOR)).otherwise(F.lit(1.0))
        idiom = _first_idiom([phrase[p] for p in ((0, -1, -2), (0, -1), (1, 0), (2, 1, 0), (2, 1), (3, 2, 1), (3, 2))])
        damped = phrase[3, 2].isin(*V.DAMPING_PHRASES) | phrase[2, 1].isin(*V.DAMPING_PHRASES)
        less = F.when(damped, F.lit(V.BOOST)).otherwise(F.lit(0.0))
        return F.when(plain[3], F.coalesce(idiom, raised(v, 3) * factor) - less).otherwise(v)

    def least(v: Column) -> Column:
        negated = plain[1] & (word[1] == "least") & ~word[2].isin(*V.LEAST_EXEMPT)
        return F.when(negated, v * V.NEGATION_FACTOR).otherwise(v)

    own = near["v"]
    no_before = (word[1] == "no") | (word[2] == "no") | ((word[3] == "no") & word[1].isin(*V.ALTERNATIVES))
    start = F.when(no_before, own * V.NEGATION_FACTOR).when((word[0] == "no") & near["next_is_entry"], F.lit(0.0)).otherwise(own)
    silent = near["silent"] | (phrase[0, -1] == "kind of")
    return F.when(silent, F.lit(0.0)).otherwise(_let(_let(_let(_let(start, nearest), second), third), least))


def rule_total(words: Column) -> Column:
    """Sum over the entries of a text's described words after all rules but emphasis, in whole units of 1e-9."""
    none = F.lit("")

    def around(word: Column, i: Column) -> Column:
        """An entry with the words before it (`w1`, ...) and behind it (`f1`, ...); `plain`: there is one, and it is no entry."""
        before = {n: F.get(words, F.when(i >= n, i - n)) for n in (1, 2, 3)}
        fields = [i.alias("i"), word["v"].alias("v"), word["w"].alias("w0"), (word["d"] != 0).alias("silent")]
        for n, other in before.items():
            fields += [
                F.coalesce(other["w"], none).alias(f"w{n}"), (other["w"].isNotNull() & other["v"].isNull()).alias(f"plain{n}"),
                (other["d"] * V.BOOSTER_DAMPING[n - 1]).alias(f"degree{n}"), other["n"].alias(f"negates{n}"),
            ]
        fields += [F.coalesce(F.get(words, i + n)["w"], none).alias(f"f{n}") for n in (1, 2)]
        return F.struct(*fields, F.get(words, i + 1)["v"].isNotNull().alias("next_is_entry"))

    def weighed(near: Column, but: Column) -> Column:
        i = near["i"]
        side = F.when(but < 0, F.lit(1.0)).when(i < but, F.lit(V.BUT_BEFORE)).when(i > but, F.lit(V.BUT_AFTER)).otherwise(F.lit(1.0))
        return F.rint(_entry_value(near) * side * 1e9).cast("bigint")

    entries = F.filter(F.transform(words, lambda word, i: F.when(word["v"].isNotNull(), around(word, i))), lambda near: near.isNotNull())
    but = F.array_position(F.transform(words, lambda word: word["w"]), "but") - 1
    total = _let(but, lambda at: F.aggregate(entries, F.lit(0).cast("bigint"), lambda sum_, near: sum_ + weighed(near, at)))
    return total / F.lit(1e9)


def _compound(total: Column, text: Column) -> Column:
    """Both the total and its raised form are used several times: each is evaluated once, as the total walks all words."""
    lift = _emphasis(F.coalesce(text, F.lit("")))
    raised = _let(total, lambda sum_: F.when(sum_ > 0, sum_ + lift).when(sum_ < 0, sum_ - lift).otherwise(sum_))
    return _let(raised, lambda sum_: normalise(sum_))


def score_texts(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    *,
    rules: bool = True,
) -> DataFrame:
    """(key, compound) for every row of `df`, by a join with the lexicon; `key` must be unique. Texts without a hit score 0.

    Each word of a text is joined once; with rules, the hits of a text come back to it as (word, valence).
    """
    source = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    words = staged(source, {"_w": sentiment_tokens(F.col("_text"))})
    if not rules:
        # one row per token; a text without tokens keeps one row so that it is scored 0
        rows = words.select("_key", F.explode_outer("_w").alias("token"))
        valued = rows.join(lexicon.select("token", "valence"), "token", "left")
        units = F.rint(F.coalesce(F.col("valence"), F.lit(0.0)) * 1e9).cast("bigint")
        totals = valued.groupBy("_key").agg(F.sum(units).alias("_u"))
        return totals.select(F.col("_key").alias(key), normalise(F.coalesce("_u", F.lit(0)) / F.lit(1e9)).alias("compound"))
    distinct = words.select("_key", F.explode(F.array_distinct("_w")).alias("token"))
    hits = distinct.join(lexicon.select("token", F.col("valence").cast("double").alias("valence")).where("valence <> 0"), "token")
    found = hits.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("token", "valence"))).alias("_hits"))
    valence = lambda word: F.when(F.col("_hits").isNotNull(), F.element_at("_hits", word))
    valued = staged(words.join(found, "_key", "left"), {"_d": described_words(F.col("_w"), valence)})
    return valued.select(F.col("_key").alias(key), _compound(rule_total(F.col("_d")), F.col("_text")).alias("compound"))


def _valence(entries: Mapping[str, float]) -> Callable[[Column], Column]:
    """Valence of a word, null if it is no entry: one hashed test for all entries, then one per distinct valence."""
    by_value: dict[float, list[str]] = {}
    for token, value in sorted(entries.items()):
        if value:
            by_value.setdefault(float(value), []).append(token)
    known = [token for tokens in by_value.values() for token in tokens]

    def of(word: Column) -> Column:
        chain = F.when(F.lit(False), F.lit(0.0))
        for value, tokens in by_value.items():
            chain = chain.when(word.isin(*tokens), F.lit(value))
        return F.when(word.isin(*known), chain) if known else chain

    return of


def _small_entries(lexicon: DataFrame) -> dict[str, float] | None:
    """The lexicon's entries, or None if there are more than `MAX_DICTIONARY`."""
    rows = lexicon.select("token", "valence").limit(MAX_DICTIONARY + 1).collect()
    return None if len(rows) > MAX_DICTIONARY else {row["token"]: row["valence"] for row in rows}


def lexicon_scorer(lexicon: DataFrame | Mapping[str, float]) -> Scorer:
    """Scorer for `enrich`: text column -> compound score column, wholly on the JVM.

    A lexicon table is read to the driver only up to `MAX_DICTIONARY` entries; `with_scores`, or `enrich` given the
    table itself, takes any size.
    """
    if isinstance(lexicon, DataFrame):
        lexicon = _small_entries(lexicon)
        if lexicon is None:
            raise ValueError(f"lexicon has more than {MAX_DICTIONARY} entries; use with_scores")
    valence = _valence(lexicon)

    def score(text: Column) -> Column:
        return _compound(_let(described_words(sentiment_tokens(text), valence), rule_total), text)

    return score


def with_scores(df: DataFrame, text: Column, lexicon: DataFrame, name: str) -> DataFrame:
    """Add the compound score of a text under a lexicon of any size.

    Up to `MAX_DICTIONARY` entries it is a row-wise expression. Beyond, each distinct text is scored by the join and
    found again by its digest.
    """
    entries = _small_entries(lexicon)
    if entries is not None:
        return df.withColumn(name, lexicon_scorer(entries)(text))
    keyed = df.withColumns({"_scored": text, "_text_key": F.md5(F.coalesce(text, F.lit("")).cast("binary"))})
    texts = keyed.groupBy("_text_key").agg(F.first("_scored", ignorenulls=True).alias("_scored"))
    scores = score_texts(texts, "_text_key", "_scored", lexicon).withColumnRenamed("compound", name)
    return keyed.join(scores, "_text_key").drop("_text_key", "_scored")
