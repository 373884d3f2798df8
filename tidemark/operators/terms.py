"""Term lists of any size met with texts by an index on the first word of each term.

Words are `[a-z0-9]` runs of the lower-cased text; a term is a run of words. A word of a text meets the terms that
begin with it, and the words behind it decide in place. So the rows made are word hits, whatever the lengths of the
terms are, and a text never travels with its words: each row holds as many following words as the longest term.
The term table is broadcast or shuffled as the planner measures it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import staged


def plain_words(text: Column) -> Column:
    """All `[a-z0-9]` runs of a text in order."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda word: word != "")


def term_index(terms: DataFrame, term: str = "keyword") -> DataFrame:
    """The rows of a term table with `_first` and `_rest`. Null terms and terms without a word have no entry."""
    rows = staged(terms.where(F.col(term).isNotNull()), {"_words": plain_words(F.col(term))})
    return rows.where(F.size("_words") > 0).select(
        *terms.columns, F.col("_words")[0].alias("_first"), F.slice("_words", 2, F.size("_words")).alias("_rest")
    )


def term_hits(texts: DataFrame, terms: DataFrame, key: str, *, text: str = "text", term: str = "keyword") -> DataFrame:
    """One row per occurrence of a term: `key`, `position` (of its first word, from 0) and the columns of `terms`.

    Null texts and texts without words have no hits. A term listed twice gives its hits twice. `terms` may not have a
    column named as the key or `position`.
    """
    clash = {key, "position"} & set(terms.columns)
    if clash:
        raise ValueError(f"term table has columns {sorted(clash)}")
    index = term_index(terms, term)
    # a bound on the words that a row carries; one row
    longest = index.agg(F.coalesce(F.max(F.size("_rest")), F.lit(0))).first()[0]
    rows = staged(texts.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("_text")), {"_words": plain_words(F.col("_text"))})
    words = rows.select(key, "_words", F.posexplode("_words").alias("position", "_first"))
    if longest:
        words = words.withColumn("_next", F.slice("_words", F.col("position") + 2, longest))
        met = words.drop("_words").join(index, "_first")
        met = met.where((F.size("_rest") == 0) | (F.slice("_next", 1, F.size("_rest")) == F.col("_rest")))
    else:
        met = words.drop("_words").join(index, "_first")
    return met.select(key, "position", *terms.columns)


def term_documents(texts: DataFrame, terms: DataFrame, key: str, *, text: str = "text", term: str = "keyword") -> DataFrame:
    """Per row of `terms` that occurs: its columns and `documents`, the number of keys whose text has it.

    Rows of one key count once, null keys as one; rows of the term table that are equal are one term.
    """
    hits = term_hits(texts, terms.distinct(), key, text=text, term=term)
    once = hits.groupBy(key, *terms.columns).agg(F.lit(1).alias("_one"))  # pre-aggregated in the tasks
    return once.groupBy(*terms.columns).agg(F.count(F.lit(1)).alias("documents"))
