"""Term matching. Three rules exist and are kept apart:

* `HybridMatcher`: terms made of letters and digits must stand alone between characters other than
  `[a-z0-9]`; every other term (blank, hyphen, apostrophe inside) matches as a plain substring.
* `WordMatcher`: a term must stand between non-word characters (Unicode letters, digits and `_` are
  word characters); blanks in a term match any white space.
* `contains_term`: plain substring.

Single-word terms are looked up among the distinct tokens of a text: one split plus hash lookups per
text, not one regex per term. Substring terms are grouped under a part they share ("price" for all
price phrases), so most texts are searched for a few parts instead of every phrase. All lists become
literal arrays, which keeps plans and generated code small however long the lists are.

Matchers should sit on staged columns (`attach`); `over` is for short strings.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import staged


def _literals(terms: Iterable[str]) -> Column:
    terms = list(terms)
    return F.array(*[F.lit(t) for t in terms]) if terms else F.expr("cast(array() as array<string>)")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def overlaps(array: Column, terms: Iterable[str]) -> Column:
    terms = list(terms)
    return F.coalesce(F.arrays_overlap(array, _literals(terms)), F.lit(False)) if terms else F.lit(False)


def plain_tokens(lowered: Column) -> Column:
    """Distinct `[a-z0-9]` runs."""
    return F.array_distinct(F.split(lowered, "[^a-z0-9]+"))


def word_tokens(lowered: Column) -> Column:
    """Distinct Unicode word runs."""
    return F.array_distinct(F.split(lowered, r"(?U)\W+"))


def _by_shared_part(terms: list[str]) -> list[tuple[str, list[str]]]:
    """Group terms under the word that most of the remaining ones contain. Every term contains its part,
    so a text without the part holds none of its terms."""
    left, groups = list(terms), []
    while left:
        words = {w for t in left for w in re.findall(r"\w{4,}", t)}
        counts = [(sum(w in t for t in left), len(w), w) for w in words]
        size, _, part = max(counts, default=(0, 0, ""))
        if size <= 1:
            return groups + [(t, [t]) for t in left]
        groups.append((part, [t for t in left if part in t]))
        left = [t for t in left if part not in t]
    return groups


def _grouped(terms: list[str]) -> Column:
    """array<struct(part, terms)>"""
    return F.array(
        *[F.struct(F.lit(p).alias("part"), _literals(ts).alias("terms")) for p, ts in _by_shared_part(terms)]
    )


def _any_substring(text: Column, terms: list[str]) -> Column:
    def group_found(group: Column) -> Column:
        return F.contains(text, group["part"]) & F.exists(group["terms"], lambda t: F.contains(text, t))

    return F.exists(_grouped(terms), group_found)


def _substrings_found(text: Column, terms: list[str]) -> Column:
    candidates = F.filter(_grouped(terms), lambda group: F.contains(text, group["part"]))
    return F.flatten(
        F.transform(candidates, lambda group: F.filter(group["terms"], lambda t: F.contains(text, t)))
    )


class _Matcher:
    tokenise: Callable[[Column], Column]

    def __init__(self, lowered: Column, tokens: Column):
        self.lowered = lowered
        self.tokens = tokens

    @classmethod
    def over(cls, text: Column):
        """Matcher on plain expressions: they are evaluated again at each use."""
        lowered = F.lower(F.coalesce(text, F.lit("")))
        return cls(lowered, cls.tokenise(lowered))

    @classmethod
    def attach(cls, df: DataFrame, text: Column, name: str = "_m"):
        """(df with staged `<name>_low` and `<name>_tok`, matcher on them)."""
        low, tok = f"{name}_low", f"{name}_tok"
        df = staged(df, {low: F.lower(F.coalesce(text, F.lit("")))})
        df = staged(df, {tok: cls.tokenise(F.col(low))})
        return df, cls(F.col(low), F.col(tok))


class HybridMatcher(_Matcher):
    tokenise = staticmethod(plain_tokens)

    @staticmethod
    def split_terms(terms: Iterable[str]) -> tuple[list[str], list[str], list[str]]:
        """Terms that are tokens, alphanumeric terms with other letters, phrases."""
        folded = list(dict.fromkeys(term.lower() for term in terms))
        words = [t for t in folded if re.fullmatch("[a-z0-9]+", t)]
        foreign = [t for t in folded if t.isalnum() and t not in words]
        return words, foreign, [t for t in folded if not t.isalnum()]

    def _stands_alone(self, term: str) -> Column:
        pattern = rf"(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])"
        return F.contains(self.lowered, F.lit(term)) & F.rlike(self.lowered, F.lit(pattern))

    def any(self, terms: Iterable[str]) -> Column:
        words, foreign, phrases = self.split_terms(terms)
        found = overlaps(self.tokens, words)
        for term in foreign:
            found = found | self._stands_alone(term)
        return found | _any_substring(self.lowered, phrases) if phrases else found

    def hits(self, terms: Iterable[str]) -> Column:
        """Sorted distinct matching terms."""
        words, foreign, phrases = self.split_terms(terms)
        found = F.array_intersect(self.tokens, _literals(words))
        if foreign:
            alone = [F.when(self._stands_alone(t), F.lit(t)) for t in foreign]
            found = F.concat(found, F.array_compact(F.array(*alone)))
        if phrases:
            found = F.concat(found, _substrings_found(self.lowered, phrases))
        return F.array_sort(found)


class WordMatcher(_Matcher):
    tokenise = staticmethod(word_tokens)

    @staticmethod
    def split_terms(terms: Iterable[str]) -> tuple[list[str], list[str]]:
        folded = list(dict.fromkeys(term.lower() for term in terms))
        words = [t for t in folded if re.fullmatch(r"\w+", t)]
        return words, [t for t in folded if not re.fullmatch(r"\w+", t)]

    def any(self, terms: Iterable[str]) -> Column:
        words, phrases = self.split_terms(terms)
        return F.size(self.hits(terms)) > 0 if phrases else overlaps(self.tokens, words)

    def hits(self, terms: Iterable[str]) -> Column:
        """Matching terms (distinct, not sorted).

        The words of a phrase that matches are all tokens of the text, so its regex runs only on texts
        that hold every one of them.
        """
        words, phrases = self.split_terms(terms)
        if not phrases:
            return F.array_intersect(self.tokens, _literals(words))
        entries = F.array(*[self._entry(p) for p in phrases])
        vocabulary = list(dict.fromkeys([*words, *(w for p in phrases for w in re.findall(r"\w+", p))]))

        def found(present: Column) -> Column:
            phrase_hits = F.filter(
                entries,
                lambda e: (F.size(F.array_except(e["words"], present)) == 0)
                & F.rlike(self.lowered, e["pattern"]),
            )
            return F.concat(
                F.array_intersect(present, _literals(words)), F.transform(phrase_hits, lambda e: e["term"])
            )

        return let(F.array_intersect(self.tokens, _literals(vocabulary)), found)

    @staticmethod
    def _entry(term: str) -> Column:
        body = r"\s+".join(re.escape(piece) for piece in term.split())
        return F.struct(
            F.lit(term).alias("term"),
            _literals(dict.fromkeys(re.findall(r"\w+", term))).alias("words"),
            F.lit(rf"(?U)(?<!\w){body}(?!\w)").alias("pattern"),
        )

    def all_words(self, phrase: str) -> Column:
        """Every word of the phrase occurs somewhere in the text."""
        words = list(dict.fromkeys(phrase.lower().split()))
        return F.size(F.array_intersect(self.tokens, _literals(words))) == len(words)


def contains_term(text: Column, terms: Iterable[str]) -> Column:
    """Any term as a plain substring. A term that contains another listed term adds nothing."""
    terms = sorted(set(terms), key=len)
    minimal = [t for i, t in enumerate(terms) if not any(s in t for s in terms[:i])]
    return _any_substring(text, minimal)


def count_phrase(text: Column, phrase: Column) -> Column:
    """Non-overlapping occurrences of a phrase."""
    removed = F.length(text) - F.length(F.replace(text, phrase, F.lit("")))
    return F.floor(removed / F.length(phrase)).cast("bigint")


def count_word(text: Column, word: str) -> Column:
    """Occurrences of a whole word."""
    return F.regexp_count(text, F.lit(rf"(?U)\b{re.escape(word)}\b")).cast("bigint")


def letter_tokens(lowered: Column, least: int = 3) -> Column:
    """All standalone runs of at least `least` ASCII letters, repeats kept."""
    return F.regexp_extract_all(lowered, F.lit(rf"(?U)\b[a-z]{{{least},}}\b"), F.lit(0))


def without_stopwords(tokens: Column, stopwords: Iterable[str]) -> Column:
    """Drop stop words, keep repeats."""
    stop = _literals(stopwords)
    return F.filter(tokens, lambda token: ~F.array_contains(stop, token))
