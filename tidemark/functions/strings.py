"""String expressions: cleaning, whitespace, lists, ids."""

from __future__ import annotations

import html
import re
import sys

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.matching import let


def strip_text(value: Column) -> Column:
    """Trim any white space from both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def squeeze(value: Column) -> Column:
    """Runs of white space become one blank; ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def squeeze_or_empty(value: Column) -> Column:
    return F.coalesce(squeeze(value), F.lit(""))


def compact(value: Column, max_length: int | None = None) -> Column:
    """Squeezed text, null as empty, cut to `max_length` characters if one is given."""
    text = squeeze_or_empty(value)
    return text if max_length is None else F.substring(text, 1, max_length)


def trimmed(value: Column) -> Column:
    """Trimmed text, null as empty."""
    return F.coalesce(strip_text(value), F.lit(""))


def fold(value: Column) -> Column:
    """Lower case, as the matchers read texts (the sharp s is not expanded; see `casefold`)."""
    return F.lower(value)


def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """What full case folding changes in lower-cased text: letters to one letter, letters to several."""
    lowered = (c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) <= 0xDFFF and c.lower() == c)
    pairs = {c: c.casefold() for c in lowered if c.casefold() != c}
    return {c: f for c, f in pairs.items() if len(f) == 1}, {c: f for c, f in pairs.items() if len(f) > 1}


LETTER_FOLDINGS, LONG_FOLDINGS = _foldings()


def casefold(value: Column) -> Column:
    """Full Unicode case folding, equal to Python's `casefold`: sharp s, ligatures, final sigma and the like.

    Texts of ASCII letters are only lower-cased; letters that fold to several are looked for before they are replaced.
    Null stays null.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("letter"), F.lit(f).alias("folded")) for c, f in LONG_FOLDINGS.items()])

    def long(text: Column) -> Column:
        spelled = F.aggregate(pairs, text, lambda done, pair: F.replace(done, pair["letter"], pair["folded"]))
        return F.when(text.rlike(f"[{''.join(LONG_FOLDINGS)}]"), spelled).otherwise(text)

    def full(text: Column) -> Column:
        letters = F.translate(text, "".join(LETTER_FOLDINGS), "".join(LETTER_FOLDINGS.values()))
        return F.when(text.rlike(r"[^\x00-\x7F]"), let(letters, long)).otherwise(text)

    return let(F.lower(value), full)


def clean_markup(text: Column) -> Column:
    """Drop links, hashtags, mentions and tags, squeeze white space, lower-case."""
    cleaned = F.coalesce(text, F.lit(""))
    for pattern in (r"(?U)http\S+", r"(?U)#\w+", r"(?U)@\w+", r"<.*?>"):
        cleaned = F.regexp_replace(cleaned, pattern, "")
    return F.lower(squeeze(cleaned))


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def html_to_text(raw: Column) -> Column:
    """HTML to plain text. Only values holding an `&` are sent to Python for entity decoding."""
    bare = F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?iU)<br\s*/?>", "\n")
    bare = F.regexp_replace(bare, r"<[^>]+>", " ")
    decoded = _unescape(F.when(F.contains(bare, F.lit("&")), bare))
    return squeeze(F.coalesce(decoded, bare))


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(value, F.lit("")) for value in values])


def join_filled(separator: str, *values: Column) -> Column:
    """Join the values that are neither null nor empty."""
    return F.concat_ws(separator, *[F.nullif(value, F.lit("")) for value in values])


def split_list(value: Column, separator: str = ",") -> Column:
    """Separated list to a trimmed array without blanks."""
    parts = F.transform(F.split(value, re.escape(separator)), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def title_of(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def count_char(text: Column, char: str) -> Column:
    """Number of occurrences of one character."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def label_code(value: Column) -> Column:
    """Code part of `code: label`, split at the first separator; the whole value if there is none."""
    return F.trim(F.when(F.contains(value, F.lit(": ")), F.substring_index(value, ": ", 1)).otherwise(value))


def label_text(value: Column) -> Column:
    """Label part of `code: label` without quotes; the whole value if there is no separator."""
    tail = F.regexp_extract(value, r"(?s)^.*?: (.*)$", 1)
    unquoted = F.regexp_replace(F.trim(tail), r'^"+|"+$', "")
    return F.when(F.contains(value, F.lit(": ")), unquoted).otherwise(F.trim(value))


def sorted_set(array: Column) -> Column:
    return F.array_sort(F.array_distinct(array))


def shorten(value: Column, limit: int = 220) -> Column:
    """Display form for samples: longer text is cut to `limit - 1` characters and marked."""
    cut = F.concat(F.substring(value, 1, limit - 1), F.lit("..."))
    return F.when(F.length(value) > limit, cut).otherwise(value)


# ------------------------------------------------------------------ identities
def digest_id(prefix: str, *parts: Column) -> Column:
    """`prefix` + sha1 of the parts joined by `|`, nulls as empty."""
    filled = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.concat(F.lit(prefix), F.sha1(F.concat_ws("|", *filled)))


def unified_id(source_index: Column, source_es_id: Column) -> Column:
    return digest_id("unified-", source_index, source_es_id)


def raw_record_id(platform: Column, *parts: Column) -> Column:
    return F.concat(platform, digest_id("-", platform, *parts))


def canonical_id(
    platform: Column,
    *,
    url: Column,
    archive_url: Column,
    source_id: Column,
    source_es_id: Column,
    raw_id: Column,
    news_platform: str = "gdelt",
) -> Column:
    """Key shared by copies of one item: by link for news, by source id otherwise."""
    name = F.lower(F.coalesce(F.nullif(platform, F.lit("")), F.lit("unknown")))
    news = first_filled(url, archive_url, source_id, source_es_id, raw_id)
    other = first_filled(source_id, source_es_id, raw_id)
    return digest_id("canonical-", name, F.when(name == news_platform, news).otherwise(other))
