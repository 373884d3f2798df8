"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps what was measured and one bit per failed rule, so
that a policy (a named, versioned set of rules) is a mask and changing it never reads the texts again, and the
share of each rule in the rejections (ablation) is an aggregation over the few distinct bit patterns.

Only DataFrame expressions are used. Null and empty texts have no words, so they fail `few_words`. Null ids and
repeated rows are kept as they are: one ledger row per input row. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import staged
from tidemark.llm.common import SPACES, replaced, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document fails where `failed` (a condition over the measurements) is true."""

    name: str
    failed: str


# The position of a rule is its bit: append new rules, never reorder them.
RULES: tuple[Rule, ...] = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 2 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)"),
)

BASE = ("few_words", "repeated_windows")
# Policies by version; a version is never changed once results were made with it.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "word_length"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask_of(policy: str, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def _windows(words: Column, n: Column) -> Column:
    """(window, position) of all 3-word windows, sorted, so that equal windows are neighbours."""
    size = F.greatest(n - 2, F.lit(0))
    window = F.arrays_zip(F.slice(words, 1, size), F.slice(words, 2, size), F.slice(words, 3, size))
    first, none = F.lit(1), F.array().cast("array<int>")
    positions = F.when(size > 0, F.sequence(first, size)).otherwise(none)
    zipped = F.arrays_zip(window.alias("window"), positions.alias("position"))
    return F.when(n >= 3, F.sort_array(zipped))


def _covered(sorted_windows: Column) -> Column:
    """Number of words that lie in a window found at least twice."""
    n = F.size(sorted_windows)
    indices = F.when(n > 1, F.sequence(F.lit(1), n - 1))
    second = F.filter(indices, lambda i: F.get(sorted_windows, i)["window"] == F.get(sorted_windows, i - 1)["window"])
    members = F.array_distinct(F.concat(second, F.transform(second, lambda i: i - 1)))
    positions = F.sort_array(F.transform(members, lambda i: F.get(sorted_windows, i)["position"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(state: Column, p: Column) -> Column:
        fresh = p + 3 - F.greatest(state["end"], p)
        return F.struct((p + 3).alias("end"), (state["total"] + fresh).alias("total"))

    return F.coalesce(F.aggregate(positions, start, add, lambda state: state["total"]), F.lit(0))


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: `doc_id` and the measurements of its whole text."""
    text = F.col("_text")
    base = docs.select("doc_id", text_or_empty().alias("_text"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    split = staged(base, {"_words": words_of(text), "_lines": lines})
    sized = staged(split, {"_n": F.size("_words")})
    sorted_ = staged(sized, {"_sorted": _windows(F.col("_words"), F.col("_n"))})
    ready = staged(sorted_, {"_covered": _covered(F.col("_sorted"))})
    return ready.select(
        "doc_id",
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(replaced(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_covered").cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements and `failed_bits`: bit i is set where rule i fails."""
    bits = [F.when(F.expr(rule.failed), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs).withColumn("failed_bits", total.cast("long"))


def apply_policy(entries: DataFrame, policy: str, column: str = "kept", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the verdict of a policy to ledger rows."""
    return entries.withColumn(column, F.col("failed_bits").bitwiseAND(F.lit(mask_of(policy, rules))) == 0)


def ablations(entries: DataFrame, policy: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects."""
    mask = mask_of(policy, rules)
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    listed = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, r in enumerate(rules) if mask >> i & 1
    ])
    each = patterns.select("bits", "n", F.inline(listed))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only_this"),
    )


def quality(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with the verdicts of the base rules and of a policy."""
    judged = apply_policy(ledger(docs), "v1", "_base")
    return apply_policy(judged, policy).withColumn("base_failed", ~F.col("_base")).drop("_base")


def keep_quality(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The documents that pass a policy, with all their columns.

    The verdict is taken from the row itself, so that null and repeated ids need no join.
    """
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"), F.col("text"))
    return apply_policy(ledger(row), policy).filter("kept").select("doc_id.*")
