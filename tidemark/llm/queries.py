"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, hilbert_shards, html_extract, jaccard_join, language_id, merkle, packing, prefix_trie, quality_rules,
    secret_scan, simhash, suffix_dedup, token_files,
)
from tidemark.session import scratch_dir, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the folder may be set in the environment."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if not folder:
        found = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(found.origin) if found and found.origin else "/opt/tokenizers"
    return os.path.join(folder, name)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tune(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of every document from its language mixture."""
    return language_id.identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "n_languages")


@query
def op2_html_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op3_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to, as digests."""
    return bpe.digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query
def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdicts of every document."""
    return quality_rules.quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "failed_bits",
    )


CHECKS["op5_quality_ledger"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS d
  FROM (SELECT doc_id, unnest(l) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(w.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.n - l.d, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM words w LEFT JOIN lines l ON l.doc_id = w.doc_id LEFT JOIN covered c ON c.doc_id = w.doc_id
), judged AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 16 ELSE 0 END) AS BIGINT) AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_bits = 0 AS kept, n_lines, failed_bits
FROM judged
"""


@query
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document along a Hilbert curve."""
    return hilbert_shards.assign_shards(documents(spark, sf_dir), 40)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited form; near ones of each fiftieth document by block tables."""
    return simhash.with_near_counts(simhash.compare_with_edited(documents(spark, sf_dir)))


@query
def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, packed into sequences of 4096 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written, read back and checked."""
    path = scratch_dir(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_checksums(spark, path)


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that start elsewhere too."""
    return suffix_dedup.removed_digests(documents(spark, sf_dir))


@query
def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of word shingles."""
    return jaccard_join.component_rows(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document: the patterns' and those of random strings."""
    return secret_scan.digests(secret_scan.find_secrets(documents(spark, sf_dir).select("doc_id", "text")))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and tamper check of every document."""
    return merkle.tamper_check(documents(spark, sf_dir)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    )


# crc32 of the decimal id: a table of 256 remainders, one step per byte
CRC_STEP = """
crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
)"""


def crc_of(value: str) -> str:
    """DuckDB's crc32 (unsigned) of an integer's decimal digits, beside the table `crc`."""
    digits = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


CHECKS["op12_merkle_manifest"] = f"""
WITH RECURSIVE {CRC_STEP}, fields AS (
  SELECT doc_id, source, text, {_field("doc_id")} || {_field("source")} || {_field("lang")} || {_field("n_chars")} AS head,
         coalesce({crc_of("doc_id")} % 5 = 0, false) AS tampered
  FROM documents, crc
), leafs AS (
  SELECT doc_id, source, sha256(head || {_field("text")}) AS leaf,
         CASE WHEN tampered THEN sha256(head || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
              ELSE sha256(head || {_field("text")}) END AS seen
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, seen) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n FROM leafs
), nodes AS (
  SELECT 0 AS level, source, place, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, source, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY level, source, place // 16, n
), subroots AS (
  SELECT source, h AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, place, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY place)) FROM tops WHERE n > 1 GROUP BY level, place // 16, n
), walk AS (
  SELECT p.doc_id, p.source, p.leaf, p.place AS start, 0 AS level, p.place, p.n, p.seen AS folded, '' AS proof FROM placed p
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.start, w.level + 1, w.place // 16, (w.n + 15) // 16,
         sha256(string_agg(CASE WHEN s.place = w.place THEN w.folded ELSE s.h END, '' ORDER BY s.place)),
         w.proof || coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place <> w.place), '')
  FROM walk w JOIN nodes s ON s.level = w.level AND s.source IS NOT DISTINCT FROM w.source AND s.place // 16 = w.place // 16
  WHERE w.n > 1 GROUP BY w.doc_id, w.source, w.leaf, w.start, w.level, w.place, w.n, w.folded, w.proof
), climbed AS (
  SELECT w.doc_id, w.source, w.leaf, w.start, s.subroot, 0 AS level, s.place, s.n, w.folded, w.proof
  FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, w.start, w.subroot, w.level + 1, w.place // 16, (w.n + 15) // 16,
         sha256(string_agg(CASE WHEN s.place = w.place THEN w.folded ELSE s.h END, '' ORDER BY s.place)),
         w.proof || coalesce(string_agg(s.h, '' ORDER BY s.place) FILTER (WHERE s.place <> w.place), '')
  FROM climbed w JOIN tops s ON s.level = w.level AND s.place // 16 = w.place // 16
  WHERE w.n > 1 GROUP BY w.doc_id, w.source, w.leaf, w.start, w.subroot, w.level, w.place, w.n, w.folded, w.proof
), root AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climbed, root WHERE n = 1
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


CHECKS["op13_prefix_trie"] = f"""
WITH {CRC_STEP}, own AS (
  SELECT conv_id, list({{'turn': md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'octets': strlen(coalesce(text, ''))}}
                       ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), built AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM (SELECT conv_id, turns, {crc_of("conv_id")} % 9 AS h FROM own, crc) o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), paths AS (
  SELECT conv_id, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built
), nodes AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, turns[1:depth]
), families AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY path[1:depth - 1]
), valued AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, p.conv_id AS parent_conv_id,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * n.path[n.depth].octets END AS saved
  FROM nodes n LEFT JOIN families f ON f.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
), below AS (
  SELECT path[1:d] AS path, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY path[1:d]
)
SELECT v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children, b.n_leaves, b.saved_tokens, v.ends_sha256
FROM valued v JOIN below b ON b.path = v.path
"""
