"""SimHash fingerprints and a Hamming search by probes of block tables, in DataFrame expressions only.

The terms of a text are its pairs of neighbouring words (the word itself if there is one only), weighted by how
often they occur. Each term's hash votes on 128 signed bits; a bit is set where the votes for it are more than
half. Two counters of 32 bits share one long, so a text may have 2 ** 32 terms.

Null texts are empty; a text without words has the fingerprint of zeros. Equal texts have equal fingerprints.
Repeated rows and null ids are rows like others: the order of ids is descending with nulls last, ties by text
digest. The next document of a single one is that document itself. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.staging import staged
from tidemark.llm.common import saved, shuffle_width, text_or_empty, words_of

WORDS_OF_64 = 2
BITS = 64 * WORDS_OF_64
# Texts that share 0.8 of their five-word shingles have some 12 different bits (cosine 0.956 of their pairs), with a
# standard deviation of 3.3.
RADIUS = 20
N_BLOCKS = 7  # two bits of some block at most differ within the radius
HOT_KEY = 2_000  # fingerprints of one block value beyond which they are dealt in parts
_PAIR = 0x0000000100000001  # bits i and i + 32 of a hash


def terms_of(text: Column) -> Column:
    """Pairs of neighbouring words; a single word stands for itself."""
    words = words_of(text)
    return F.transform(F.array(words), lambda w: F.when(
        F.size(w) > 1,
        F.arrays_zip(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(1))).alias("a"), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(1))).alias("b")),
    ).otherwise(F.arrays_zip(w.alias("a"), F.transform(w, lambda _: F.lit("")).alias("b"))))[0]


def vote_sums() -> list[Column]:
    """Aggregates over term hashes `_h0`, `_h1`: sum i of word k counts its bits i and i + 32."""
    return [
        F.sum(F.shiftrightunsigned(F.col(f"_h{k}"), i).bitwiseAND(F.lit(_PAIR))).alias(f"_v{k}_{i}")
        for k in range(WORDS_OF_64) for i in range(32)
    ]


def sealed() -> list[Column]:
    """The fingerprint's longs from the sums and the number of terms `_terms`."""
    words = []
    for k in range(WORDS_OF_64):
        word = F.lit(0).cast("long")
        for i in range(32):
            votes = F.col(f"_v{k}_{i}")
            low = F.when(votes.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("_terms"), F.lit(1 << i)).otherwise(F.lit(0))
            bit = 1 << (i + 32)
            high = F.when(F.shiftrightunsigned(votes, 32) * 2 > F.col("_terms"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0))
            word = word.bitwiseOR(low.cast("long")).bitwiseOR(high.cast("long"))
        words.append(word)
    return words


def fingerprints(rows: DataFrame, texts: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """Fingerprints (array of longs) of several texts per row, named by `texts` (text column -> result).

    `keys` are returned and settle the texts: rows with equal keys have equal texts. Their votes are added up together,
    which changes no majority, and the rows come back as often as they were. A row's terms are summed in the task that
    reads it, so that one row of sums per text is sent, however long the text is.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).alias("text")) for i, c in enumerate(texts)]))
    split = rows.select(*keys, each.alias("_t")).select(*keys, F.col("_t.which").alias("_which"), F.col("_t.text").alias("_text"))
    named = staged(split, {"_list": terms_of(F.col("_text"))})
    term = named.select(*keys, "_which", F.posexplode_outer("_list").alias("_at", "_term"))
    hashed = term.select(
        *keys, "_which", F.col("_term").isNotNull().alias("_is"), F.coalesce(F.col("_at") == 0, F.lit(True)).alias("_first"),
        F.xxhash64("_term.a", "_term.b").alias("_h0"), F.xxhash64("_term.b", "_term.a", F.lit(1)).alias("_h1"),
    )
    counted = hashed.groupBy(*keys, "_which").agg(
        F.sum(F.col("_is").cast("long")).alias("_terms"), F.count_if("_first").alias("_copies"), *vote_sums())
    done = counted.select(*keys, "_which", "_copies", F.when(F.col("_terms") > 0, F.array(*sealed())).otherwise(
        F.array(*[F.lit(0).cast("long")] * WORDS_OF_64)).alias("_fp"))
    rows = done.groupBy(*keys).agg(F.max("_copies").alias("_copies"), *[
        F.max(F.when(F.col("_which") == i, F.col("_fp"))).alias(name) for i, name in enumerate(texts.values())
    ])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copy", "_copies")


def as_hex(fp: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(F.get(fp, k))), 16, "0") for k in range(WORDS_OF_64)])


def distance(a: Column, b: Column) -> Column:
    """Number of different bits."""
    parts = [F.bit_count(F.get(a, k).bitwiseXOR(F.get(b, k))) for k in range(WORDS_OF_64)]
    return sum(parts[1:], parts[0])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / BITS


def blocks() -> list[tuple[int, int]]:
    """(first bit, width) of each block; bit i is bit i % 64 of long i // 64."""
    edges = [BITS * b // N_BLOCKS for b in range(N_BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_values(words: Sequence[Column]) -> list[Column]:
    """The bits of each block as a long."""
    out = []
    for at, width in blocks():
        k, low = divmod(at, 64)
        value = F.shiftrightunsigned(words[k], low)
        if low + width > 64:
            value = value.bitwiseOR(F.shiftleft(words[k + 1], 64 - low))
        out.append(value.bitwiseAND(F.lit((1 << width) - 1).cast("long")))
    return out


def block_key(block: int, value: Column) -> Column:
    return F.lit(block << 32).cast("long").bitwiseOR(value)


def probes(words: Sequence[Column], flips: int) -> Column:
    """Keys of all values that differ from a fingerprint's block in `flips` bits or fewer, block by block."""
    def near(block: int, width: int, value: Column) -> Column:
        masks = [sum(1 << i for i in bits) for n in range(flips + 1) for bits in combinations(range(width), n)]
        return F.transform(F.lit(masks).cast("array<long>"), lambda m: block_key(block, value.bitwiseXOR(m)))

    return F.concat(*[near(b, width, value) for b, ((_, width), value) in enumerate(zip(blocks(), block_values(words)))])


def neighbours(queries: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of distinct fingerprints (`query`, `found`, `distance`) at most `radius` bits apart, the same excluded.

    Fingerprints within the radius differ in `radius // N_BLOCKS` bits or fewer in some block. The table has one key
    per block, a query one for each value so near to its own; rows that meet are compared exactly, and a pair counts
    in the first block that brings it together. Copies meet once: both sides are reduced to distinct fingerprints
    first. Keys of many fingerprints are dealt in parts, and the queries' probes of them go to every part. Probes are
    many and compress well, so their join is told to shuffle; the stored list of hot keys may be broadcast by its size.
    """
    flips = radius // N_BLOCKS
    q, f = ([F.col(f"_{n}{k}") for k in range(WORDS_OF_64)] for n in "qf")

    def longs(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.get("fp", k).alias(f"_{name}{k}") for k in range(WORDS_OF_64)]).distinct()

    stored = longs(table, "f").select(*f, F.explode(F.array(*[block_key(b, v) for b, v in enumerate(block_values(f))])).alias("_key"))
    sizes = stored.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_KEY)
    hot = saved(sizes.select("_key", F.ceil(F.col("_n") / HOT_KEY).alias("_parts")), "hot-keys")
    stored = stored.join(hot, "_key", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*f), F.col("_parts")), F.lit(0)).cast("long")).drop("_parts")
    asked = longs(queries, "q").select(*q, F.explode(probes(q, flips)).alias("_key")).join(hot, "_key", "left")
    last = F.coalesce(F.col("_parts") - 1, F.lit(0)).cast("long")
    asked = asked.select(*q, "_key", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_part"))

    apart = [a.bitwiseXOR(b) for a, b in zip(q, f)]
    bits = sum((F.bit_count(x) for x in apart[1:]), F.bit_count(apart[0]))
    first = F.coalesce(*[F.when(F.bit_count(v) <= flips, F.lit(b)) for b, v in enumerate(block_values(apart))])
    near = asked.join(stored.hint("shuffle_merge"), ["_key", "_part"]).withColumn("distance", bits).filter(F.col("distance").between(1, radius))
    return near.filter(first == F.shiftright("_key", 32)).select(F.array(*q).alias("query"), F.array(*f).alias("found"), "distance")


def with_next(df: DataFrame, values: dict[str, str], key: str = "doc_id", tie: str = "_digest") -> DataFrame:
    """Add columns of the next row in descending order of the key (nulls last, ties by `tie`); the first follows the last.

    Rows are dealt to ranges of keys between quantiles, the next row is taken inside each range, and the first
    row of the range below is fetched for the last row of each: one row per range, never a whole column.
    """
    n_ranges = max(2, min(shuffle_width(df), 2048))
    quantiles = [i / n_ranges for i in range(1, n_ranges)]
    bounds = df.select(F.percentile_approx(key, quantiles, F.lit(100_000)).alias("b")).first()["b"] or []
    marks = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast(f"array<{df.schema[key].dataType.simpleString()}>")
    number = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.size(F.filter(marks, lambda b: b <= F.col(key))))
    ranged = staged(df, {"_range": number})
    inside = Window.partitionBy("_range").orderBy(F.col(key).desc_nulls_last(), F.col(tie))
    packed = F.struct(*[F.col(c).alias(n) for c, n in values.items()])
    led = ranged.withColumn("_next", F.lead(packed).over(inside))
    # the first row of each range: the greatest key, the least tie
    heads = ranged.groupBy("_range").agg(
        F.min_by(packed, F.struct(F.col(key).isNull().alias("n"), (-F.col(key)).alias("k"), F.col(tie).alias("t"))).alias("_head")
    )
    around = Window.orderBy(F.col("_range").desc())  # one row per range
    whole = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = heads.select("_range", F.coalesce(F.lead("_head").over(around), F.first("_head").over(whole)).alias("_below"))
    filled = led.join(below, "_range").withColumn("_following", F.coalesce("_next", "_below"))
    return filled.select(*df.columns, *[F.col("_following").getField(n).alias(n) for n in values.values()])


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by the start of the following one."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited form, and how alike these and the next document's are."""
    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    rows = rows.select("doc_id", "_text", F.unhex(F.md5(F.col("_text").cast("binary"))).alias("_digest"))
    paired = with_next(rows, {"_text": "_after"})
    both = staged(paired, {"_edited": edited(F.col("_text"), F.col("_after"))})
    keyed = staged(both, {
        "n_chars": F.length("_text").cast("long"),
        "_sha": F.unhex(F.sha2(F.col("_edited").cast("binary"), 256)),
    })
    keys = ["doc_id", "_digest", "n_chars", "_sha"]
    # stored, as the ranges below read it several times
    printed = saved(fingerprints(keyed, {"_text": "_own", "_edited": "_other"}, keys), "printed")
    followed = with_next(printed, {"_own": "_next_own"})
    return followed.select(
        "doc_id", "n_chars", F.lower(F.hex("_sha")).alias("edited_sha256"), as_hex(F.col("_own")).alias("fingerprint"),
        as_hex(F.col("_other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next_own")).alias("near_next"),
        F.col("_own").alias("fp"),
    )


def with_near_counts(compared: DataFrame, radius: int = RADIUS, every: int = 50) -> DataFrame:
    """Add `n_near`: how many distinct other fingerprints of all rows lie within `radius` bits.

    Searched for rows whose id is divisible by `every`; null for the others.
    """
    rows = saved(compared, "fingerprints")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    met = neighbours(rows.filter(asked), rows, radius)
    counts = met.groupBy(F.col("query").alias("fp")).agg(F.count("*").alias("_n"))
    searched = rows.filter(asked).join(counts, "fp", "left").withColumn("n_near", F.coalesce("_n", F.lit(0)))
    rest = rows.filter(~asked).withColumn("n_near", F.lit(None).cast("long"))
    return searched.select(*rest.columns).unionByName(rest).drop("fp")
