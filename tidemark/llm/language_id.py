"""Language mixture inference by expectation maximisation over n-gram likelihoods.

Learning counts byte trigrams of lower-cased words per language over all labelled documents. A word's likelihood
under a language is the product of its smoothed conditional trigram probabilities. For a document the shares of
the languages are the mixture weights that maximise the likelihood of its words (EM). The set of languages is
chosen by penalised likelihood among nested sets: the k largest shares, for k = 1, 2, ...

The model is two tables of fixed size per language, whatever the corpus; it is gathered and sent with the tasks.
Null texts and texts without a letter get `und` and score 0, and so do all where no language was learned. Null
labels and null texts teach nothing. Repeated rows count as often as they occur; each gets its row. Ties go to
the label that sorts first. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices

TRIGRAM_SLOTS = 1 << 18  # trigrams share slots by hash
CONTEXT_SLOTS = 1 << 16  # every pair of bytes has its own
SMOOTHING = 0.02
LEAST_SHARE = 0.01  # a language with less of the unrestricted mixture enters no set
_BLANK = 0x20


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    trigrams: np.ndarray  # (language, slot) log probability of a trigram's last byte given the other two


def _letters() -> np.ndarray:
    """Byte -> itself if it can be part of a lower-cased letter, else a blank."""
    table = np.full(256, _BLANK, np.uint8)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


_TABLE = _letters()


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts with a blank after each, letters only; offset of each text and the end."""
    lowered = pc.binary_join_element_wise(pc.utf8_lower(texts.cast(pa.large_string())), *(pa.scalar(x, pa.large_string()) for x in ("", " ")))
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
    data = lowered.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return _TABLE[raw[offsets[0] : offsets[-1]]], offsets - offsets[0]


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each letter byte: its index, the slot of its trigram and its context (the two bytes before it)."""
    padded = np.concatenate([np.full(2, _BLANK, np.uint8), data])
    before = padded[1:-1]
    # a word starts with a blank context; bytes of the word before it do not reach in
    earlier = np.where(before == _BLANK, _BLANK, padded[:-2])
    at = np.flatnonzero(data != _BLANK)
    context = earlier[at].astype(np.uint32) << 8 | before[at]
    return at, ((context << 8 | data[at]) * np.uint32(2654435761)) >> np.uint32(14), context


def count_grams(docs: DataFrame) -> DataFrame:
    """Trigram and context counts per label over all rows with a label and a text; (label, kind, slot, n)."""
    schema = "label string, kind int, slot int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for label in pc.unique(batch.column(0)).to_pylist():
                own = counts.setdefault(label, [np.zeros(TRIGRAM_SLOTS, np.int64), np.zeros(CONTEXT_SLOTS, np.int64)])
                rows = batch.filter(pc.equal(batch.column(0), label))
                for part in text_slices(rows, "text", 2_000_000):
                    _, slots, contexts = _grams(_buffer(part.column(1))[0])
                    own[0] += np.bincount(slots, minlength=TRIGRAM_SLOTS)
                    own[1] += np.bincount(contexts, minlength=CONTEXT_SLOTS)
        for label, tables in counts.items():
            for kind, table in enumerate(tables):
                slot = np.flatnonzero(table).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(slot), pa.string()), pa.array(np.full(len(slot), kind, np.int32)), pa.array(slot), pa.array(table[slot])],
                    names=["label", "kind", "slot", "n"],
                )

    rows = docs.filter("label is not null and text is not null").select(F.col("label").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema).groupBy("label", "kind", "slot").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> Model:
    """Fit the model on columns `label` and `text`. What reaches the driver is bounded by the tables' sizes."""
    counted = count_grams(docs).toPandas()
    labels = tuple(sorted(counted["label"].unique()))
    index = counted["label"].map({label: i for i, label in enumerate(labels)})
    trigrams = np.zeros((len(labels), TRIGRAM_SLOTS))
    contexts = np.zeros((len(labels), CONTEXT_SLOTS))
    for table, kind in ((trigrams, 0), (contexts, 1)):
        rows = (counted["kind"] == kind).to_numpy()
        table[index[rows].astype(int), counted["slot"][rows]] = counted["n"][rows]
    # a slot's context is not known from the slot, so the context's share is applied at scoring through its table
    joint = np.log(trigrams + SMOOTHING).astype(np.float32)
    given = np.log(contexts + SMOOTHING * 256).astype(np.float32)
    return Model(labels, np.concatenate([joint, given], axis=1))


def _word_scores(model: Model, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihood of each word per language, byte index where each word starts)."""
    at, slots, contexts = _grams(data)
    if not len(at):
        return np.zeros((0, len(model.labels)), np.float32), at
    first = np.concatenate([[True], np.diff(at) > 1])
    opens = np.flatnonzero(first)
    scores = np.empty((len(opens), len(model.labels)), np.float32)
    for i, table in enumerate(model.trigrams):
        scores[:, i] = np.add.reduceat(table[slots] - table[TRIGRAM_SLOTS + contexts], opens)
    return scores, at[opens]


def _em(likely: np.ndarray, peak: np.ndarray, bounds: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixture weights of each document's words from a start, and the log likelihood; zero weights stay zero."""
    doc = np.repeat(np.arange(len(shares)), np.diff(bounds))
    words = np.maximum(np.diff(bounds), 1)[:, None]
    for _ in range(rounds):
        part = likely * shares[doc]
        part /= part.sum(axis=1, keepdims=True) + 1e-30
        shares = _sums(part, bounds) / words
    fit = np.log((likely * shares[doc]).sum(axis=1, dtype=np.float64) + 1e-30) + peak
    return shares, _sums(fit[:, None], bounds)[:, 0]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows of each document; zero for a document without rows."""
    total = np.zeros((len(bounds) - 1, values.shape[1]), np.float64)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        total[filled] = np.add.reduceat(values, bounds[:-1][filled], axis=0, dtype=np.float64)
    return total


def infer(scores: np.ndarray, bounds: np.ndarray, penalty: float, rounds: int = 12) -> np.ndarray:
    """Language shares of each document over its chosen language set.

    `penalty` times log(words) is the price of each language after the first. Sets of every size are tried, the k-th
    with the k largest shares of the mixture over all languages.
    """
    n, languages = len(bounds) - 1, scores.shape[1]
    peak = scores.max(axis=1) if len(scores) else np.zeros(0)
    likely = np.exp(scores - peak[:, None])
    words = np.diff(bounds)
    shares, _ = _em(likely, peak, bounds, np.full((n, languages), 1 / languages), rounds)
    order = np.argsort(-shares, axis=1, kind="stable")
    single = _sums(scores, bounds)
    best_one = single.argmax(axis=1)
    best = np.zeros((n, languages))
    best[np.arange(n), best_one] = 1
    best_value = single[np.arange(n), best_one]
    for k in range(2, languages + 1):
        kth = np.take_along_axis(shares, order[:, k - 1 : k], axis=1)[:, 0]
        some = np.flatnonzero((kth > LEAST_SHARE) & (words > 0))
        if not len(some):
            break
        rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in some])
        inner = np.concatenate([[0], np.cumsum(words[some])])
        start = np.zeros((len(some), languages))
        np.put_along_axis(start, order[some, :k], 1 / k, axis=1)
        found, fit = _em(likely[rows], peak[rows], inner, start, rounds)
        value = fit - penalty * (k - 1) * np.log(words[some] + 1)
        better = value > best_value[some]
        best[some[better]], best_value[some[better]] = found[better], value[better]
    return best


def predict(docs: DataFrame, model: Model, penalty: float = 2.0) -> DataFrame:
    """All columns of `docs` and `lang_pred`, `score` (its share) and `n_languages` (size of the chosen set)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    # the row travels beside its text as one struct, so that no name of its columns can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("text"))
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, n_languages int"
    fields = ["row", "lang_pred", "score", "n_languages"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                shares = _shares(known, part.column(1), penalty)
                pick = shares.argmax(axis=1) if known.labels else np.zeros(len(shares), int)
                share = shares[np.arange(len(shares)), pick] if known.labels else np.zeros(len(shares))
                told = part.column(2).to_numpy(zero_copy_only=False).astype(bool) & (share > 0)
                label = [known.labels[i] if ok else "und" for i, ok in zip(pick, told)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(label, pa.string()), pa.array(np.where(told, np.minimum(share, 1.0), 0.0)),
                     pa.array(np.where(told, (shares > 0.005).sum(axis=1), 0).astype(np.int32))],
                    names=fields,
                )

    out = rows.select("row", F.coalesce("text", F.lit("")).alias("text"), has_letter.alias("has_letter")).mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], *fields[1:])


def _shares(model: Model, texts: pa.Array, penalty: float) -> np.ndarray:
    """Shares of each text; a text of letters that never were seen still gets its most likely language."""
    if not model.labels:
        return np.zeros((len(texts), 0))
    data, offsets = _buffer(texts)
    size = 1 << 21
    scores, starts, at = [], [], 0
    while at < len(data):  # a very long text is scored in pieces that end between words
        end = min(at + size, len(data))
        while end < len(data) and data[end - 1] != _BLANK:
            end += 1
        own, where = _word_scores(model, data[at:end])
        scores.append(own)
        starts.append(where + at)
        at = end
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    every = np.concatenate(scores) if scores else np.zeros((0, len(model.labels)), np.float32)
    return infer(every, np.searchsorted(where, offsets), penalty)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 1 by 3. A null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, penalty: float = 2.0) -> DataFrame:
    """Learn from the documents that are not held out, predict all: `docs` with `held_out` and the predictions."""
    taught = docs.filter(~held_out()).select(F.col("lang").alias("label"), "text")
    return predict(docs, learn(taught), penalty).withColumn("held_out", held_out())


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents with letters whose main language has at least `min_score` of the words; columns as they came.

    Where no document teaches a language, nothing can be told and all documents with a letter stay.
    """
    names = docs.columns
    model = learn(docs.filter(~held_out()).select(F.col("lang").alias("label"), "text"))
    if not model.labels:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept_row"), "text")
    judged = predict(marked, model).filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    return judged.select("kept_row.*")
