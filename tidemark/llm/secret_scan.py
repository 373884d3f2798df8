"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Two kinds of first-order chains over `SYMBOLS` are compared: one of ordinary strings, and several of random ones. A run
of symbols is reported as `random` if it is likelier by `log(odds)`, and by `PER_SYMBOL` a symbol, under the mixture of
the random chains.

Training is on labelled strings. The values that the patterns find are labelled random, and all runs of all documents
that are too short to be reported (words) ordinary, so that a secret that occurs often does not teach itself; both are
counted over the whole corpus, in tables of fixed size. Ordinary identifiers are words joined (`get_name`, `getName`,
`GET_NAME`, `path/to`) and lines of one symbol; their counts follow from those of words and word ends. Further random
strings are drawn from the usual alphabets of keys with a fixed seed, `SAMPLES` strings of `SAMPLE_LENGTH` characters
each, so that a secret of a form that no pattern knows is found too.

Positions are code points, ends exclusive; texts are scanned whole. A null text is empty and has no spans. Repeated
rows and null ids are scanned like others; columns of the input travel as they are, in one struct, so none can clash
but `found` itself, which is replaced. An empty table gives an empty result. Of spans that start together the kind
listed first comes first; a random run inside a pattern's span is not reported again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, text_slices

# Fixed values of the patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # whole runs, as no hex digit stands before one
MIN_VALUE, MIN_ACCESS = 12, 18
# What a text must hold to be searched at all, for a search by bytes.
_MAY_HOLD = (r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", r"AKIA[A-Z0-9]", r"[0-9a-f]{16}")

SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
ALPHABETS = (b"0123456789abcdef", b"abcdefghijklmnopqrstuvwxyz0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", SYMBOLS[:62], SYMBOLS[:64], SYMBOLS[:62] + b"_-")
STATES = len(SYMBOLS) + 1  # state 0 is before a run
SAMPLES, SAMPLE_LENGTH, SEED = 2_000, 32, 1
SMOOTHING = 0.5  # for each symbol
BACKED = 10.0  # symbols that the general frequencies count for after each symbol
MIN_RUN = 16
ODDS = 1e6  # ordinary runs of this length for each random one
PER_SYMBOL = 1.5  # least ratio per symbol: text of a language that was never seen gains less
JOINED = 0.1  # share of words that are taken to be joined, by each joiner
CAPITAL = 0.05  # share of words that are taken to be in capitals
REPEATED = 0.05  # share of symbols that are taken to stand in a line of the same
ORDINARY, RANDOM = 0, 1

_STATE_OF = np.zeros(256, np.uint8)
_STATE_OF[np.frombuffer(SYMBOLS, np.uint8)] = np.arange(1, STATES)
Span = tuple[int, int, int]


@dataclass(frozen=True)
class Model:
    ordinary: np.ndarray  # (state, state) log probability of the next symbol
    random: np.ndarray  # (chain, state, state)


def base_spans(text: str, held: tuple[bool, bool, bool] = (True, True, True)) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans (kind, start, end) of the patterns, and the values in them; `held` says which kinds may be there."""
    spans, values = [], []
    if held[0]:
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= MIN_VALUE:
                spans.append((0, match.start(), match.end()))
                values.append(match.span(2))
    if held[1]:
        spans += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if held[2]:
        spans += [(2, *m.span()) for m in HEX.finditer(text)]
    return spans, values + [span[1:] for span in spans if span[0]]


class _Batch:
    """Texts of a batch as one buffer of states, with the patterns' spans."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        joined = pc.binary_join_element_wise(texts, *(pa.scalar(x, pa.large_string()) for x in ("", "\n")))
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
        raw = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.states = _STATE_OF[raw]
        self.leads = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each code point
        self.first = np.searchsorted(self.leads, self.offsets)  # code points before each text
        held = [pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False) for pattern in _MAY_HOLD]
        self.spans: dict[int, list[Span]] = {}
        self.values: list[tuple[int, int]] = []  # in bytes of the buffer
        for i in np.flatnonzero(held[0] | held[1] | held[2]).tolist():
            spans, values = base_spans(texts[i].as_py(), (held[0][i], held[1][i], held[2][i]))
            if spans:
                self.spans[i] = spans
                self.values += [(self.leads[self.first[i] + a], self.leads[self.first[i] + b]) for a, b in values]

    def transitions(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of each symbol, and its transition as a number."""
        at = np.flatnonzero(self.states)
        before = np.where(at > 0, self.states[at - 1], 0)
        return at, before.astype(np.int32) * STATES + self.states[at]

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends (in bytes) of runs of `MIN_RUN` symbols or more."""
        inside = np.concatenate([[False], self.states != 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        long = edges[1::2] - edges[::2] >= MIN_RUN
        return edges[::2][long], edges[1::2][long]


def count_transitions(docs: DataFrame) -> DataFrame:
    """(label, transition, n) over all documents: `RANDOM` in the patterns' values, `ORDINARY` in other short runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                texts = _Batch(part.column(0))
                at, moves = texts.transitions()
                secret = np.zeros(len(at), bool)
                for a, b in texts.values:
                    secret[np.searchsorted(at, a) : np.searchsorted(at, b)] = True
                edges = np.zeros(len(texts.states) + 1, np.int8)
                starts, ends = texts.runs()
                edges[starts], edges[ends] = 1, -1
                long = np.cumsum(edges, dtype=np.int8)[at] > 0
                counts[ORDINARY] += np.bincount(moves[~(secret | long)], minlength=STATES * STATES)
                counts[RANDOM] += np.bincount(moves[secret], minlength=STATES * STATES)
        label, move = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(move.astype(np.int32)), pa.array(counts[label, move])],
                                         names=["label", "move", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(run, "label int, move int, n long")
    return rows.groupBy("label", "move").agg(F.sum("n").alias("n"))


def _chain(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of the next symbol; after a symbol that was seldom seen, those of symbols in general."""
    moves = counts.reshape(STATES, STATES)[:, 1:]
    general = moves.sum(axis=0) + SMOOTHING
    smooth = moves + BACKED * general / general.sum()
    likely = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return np.concatenate([np.full((STATES, 1), -np.inf), likely], axis=1).astype(np.float32)


def identifier_counts(counts: np.ndarray) -> np.ndarray:
    """Transitions of ordinary strings: those counted, and those of identifiers made of the same words."""
    words = counts.reshape(STATES, STATES).astype(float)
    out = words.copy()
    starts, ends = words[0], np.maximum(words.sum(axis=0) - words.sum(axis=1), 0)
    ends[0] = 0
    lower = _STATE_OF[np.arange(ord("a"), ord("z") + 1)]
    upper = _STATE_OF[np.arange(ord("A"), ord("Z") + 1)]
    capitals = np.zeros_like(words)
    capitals[np.ix_([0, *upper], upper)] = words[np.ix_([0, *lower], lower)]
    out += CAPITAL * capitals
    for begin, end in ((starts, ends), (CAPITAL * capitals[0], CAPITAL * _moved(ends, lower, upper))):
        for joiner in _STATE_OF[np.frombuffer(b"_-/", np.uint8)]:
            out[:, joiner] += JOINED * end
            out[joiner] += JOINED * begin
    camel = _moved(starts, lower, upper)
    out += JOINED * np.outer(ends, camel) / max(camel.sum(), 1)
    return out + np.diag(REPEATED * (out.sum(axis=1) + 10) * (np.arange(STATES) > 0))


def _moved(values: np.ndarray, source: np.ndarray, target: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    out[target] = values[source]
    return out


def drawn_counts(alphabet: bytes, rng: np.random.Generator) -> np.ndarray:
    """Transitions of random strings over an alphabet."""
    symbols = _STATE_OF[np.frombuffer(alphabet, np.uint8)]
    strings = np.concatenate([np.zeros((SAMPLES, 1), np.int64), rng.choice(symbols, (SAMPLES, SAMPLE_LENGTH))], axis=1)
    return np.bincount((strings[:, :-1] * STATES + strings[:, 1:]).ravel(), minlength=STATES * STATES)


def learn(docs: DataFrame) -> Model:
    """Fit the chains; the driver gets one row per label and transition at most."""
    counts = np.zeros((2, STATES * STATES), np.int64)
    for row in count_transitions(docs).collect():
        counts[row["label"], row["move"]] = row["n"]
    rng = np.random.default_rng(SEED)
    drawn = [drawn_counts(alphabet, rng) for alphabet in ALPHABETS]
    return Model(_chain(identifier_counts(counts[ORDINARY])), np.stack([_chain(c) for c in ([counts[RANDOM]] if counts[RANDOM].any() else []) + drawn]))


def log_ratios(model: Model, moves: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Log likelihood ratio (random to ordinary) of strings given as transitions; `bounds` are their starts in `moves`."""
    if not len(bounds):
        return np.zeros(0)
    chains = np.stack([np.add.reduceat(chain.ravel()[moves], bounds, dtype=np.float64) for chain in model.random])
    peak = chains.max(axis=0)
    mixture = peak + np.log(np.exp(chains - peak).mean(axis=0))
    return mixture - np.add.reduceat(model.ordinary.ravel()[moves], bounds, dtype=np.float64)


def ratio_of(model: Model, string: str) -> float:
    """The log likelihood ratio of one string of `SYMBOLS`."""
    states = np.concatenate([[0], _STATE_OF[np.frombuffer(string.encode(), np.uint8)]]).astype(np.int32)
    return float(log_ratios(model, states[:-1] * STATES + states[1:], np.zeros(1, np.int64))[0])


def _random_spans(model: Model, texts: _Batch, least: float) -> dict[int, list[tuple[int, int, float]]]:
    """(start, end, ratio) in code points of the random runs of each text that has some."""
    starts, ends = texts.runs()
    if not len(starts):
        return {}
    sizes = ends - starts
    bounds = np.cumsum(sizes) - sizes
    places = np.repeat(starts - bounds, sizes) + np.arange(sizes.sum())
    before = np.where(places > 0, texts.states[places - 1], 0)
    before[bounds] = 0
    ratios = log_ratios(model, before.astype(np.int32) * STATES + texts.states[places], bounds)
    out: dict[int, list[tuple[int, int, float]]] = {}
    for i in np.flatnonzero(ratios >= np.maximum(least, PER_SYMBOL * sizes)).tolist():
        doc = int(np.searchsorted(texts.offsets, starts[i], "right")) - 1
        start = int(np.searchsorted(texts.leads, starts[i])) - int(texts.first[doc])
        end = start + int(sizes[i])
        if not any(a <= start and end <= b for _, a, b in texts.spans.get(doc, ())):
            out.setdefault(doc, []).append((start, end, float(ratios[i])))
    return out


def scan(docs: DataFrame, model: Model, odds: float = ODDS) -> DataFrame:
    """`docs` with `found`: spans (kind, start, end, score) of every text; the score of a pattern is null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "found"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text_or_empty().alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, found array<struct<kind:string,start:long,end:long,score:double>>"
    least = float(np.log(odds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                texts = _Batch(part.column(1))
                extra = _random_spans(shared.value, texts, least)
                spans: list[tuple] = []
                bounds = np.zeros(part.num_rows + 1, np.int32)
                for doc in sorted({*texts.spans, *extra}):
                    own = [(a, kind, b, None) for kind, a, b in texts.spans.get(doc, ())]
                    own += [(a, 3, b, ratio) for a, b, ratio in extra.get(doc, ())]
                    spans += sorted(own)
                    bounds[doc + 1] = len(own)
                fields = [[KINDS[s[1]] for s in spans], [s[0] for s in spans], [s[2] for s in spans], [s[3] for s in spans]]
                found = pa.StructArray.from_arrays(
                    [pa.array(f, t) for f, t in zip(fields, (pa.string(), pa.int64(), pa.int64(), pa.float64()))], ["kind", "start", "end", "score"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(np.cumsum(bounds, dtype=np.int32)), found)],
                                                 names=["row", "found"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in names], "found")


def find_secrets(docs: DataFrame, odds: float = ODDS) -> DataFrame:
    """Learn from all documents, then scan them."""
    return scan(docs, learn(docs), odds)


def listed(found: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    one = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each span (overlapping ones as one) replaced by the name of its kind in brackets."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(found, start, add, rest)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts per kind and the digest of the patterns' spans of each document."""
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = listed(F.filter("found", lambda s: s["kind"] != KINDS[3]))
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), count("random").alias("n_random"),
    )
