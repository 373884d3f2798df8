"""Word tables over vocabularies of the tokenizers library: its results, with each distinct word encoded once."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

from tidemark.llm.pretokens import WordTable, byte_level_starts, lower_word_starts

# Letters up to U+024F are composed already, and each has one lower-case form (save U+0130): texts of these
# only are lower-cased in one go. All other texts are left to the library as a whole.
_SIMPLE = regex.compile(r"[\x00-įı-ɏ‐-‧‰-⁞]*")

_JOINED = 1_000  # words of one text


@lru_cache(maxsize=4)
def word_table(path: str) -> WordTable:
    """A table for a byte-level or a lower-casing word tokenizer file, once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def words(values: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(values, add_special_tokens=False)]

    def text(value: str) -> list[int]:
        return tokenizer.encode(value, add_special_tokens=False).ids

    def plain(value: str) -> bool:
        return not any(s in value for s in special)

    line = text("\n")

    def joined(values: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """One text of many words, a line feed between them: it is a pre-token and an id of its own beside all words
        but those of white space. None if it is not."""
        blank = [i for i, v in enumerate(values) if v.isspace() or not v]
        alone = words([values[i] for i in blank])
        known = set(blank)
        rest = [v for i, v in enumerate(values) if i not in known] if known else values
        batch = ["\n".join(rest[i : i + _JOINED]) + "\n" for i in range(0, len(rest), _JOINED)]
        ids = np.fromiter(chain.from_iterable(words(batch)), np.int32)
        ends = np.flatnonzero(ids == line[0])
        if len(ends) != len(rest) or (len(ends) and ends[-1] != len(ids) - 1):
            return None
        counts, own = np.zeros(len(values), np.int64), np.ones(len(values), bool)
        own[blank] = False
        counts[own] = np.diff(ends, prepend=-1) - 1
        counts[blank] = [len(a) for a in alone]
        out, mine = np.empty(int(counts.sum()), np.int32), np.repeat(own, counts)
        out[mine] = ids[ids != line[0]]
        out[~mine] = np.fromiter(chain.from_iterable(alone), np.int32)
        return out, counts

    if tokenizer.normalizer is None:
        apart = len(line) == 1 and not any("\n" in s for s in special)
        return WordTable(byte_level_starts, words, plain, text, encode_joined=joined if apart else None)
    return WordTable(
        lower_word_starts, words, lambda v: plain(v) and _SIMPLE.fullmatch(v) is not None, text,
        prepare=str.lower, drop_spaces=True,
    )
