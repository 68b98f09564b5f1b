"""Quality rules by suffix-array repetition.

Within a slice of documents the words of each text are sorted as suffixes by prefix
doubling (only groups of still equal suffixes are sorted again). Neighbours in the suffix
array give the longest common prefixes; a suffix whose longest common prefix with a
neighbour has at least ``window`` words is an occurrence of a repeated substring. The
union of these spans and the longest of them are limited.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from graniteflow.llm.batches import add_columns, keep_rows

WINDOW = 8
MIN_WORDS = 20
#: Percent of the words that repeats may cover, and that the longest repeat may have.
MAX_COVERED, MAX_LONGEST = 30, 15
COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, longest_repeat bigint, "
    "base_failed boolean, kept boolean"
)
_SPACE = b"\t\n\x0b\x0c\r "
_NO_CHARS = bytes(range(0x80, 0xC0)) + _SPACE
_SYMBOLS = b"#*$%&|<>"


def repeat_lengths(symbols: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For each word the longest prefix of its suffix that occurs elsewhere in its document, or 0 below ``window``.

    ``symbols`` numbers the words of all documents one after another and ``owner`` the
    document of each. Ranks are indices into the suffix array of all of them.
    """
    n = len(symbols)
    best = np.zeros(n, np.int64)
    if not n:
        return best
    # A unique end after each document keeps matches inside it.
    last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
    ends = last + 1 + np.arange(len(last))
    size = n + len(last)
    word = np.ones(size, bool)
    word[ends] = False
    key = np.empty(size, np.int64)
    key[word] = owner * (int(symbols.max()) + 2) + symbols + 1
    key[ends] = np.arange(len(last)) * (int(symbols.max()) + 2)

    def regroup(at: np.ndarray, keys: np.ndarray, bases: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted positions, their new ranks, and whether others share the rank."""
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        new = np.append(True, keys[1:] != keys[:-1])
        starts = np.flatnonzero(new)
        if bases is None:
            ranks = np.repeat(starts, np.diff(starts, append=len(at)))
        else:  # ranks stay within the group that is refined
            old = bases[order]
            group = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
            offset = np.arange(len(at)) - np.repeat(group, np.diff(group, append=len(at)))
            ranks = old + np.repeat(offset[starts], np.diff(starts, append=len(at)))
        shared = ~(new & np.append(new[1:], True))
        return at, ranks, shared

    at, ranks, shared = regroup(np.arange(size), key, None)
    rank = np.empty(size, np.int64)
    rank[at] = ranks
    levels, live, h = [rank.copy()], np.sort(at[shared]), 1
    while len(live):
        at, ranks, shared = regroup(live, rank[live] * size + rank[live + h], rank[live])
        rank[at] = ranks
        levels.append(rank.copy())
        live, h = np.sort(at[shared]), 2 * h
    suffixes = np.empty(size, np.int64)
    suffixes[rank] = np.arange(size)
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(size - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        inside = (i < size) & (j < size)
        same = np.zeros(size - 1, bool)
        same[inside] = levels[k][i[inside]] == levels[k][j[inside]]
        common[same] += 1 << k
    longest = np.zeros(size, np.int64)
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    longest[longest < window] = 0
    return longest[word]


def measure(texts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, longest_repeat of each text."""
    split = [t.split() for t in texts]
    numbers: dict[bytes, int] = {}
    counts = np.fromiter(map(len, split), np.int64, len(split))
    symbols = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(split)), np.int64, int(counts.sum()))
    owner = np.repeat(np.arange(len(split)), counts)
    length = repeat_lengths(symbols, owner, window)
    spans = np.zeros(len(symbols) + 1, np.int64)
    starts = np.flatnonzero(length)
    np.add.at(spans, starts, 1)
    np.add.at(spans, starts + length[starts], -1)
    covered = np.cumsum(spans[:-1]) > 0
    repeated = np.bincount(owner[covered], minlength=len(split)).astype(np.int64)
    longest = np.zeros(len(split), np.int64)
    np.maximum.at(longest, owner[starts], length[starts])
    chars = [len(t.translate(None, _NO_CHARS)) for t in texts]
    signs = [len(t) - len(t.translate(None, _SYMBOLS)) for t in texts]
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    return [counts, np.array(chars, np.int64), np.array(signs, np.int64), np.array([len(x) - len(set(x)) for x in lines], np.int64), repeated, longest]


def verdicts(
    texts: list[bytes], window: int = WINDOW, min_words: int = MIN_WORDS, max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> list[np.ndarray]:
    """The ``COLUMNS`` of each text."""
    n_words, chars, signs, dup, repeated, longest = measure(texts, window)
    failed = (n_words < min_words) | (100 * repeated > 30 * n_words)
    kept = ~failed & (100 * repeated <= max_covered * n_words) & (100 * longest <= max_longest * n_words)
    return [n_words, chars, signs, dup, repeated, longest, failed, kept]


def judge(
    df: DataFrame, text_col: str = "text", keep: list[str] | None = None, window: int = WINDOW, min_words: int = MIN_WORDS,
    max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """``keep`` columns and ``COLUMNS`` for every row; rows are neither moved nor merged.

    A null text counts as empty: all measures 0, ``base_failed`` true. ``kept`` is false if
    ``base_failed``, if repeats cover more than ``max_covered`` percent of the words, or if
    the longest has more than ``max_longest`` percent of them. The whole text is measured.
    """

    compute = lambda texts: verdicts(texts, window, min_words, max_covered, max_longest)
    return add_columns(df, text_col, COLUMNS, lambda: compute, keep if keep is not None else ["doc_id"])


def keep_passing(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with all their columns."""
    return keep_rows(df, text_col, lambda: lambda texts: verdicts(texts)[-1])
