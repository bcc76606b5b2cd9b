"""Recompression of word sequences: equal passages get equal symbols inside, wherever they stand.

Runs of a word and then, round by round, pairs of neighbouring symbols are given new names.
A name is a fingerprint of what it stands for, so every task of a Spark job gives the same
name to the same run or pair, and a round needs no exchange of names. Which pairs a round
joins depends on the two symbols alone (one must fall into the left class, the other into the
right class); for each symbol the number of words to its left and right that its making
looked at is kept. A symbol whose words and looked-at words lie within a passage is thus found
in every copy of the passage.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

ROUNDS = 5
LONGEST = 12
LONGEST_RUN = 3
BLOCK = 1 << 20
NO_ANCHOR = np.iinfo(np.int64).max

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each number (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@cache
def _powers(size: int, inverse: bool) -> np.ndarray:
    return np.cumprod(np.concatenate([[U(1)], np.full(size - 1, BASE_INVERSE if inverse else BASE)]), dtype=np.uint64)


def powers(size: int, inverse: bool = False) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    return _powers(1 << max(10, int(size - 1).bit_length()), inverse)[:size]


class Ranges:
    """Fingerprints of ranges of a sequence of numbers, from sums of its beginnings."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(len(values)), out=self.sums[1:])
        self.back = powers(len(values) + 1, inverse=True)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def word_fingerprints(text: bytes) -> np.ndarray:
    """A 64-bit fingerprint of every word of the text, in order."""
    found, at = [], 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        while end < len(text) and not WHITE[text[end]]:
            end += 1
        data = np.frombuffer(text, np.uint8, end - at, at)
        edge = np.flatnonzero(np.diff(~WHITE[data], prepend=False, append=False))
        if len(edge):
            found.append(Ranges(BYTE_VALUES[data]).of(edge[::2], edge[1::2]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


@dataclass
class Symbols:
    """Symbols in text order: names, first word, word behind the last, words looked at on both sides."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    left: np.ndarray
    right: np.ndarray


def run_symbols(words: np.ndarray, apart: np.ndarray) -> Symbols:
    """Words, with runs of up to ``LONGEST_RUN`` equal words as one symbol; ``apart`` marks first words of documents."""
    n = len(words)
    begins = np.concatenate([[True], (words[1:] != words[:-1]) | apart[1:]])
    first = np.flatnonzero(begins)
    length = np.diff(first, append=n)
    each = np.repeat(length, length)
    keep = begins | (each > LONGEST_RUN)
    starts = np.flatnonzero(keep)
    size = np.where(each[starts] > LONGEST_RUN, 1, each[starts])
    names = np.where(size > 1, mixed(words[starts] + size.astype(np.uint64) * BASE), words[starts])
    looked = np.where(each[starts] > LONGEST_RUN, LONGEST_RUN, 1)
    return Symbols(names, starts, starts + size, looked, looked.copy())


def pair_round(symbols: Symbols, apart: np.ndarray, turn: int, longest: int = LONGEST) -> Symbols:
    """One round: each left-class symbol followed by a right-class one becomes a symbol with it."""
    names, starts, ends, left, right = symbols.names, symbols.starts, symbols.ends, symbols.left, symbols.right
    if len(names) < 2:
        return symbols
    size = ends - starts
    rightmost = mixed(names + powers(turn + 2)[turn + 1]) >> U(63) == 1
    edge = apart[starts[1:]]
    joined = ~rightmost[:-1] & rightmost[1:] & ~edge & (size[:-1] + size[1:] <= longest)

    new_left, new_right = left.copy(), right.copy()
    # A right-class symbol stays apart from the one before it: that one was looked at.
    i = np.flatnonzero(rightmost[1:] & ~joined & ~edge) + 1
    new_left[i] = np.maximum(new_left[i], size[i - 1] + left[i - 1])
    new_right[i] = np.maximum(new_right[i], right[i - 1] - size[i])
    # A left-class symbol stays apart from the one behind it.
    i = np.flatnonzero(~rightmost[:-1] & ~joined & ~edge)
    new_right[i] = np.maximum(new_right[i], size[i + 1] + right[i + 1])
    new_left[i] = np.maximum(new_left[i], left[i + 1] - size[i])
    # At a document's ends the end itself was looked at.
    i = np.flatnonzero(edge)
    new_right[i] = np.maximum(new_right[i], 1)
    new_left[i + 1] = np.maximum(new_left[i + 1], 1)

    a = np.flatnonzero(joined)
    b = a + 1
    names = names.copy()
    names[a] = mixed(names[a] * BASE + (names[b] ^ (names[b] >> U(29))))
    new_left[a] = np.maximum(left[a], left[b] - size[a])
    new_right[a] = np.maximum(right[b], right[a] - size[b])
    new_ends = ends.copy()
    new_ends[a] = ends[b]
    keep = np.ones(len(names), bool)
    keep[b] = False
    return Symbols(names[keep], starts[keep], new_ends[keep], new_left[keep], new_right[keep])


def recompress(words: np.ndarray, apart: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = run_symbols(words, apart)
    for turn in range(rounds):
        symbols = pair_round(symbols, apart, turn)
    return symbols


@dataclass
class Anchored:
    """Stretches of windows that hang on one anchor: its key, the first window, how many, and their words' fingerprint."""

    keys: np.ndarray
    first: np.ndarray
    count: np.ndarray
    content: np.ndarray


def anchored_windows(words: np.ndarray, apart: np.ndarray, window: int, rounds: int = ROUNDS) -> Anchored:
    """Every window of every document, grouped by its anchor.

    A window's anchor is the symbol of the least rank among those whose words and looked-at
    words lie in the window, the first one of equals; the window's words alone decide it. A
    window without such a symbol is its own anchor. The key is a fingerprint of the words that
    the anchor stands for and looked at.
    """
    n = len(words)
    starts_at = np.flatnonzero(apart)
    doc_start = np.repeat(starts_at, np.diff(starts_at, append=n))
    doc_end = np.repeat(np.append(starts_at[1:], n), np.diff(starts_at, append=n))
    valid = np.arange(n) + window <= doc_end
    symbols = recompress(words, apart, rounds)
    low = np.maximum(doc_start[symbols.starts], symbols.ends + symbols.right - window)
    high = np.minimum(doc_end[symbols.starts] - window, symbols.starts - symbols.left)
    serves = np.flatnonzero(low <= high)
    low, high = low[serves], high[serves]
    rank = mixed(symbols.names[serves] ^ BASE)

    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    anchor = np.full(n, NO_ANCHOR, np.int64)
    numbers = np.arange(len(serves))
    for step in range(2):
        live = numbers
        for offset in range(window):
            live = live[low[live] + offset <= high[live]]
            if not len(live):
                break
            at = low[live] + offset
            if step == 0:
                np.minimum.at(least, at, rank[live])
            else:
                won = least[at] == rank[live]
                np.minimum.at(anchor, at[won], live[won])

    ranges = Ranges(words)
    at = np.flatnonzero(valid)
    if not len(at):
        empty = np.zeros(0, np.uint64)
        return Anchored(empty, at, at, empty)
    own = anchor[at]
    alone = own == NO_ANCHOR
    begins = np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1) | alone[1:] | apart[at[1:]]])
    first = at[begins]
    count = np.diff(np.flatnonzero(begins), append=len(at))
    own, alone = own[begins], alone[begins]
    chosen = serves[np.where(alone, 0, own)] if len(serves) else np.zeros(len(own), np.int64)
    key_from = np.where(alone, first, symbols.starts[chosen] - symbols.left[chosen])
    key_to = np.where(alone, first + window, symbols.ends[chosen] + symbols.right[chosen])
    offset = np.where(alone, 0, symbols.left[chosen])
    keys = mixed(ranges.of(key_from, key_to) + (offset + 1).astype(np.uint64) * BASE)
    place = np.where(alone, 0, symbols.starts[chosen] - first + 1)
    content = mixed(ranges.of(first, first + count + window - 1) + place.astype(np.uint64) * BASE)
    return Anchored(keys, first, count, content)


def window_fingerprints(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    return Ranges(words).of(starts, starts + window)
