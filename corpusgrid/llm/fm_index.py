"""A two-way FM-index of one shard, with intervals extended on either side at once.

The text is a sequence of symbols, 0 between pieces. Its rotations are sorted by their
first ``DEPTH`` symbols; the symbols before them, in that order, are the transform (BWT).
Equal starts stay in any order, as intervals of phrases of at most ``DEPTH`` symbols do
not depend on it. A second transform holds the reversed text. A phrase has an interval in
both, of one size: its count. Extending it to the left reads its stretch of the first
transform, where each symbol met leads to an interval (by the last-to-first mapping), and
the counts of smaller symbols tell the interval in the second one; to the right the two
change roles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH, BLOCK = 6, 1 << 18


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of the distinct keys."""
    order = np.argsort(keys).astype(np.int32)
    ordered = keys[order]
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]), dtype=np.int32)
    return rank


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys in the order of (first, second)."""
    key = first.astype(np.int64)
    key *= int(second.max(initial=0)) + 1
    key += second
    return key


def transform(symbols: np.ndarray) -> np.ndarray:
    """The symbols before the rotations, which are sorted by their first ``DEPTH`` symbols."""
    two = dense(pairs(symbols, np.roll(symbols, -1)))
    four = dense(pairs(two, np.roll(two, -2)))
    order = np.argsort(pairs(four, np.roll(two, -4)))
    return symbols[order - 1]


@dataclass
class Phrases:
    """Phrases of one length: intervals ``lo`` in the transform and ``back`` in the reversed one, of ``size``.

    ``base`` and ``symbol`` tell which phrase was extended by what.
    """

    lo: np.ndarray
    back: np.ndarray
    size: np.ndarray
    base: np.ndarray
    symbol: np.ndarray

    def __len__(self) -> int:
        return len(self.lo)

    def of(self, kept: np.ndarray) -> Phrases:
        return Phrases(*(c[kept] for c in (self.lo, self.back, self.size, self.base, self.symbol)))


def spans(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the interval, place) of every place of the intervals."""
    which = np.repeat(np.arange(len(lo)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which]


def inside(lo: np.ndarray, size: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether each place lies in one of the disjoint intervals."""
    order = np.argsort(lo)
    lo, stop = lo[order], (lo + size)[order]
    at = np.searchsorted(lo, places, side="right") - 1
    return (at >= 0) & (places < stop[at]) if len(lo) else np.zeros(len(places), bool)


class FmIndex:
    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.forward, self.backward = forward, backward

    @classmethod
    def of(cls, symbols: np.ndarray) -> FmIndex:
        return cls(transform(symbols), transform(symbols[::-1]))

    def single(self) -> Phrases:
        """Every symbol but 0 as a phrase of its own; ``base`` is its place in this list."""
        counts = np.bincount(self.forward)
        lo = np.cumsum(counts) - counts
        symbol = np.flatnonzero(counts)
        symbol = symbol[symbol > 0]
        return Phrases(lo[symbol], lo[symbol], counts[symbol], np.arange(len(symbol)), symbol)

    def extend(self, phrases: Phrases, left: bool) -> Phrases:
        """All phrases one symbol longer on that side, of those whose other part is among ``phrases`` too."""
        bwt = self.forward if left else self.backward
        lo, back = (phrases.lo, phrases.back) if left else (phrases.back, phrases.lo)
        to_first = np.empty(len(bwt), np.int32)  # the last-to-first mapping
        to_first[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)
        kinds, ends, found, start = int(bwt.max(initial=0)) + 1, np.cumsum(phrases.size), [], 0
        while start < len(phrases):  # some intervals at a time, for bounded memory
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
            which, place = spans(lo[start:stop], phrases.size[start:stop])
            key = which * kinds + bwt[place]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            base, symbol = key[first] // kinds + start, key[first] % kinds
            new_lo, smaller = to_first[place[order[first]]], first + done - (ends - phrases.size)[base]
            kept = (symbol > 0) & inside(lo, phrases.size, new_lo)
            columns = new_lo, back[base] + smaller, np.diff(np.append(first, len(key))), base, symbol
            found.append([c[kept] for c in columns])
            start = stop
        new_lo, new_back, size, base, symbol = map(np.concatenate, zip(*found)) if found else np.zeros((5, 0), np.int64)
        new_lo, new_back = (new_lo, new_back) if left else (new_back, new_lo)
        return Phrases(new_lo, new_back, size, base, symbol)
