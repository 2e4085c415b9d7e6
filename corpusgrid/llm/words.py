"""Words and word shingles of Arrow text columns, hashed with array operations.

A word is a maximal run of the bytes of a class in the lower-cased UTF-8 text: bytes of
non-ASCII characters count as word bytes. The hash of a word is a polynomial over its
bytes modulo 2^64, taken from running sums, then mixed; so no Python object is made per
word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = 5


def byte_class(ascii_letters_only: bool) -> np.ndarray:
    allowed = np.zeros(256, bool)
    allowed[128:] = True
    allowed[ord("a"):ord("z") + 1] = True
    if not ascii_letters_only:
        allowed[ord("0"):ord("9") + 1] = True
    return allowed


LETTERS, ALNUM = byte_class(True), byte_class(False)
_POWERS = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _POWERS["n"]:
        size = max(n, 1 << 20)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        steps = np.full(size, BASE, np.uint64)
        steps[0] = 1
        back = np.full(size, inverse, np.uint64)
        back[0] = 1
        _POWERS.update(n=size, up=np.cumprod(steps, dtype=np.uint64), down=np.cumprod(back, dtype=np.uint64))
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, on a fresh array."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_slices(texts: pa.Array, limit: int = 1_000_000):
    """(first row, slice) with about ``limit`` bytes each; a longer text is a slice of its own."""
    n = len(texts)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if n else []
    start = 0
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


class Words:
    """The words of a slice: ``hash``, ``start``, ``end`` (bytes of ``data``), ``bounds`` of each text's words."""

    def __init__(self, texts: pa.Array, allowed: np.ndarray = ALNUM):
        lowered = pc.utf8_lower(pc.fill_null(texts, ""))
        lowered = pa.concat_arrays([lowered.cast(pa.large_string())])
        n = len(lowered)
        offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset:lowered.offset + n + 1]
        raw = lowered.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        self.data, self.offsets = data, offsets - offsets[0]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = allowed[data]
        first = np.zeros(len(data) + 1, bool)  # a text begins here
        first[self.offsets] = True
        is_in, was_in = inside[1:].astype(bool), inside[:-1].astype(bool)
        self.start = np.flatnonzero(is_in & (~was_in | first))
        self.end = np.flatnonzero(was_in & (~is_in | first))
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.bounds = np.searchsorted(self.start, self.offsets)

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times) of the distinct shingles of each text, sorted; shingles have 48 bits.

    A text with fewer words than ``width`` has its whole word sequence as one shingle; a
    text without words has none.
    """
    n = len(words.hash)
    counts = np.diff(words.bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    left = words.bounds[1:][text] - np.arange(n) if n else np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        part = np.zeros(n, np.uint64)
        part[:n - k] = words.hash[k:] + np.uint64(k + 1)
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(left > k, part, np.uint64(0))
    at_start = np.zeros(n, bool)
    at_start[words.bounds[:-1][counts > 0]] = True
    chosen = (left >= width) | (at_start & (counts[text] < width) if n else at_start)
    key = (text[chosen].astype(np.uint64) << np.uint64(48)) | (mix(total[chosen]) >> np.uint64(16))
    key.sort()
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(new, len(key)))
    return (key[new] >> np.uint64(48)).astype(np.int64), key[new] & np.uint64((1 << 48) - 1), times
