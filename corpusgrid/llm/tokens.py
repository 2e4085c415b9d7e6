"""Token ids of whole texts with a public byte-level BPE vocabulary.

A whole text goes through one call of a coder with the vocabulary's ranks and word
pattern. Texts with a special token's string or with a long run of white space, which the
pattern would search back and forth, go to the ``tokenizers`` library, which defines the ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import cached_property

import numpy as np

CACHE_LIMIT = 200_000
SPECIAL, LONG_SPACE = "<|endoftext|>", re.compile(r"\s{200}")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkIds:
    """Ids of chunks of text, each encoded once while it is kept; the number kept is bounded.

    A Python worker lives on after a task, so tasks call ``forget`` at their end.

    ``encode`` takes new chunks and returns their ids one after another, and their counts.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = CACHE_LIMIT):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def learn(self, chunks: list[str]) -> None:
        ids, sizes = self.encode(chunks)
        n, need = len(self.place), self.used + len(ids)
        self.flat = grown(self.flat, need)
        self.starts, self.sizes = grown(self.starts, n + len(chunks)), grown(self.sizes, n + len(chunks))
        self.flat[self.used:need] = ids
        self.sizes[n:n + len(chunks)] = sizes
        self.starts[n:n + len(chunks)] = self.used + np.cumsum(sizes) - sizes
        self.place.update(zip(chunks, range(n, n + len(chunks))))
        self.used = need

    def gather(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of chunks; new chunks of all lists are encoded first."""
        met: set[str] = set()
        for chunks in texts:
            met.update(chunks)
        fresh = met.difference(self.place)
        if len(self.place) + len(fresh) > self.limit:
            self.forget()
            fresh = met
        if fresh:
            self.learn(list(fresh))
        out = []
        for chunks in texts:
            at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
            size = self.sizes[at]
            before = np.cumsum(size) - size
            out.append(self.flat[np.repeat(self.starts[at] - before, size) + np.arange(int(size.sum()))])
        return out


def grown(a: np.ndarray, need: int) -> np.ndarray:
    if need <= len(a):
        return a
    out = np.zeros(max(need, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


class ByteBpe:
    """``many(texts)`` equals the library's encoding without added special tokens."""

    def __init__(self, json_path: str | None = None, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken
        self.json_path = json_path or vocabulary_path("byte_bpe_50k.json")
        with open(ranks_path or vocabulary_path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        """The library's own coder, read when a text first needs it."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.json_path)

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL in text or LONG_SPACE.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.words.encode_ordinary(text), np.uint32)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; equal texts of one call are encoded once and share an array."""
        known = {t: self.ids(t) for t in dict.fromkeys(texts)}
        return [known[t] for t in texts]


_CODERS: dict[tuple, ByteBpe] = {}


def coder(json_path: str | None = None, ranks_path: str | None = None) -> ByteBpe:
    """One coder per Python worker, as the vocabulary takes a moment to read."""
    key = (json_path, ranks_path)
    if key not in _CODERS:
        _CODERS[key] = ByteBpe(json_path, ranks_path)
    return _CODERS[key]


def blocks(texts: list, limit: int = 1_000_000):
    """Slices of a list of texts with about ``limit`` characters each; None counts as empty."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
