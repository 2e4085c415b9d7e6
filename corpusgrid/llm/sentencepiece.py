"""Piece encoding by a streaming Viterbi search, and decoding.

The vocabulary is a public file. A piece's log probability is taken from its rank by
Zipf's law, ``-ln(rank + 2.7)``; the best segmentation has the largest sum, and of equal
ones the one whose last pieces are longest. A space is the mark U+2581 and one mark is put
before the text. A character without a piece of its own, and a mark that stands in the
text itself, become byte pieces, so decoding restores every text exactly.

The search keeps scores for as many positions as the longest piece has characters. From
time to time it follows the back pointers of all positions that can still be extended;
where they meet, everything before is committed. No piece holds a mark after another
character, so such a place is always a meeting point: texts are cut there and equal
stretches are searched once per worker.

Defined results: a null or empty text has no ids and decodes to the empty text. Repeated
rows are encoded each. A null ``doc_id`` passes through, as do extra columns the caller
keeps.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from corpusgrid.llm.lattice import SPACE, Lattice, code, load_pieces
from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.tokens import ChunkIds, blocks

STRETCH = re.compile(f"{SPACE}*[^{SPACE}]*", re.S)
HELD = "\udc00"  # stands for a mark of the text itself while encoding; no valid text holds it


class Vocabulary:
    def __init__(self, path: str | None = None):
        pieces = load_pieces(path)
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        for i, p in enumerate(pieces):
            if re.fullmatch("<0x[0-9A-F]{2}>", p):
                self.bytes[int(p[3:5], 16)] = i
                self.text.append(bytes([int(p[3:5], 16)]))
            elif p in ("<unk>", "<s>", "</s>"):
                self.text.append(b"")
            else:
                self.text.append(p.replace(SPACE, " ").encode())
                if not re.search(f"[^{SPACE}]{SPACE}", p):
                    self.ids[p], self.scores[p] = i, -math.log(i - 258 + 2.7)
        self.longest = max(map(len, self.ids))
        self.piece_scores, self.piece_ids = np.array(list(self.scores.values())), np.array(list(self.ids.values()))
        self.byte_score = -math.log(len(pieces)) * 2

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in (SPACE if char == HELD else char).encode()]


class StreamingViterbi:
    """Takes characters one stretch at a time; ``out`` holds the committed ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.out: list[int] = []
        self.buffer, self.base = "", 0  # characters from the last committed boundary on
        self.score, self.back = [0.0], [0]  # of the positions 0..len(buffer)
        self.commits = 0

    def feed(self, text: str) -> None:
        scores, longest, width = self.v.scores, self.v.longest, 4 * self.v.longest
        for char in text:
            self.buffer += char
            end = len(self.buffer)
            best, size = self.score[end - 1] + self.v.byte_score * (3 if char == HELD else len(char.encode())), 0
            for start in range(max(0, end - longest), end):
                s = scores.get(self.buffer[start:end])
                if s is not None and self.score[start] + s > best:
                    best, size = self.score[start] + s, end - start
            self.score.append(best)
            self.back.append(size)
            if end >= width and end % longest == 0:
                self.commit()

    def meeting(self) -> int:
        """The last boundary that the best paths to all extendable positions share."""
        ends = set(range(max(0, len(self.buffer) - self.v.longest + 1), len(self.buffer) + 1))
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - (self.back[last] or 1))
        return ends.pop()

    def emit(self, end: int) -> None:
        ids: list[int] = []
        at = end
        while at:
            size = self.back[at]
            if size:
                ids.append(self.v.ids[self.buffer[at - size:at]])
            else:
                ids += reversed(self.v.fallback(self.buffer[at - 1]))
            at -= size or 1
        self.out += reversed(ids)

    def commit(self) -> None:
        at = self.meeting()
        if at:
            self.emit(at)
            self.commits += 1
            self.buffer, self.back = self.buffer[at:], [0] + self.back[at + 1:]
            self.score = [s - self.score[at] for s in self.score[at:]]

    def finish(self) -> list[int]:
        self.emit(len(self.buffer))
        self.buffer, self.score, self.back = "", [0.0], [0]
        return self.out


def short_paths(v: Vocabulary, lattice: Lattice, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same search for many stretches that fit in the window; each follows one mark.

    Returns the ids one stretch after another, and their counts.
    """
    codes, lengths = code(words)
    n, width = len(words), codes.shape[1]
    score, back = np.full((width + 1, n), -np.inf), np.zeros((width + 1, n), np.int8)
    used = np.full((width + 1, n), len(lattice.pieces), np.int32)
    score[0] = 0.0
    scores = np.append(v.piece_scores, -np.inf)
    for end, size, rows, piece in lattice.edges(codes, lengths):
        here = score[end - size, rows]
        if size == 1:
            char = codes[rows, end - 1]
            octets = 1 + (char >= 0x80).astype(int) + (char >= 0x800) + (char >= 0x10000)
            plain, own = here + v.byte_score * octets, here + scores[piece]
            piece = np.where(own > plain, piece, len(lattice.pieces))
            here = np.maximum(own, plain)
        else:
            here = here + scores[piece]
        better = here >= score[end, rows]
        rows = rows[better]
        score[end, rows], back[end, rows], used[end, rows] = here[better], size, piece[better]
    at, live, steps = lengths.copy(), np.arange(n), []
    while len(live):
        steps.append((live, used[at[live], live], at[live]))
        at[live] -= back[at[live], live]
        live = live[at[live] > 0]
    row, piece, end = (np.concatenate([s[k] for s in reversed(steps)]) for k in range(3))
    order = np.argsort(row, kind="stable")
    row, piece, end = row[order], piece[order], end[order]
    ids = np.append(v.piece_ids, 0)[piece]
    sizes = np.bincount(row, minlength=n)
    bare = np.flatnonzero(piece == len(lattice.pieces))
    if len(bare):  # characters that become several byte pieces
        octets = [v.fallback((SPACE + words[r])[e - 1]) for r, e in zip(row[bare].tolist(), end[bare].tolist())]
        repeat = np.ones(len(ids), np.int64)
        repeat[bare] = [len(o) for o in octets]
        sizes = np.bincount(row, repeat, minlength=n).astype(np.int64)
        wide, is_byte = np.repeat(ids, repeat), np.repeat(piece == len(lattice.pieces), repeat)
        wide[is_byte] = np.concatenate(octets)
        ids = wide
    return ids.astype(np.uint32), sizes


class Encoder:
    def __init__(self, path: str | None = None):
        self.v = Vocabulary(path)
        self.lattice = Lattice(list(self.v.ids))
        self.stretches = ChunkIds(self.encode)

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Stretches without their first mark; long ones go through the streaming search."""
        sizes, count = np.array([len(s) for s in stretches]), np.zeros(len(stretches), np.int64)
        order, flat = [], []
        for low, high in ((-1, 4), (4, 7), (7, 10), (10, 16), (16, 4 * self.v.longest)):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            for a in range(0, len(group), 8192):
                some = group[a:a + 8192]
                ids, count[some] = short_paths(self.v, self.lattice, [stretches[i] for i in some.tolist()])
                order.append(some)
                flat.append(ids)
        for i in np.flatnonzero(sizes > 4 * self.v.longest):
            search = StreamingViterbi(self.v)
            search.feed(SPACE + stretches[i])
            flat.append(np.array(search.finish(), np.uint32))
            order.append(np.array([i]))
            count[i] = len(flat[-1])
        placed, ids = np.concatenate(order), np.concatenate(flat)
        start = np.zeros(len(stretches), np.int64)
        start[placed] = np.cumsum(count[placed]) - count[placed]
        before = np.cumsum(count) - count
        return ids[np.repeat(start - before, count) + np.arange(len(ids))], count

    def many(self, texts: list[str]) -> list[np.ndarray]:
        return self.stretches.gather([cut(t) for t in texts])

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.v.text.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def cut(text: str) -> list[str]:
    """Stretches of a text, each without its first mark."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, HELD)
    if "  " not in text and text[0] != " ":  # every mark starts a stretch of its own
        return text.split(" ")
    return [p[1:] for p in STRETCH.findall(SPACE + text.replace(" ", SPACE)) if p]


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>, ids_crc32`` (little-endian unsigned 32-bit ids) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks(texts):
                found = tool.many([t or "" for t in texts[a:b]])
                ends = np.cumsum([0, *map(len, found)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).astype(np.int32)))
                sums = [zlib.crc32(f.astype("<u4").tobytes()) for f in found]
                yield pa.record_batch([batch.column(0).slice(a, b - a), ids, pa.array(sums, pa.int64())],
                                      names=["doc_id", "ids", "ids_crc32"])
        tool.stretches.forget()
        tidy()

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, ids_crc32 long")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``text`` in place of ``ids``."""
    at = encoded.columns.index("ids")
    schema = StructType([StructField("text", StringType()) if f.name == "ids" else f for f in encoded.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            texts = pa.array([tool.text(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string())
            columns = list(batch.columns)
            columns[at] = texts
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return encoded.mapInArrow(run, schema)
