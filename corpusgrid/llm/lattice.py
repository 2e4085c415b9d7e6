"""The lattice of a fixed public piece vocabulary, for many words at once.

A word is the space mark followed by its letters. All ways to cut it into pieces are
summed by a forward pass over positions, for many words and several languages at a time.
A letter that no piece covers counts as a piece of a fixed small probability. Sums carry
a factor ``SCALE`` per position (a power of two, so it rounds nothing), which keeps a
word of ``LONGEST_WORD`` uncovered letters far from the least float; longer words are
scaled position by position.
"""

from __future__ import annotations

import numpy as np

from corpusgrid.llm.tokens import vocabulary_path
from corpusgrid.llm.words import mix

SPACE = "▁"
UNKNOWN = 1e-9
LONGEST_WORD = 40
SCALE = 2.0 ** 20
LONG_CELLS = 200_000  # letters of long words that are fitted side by side
BITS = 18
_HASH = np.uint64(0x9FB21C651E98DF25)


def load_pieces(path: str | None = None) -> list[str]:
    """The pieces of the vocabulary by id."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path("piece_bpe_32k.model"))
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def word_pieces(path: str | None = None) -> list[str]:
    """Pieces that lower-case words can hold, without duplicates."""
    return [p for p in load_pieces(path) if p.removeprefix(SPACE).isalpha() and p == p.lower() or p == SPACE]


def code(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in rows padded with zeros, and lengths; the space mark comes first."""
    lengths = np.array([len(w) + 1 for w in words])
    codes = np.zeros((len(words), int(lengths.max(initial=1))), np.uint64)
    flat = np.frombuffer("".join(SPACE + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    codes[row, column] = flat
    return codes, lengths


class Lattice:
    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.scales = SCALE ** np.array([*map(len, pieces), 1.0])
        keys = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = ((h + ord(c)) * int(_HASH)) % (1 << 64)
            keys[i] = h
        mixed = mix(keys)
        order = np.argsort(mixed)
        self.keys, self.ids = keys[order], order.astype(np.int32)
        self.slots = np.searchsorted(mixed[order], np.arange(1 << BITS, dtype=np.uint64) << np.uint64(64 - BITS))
        self.slots = np.append(self.slots, len(pieces)).astype(np.int32)
        self.depth = int(np.diff(self.slots).max())

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece number of each substring hash, or the number of pieces if there is none."""
        bucket = (mix(keys) >> np.uint64(64 - BITS)).astype(np.int64)
        at, end = self.slots[bucket], self.slots[bucket + 1]
        out = np.full(len(keys), len(self.pieces), np.int32)
        for _ in range(self.depth):
            live = np.flatnonzero(at < end)
            if not len(live):
                break
            hit = self.keys[at[live]] == keys[live]
            out[live[hit]] = self.ids[at[live[hit]]]
            at[live] += 1
        return out

    def edges(self, codes: np.ndarray, lengths: np.ndarray):
        """(end, length, rows, piece numbers) of every piece and every unknown letter, by end."""
        for end in range(1, codes.shape[1] + 1):
            rows = np.flatnonzero(lengths >= end)
            for size in range(1, min(self.longest, end) + 1):
                key = np.zeros(len(rows), np.uint64)
                for k in range(end - size, end):
                    key = (key + codes[rows, k]) * _HASH
                piece = self.find(key)
                if size > 1:
                    hit = piece < len(self.pieces)
                    yield end, size, rows[hit], piece[hit]
                else:
                    yield end, size, rows, piece

    def forward(self, edges: list, n: int, width: int, table: np.ndarray) -> np.ndarray:
        """``alpha[position, word, language]``: summed products of ``table`` over all ways to reach a position."""
        alpha = np.zeros((width + 1, n, table.shape[1]))
        alpha[0] = 1.0
        for end, size, rows, piece in edges:
            alpha[end, rows] += alpha[end - size, rows] * table[piece]
        return alpha

    def log_likelihood(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language; ``table`` is (pieces + 1, languages).

        Words beyond ``LONGEST_WORD`` letters go one by one through a bounded ring of positions.
        """
        out = np.zeros((len(words), table.shape[1]))
        scaled = table * self.scales[:, None]
        sizes = np.array([len(w) for w in words])
        for low, high in ((0, 6), (6, 10), (10, 16), (16, LONGEST_WORD)):
            group = np.flatnonzero((sizes > low) & (sizes <= high) if low else sizes <= high)
            for a in range(0, len(group), 8192):
                some = group[a:a + 8192]
                codes, lengths = code([words[i] for i in some])
                alpha = self.forward(list(self.edges(codes, lengths)), len(some), codes.shape[1], scaled)
                out[some] = np.log(alpha[lengths, np.arange(len(some))]) - (lengths * np.log(SCALE))[:, None]
        for i in np.flatnonzero(sizes > LONGEST_WORD):
            out[i] = self.long_word(words[i], table)
        return out

    def long_word(self, word: str, table: np.ndarray) -> np.ndarray:
        """One word of any length, with a ring of the last positions and a running scale."""
        names = {p: i for i, p in enumerate(self.pieces)}
        text, ring, scale = SPACE + word, {0: np.ones(table.shape[1])}, np.zeros(table.shape[1])
        for end in range(1, len(text) + 1):
            total = np.zeros(table.shape[1])
            for size in range(1, min(self.longest, end) + 1):
                piece = names.get(text[end - size:end], len(self.pieces) if size == 1 else None)
                if piece is not None:
                    total += ring[end - size] * table[piece]
            ring[end] = total
            ring.pop(end - self.longest, None)
            if total.min() < 1e-200:
                scale += np.log(total)
                ring = {k: v / total for k, v in ring.items()}
        return np.log(ring[len(text)]) + scale

    def expected(self, words: list[str], counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over all segmentations (forward and backward)."""
        total = np.zeros(len(self.pieces) + 1)
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        long = order[sizes[order] > LONGEST_WORD]
        while len(long):
            some = long[:max(1, int(((sizes[long] + 1) * np.arange(1, len(long) + 1) <= LONG_CELLS).sum()))]
            total += self.expected_long([words[i] for i in some], counts[some], probability)
            long = long[len(some):]
        short = np.flatnonzero(sizes <= LONGEST_WORD)
        words, counts = [words[i] for i in short], counts[short]
        scaled = probability * self.scales
        table = scaled[:, None]
        for a in range(0, len(words), 8192):
            codes, lengths = code(words[a:a + 8192])
            n, edges = len(lengths), list(self.edges(codes, lengths))
            alpha = self.forward(edges, n, codes.shape[1], table)[:, :, 0]
            beta = np.zeros_like(alpha)
            beta[lengths, np.arange(n)] = 1.0
            for end, size, rows, piece in reversed(edges):
                beta[end - size, rows] += beta[end, rows] * scaled[piece]
            weight = counts[a:a + 8192] / alpha[lengths, np.arange(n)]
            for end, size, rows, piece in edges:
                use = alpha[end - size, rows] * scaled[piece] * beta[end, rows] * weight[rows]
                total += np.bincount(piece, use, len(total))
        return total

    def expected_long(self, words: list[str], counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """``expected`` of words of any length: each position is scaled to 1, and the way back
        follows the share of each last piece, so nothing under- or overflows."""
        codes, lengths = code(words)
        n, width = codes.shape
        none = len(self.pieces)
        pieces = np.full((width + 1, n, self.longest), none, np.int32)
        shares = np.zeros((width + 1, n, self.longest))
        for size in range(1, min(self.longest, width) + 1):
            key = np.zeros((n, width - size + 1), np.uint64)
            for k in range(size):
                key = (key + codes[:, k:width - size + 1 + k]) * _HASH
            found = self.find(key.reshape(-1)).reshape(key.shape).T
            pieces[size:, :, size - 1] = found
            shares[size:, :, size - 1] = probability[found] if size == 1 else np.where(found < none, probability[found], 0.0)
        last = np.zeros((n, self.longest))  # earlier sums beside that of the position before, which is 1
        last[:, 0] = 1.0
        for end in range(1, width + 1):
            shares[end] *= last
            whole = shares[end].sum(1, keepdims=True)
            shares[end] /= whole
            last[:, 1:] = last[:, :-1] / whole
            last[:, 0] = 1.0
        use = np.zeros((width + 1, n))  # how often a position ends a piece
        use[lengths, np.arange(n)] = counts
        for end in range(width, 0, -1):
            shares[end] *= use[end][:, None]
            reach = min(self.longest, end)
            use[end - reach:end] += shares[end][:, :reach][:, ::-1].T
        return np.bincount(pieces.reshape(-1), shares.reshape(-1), none + 1)
