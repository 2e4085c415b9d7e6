"""Periodic runs of words by an online dynamic program over sparse diagonals.

Diagonal q of a text holds the places i where word i equals word i - q; a run of period q
is a stretch of such places. Each word looks up its earlier occurrences and lengthens the
matches of their lags; a diagonal that was not lengthened has ended, and is emitted at
once if it is long enough. Looking up every earlier occurrence would be quadratic for a
frequent word, so occurrences are those of stretches: for lags in (w/2, w], w a power of
two, the nearest earlier occurrence of the w words that end here. No run is lost or
changed by that:

* a run of period q has 2q matches or more, so w <= 2q of them in a row somewhere;
* inside it the nearest earlier occurrence of w >= q words is q words back, for a nearer
  one would give the stretch a smaller period (Fine and Wilf);
* so a diagonal found this way covers its whole run, and its period is the smallest.

Of each width only stretches whose halves occur twice are looked up, and the widths end
where none does. A text of n words costs O(n log n), whatever it repeats.

Texts are handled each within its row, so nothing is shuffled and a lost task is run again.
Defined results: a null or empty text has no words and no runs; repeated rows give equal
results; with a null ``doc_id`` no words are replaced; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.tokens import blocks

LEAST, TIMES = 24, 3


class Run(NamedTuple):
    start: int
    length: int
    period: int


class Codes(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def earlier_occurrences(codes: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, last place, lag) of the stretches of each width whose nearest earlier one is in its band of lags.

    ``codes`` are the words of some texts one after another, ``text`` the text of each.
    """
    n = len(codes)
    place, name = np.arange(n), codes.astype(np.int64) + text * (int(codes.max(initial=0)) + 1)
    width = 1
    while len(place):
        order = np.argsort(name, kind="stable")
        same = name[order[1:]] == name[order[:-1]]
        here, before = place[order[1:]][same], place[order[:-1]][same]
        band = (here - before <= width) & (2 * (here - before) > width)
        found = np.sort(here[band])
        lag = np.zeros(n, np.int64)
        lag[here] = here - before
        yield width, found + width - 1, lag[found]
        # stretches of twice the width, both halves of which occur more than once
        group = np.concatenate([[0], np.cumsum(~same)])
        repeated = np.zeros(len(order), bool)
        repeated[1:] |= same
        repeated[:-1] |= same
        halves = np.full(n + width, -1, np.int64)
        halves[place[order[repeated]]] = group[repeated]
        first = np.flatnonzero(halves[:n] >= 0)
        place = first[halves[first + width] >= 0]
        name = halves[place] * (int(group[-1]) + 1) + halves[place + width]
        width *= 2


class Diagonals:
    """The active lags of one text; ``step`` is called with places in ascending order."""

    def __init__(self, least: int = LEAST, times: int = TIMES):
        self.least, self.times = least, times
        self.active: dict[int, list[int]] = {}  # lag: first matching word, last one
        self.runs: list[Run] = []

    def step(self, at: int, width: int, lag: int) -> None:
        """The ``width`` words ending with word ``at`` are met ``lag`` words before."""
        self.end(at - 1)
        match = self.active.get(lag)
        if match is None:
            self.active[lag] = [at - width + 1, at]
        else:
            match[1] = at

    def end(self, before: int) -> None:
        """Emits the diagonals that no word from ``before`` on has lengthened."""
        for lag in [q for q, (_, last) in self.active.items() if last < before]:
            first, last = self.active.pop(lag)
            length = last - first + 1 + lag
            if length >= max(self.least, self.times * lag):
                self.runs.append(Run(first - lag, length, lag))


def runs_of(words: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """The runs of each array of word codes, by start and then period; ``times`` is 3 or more."""
    if times < 3:
        raise ValueError("a run holds three periods or more, or its stretches could be missed")
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(words)), sizes)
    codes = np.concatenate(words) if len(words) else np.zeros(0, np.int64)
    widths, places, lags = [], [], []
    for width, at, lag in earlier_occurrences(codes, text):
        widths.append(np.full(len(at), width))
        places.append(at)
        lags.append(lag)
    found = [Diagonals(least, times) for _ in words]
    if places:
        at = np.concatenate(places)
        order = np.argsort(at, kind="stable")
        at, width, lag = at[order], np.concatenate(widths)[order], np.concatenate(lags)[order]
        owner = text[at]
        for t, i, w, q in zip(owner.tolist(), (at - starts[owner]).tolist(), width.tolist(), lag.tolist()):
            found[t].step(i, w, q)
    for diagonals, size in zip(found, sizes.tolist()):
        diagonals.end(size)
    return [sorted(d.runs, key=itemgetter(0, 2)) for d in found]


def edited(words: list, doc_id: int | None) -> list:
    """One document in ten has a tail that repeats some of its words; which, the id's checksum tells."""
    n = len(words)
    checksum = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if not n or checksum % 10:
        return words
    seed = checksum // 10
    a = seed % n
    p = 1 + (n - a) // (3 + seed % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def strongest(runs: Iterable[Run]) -> Run | None:
    """The run with the greatest exact length/period; of equal ones the least start, then period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def kept_words(words: list, runs: list[Run]) -> list:
    """The words that no run repeats: all but those after the first period of a run."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


SCHEMA = ("n_words long, runs array<struct<start: long, length: long, period: long>>, start long, length long, period long, "
          "exponent_milli long, collapsed string")


def detect_runs(docs: DataFrame, replace: bool = False, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per document ``doc_id``, its ``runs``, the strongest of them, and the ``collapsed`` text.

    ``replace`` first puts repeated tails into one document of ten, by ``edited``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            found, collapsed, sizes = [], [], []
            for a, b in blocks(texts):
                words = [t.encode().split() for t in texts[a:b]]
                if replace:
                    words = [edited(w, i) for w, i in zip(words, ids[a:b].to_pylist())]
                codes = Codes()
                runs = runs_of([np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in words], least, times)
                found += runs
                sizes += map(len, words)
                collapsed += [b" ".join(kept_words(w, r)) for w, r in zip(words, runs)]
            best = [strongest(r) for r in found]
            flat = list(chain.from_iterable(found))
            struct = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], Run._fields)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            of_best = lambda get: pa.array([get(r) if r else None for r in best], pa.int64())
            yield pa.record_batch(
                [ids, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), struct),
                 *[of_best(itemgetter(k)) for k in range(3)], of_best(lambda r: 1000 * r.length // r.period),
                 pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", *Run._fields, "exponent_milli", "collapsed"])
        tidy()

    return small_batches(docs).select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {SCHEMA}")
