"""Language identification by unigrams of pieces, marginalised over segmentations.

Each language has probabilities for the pieces of a fixed public vocabulary. A word is
scored by the sum over all its segmentations (a forward pass over the lattice), a text by
the sum of its words' log probabilities, and the score is the posterior of the best
language under equal priors. Piece probabilities are fitted by expectation maximisation
on words of a sample of labelled texts; the sample has about ``sample`` texts, spread
evenly over the languages, chosen by a hash of the id. ``sample`` is a documented bound of
the fit alone; every text is scored whole.

Distinct words are scored once per worker; a text's words are found and hashed with array
operations, so memory is bounded by one slice of texts and the word cache.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Ties go
to the first language in alphabetical order. Without labelled text every text is ``und``.
A null ``doc_id`` counts as the id ``''`` and is scored as any other. Repeated rows are
scored alike. Extra columns pass through where the caller selects them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from corpusgrid.llm.lattice import UNKNOWN, Lattice, word_pieces
from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.words import LETTERS, Words, text_slices

SAMPLE, FOLDS, ROUNDS, UNDECIDED = 2000, 5, 4, "und"
CACHE_LIMIT = 200_000


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # (pieces + 1, languages); the last row is an unknown letter


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def sample_rows(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows, as many of each language, by a hash of ``doc_id``.

    Only ids and labels are read to count; the texts of the chosen rows come after.
    """
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    share = sample / max(1, len(sizes))
    if not sizes:
        return labelled
    parts = F.lit(None).cast("double")
    for row in sizes:
        parts = F.when(F.col("lang") == row["lang"], F.lit(share / row["count"])).otherwise(parts)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(place < parts)


def word_counts(rows: DataFrame) -> DataFrame:
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z\x{80}-\x{10FFFF}]+"), 0))
    return rows.select("lang", words.alias("word")).groupBy("lang", "word").count()


def fit(labelled: DataFrame, sample: int = SAMPLE, path: str | None = None) -> Model:
    """Fits from rows ``doc_id, text, lang`` with non-null label and text."""
    found = word_counts(sample_rows(labelled, sample)).toPandas()  # words of a bounded sample
    pieces = word_pieces(path)
    lattice, languages = Lattice(pieces), sorted(found["lang"].unique())
    columns = []
    for language in languages:
        own = found[found["lang"] == language].sort_values("word")
        words, counts = own["word"].tolist(), own["count"].to_numpy(float)
        p = np.full(len(pieces) + 1, 1.0 / len(pieces))
        p[-1] = UNKNOWN
        for _ in range(ROUNDS):
            used = lattice.expected(words, counts, p)[:-1] + 0.01
            p[:-1] = used / used.sum()
        columns.append(p)
    return Model(languages, pieces, np.stack(columns, 1) if columns else np.zeros((len(pieces) + 1, 0)))


class Scorer:
    """Scores slices of texts; keeps the scores of words it has met, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.scores = np.zeros((1 << 12, len(self.model.languages)))

    def rows_of(self, hashes: np.ndarray, words: Words, first: np.ndarray) -> np.ndarray:
        new = [i for i, h in enumerate(hashes.tolist()) if h not in self.known]
        if len(self.known) + len(new) > CACHE_LIMIT:
            self.forget()
            new = list(range(len(hashes)))
        if new:
            base, texts = len(self.known), [words.word(first[i]) for i in new]
            need = base + len(new)
            if need > len(self.scores):
                grown = np.zeros((max(need, 2 * len(self.scores)), self.scores.shape[1]))
                grown[:base] = self.scores[:base]
                self.scores = grown
            self.scores[base:need] = self.lattice.log_likelihood(texts, self.model.table)
            for k, i in enumerate(new):
                self.known[int(hashes[i])] = base + k
        return np.fromiter(map(self.known.__getitem__, hashes.tolist()), np.int64, len(hashes))

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Predicted language and posterior of each text."""
        n, languages = len(texts), self.model.languages
        words = Words(texts, LETTERS)
        total = np.zeros((n, len(languages)))
        if len(words.hash) and languages:
            distinct, first, at = np.unique(words.hash, return_index=True, return_inverse=True)
            rows = self.rows_of(distinct, words, first)[at]
            counts = np.diff(words.bounds)
            filled = np.flatnonzero(counts)
            total[filled] = np.add.reduceat(self.scores[rows], words.bounds[:-1][filled], axis=0)
        shifted = np.exp(total - total.max(axis=1, keepdims=True)) if languages else total
        best = total.argmax(axis=1) if languages else np.zeros(n, int)
        letter = self.has_letter(texts, words)
        sure = shifted.max(axis=1, initial=0) / np.maximum(shifted.sum(axis=1), 1e-300)
        keep = letter & bool(languages)
        return [languages[b] if k else UNDECIDED for b, k in zip(best, keep)], np.where(keep, sure, 0.0)

    @staticmethod
    def has_letter(texts: pa.Array, words: Words) -> np.ndarray:
        """ASCII letters are found in the bytes; only other texts are looked at by character."""
        sums = np.append(0, np.cumsum((words.data >= 97) & (words.data <= 122)))
        letter = sums[words.offsets[1:]] > sums[words.offsets[:-1]]
        for i in np.flatnonzero(~letter & (np.diff(words.offsets) > 0)):
            letter[i] = any(map(str.isalpha, texts[int(i)].as_py() or ""))
        return letter


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    rows = docs.drop("lang_pred", "score")
    schema = StructType(list(rows.schema)).add("lang_pred", StringType()).add("score", DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.table))
    at, names = rows.columns.index("text"), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            for start, texts in text_slices(batch.column(at)):
                languages, sure = scorer.score(texts)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(languages, pa.string()), pa.array(sure)],
                                                 names=[*names, "lang_pred", "score"])
        del scorer
        tidy()

    return small_batches(rows).mapInArrow(run, schema)


def identify(docs: DataFrame, sample: int = SAMPLE, path: str | None = None) -> DataFrame:
    """Fits on the rows that are not held out, then predicts every row from its text."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = fit(labelled.select("doc_id", "text", "lang"), sample, path)
    return predict(docs, model)
