"""Scores of a table of queries, document by document.

The postings of the asked terms are dealt by document, once and as numbers. A task then
holds whole documents and knows all queries of a block (``ROWS`` rows of terms at most, one
pass over the postings for each block), so what a query and a document have in common is
added up in arrays and no pair of them is shuffled. If only the best of each query are
wanted, a task gives its own best and those that tie with them after rounding.

A query is made of groups: a term, or terms of which each counts with a weight. Rows of
documents whose key is equal, null included, are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgrid.operators.index import TextIndex
from corpusgrid.session import literal_rows, materialise

ROWS, QUERIES = 1 << 18, 1 << 14
CELLS, HELD = 1 << 21, 1 << 17
#: Scores are rounded to 6 places; what lies this far below the last of the best cannot tie with it.
TIE = 2e-6


@dataclass
class Block:
    """Some queries: which groups a term is in, and which queries a group is in (places from ``starts``)."""

    qid: pa.Array
    need: np.ndarray
    n_terms: np.ndarray
    terms: list[str]
    term_starts: np.ndarray
    group: np.ndarray
    weight: np.ndarray
    group_starts: np.ndarray
    query: np.ndarray
    coef: np.ndarray
    uses: np.ndarray
    plain: bool  # every term is a group of its own


def _numbered(values: list) -> tuple[np.ndarray, list]:
    known: dict = {}
    at = np.array([known.setdefault(v, len(known)) for v in values], np.int64)
    return at, list(known)


def _starts(sorted_at: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_at, np.arange(n + 1))


def block_of(uses: pa.Table, members: pa.Table | None) -> Block:
    """From rows ``(qid, grp, coef, uses, need, n_terms)`` and ``(grp, term, weight)``. Without the latter a group is its
    term, or the list of its terms."""
    query, qids = _numbered(uses["qid"].to_pylist())
    first = np.unique(query, return_index=True)[1]
    names = [tuple(g) if isinstance(g, list) else g for g in uses["grp"].to_pylist()]
    group, groups = _numbered(names)
    order = np.argsort(group, kind="stable")
    if members is not None:
        at = {g: i for i, g in enumerate(groups)}
        owner, words, weight = [at[g] for g in members["grp"].to_pylist()], members["term"].to_pylist(), members["weight"].to_numpy()
    else:
        pairs = [(i, t) for i, g in enumerate(groups) for t in (g if isinstance(g, tuple) else (g,))]
        owner, words, weight = [i for i, _ in pairs], [t for _, t in pairs], np.ones(len(pairs))
    plain = members is None and all(not isinstance(g, tuple) or len(g) == 1 for g in groups)
    term, terms = _numbered(words)
    turn = np.argsort(term, kind="stable")

    def column(name: str) -> np.ndarray:
        return uses[name].to_numpy().astype(float)

    return Block(pa.array(qids, uses["qid"].type), column("need")[first], column("n_terms")[first], terms,
                 _starts(term[turn], len(terms)), np.array(owner, np.int64)[turn], weight[turn].astype(float),
                 _starts(group[order], len(groups)), query[order], column("coef")[order], column("uses")[order], plain)


def _spread(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``at`` its entries in the lists that begin at ``starts``: (which of ``at``, entry)."""
    size = starts[at + 1] - starts[at]
    ends = np.cumsum(size)
    own = np.repeat(np.arange(len(at)), size)
    return own, np.arange(ends[-1] if len(ends) else 0) - (ends - size)[own] + starts[at][own]


def _changes(keys: pa.Array) -> np.ndarray:
    """Places where a key differs from the one before."""
    before, now = keys.slice(0, len(keys) - 1), keys.slice(1)
    if pa.types.is_nested(keys.type):
        rows = keys.to_pylist()
        return np.flatnonzero([a != b for a, b in zip(rows, rows[1:])]) + 1
    other = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
    gone = pc.is_null(now).to_numpy(zero_copy_only=False) != pc.is_null(before).to_numpy(zero_copy_only=False)
    return np.flatnonzero(other | gone) + 1


class Scorer:
    """The scored pairs of documents as they stream by."""

    def __init__(self, block: Block, coord: bool, once: bool, size: int | None):
        self.block, self.coord, self.once, self.size = block, coord, once, size
        self.best = np.full((len(block.qid), size or 0), -np.inf)

    def scored(self, term: np.ndarray, doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score) for postings of ``n`` documents."""
        b, q = self.block, len(self.block.qid)
        group, times = term, np.ones(len(term))
        if not b.plain:
            own, entry = _spread(b.term_starts, term)
            group, doc, value = b.group[entry], doc[own], value[own] * b.weight[entry]
            times = np.ones(len(group))
        if self.once:
            code, at = np.unique(group * n + doc, return_inverse=True)
            value, group, doc, times = np.bincount(at, weights=value, minlength=len(code)), code // n, code % n, np.ones(len(code))
        own, entry = _spread(b.group_starts, group)
        cell = b.query[entry] * n + doc[own]
        score = np.bincount(cell, weights=b.coef[entry] * value[own], minlength=q * n).reshape(q, n)
        matched = np.bincount(cell, weights=b.uses[entry] * times[own], minlength=q * n).reshape(q, n)
        hit = (matched > 0) & (matched >= b.need[:, None])
        if self.coord:
            score = score * matched / b.n_terms[:, None]
        if self.size:
            own_best = np.where(hit, score, -np.inf)
            if n > self.size:
                own_best = -np.partition(-own_best, self.size - 1, axis=1)[:, :self.size]
            both = np.concatenate([self.best, own_best], 1)
            self.best = -np.partition(-both, self.size - 1, axis=1)[:, :self.size]
            hit &= score >= self.best.min(1)[:, None] - TIE
        at, doc = np.nonzero(hit)
        return at, doc, score[at, doc]

    def batches(self, rows: pa.RecordBatch, whole: bool) -> Iterator[pa.RecordBatch | int]:
        """Of rows in the order of documents: scored batches, and last the place up to which documents are done."""
        b = self.block
        starts = np.concatenate([[0], _changes(rows.column(1))])
        edges = np.append(starts, rows.num_rows)
        done = len(starts) if whole else len(starts) - 1
        term = rows.column(0).to_numpy()
        value = np.sqrt(rows.column(2).to_numpy() / rows.column(3).to_numpy()) if rows.num_columns > 2 else np.ones(len(term))
        reach = np.diff(b.group_starts)
        cost = np.array([reach[b.group[x:y]].sum() + y - x for x, y in zip(b.term_starts, b.term_starts[1:])]) if not b.plain else reach + 1
        spent = np.concatenate([[0], np.cumsum(cost[term])])[edges]
        most, at = max(1, CELLS // max(1, len(b.qid))), 0
        while at < done:
            stop = min(done, at + most, max(at + 1, int(np.searchsorted(spent, spent[at] + CELLS, side="right")) - 1))
            x, y = edges[at], edges[stop]
            doc = np.repeat(np.arange(stop - at), np.diff(edges[at:stop + 1]))
            query, found, score = self.scored(term[x:y], doc, value[x:y], stop - at)
            if len(query):
                yield pa.record_batch([b.qid.take(pa.array(query)), rows.column(1).take(pa.array(starts[at + found])), pa.array(score)],
                                      names=["qid", "key", "score"])
            at = stop
        yield int(edges[done])


class TableHits:
    """``hits`` of a clause over a table of queries; ``asked`` gives for a norm the rows ``(qid, grp, coef, uses, need,
    n_terms)``: what a group adds for a query, how many of its clauses it is, and how many must match.

    With ``once`` a group counts once in a document however many of its terms stand there.
    """

    def __init__(self, index: TextIndex, field: str, asked: Callable[[DataFrame], DataFrame], members: DataFrame | None = None,
                 coord: bool = True, once: bool = False, scored: bool = True):
        self.index, self.field, self.asked, self.members = index, field, asked, members
        self.coord, self.once, self.scored = coord, once, scored

    def __call__(self, norm: DataFrame) -> DataFrame:
        return self.within(norm)

    def within(self, norm: DataFrame, size: int | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The rows of a superset of the ``size`` best of each query, among the documents that ``keep`` leaves of postings."""
        asked = materialise(self.asked(norm), "asked")
        held = asked.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("qid").alias("queries")).first()
        n = max(1, -(-held["rows"] // ROWS), -(-held["queries"] // QUERIES))
        out = [self._pass(asked if n == 1 else asked.filter(F.pmod(F.xxhash64("qid"), F.lit(n)) == i), size, keep) for i in range(n)]
        while len(out) > 1:
            out = [a.unionByName(b) for a, b in zip(out[::2], out[1::2])] + out[len(out) - len(out) % 2:]
        return out[0]

    def _pass(self, asked: DataFrame, size: int | None, keep) -> DataFrame:
        index, key, spark = self.index, self.index.key, asked.sparkSession
        members = self.members
        if members is not None:
            members = members.join(asked.select("grp").distinct(), "grp", "left_semi").toArrow()
        block = block_of(asked.toArrow(), members)
        schema = T.StructType([asked.schema["qid"], index.postings.schema[key], T.StructField("score", T.DoubleType())])
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        if not block.terms:
            return spark.createDataFrame([], schema)
        ids = literal_rows(spark, term=block.terms, _term=pa.array(range(len(block.terms)), pa.int64()))
        values = ["tf", "field_len"] if self.scored else []
        # a bounded number of terms, so that the postings are not shuffled to meet them
        rows = index.lookup(self.field).join(F.broadcast(ids), "term").select("_term", key, *values)
        rows = (keep(rows) if keep else rows).select("_term", key, *values)
        shared = spark.sparkContext.broadcast(block)
        coord, once = self.coord, self.once

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shared.value, coord, once, size)

            def named(out: pa.RecordBatch) -> pa.RecordBatch:
                return out.rename_columns(["qid", key, "score"])

            held, count = [], 0
            for batch in batches:
                held.append(batch)
                count += batch.num_rows
                if count >= HELD:
                    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    for out in scorer.batches(rows, False):
                        if isinstance(out, int):
                            held, count = [rows.slice(out)], rows.num_rows - out
                        else:
                            yield named(out)
            if count:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield from (named(out) for out in scorer.batches(rows, True) if not isinstance(out, int))

        return rows.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)
