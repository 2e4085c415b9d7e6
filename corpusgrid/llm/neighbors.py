"""Approximate nearest neighbours by inner product, with low-dimensional stable projections.

Largest inner product becomes least distance by one added component, sqrt(M^2 - |x|^2)
with M the largest norm (0 for a query). Vectors are projected to ``DIMS`` dimensions by
a fixed Gaussian matrix: the projected squared distance divided by the true one follows
a chi-square distribution. The rows are dealt by hash into blocks of about ``BLOCK``;
each block has a kd-tree over its projected points and is written as one row. A block of
queries meets every block of rows: a query takes the leaves of the tree in the order of
their projected distance, verifies every vector in them with the true inner product in
double precision, and stops once a vector nearer than its k-th best would lie beyond the
next leaf only with probability ``1 - SURE``. Then the best k of all blocks are merged.

Every row is indexed; nothing is sampled. Work is queries x blocks leaf visits at least.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component take no part. A query's candidates are the vectors of its own dimension with
another ``vec_id``. Rows repeated exactly count once. Ties go to the smaller ``vec_id``.
Null ids take no part. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.session import materialise

DIMS, SURE, LEAF, BLOCK, QUERIES = 8, 0.97, 64, 32768, 1024
TOP, EVERY = 20, 20


def chi_square(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """The distribution function, in closed form for an even number of degrees."""
    half, term = x / 2, np.ones_like(x)
    total = np.ones_like(x)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1.0 - np.exp(-half) * total


def gaussian(dim: int) -> np.ndarray:
    return np.random.default_rng([2014, dim]).normal(size=(dim + 1, DIMS))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Rows of each leaf: halves at the median of the widest dimension, so equal points divide too."""
    done, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        part = points[rows]
        axis = int((part.max(0) - part.min(0)).argmax())
        half = len(rows) // 2
        order = np.argpartition(part[:, axis], half)
        stack += [rows[order[half:]], rows[order[:half]]]
    return done


class Tree:
    """One block: ids and vectors in leaf order, and the box of each leaf."""

    PARTS = {"ids": np.int64, "vectors": np.float64, "ends": np.int64, "low": np.float64, "high": np.float64}

    def __init__(self, row: dict):
        """From the stored bytes."""
        for name, kind in self.PARTS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.vectors = self.vectors.reshape(len(self.ids), -1)
        self.low, self.high = self.low.reshape(-1, DIMS), self.high.reshape(-1, DIMS)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, norm: float) -> dict:
        room = np.sqrt(np.maximum(norm ** 2 - (vectors ** 2).sum(1), 0))
        points = np.hstack([vectors, room[:, None]]) @ gaussian(vectors.shape[1])
        leaves = kd_leaves(points)
        rows = np.concatenate(leaves)
        parts = {"ids": ids[rows], "vectors": vectors[rows], "ends": np.cumsum([len(x) for x in leaves]),
                 "low": np.stack([points[x].min(0) for x in leaves]), "high": np.stack([points[x].max(0) for x in leaves])}
        return {name: parts[name].astype(kind).tobytes() for name, kind in cls.PARTS.items()}

    def search(self, query_ids: np.ndarray, queries: np.ndarray, norm: float, top: int = TOP):
        """(ids, scores) of the best of each query; -1 and -inf where there are fewer."""
        n = len(queries)
        flat = queries @ gaussian(queries.shape[1])[:-1]
        bound = np.zeros((n, len(self.ends)))
        for d in range(DIMS):
            x = flat[:, d:d + 1]
            bound += np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0) ** 2
        order = np.argsort(bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, 1)
        ids, scores = np.full((n, top), -1, np.int64), np.full((n, top), -np.inf)
        size = (queries ** 2).sum(1) + norm ** 2
        width = int(np.diff(self.ends, prepend=0).max())
        live = np.arange(n)
        for step in range(len(self.ends)):
            worst = size[live] - 2 * scores[live, -1]  # squared distance of the k-th best
            with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
                far = bound[live, step] > 1e-9 * size[live]
                sure = chi_square(np.where(np.isfinite(worst), bound[live, step] / np.maximum(worst, 1e-300), 0.0)) >= SURE
            live = live[~(far & sure)]
            if not len(live):
                break
            end = self.ends[order[live, step]]
            start = np.where(order[live, step] > 0, self.ends[order[live, step] - 1], 0)
            at = start[:, None] + np.arange(width)
            real = at < end[:, None]
            at = np.minimum(at, len(self.ids) - 1)
            found = np.einsum("qpd,qd->qp", self.vectors[at], queries[live])
            other = self.ids[at]
            found[~real | (other == query_ids[live, None])] = -np.inf
            all_ids = np.hstack([ids[live], other])
            all_scores = np.hstack([scores[live], found])
            by_id = np.argsort(all_ids, axis=1, kind="stable")
            by_score = np.argsort(-np.take_along_axis(all_scores, by_id, 1), axis=1, kind="stable")[:, :top]
            best = np.take_along_axis(by_id, by_score, 1)
            ids[live], scores[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_scores, best, 1)
        return ids, scores


def valid(rows: DataFrame) -> DataFrame:
    """``vec_id, v array<double>, dim`` of the vectors that take part, each exact row once."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
            .distinct().withColumn("dim", F.size("v")))


def bundle(key: list[str], make):
    """One row of a group: what ``make`` gives for its ids and vectors."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        ids, vectors = frame["vec_id"].to_numpy(np.int64), np.stack(frame["v"].to_numpy()).astype(np.float64)
        return pd.DataFrame([{k: frame[k].iloc[0] for k in key} | make(ids, vectors)])
    return run


def search(rows: DataFrame, queries: DataFrame | None = None, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the best ``top`` of every query."""
    data = materialise(valid(rows), "vectors")
    asked = data.where(F.col("vec_id") % EVERY == 0) if queries is None else valid(queries)
    count, norm = data.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    norm = float(norm or 0.0)
    n_blocks, n_queries = max(1, -(-count // BLOCK)), max(1, -(-asked.count() // QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    index = materialise(data.withColumn("block", deal(n_blocks)).groupBy("dim", "block").applyInPandas(
        bundle(["dim", "block"], lambda ids, v: Tree.build(ids, v, norm)),
        "dim int, block int, ids binary, vectors binary, ends binary, low binary, high binary"), "vector-blocks")
    groups = asked.withColumn("part", deal(n_queries)).groupBy("dim", "part").applyInPandas(
        bundle(["dim", "part"], lambda ids, v: {"q_ids": ids.tobytes(), "q_vectors": v.tobytes()}),
        "dim int, part int, q_ids binary, q_vectors binary")
    meet = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, asked_for = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_vectors"]).reshape(-1, row["dim"])
                found, scores = Tree(row).search(q_ids, asked_for, norm, top)
                hit = np.isfinite(scores)
                owner = np.broadcast_to(q_ids[:, None], found.shape)
                yield pa.record_batch([pa.array(owner[hit]), pa.array(found[hit]), pa.array(scores[hit])],
                                      names=["query_id", "vec_id", "score"])

    near = (meet.join(index, ["dim", "block"]).repartition("dim", "part", "block")
            .mapInArrow(run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
