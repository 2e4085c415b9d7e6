"""Explanations of scores, derived from the clauses of a query.

A query is a tree of clauses, each of which knows how it is made of others
(``queries.Made``). The explanation of a document lists the nodes of that tree that
take part in its score:

* ``path array<int>``: empty for the whole query, one more number a level
* ``description``: what a clause makes of those below it (``sum of:``, ``max of:``,
  ``product of:``), a term, or the name of a factor
* ``value``: for a clause the score it gives by itself under the norm of the whole query,
  not rounded

Below a clause stand its clauses that matched, then its factors. Its value is what its
description makes of the former, times all the latter. A clause that matches inside one
that does not is left out. Phrases, expanded words and elements are told as a whole.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.operators.queries import Clause


def explanation(clause: Clause, ids: DataFrame) -> DataFrame:
    """``(key, explanation array<struct<path, description, value>>)`` of the documents in
    ``ids``, a page of a result, in the order of the tree.

    Every clause is asked once for the scores of the page; all of it is one union and one
    aggregation by document, whose rows are as many as the query has nodes.
    """
    if isinstance(clause.ssw, DataFrame):
        raise ValueError("a table of queries has no explanation")
    norm = 1 / math.sqrt(clause.ssw) if clause.ssw else 1.0
    rows = reduce(DataFrame.unionByName, _nodes(clause, norm, ids.select(clause.key), []))
    nodes = rows.groupBy(clause.key).agg(F.array_sort(F.collect_list(F.struct("path", "kind", "description", "value"))).alias("nodes"))
    reached = nodes.withColumn("nodes", F.expr(
        "filter(nodes, n -> forall(sequence(0, size(n.path)), d -> d = size(n.path) or exists(nodes, a -> a.path = slice(n.path, 1, d))))"))
    # the share of matched clauses: those beside it in the tree
    counted = """transform(nodes, n -> struct(n.path as path,
        if(n.kind = 'coord', concat('coord of ', cast(n.value as int)), n.description) as description,
        if(n.kind = 'coord', size(filter(nodes, c -> c.kind = 'clause' and size(c.path) = size(n.path)
            and slice(c.path, 1, size(n.path) - 1) = slice(n.path, 1, size(n.path) - 1))) / n.value, n.value) as value))"""
    return reached.select(clause.key, F.expr(counted).alias("explanation"))


def _nodes(clause: Clause, norm: float, ids: DataFrame, path: list[int]) -> list[DataFrame]:
    """Rows ``(key, path, kind, description, value)`` of a clause and of all below it."""
    key, made = clause.key, clause.made
    parts = made.of()
    out = [_told(clause.hits(norm).join(ids, key, "left_semi"), key, _path(path), "clause", F.lit(made.how), F.col("score"))]
    for i, part in enumerate(parts):
        out += _nodes(part, norm, ids, path + [i])
    after = len(parts)
    if made.coord:
        out.append(_told(ids, key, _path(path + [after]), "coord", F.lit("coord"), F.lit(float(made.coord))))
        after += 1
    if made.factors:
        place = F.concat(_path(path), F.array(F.col("ord") + after))
        out.append(_told(made.factors(norm, ids), key, place, "factor", F.col("description"), F.col("value")))
    return out


def _path(path: list[int]) -> Column:
    return F.array(*[F.lit(i) for i in path]).cast("array<int>")


def _told(rows: DataFrame, key: str, path: Column, kind: str, description: Column, value: Column) -> DataFrame:
    return rows.select(key, path.alias("path"), F.lit(kind).alias("kind"), description.alias("description"), value.alias("value"))
