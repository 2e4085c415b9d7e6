"""Text queries inside arrays of objects.

The elements of an array become documents of an index of their own, keyed by
``_element struct<key, at>``: postings are by (document, element), so all words of a
clause must meet in one element, and frequencies count elements. Any clause over that
index is then folded into a score of the document, by partial aggregates, so that a
document with very many elements is no large group. The folded clause takes its share of the
query norm and combines with clauses over whole documents.

    rows = element_rows(docs, "id", "comments")
    index = build_index(rows, ELEMENT, {"body": analyzer}, "comments")
    best = fold_elements(match(index, "body", "red fox"), "id", "max")
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgrid.operators.queries import Clause, Made

ELEMENT = "_element"


def element_rows(docs: DataFrame, key: str, path: str) -> DataFrame:
    """One row per element of the array ``path``: ``_element`` (key and place from 0) and
    the fields of the element; elements that are no objects are the field ``value``.

    Null arrays and null elements have no row. A field named ``_element`` is refused.
    """
    of = docs.select(F.col(path).alias("x")).schema["x"].dataType.elementType
    fields = of.names if isinstance(of, T.StructType) else None
    if fields and ELEMENT in fields:
        raise ValueError(f"an element has a field {ELEMENT}")
    rows = docs.select(F.col(key).alias("_key"), F.posexplode(path).alias("_at", "_value")).filter(F.col("_value").isNotNull())
    here = F.struct(F.col("_key").alias(key), F.col("_at").alias("at")).alias(ELEMENT)
    return rows.select(here, *([F.col("_value")[f].alias(f) for f in fields] if fields else [F.col("_value").alias("value")]))


def fold_elements(clause: Clause, key: str, score_mode: str = "avg") -> Clause:
    """Documents with a matching element, scored by the scores of all their matching ones:
    ``avg``, ``max``, ``total``, or ``none`` for the constant 1."""
    fold = {"avg": F.avg("score"), "max": F.max("score"), "total": F.sum("score"), "none": F.lit(1.0)}[score_mode]

    def hits(norm):
        rows = clause.raw() if score_mode == "none" else clause.hits(norm)
        return rows.groupBy("qid", F.col(clause.key)[key].alias(key)).agg(fold.alias("score"))

    # a table of queries keeps its norm, which tells that it is one
    constant = score_mode == "none" and not isinstance(clause.ssw, DataFrame)
    return Clause(key, hits, 0.0 if constant else clause.ssw, made=Made(f"{score_mode} of elements"))
