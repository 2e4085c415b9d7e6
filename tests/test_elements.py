import math

import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.operators import queries as Q
from corpusgrid.operators.elements import ELEMENT, element_rows, fold_elements
from corpusgrid.operators.index import build_index

WHITE = A.analyzer("whitespace")
DOCS = [
    (1, "red", [("red fox", 3), ("blue dog", 1)]),
    (2, "blue", [("red dog", 2), ("blue fox", 5), None, (None, 7)]),
    (3, "red", [("red fox fox", 1), ("red fox", 9), ("a red b", 4)]),
    (4, None, []),
    (5, "fox", None),
    (6, "red", [("red fox", 3)] * 40),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, title string, notes array<struct<body string, stars int>>")


@pytest.fixture(scope="module")
def notes(docs):
    return build_index(element_rows(docs, "id", "notes"), ELEMENT, {"body": WHITE}, "notes")


def element_scores(words):
    """Scores of elements by the formula: ``{(id, at): score}``."""
    bodies = {(d, i): (e[0] or "").split() for d, _, es in DOCS for i, e in enumerate(es or []) if e}
    idf = {w: 1 + math.log(len(bodies) / (sum(w in b for b in bodies.values()) + 1)) for w in words}
    norm = 1 / math.sqrt(sum(v * v for v in idf.values()))
    out = {}
    for k, b in bodies.items():
        met = [w for w in words if w in b]
        if met:
            out[k] = sum(math.sqrt(b.count(w) / len(b)) * idf[w] ** 2 for w in met) * norm * len(met) / len(words)
    return out


def found(clause):
    return {r["id"]: r["score"] for r in clause.scores().collect()}


@pytest.mark.parametrize("mode", ["avg", "max", "total", "none"])
def test_elements_are_scored_and_folded(notes, mode):
    fold = {"avg": lambda v: sum(v) / len(v), "max": max, "total": sum, "none": lambda v: 1.0}[mode]
    per_doc = {}
    for (d, _), s in element_scores(["red", "fox"]).items():
        per_doc.setdefault(d, []).append(s)
    got = found(fold_elements(Q.match(notes, "body", "red fox"), "id", mode))
    assert got.keys() == per_doc.keys() == {1, 2, 3, 6}
    for d, v in per_doc.items():
        assert abs(got[d] - fold(v)) < 2e-6


def test_words_must_meet_in_one_element(notes):
    assert set(found(fold_elements(Q.match(notes, "body", "red fox", operator="and"), "id"))) == {1, 3, 6}
    assert set(found(fold_elements(Q.match_phrase(notes, "body", "blue fox"), "id"))) == {2}
    few = Q.filtered(Q.match(notes, "body", "red fox", operator="and"), notes.docs, F.col("stars") > 5)
    assert set(found(fold_elements(few, "id"))) == {3}


def test_elements_beside_whole_documents(docs, notes):
    titles = build_index(docs.select("id", "title"), "id", {"title": WHITE}, "titles")
    inside = fold_elements(Q.term(notes, "body", "dog"), "id", "max")
    both = Q.bool_(must=[inside], should=[Q.term(titles, "title", "red")])
    norm = 1 / math.sqrt(inside.ssw + Q.term(titles, "title", "red").ssw)
    alone = {r["id"]: r["score"] for r in inside.hits(norm).collect()}
    title = {r["id"]: r["score"] for r in Q.term(titles, "title", "red").hits(norm).collect()}
    assert found(both) == {1: round(alone[1] + title[1], 6), 2: round(alone[2] / 2, 6)}
    assert set(found(Q.not_(inside, docs))) == {3, 4, 5, 6}
    assert set(found(Q.bool_(must=[Q.term(titles, "title", "red")], must_not=[inside]))) == {3, 6}


def test_a_table_of_queries(spark, notes):
    asked = spark.createDataFrame([(1, "dog"), (2, "red fox"), (3, "absent"), (4, None)], "qid long, text string")
    rows = fold_elements(Q.match(notes, "body", asked), "id", "max").scores().collect()
    one = found(fold_elements(Q.match(notes, "body", "red fox"), "id", "max"))
    assert {r["id"]: r["score"] for r in rows if r["qid"] == 2} == one
    assert {r["id"] for r in rows if r["qid"] == 1} == {1, 2} and {r["qid"] for r in rows} == {1, 2}
    ones = fold_elements(Q.match(notes, "body", asked), "id", "none").scores().collect()
    assert {(r["qid"], r["id"], r["score"]) for r in ones} == {(r["qid"], r["id"], 1.0) for r in rows}


def test_plain_elements_and_names(spark, docs):
    tags = spark.createDataFrame([(1, ["a b", None, "c"]), (2, None)], "id long, tags array<string>")
    assert sorted((r[ELEMENT]["id"], r[ELEMENT]["at"], r["value"]) for r in element_rows(tags, "id", "tags").collect()) == [(1, 0, "a b"), (1, 2, "c")]
    assert element_rows(docs.limit(0), "id", "notes").count() == 0
    clash = docs.select("id", F.expr("transform(notes, n -> struct(n.body as id, n.stars as at))").alias("notes"))
    assert element_rows(clash, "id", "notes").columns == [ELEMENT, "id", "at"]
    bad = docs.select("id", F.expr("transform(notes, n -> struct(n.body as _element))").alias("notes"))
    with pytest.raises(ValueError):
        element_rows(bad, "id", "notes")
