import math

import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.operators import queries as Q
from corpusgrid.operators.index import build_index
from corpusgrid.plans.search import View

TEXTS = {1: "the quick brown fox", 2: "quick quick fox", 3: "the lazy dog", 4: "brown dog and the quick fox jumps", 5: "fox brown quick", 6: "", 7: None}


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "id long, text string").withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    return build_index(docs, "id", {"text": A.custom_analyzer("standard", filters=["lowercase"])})


def told(index, query, size=10):
    """Rows of a page with their nodes by path, each checked against those below it."""
    out = {}
    for r in View(index.docs, "id").matching(query).page(0, size).explain().collect():
        nodes = {tuple(n["path"]): (n["description"], n["value"]) for n in r["explanation"]}
        assert list(nodes) == sorted(nodes) and len(nodes) == len(r["explanation"])
        assert round(nodes[()][1], 6) == r["_score"]
        for path, (how, value) in nodes.items():
            below = [nodes[p] for p in sorted(nodes) if p[:-1] == path and p]
            if below and not how.startswith("script"):
                assert math.isclose(made(how, below), value, rel_tol=1e-12), (path, how, below, value)
        out[r["id"]] = nodes
    return out


FACTORS = ("coord of", "boost", "negative boost", "filters", "tf", "idf squared", "field norm", "query norm")


def made(how, below):
    """The value a node must have by its description."""
    clauses = [v for d, v in below if not d.startswith(FACTORS)]
    factor = math.prod(v for d, v in below if d.startswith(FACTORS))
    if not clauses:
        return factor
    if how == "sum of:" or how == "product of:":
        return sum(clauses) * factor
    share = 0.0 if how == "max of:" else float(how.split()[2])
    return (max(clauses) + share * (sum(clauses) - max(clauses))) * factor


def test_a_tree_adds_up_at_every_node(index):
    both = Q.bool_(must=[Q.term(index, "text", "quick")], should=[Q.match(index, "text", "fox lazy fox", boost=2.0), Q.prefix(index, "text", "ju")],
                   must_not=[Q.match_phrase(index, "text", "quick quick")], factor=1.5)
    query = Q.boosting(Q.dis_max([both, Q.term(index, "text", "dog", boost=3.0)], tie_breaker=0.3), Q.term(index, "text", "jumps"), 0.2)
    out = told(index, query)
    assert set(out) == {1, 3, 4, 5}
    assert {d for d, _ in out[4].values()} >= {"negative boost", "coord of 3"}
    assert "negative boost" not in {d for d, _ in out[1].values()}
    # document 3 holds "lazy", but not what the bool demands: nothing of the bool is told
    assert [d for p, (d, _) in out[3].items() if p[:2] == (0, 0)] == []
    assert out[3][(0, 1)][0] == "text:dog"
    assert out[4][(0, 0, 3)] == ("coord of 3", 1.0)
    assert out[1][(0, 0, 3)][1] == 2 / 3


def test_other_clauses_are_told(index):
    fox = Q.term(index, "text", "fox")
    weighed = Q.custom_filters_score(Q.custom_boost(fox, 2.0), index.docs, [(F.col("n") > 16, 3.0), (F.col("id") == 1, 5.0)], "total")
    assert {i: n[(1,)] for i, n in told(index, weighed).items()} == {
        1: ("filters", 8.0), 2: ("filters", 1.0), 4: ("filters", 3.0), 5: ("filters", 1.0)}
    told(index, Q.indices(index.docs, [1, 3], fox, index_column="id"))
    told(index, Q.boost(Q.match(index, "text", "fox dog"), 4.0))
    scripted = Q.custom_score(fox, index.docs, "_score * n")
    assert told(index, scripted)[2][()][0] == "script over:"
    assert [d for d, _ in told(index, Q.match_phrase(index, "text", "quick fox"))[2].values()] == ['text:"quick fox"']


def test_pages_and_no_query(spark, index):
    assert set(told(index, Q.match(index, "text", "quick fox"), 2)) == {2, 5}
    plain = View(index.docs, "id").explain().collect()
    assert {r["explanation"][0]["description"] for r in plain} == {"constant"} and len(plain) == len(TEXTS)
    assert told(index, Q.match(index, "text", "absent")) == {}
    table = spark.createDataFrame([(1, "fox")], "qid long, text string")
    with pytest.raises(ValueError):
        View(index.docs, "id").matching(Q.match(index, "text", table)).explain()
