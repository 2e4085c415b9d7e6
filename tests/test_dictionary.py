"""Patterns and near words by the tables over the vocabulary, against loops."""

import itertools
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.operators import dictionary as D
from corpusgrid.operators import queries as Q
from corpusgrid.operators.index import build_index
from tests.test_queries import edits

WORDS = ["".join(w) for n in range(1, 5) for w in itertools.product("abc", repeat=n)][::2] + [
    "through", "though", "thorough", "rough", "enough", "éclair", "eclair", "a.b", "x(y", "quick", "quack"]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(list(enumerate([*WORDS, "a through rough"])), "id long, text string")
    return build_index(docs, "id", {"text": A.custom_analyzer("whitespace")})


def ids(clause):
    return {r["id"] for r in clause.scores().collect()}


@pytest.mark.parametrize("pattern", ["*ough*", "*ough", "?hough", "*b*", "*", "??", "*a?b*", "*c", "*éc*", "*.b", "*(y", "a*b", "*zzz*", "?"])
def test_patterns_equal_a_scan(index, pattern):
    fits = re.compile(Q.glob_regex(pattern))
    want = {i for i, w in enumerate(WORDS) if fits.search(w)} | (
        {len(WORDS)} if any(fits.search(w) for w in ("a", "through", "rough")) else set())
    assert ids(Q.wildcard(index, "text", pattern)) == want


def test_pieces_of_patterns():
    assert D.pattern_grams("*ough*") == ["oug", "ugh"] and D.pattern_grams("*d") == ["d" + D.END]
    assert D.pattern_grams("*a?b*") == [] and D.pattern_grams("?") == []


def test_a_pattern_reads_buckets_of_the_postings_only(index):
    plan = Q.wildcard(index, "text", "*nough*").scores()._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "/postings" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", scan) and "RLIKE" not in plan.upper()


@pytest.mark.parametrize("k, prefix", [(0, 0), (1, 1), (2, 0)])
@pytest.mark.parametrize("are_stored", [False, True])
def test_near_words_equal_brute_force(spark, index, k, prefix, are_stored):
    index = replace(index)  # the stored tables are a copy's own
    if are_stored:
        assert index.deletions.columns[-1] == "bucket" and index.has_deletions
    near = lambda s: {t for t in WORDS if edits(s, t) <= k and s[:prefix] == t[:prefix]}
    for word in ("rough", "abc", "a", "zz", "quick", "eclair"):
        got = Q.fuzzy_terms(index, "text", word, k if k else 0.99, prefix).collect()
        assert {r["term"] for r in got} == near(word) and len(got) == len(near(word))
        assert all(r["edits"] == edits(word, r["term"]) for r in got)
    if k:
        seeds = spark.createDataFrame([(w,) for w in WORDS + WORDS[:5]], "seed string")
        got = [(r["seed"], r["term"]) for r in Q.near_seeds(index, "text", seeds, k, prefix).collect()]
        assert set(got) == {(s, t) for s in WORDS for t in near(s)} and len(got) == len(set(got))


def test_seeds_with_many_edits_fall_back(spark, index):
    seeds = spark.createDataFrame([("thorough",), ("ab",)], "seed string")
    got = {(r["seed"], r["term"]) for r in Q.near_seeds(index, "text", seeds, 0.5).collect()}
    assert got == {(s, t) for s, k in (("thorough", 4), ("ab", 1)) for t in WORDS if edits(s, t) <= k}


def test_no_join_key_holds_many_terms(index):
    n = index.words("text").count()
    worst = index.deletions.groupBy("variant").agg(F.countDistinct("term").alias("n")).agg(F.max("n")).first()[0]
    longer = index.deletions.filter(F.length("variant") >= 3).groupBy("variant").agg(F.countDistinct("term").alias("n")).agg(F.max("n")).first()[0]
    assert worst < n / 2 and longer <= 12


@pytest.mark.parametrize("limit", [None, 2])
def test_a_table_of_fuzzy_queries_equals_one_at_a_time(spark, index, limit):
    texts = [(0, "rugh quck"), (1, "abc abc"), (2, "zzzzzz"), (3, "thrugh zzzzzz enogh")]
    table = spark.createDataFrame(texts, "qid int, text string")
    options = {"fuzziness": 1, "max_expansions": limit, "minimum_should_match": 2, "boost": 2.0}
    many = {(r["qid"], r["id"]): r["score"] for r in Q.match(index, "text", table, **options).scores().collect()}
    one = {(q, r["id"]): r["score"] for q, t in texts for r in Q.match(index, "text", t, **options).scores().collect()}
    assert many.keys() == one.keys() and many and all(abs(many[k] - one[k]) < 2e-6 for k in many)
