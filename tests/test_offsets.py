"""Offsets in the original text, for every tokenizer and through char filters; highlights by places."""

import re

import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.functions.offsets import running_sum, with_tokens
from corpusgrid.operators import queries as Q
from corpusgrid.operators.index import build_index, term_vector
from corpusgrid.plans.search import View

TEXTS = ["The quick  fox-bar, it's ünï 漢字 🎈 end", "", "a", "  lead and trail  ", "x.y'z 12-34 a_b", "mail joe@foo.org or http://a.b/c?d now", "/a/bc/d", None]


def tokens(spark, chain, texts=TEXTS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    df = with_tokens(df, "text", chain, "x")
    return {r["id"]: (r["text"], [tuple(t) for t in r["x"]]) for r in df.collect()}


CHAINS = {
    "whitespace": A.tok_whitespace, "letter": A.tok_letter, "standard": A.tok_standard, "email": A.tok_uax_url_email,
    "keyword": A.chain(A.tok_keyword), "split": A.tok_pattern(r"\W+"), "group": A.tok_pattern(r"\w+", "", 0), "ngram": A.tok_ngram(2, 3),
    "edge": A.tok_edge_ngram(1, 3), "path": A.tok_path_hierarchy("/"),
}


@pytest.mark.parametrize("name", CHAINS)
def test_every_tokenizer_cuts_its_tokens_from_the_text(spark, name):
    chain = CHAINS[name]
    plain = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string").select("id", chain(F.col("text")).alias("x"))
    want = {r["id"]: [t for t in r["x"] or [] if t is not None] for r in plain.collect()}
    for i, (text, found) in tokens(spark, chain).items():
        found = [x for x in found if x[0] is not None]
        assert [t for t, *_ in found] == want[i]
        assert all(text[s:e] == t for t, _, s, e in found)


def test_lower_case_letters(spark):
    got = tokens(spark, A.tok_lowercase, ["Ab-CD"])[0][1]
    assert got == [("ab", 0, 0, 2), ("cd", 1, 3, 5)]


def test_filters_keep_offsets(spark):
    chain = A.custom_analyzer("standard", filters=["lowercase", ("stop", ["the"]), ("synonym", {"fox": ["fox", "vulpes"]}), ("edge_ngram", 2, 3)])
    got = tokens(spark, chain, ["The Fox ran"])[0][1]
    assert got == [("fo", 1, 4, 7), ("fox", 1, 4, 7), ("vu", 1, 4, 7), ("vul", 1, 4, 7), ("ra", 2, 8, 11), ("ran", 2, 8, 11)]
    pairs = tokens(spark, A.custom_analyzer("standard", filters=[("shingle", 2)]), ["a bc d"])[0][1]
    assert pairs == [("a bc", 0, 0, 4), ("bc d", 1, 2, 6)]
    assert tokens(spark, A.custom_analyzer("standard", filters=["unique"]), ["a b a"])[0][1] == [("a", 0, 0, 1), ("b", 1, 2, 3)]


def test_offsets_through_char_filters(spark):
    chain = A.custom_analyzer("standard", char_filters=[("mapping", {"ß": "ss", "-": "", "&": " and "})], filters=["lowercase"])
    text = "Die Straße-x & Maß q"
    got = tokens(spark, chain, [text])[0][1]
    assert [(t, text[s:e]) for t, _, s, e in got] == [("die", "Die"), ("strassex", "Straße-x"), ("and", "&"), ("mass", "Maß"), ("q", "q")]
    page = "<p>One &lt;two&gt;</p><!-- no --><script>x()</script> <b>thr</b>ee &amp;four"
    got = tokens(spark, A.custom_analyzer("whitespace", char_filters=["html_strip"]), [page])[0][1]
    assert [(t, page[s:e]) for t, _, s, e in got] == [("One", "One"), ("<two>", "&lt;two&gt;"), ("thr", "thr"), ("ee", "ee"), ("&four", "&amp;four")]


def test_running_sums(spark):
    df = spark.range(1, 9).select(F.sequence(F.lit(1), (F.col("id") * 37).cast("int")).alias("a")).select("a", running_sum(F.col("a")).alias("s"))
    for r in df.collect():
        assert r["s"] == [n * (n + 1) // 2 for n in range(1, len(r["a"]) + 1)]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "Ab cd")], "id long, text string")
    assert "Python" not in term_vector(df, "id", "text")._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "a red fox, a red dog and the fox"), (2, "say foo-bar to foo"), (3, "red red fox")], "id int, text string")


def shown(index, query, settings=None):
    out = View(index.docs, "id").matching(query).highlight(None, {"text": {"number_of_fragments": 0}}, settings)
    return {r["id"]: r["highlight"]["text"][0] for r in out.collect() if "text" in r["highlight"]}


def test_a_phrase_marks_its_places_only(docs):
    index = build_index(docs, "id", {"text": A.custom_analyzer("standard", filters=["lowercase"])})
    assert shown(index, Q.match_phrase(index, "text", "red fox")) == {
        1: "a <em>red</em> <em>fox</em>, a red dog and the fox", 3: "red <em>red</em> <em>fox</em>"}
    assert shown(index, Q.match_phrase(index, "text", "a dog", slop=1))[1] == "a red fox, <em>a</em> red <em>dog</em> and the fox"
    assert shown(index, Q.match_phrase_prefix(index, "text", "red d"))[1] == "a red fox, a <em>red</em> <em>dog</em> and the fox"
    both = Q.bool_(should=[Q.match_phrase(index, "text", "red fox"), Q.term(index, "text", "dog")])
    assert shown(index, both)[1] == "a <em>red</em> <em>fox</em>, a red <em>dog</em> and the fox"


def test_highlights_of_other_analyzers(docs):
    words = build_index(docs, "id", {"text": A.custom_analyzer("whitespace")})
    assert shown(words, Q.term(words, "text", "foo-bar")) == {2: "say <em>foo-bar</em> to foo"}
    grams = build_index(docs, "id", {"text": A.custom_analyzer(("ngram", 3, 3))})
    assert shown(grams, Q.terms(grams, "text", ["foo", "o-b", "-ba"], 3)) == {2: "say <em>foo-ba</em>r to <em>foo</em>"}
    pairs = build_index(docs, "id", {"text": A.custom_analyzer("standard", filters=[("shingle", 2)])})
    assert shown(pairs, Q.term(pairs, "text", "red dog")) == {1: "a red fox, a <em>red dog</em> and the fox"}
    assert re.search("<b>to</b>", shown(words, Q.term(words, "text", "to"), {"pre_tag": "<b>", "post_tag": "</b>"})[2])
