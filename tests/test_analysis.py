import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.functions.stemming import porter, tf_porter_stem, unicode_normalise
from corpusgrid.operators import index as I

ORDER = 'To order part #ABC-123 email "joe@foo.org"'


def run(spark, fn, text, drop_gaps=True):
    tokens = fn(F.col("text"))
    row = spark.createDataFrame([(text,)], "text string").select((A.terms(tokens) if drop_gaps else tokens).alias("t")).first()
    return row["t"]


@pytest.mark.parametrize("tokenizer, want", [
    (A.tok_whitespace, ["To", "order", "part", "#ABC-123", "email", '"joe@foo.org"']),
    (A.tok_letter, ["To", "order", "part", "ABC", "email", "joe", "foo", "org"]),
    (A.tok_keyword, [ORDER]),
    (A.tok_standard, ["To", "order", "part", "ABC", "123", "email", "joe", "foo.org"]),
    (A.tok_uax_url_email, ["To", "order", "part", "ABC", "123", "email", "joe@foo.org"]),
])
def test_tokenizers(spark, tokenizer, want):
    assert run(spark, tokenizer, ORDER) == want


def test_stop_words_leave_gaps(spark):
    chain = A.custom_analyzer("standard", filters=["lowercase", ("stop", ["to"])])
    assert run(spark, chain, "To order", drop_gaps=False) == [None, "order"]


def test_english_sentence(spark):
    chain = A.chain(A.analyzer("standard"), A.tf_stop(["the", "been"]), tf_porter_stem)
    got = run(spark, chain, "The quick brown foxes jumping over the lazy dogs")
    assert got == ["quick", "brown", "fox", "jump", "over", "lazi", "dog"]


@pytest.mark.parametrize("word, stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("agreed", "agre"), ("feed", "feed"), ("plastered", "plaster"),
    ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
    ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("vietnamization", "vietnam"), ("triplicate", "triplic"), ("hopefulness", "hope"),
    ("revival", "reviv"), ("adoption", "adopt"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"),
    ("has", "ha"), ("noted", "note"), ("lazy", "lazi"), ("generalizations", "gener"), ("oscillators", "oscil")])
def test_porter(word, stem):
    assert porter(word) == stem


def test_edge_ngram_and_truncate(spark):
    chain = A.custom_analyzer(("edge_ngram", 1, 10), [("mapping", {"ß": "ss"})], [("truncate", 20), "lowercase"])
    assert run(spark, chain, "Groß") == ["g", "gr", "gro", "gros", "gross"]
    assert run(spark, A.tok_edge_ngram(2, 20), "a") == []


def test_ngram_shingle_path(spark):
    assert run(spark, A.tok_ngram(2, 3), "abcd") == ["ab", "abc", "bc", "bcd", "cd"]
    assert run(spark, A.chain(A.tok_whitespace, A.tf_shingle(2)), "a b c") == ["a b", "b c"]
    assert run(spark, A.chain(A.tok_whitespace, A.tf_shingle(2)), "a") == []
    assert run(spark, A.tok_path_hierarchy("/"), "/a/b/c") == ["/a", "/a/b", "/a/b/c"]


def test_word_delimiter_and_elision(spark):
    assert run(spark, A.chain(A.tok_whitespace, A.tf_word_delimiter), "PowerShot SD500 Wi-Fi O'Neil's") == [
        "Power", "Shot", "SD", "500", "Wi", "Fi", "O", "Neil"]
    assert run(spark, A.chain(A.tok_whitespace, A.tf_elision()), "l'avion qu'il") == ["avion", "il"]


def test_phonetic_synonym_unique(spark):
    assert run(spark, A.chain(A.tok_whitespace, A.tf_phonetic), "Robert Rupert") == ["R163", "R163"]
    assert run(spark, A.chain(A.tok_whitespace, A.tf_synonym({"tv": ["television", "telly"]})), "my tv") == ["my", "television", "telly"]
    assert run(spark, A.chain(A.tok_whitespace, A.tf_unique), "a b a") == ["a", "b"]


def test_unicode(spark):
    df = spark.createDataFrame([("ﬁne",), ("STRASSE",)], "w string")
    assert [r[0] for r in df.select(unicode_normalise()("w")).collect()] == ["fine", "strasse"]
    assert spark.range(1).select(A.collation_key_equal(F.lit("Éa"), F.lit("ea"))).first()[0]


@pytest.mark.parametrize("spec", [dict(tokenizer="nope"), dict(filters=["nope"]), dict(char_filters=["nope"])])
def test_unknown_parts(spec):
    with pytest.raises(ValueError, match="unknown"):
        A.custom_analyzer(**spec)


def test_unknown_analyzer_and_role():
    with pytest.raises(ValueError):
        A.analyzer("klingon")
    with pytest.raises(ValueError):
        A.pick_analyzer("other")


def test_analyzer_roles():
    index, search, quote, query = (lambda c: c for _ in range(4))
    assert A.pick_analyzer("index", index=index, search=search) is index
    assert A.pick_analyzer("search", index=index) is index
    assert A.pick_analyzer("search", index=index, search=search, query=query) is query
    assert A.pick_analyzer("quote", index=index, search=search, quote=quote) is quote
    assert A.pick_analyzer("quote", index=index, search=search) is search


def test_postings_round_trip(spark):
    texts = [(1, "b a b"), (2, ""), (3, None), (4, "a")]
    docs = spark.createDataFrame(texts, "id long, text string")
    rows = I.build_postings(docs, "id", {"text": A.tok_whitespace}).collect()
    got = {(r["id"], r["term"]): (r["tf"], r["field_len"], r["positions"]) for r in rows}
    assert got == {(1, "a"): (1, 3, [1]), (1, "b"): (2, 3, [0, 2]), (4, "a"): (1, 1, [0])}


def test_postings_keep_gaps(spark):
    docs = spark.createDataFrame([(1, "the cat the dog")], "id long, text string")
    chain = A.custom_analyzer("whitespace", filters=[("stop", ["the"])])
    rows = I.build_postings(docs, "id", {"text": chain}).orderBy("term").collect()
    assert [(r["term"], r["positions"], r["field_len"]) for r in rows] == [("cat", [1], 2), ("dog", [3], 2)]


def test_term_vector(spark):
    docs = spark.createDataFrame([(1, "Ab, cD")], "id long, text string")
    assert [tuple(r) for r in I.term_vector(docs, "id", "text").orderBy("pos").collect()] == [(1, "ab", 0, 0, 2), (1, "cd", 1, 4, 6)]


def test_decompound(spark):
    vocab = spark.createDataFrame([("dampfschiff",), ("schiff",)], "term string")
    words = spark.createDataFrame([("dampf",), ("schiff",)], "word string")
    got = {tuple(r) for r in I.decompound(vocab, words).select("term", "part").collect()}
    assert got == {("dampfschiff", "dampf"), ("dampfschiff", "schiff")}
