import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.operators import highlight as H
from corpusgrid.operators import queries as Q
from corpusgrid.operators import tables
from corpusgrid.operators.index import build_index
from corpusgrid.operators.schema import all_field
from corpusgrid.plans.search import View, ranked

TEXTS = {1: "the quick brown fox", 2: "quick quick fox", 3: "the lazy dog", 4: "brown dog and the quick fox jumps", 5: "fox brown quick", 6: ""}


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "id long, text string")
    return build_index(docs, "id", {"text": A.custom_analyzer("standard", filters=["lowercase"])})


def found(clause):
    return {r["id"]: r["score"] for r in clause.scores().collect()}


def brute(words, boosts=None):
    """Scores by the formula, one text at a time."""
    tokens = {d: t.split() for d, t in TEXTS.items()}
    boosts = boosts or [1.0] * len(words)
    idf = {w: 1 + math.log(len(TEXTS) / (sum(w in t for t in tokens.values()) + 1)) for w in words}
    norm = 1 / math.sqrt(sum((idf[w] * b) ** 2 for w, b in zip(words, boosts)))
    out = {}
    for d, t in tokens.items():
        hits = [(w, b) for w, b in zip(words, boosts) if w in t]
        if hits:
            s = sum(math.sqrt(t.count(w)) / math.sqrt(len(t)) * idf[w] ** 2 * b for w, b in hits)
            out[d] = round(s * norm * len(hits) / len(words), 6)
    return out


def same(a, b):
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 2e-6 for k in a)


@pytest.mark.parametrize("text", ["quick", "quick fox", "the lazy absent", "quick quick dog"])
def test_match_is_the_formula(index, text):
    same(found(Q.match(index, "text", text)), brute(text.split()))


def test_one_query_equals_a_table_of_queries(spark, index):
    texts = ["quick fox", "the lazy absent", "quick quick dog"]
    table = spark.createDataFrame(list(enumerate(texts)), "qid int, text string")
    rows = Q.match(index, "text", table).scores().collect()
    for qid, text in enumerate(texts):
        same({r["id"]: r["score"] for r in rows if r["qid"] == qid}, found(Q.match(index, "text", text)))


def test_minimum_should_match(index):
    assert set(found(Q.match(index, "text", "quick brown fox", operator="and"))) == {1, 4, 5}
    assert set(found(Q.match(index, "text", "quick brown dog", minimum_should_match="75%"))) == {1, 4, 5}
    assert Q.required(4, "or", -1) == 3 and Q.required(4, "or", "-25%") == 3 and Q.required(3, "or", 0) == 1


def test_null_queries_are_errors(index):
    for make in (Q.match, Q.term, Q.prefix, Q.wildcard, Q.fuzzy):
        with pytest.raises(ValueError):
            make(index, "text", None)


def slop_distance(text, words):
    """Least displacement by trying all placements."""
    spots = [[p - i for p, t in enumerate(text.split()) if t == w] for i, w in enumerate(words)]
    return min((max(c) - min(c) for c in itertools.product(*spots)), default=None)


@pytest.mark.parametrize("phrase", ["quick fox", "brown quick", "the fox", "quick quick"])
@pytest.mark.parametrize("slop", [0, 1, 2, 4])
def test_phrase_against_all_placements(index, phrase, slop):
    words = phrase.split()
    distances = {d: slop_distance(t, words) for d, t in TEXTS.items()}
    want = {d for d, x in distances.items() if x is not None and x <= slop}
    assert set(found(Q.match_phrase(index, "text", phrase, slop))) == want


def many(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, text string")


def by_query(clause):
    out = {}
    for r in clause.scores().collect():
        out.setdefault(r["qid"], {})[r["id"]] = r["score"]
    return out


@pytest.mark.parametrize("slop", [0, 2])
def test_a_table_of_phrases_equals_its_phrases_one_by_one(spark, index, slop):
    texts = ["quick fox", "brown quick", "the fox", "quick quick", "fox", "the zzz", "", None, "jumps quick fox", "the quick brown fox"]
    want = {q: found(Q.match_phrase(index, "text", t, slop)) for q, t in enumerate(texts) if t}
    assert by_query(Q.match_phrase(index, "text", many(spark, texts), slop)) == {q: hits for q, hits in want.items() if hits}
    assert by_query(Q.match_phrase(index, "text", many(spark, texts).limit(0), slop)) == {}


def test_a_table_of_phrase_prefixes_equals_its_phrases_one_by_one(spark, index):
    texts = ["quick f", "the q", "f", "brown d", "the x", "zzz q", "", None, "the lazy dog", "quick fo"]
    for most in (None, 1):
        want = {q: found(Q.match_phrase_prefix(index, "text", t, most)) for q, t in enumerate(texts) if t}
        table = Q.match_phrase_prefix(index, "text", many(spark, texts), most)
        assert by_query(table) == {q: hits for q, hits in want.items() if hits}


def test_a_table_of_phrases_keeps_places_of_alternatives_and_removed_words(spark):
    docs = spark.createDataFrame([(1, "hand god"), (2, "hand of god"), (3, "fist of god"), (4, "god hand")], "id long, text string")
    chain = A.custom_analyzer("standard", filters=["lowercase", ("stop", ["of"]), ("synonym", {"hand": ["hand", "palm"]})])
    stop = build_index(docs, "id", {"text": chain})
    texts = ["hand of god", "palm god", "god hand", "of"]
    for slop in (0, 1):
        want = {q: found(Q.match_phrase(stop, "text", t, slop)) for q, t in enumerate(texts)}
        assert by_query(Q.match_phrase(stop, "text", many(spark, texts), slop)) == {q: hits for q, hits in want.items() if hits}


def test_phrase_prefix_and_terms(index):
    assert set(found(Q.match_phrase_prefix(index, "text", "quick f"))) == {2, 4}
    assert set(found(Q.prefix(index, "text", "ju"))) == {4}
    assert set(found(Q.wildcard(index, "text", "?o*"))) == {1, 2, 3, 4, 5}
    assert set(found(Q.wildcard(index, "text", "d.g"))) == set()
    assert set(found(Q.fuzzy(index, "text", "dag", 1))) == {3, 4}
    assert set(found(Q.fuzzy(index, "text", "zzzzzz", 1))) == set()
    assert Q.max_edits("abcdef", 0.5) == 3 and Q.max_edits("abcdef", 2) == 2


def test_bool_logic(index):
    def q(w):
        return Q.term(index, "text", w)
    assert set(found(Q.bool_([q("quick")], [q("brown")], [q("the")]))) == {2, 5}
    assert set(found(Q.bool_(should=[q("quick"), q("brown"), q("dog")], minimum_should_match=2))) == {1, 4, 5}
    assert found(Q.bool_(must_not=[q("fox")], docs=index.docs)) == {3: 1.0, 6: 1.0}
    with pytest.raises(ValueError):
        Q.bool_(must_not=[q("fox")])
    # a boost on all clauses changes nothing, since the norm takes it out again
    plain, boosted = (Q.bool_(should=[Q.boost(q("quick"), b), Q.boost(q("dog"), b)]) for b in (1, 3))
    same(found(plain), found(boosted))


def test_matched_and_not_matched_cover_all(index):
    for clause in (Q.match(index, "text", "quick"), Q.match_phrase(index, "text", "quick fox"), Q.prefix(index, "text", "l")):
        inside, outside = set(found(clause)), set(found(Q.not_(clause, index.docs)))
        assert inside | outside == set(TEXTS) and not inside & outside


def test_constant_and_mixed_scores(index):
    all_docs = Q.match_all(index.docs, "id")
    assert set(found(all_docs).values()) == {1.0}
    mixed = Q.bool_([all_docs], [Q.term(index, "text", "lazy")], disable_coord=True)
    single = found(Q.term(index, "text", "lazy"))[3]
    assert abs(found(mixed)[3] - (1 + single)) < 2e-6


def test_text_query(index):
    got = found(Q.text_query(index, ["text^2"], required="quick", prohibited="the"))
    assert set(got) == {2, 5}
    got = found(Q.text_query(index, ["text"], optional="quick brown", default_operator="and"))
    assert set(got) == {1, 4, 5}


def test_many_copies_of_one_document(spark):
    """A third of all rows share their text: scores stay equal and whole."""
    docs = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    hot = build_index(docs, "id", {"text": A.tok_whitespace}, "hot")
    got = found(Q.match(hot, "text", "hot"))
    assert len(got) == 100 and len(set(got.values())) == 1


# --- requests
@pytest.fixture(scope="module")
def view(spark):
    docs = spark.range(25).select("id", (F.col("id") % 4).alias("k"), F.concat(F.lit("i"), F.col("id") % 2).alias("_index"))
    return View(docs, "id").sort("id")


def listed(df):
    return [r["id"] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("first, length, want", [
    (0, 5, [0, 1, 2, 3, 4]), (5, 2, [5, 6]), (0, 15, list(range(10))), (5, 15, [5, 6, 7, 8, 9]), (-4, 3, [6, 7, 8]),
    (5, -2, [5, 6, 7]), (-5, -2, [5, 6, 7]), (1000, 10, [])])
def test_slice(view, first, length, want):
    assert listed(view.slice(first, length)) == want


def test_total_equals_scan(view):
    assert view.total().first()["total"] == 25
    with pytest.raises(ValueError):
        view.scan()
    scan = view.sort().scan()
    assert scan.count() == 25 and scan.agg(F.max("_score")).first()[0] == 0


def test_setters_copy(view):
    other = view.page(5, 5).where(F.col("k") == 1)
    assert view.size_ == 10 and view.filter_ is None and listed(other.hits()) == [21]


def test_fetch_is_the_page(view, index):
    assert [r["id"] for r in view.page(3, 4).fetch().collect()] == [3, 4, 5, 6]
    best = View(index.docs, "id").matching(Q.match(index, "text", "quick fox")).page(0, 3)
    assert [r["id"] for r in best.fetch().collect()] == [r["id"] for r in best.hits().collect()]
    assert view.where(F.col("id") < 0).fetch().count() == 0


def test_shapes_of_hits(view):
    assert view.page(0, 1).fields("k").first()["k"] == [0]
    assert view.page(0, 1).script_fields({"twice": "k * :n"}, n=2).first()["twice"] == 0
    partial = view.page(0, 1).source(["k"]).first().asDict()
    assert partial == {"_index": "i0", "k": 0, "is_partial": True}


def test_scroll_tranches(view):
    rows = {r["id"]: (r["rank"], r["tranche"]) for r in view.sort("-id").scroll(10).collect()}
    assert rows[24] == (1, 0) and rows[14] == (11, 1) and rows[0] == (25, 2)


def test_ranks_are_complete(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 13).alias("k"))
    got = ranked(df, [F.col("k"), F.col("id")]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))
    assert [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)


def test_delete_by_query(view):
    kept, report = view.where(F.col("k") == 1).delete_by_query()
    assert kept.count() == 19
    assert {r["_index"]: r["deleted"] for r in report.collect()} == {"i1": 6}


def test_highlight(spark):
    hit = spark.createDataFrame([(1, "Aardwolf eats <ants>. Not aardwolfs.")], "id int, name string")
    got = H.highlight(hit, ["aardwolf"], {"name": None}).first()["highlight"]
    assert got == {"name": ["<em>Aardwolf</em> eats <ants>. Not aardwolfs."]}
    html = H.highlight(hit, ["ants"], {"name": {"encoder": "html", "pre_tag": "<b>", "post_tag": "</b>"}}).first()["highlight"]
    assert html["name"] == ["Aardwolf eats &lt;<b>ants</b>&gt;. Not aardwolfs."]
    assert H.highlight(hit, ["zebra"], {"name": None}).first()["highlight"] == {}
    with pytest.raises(ValueError):
        H.highlight(hit, ["a"], {"name": None}, {"fields": ["name"]})


def test_removed_words_keep_their_places(spark):
    docs = spark.createDataFrame([(1, "hand god"), (2, "hand of god"), (3, "hand in god"), (4, "of the")], "id long, text string")
    stop = build_index(docs, "id", {"text": A.analyzer("standard")})
    assert set(found(Q.match_phrase(stop, "text", "hand of god"))) == {2, 3}
    assert set(found(Q.match_phrase(stop, "text", "hand god"))) == {1}
    for clause in (Q.match(stop, "text", "of the"), Q.match_phrase(stop, "text", "of the"), Q.match_phrase_prefix(stop, "text", "the"),
                   Q.match(stop, "text", ""), Q.match_phrase(stop, "text", "")):
        assert found(clause) == {}


def test_tokens_made_of_one_share_its_place(spark):
    chain = A.custom_analyzer("standard", filters=["lowercase", ("stop", ["my"]), ("synonym", {"hand": ["palm", "fist"]}), ("edge_ngram", 4, 9)])
    row = spark.createDataFrame([("My hand hurts",)], "t string").select(A.placed(chain)(F.col("t")).alias("x")).first()["x"]
    assert [(r["t"], r["p"]) for r in row] == [("palm", 1), ("fist", 1), ("hurt", 2), ("hurts", 2)]
    twice = A.custom_analyzer("whitespace", filters=[("synonym", {"a": ["a", "b"]}), "unique", ("shingle", 2)])
    row = spark.createDataFrame([("a c b a",)], "t string").select(A.placed(twice)(F.col("t")).alias("x")).first()["x"]
    assert [(r["t"], r["p"]) for r in row] == [("a b", 0), ("b c", 0)]
    plain = spark.createDataFrame([("Hurts",)], "t string").select(
        A.custom_analyzer("standard", filters=["lowercase", "porter_stem", "icu_normalizer"])(F.col("t")).alias("x"))
    assert plain.first()["x"] == ["hurt"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("similarity, prefix", [(1, 0), (2, 0), (0.5, 0), (3, 2)])
def test_near_pairs_lose_nothing(spark, similarity, prefix):
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("abc", repeat=n)][::3] + ["abcabcabc", "xbcabcabc", "abcxbcab"]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    pairs = Q.near_pairs(df.withColumnRenamed("term", "seed"), df, similarity, prefix).collect()
    want = {(s, t) for s in words for t in words if edits(s, t) <= Q.max_edits(s, similarity) and s[:prefix] == t[:prefix]}
    assert {(r["seed"], r["term"]) for r in pairs} == want and len(pairs) == len(want)


def test_many_expansions_are_all_used(spark):
    docs = spark.createDataFrame([(i, f"the t{i:03d}x") for i in range(300)], "id long, text string")
    many = build_index(docs, "id", {"text": A.custom_analyzer("standard", filters=["lowercase"])})
    assert len(found(Q.match_phrase_prefix(many, "text", "the t"))) == 300
    assert len(found(Q.fuzzy(many, "text", "t000x", 3))) == 300
    assert len(found(Q.match_phrase_prefix(many, "text", "the t", max_expansions=5))) == 5


def test_a_table_of_queries_meets_clauses_for_all(spark, index):
    table = spark.createDataFrame([(0, "quick fox"), (1, "lazy dog"), (2, "absent")], "qid int, text string")
    many = Q.match(index, "text", table)
    rows = Q.bool_(must=[many, Q.prefix(index, "text", "bro")], must_not=[Q.term(index, "text", "jumps")]).scores().collect()
    one = {q: found(Q.bool_(must=[Q.match(index, "text", t), Q.prefix(index, "text", "bro")], must_not=[Q.term(index, "text", "jumps")]))
           for q, t in ((0, "quick fox"), (1, "lazy dog"))}
    assert {(r["qid"], r["id"]) for r in rows} == {(q, d) for q, hits in one.items() for d in hits}
    demoted = Q.boosting(many, Q.term(index, "text", "lazy"), 0.5).scores().collect()
    plain = {(r["qid"], r["id"]): r["score"] for r in many.scores().collect()}
    assert all(abs(r["score"] - plain[r["qid"], r["id"]] * (0.5 if r["id"] == 3 else 1)) < 2e-6 for r in demoted) and len(demoted) == len(plain)
    assert max(r["rank"] for r in many.best(2).collect()) == 2
    with pytest.raises(ValueError):
        Q.bool_(should=[many, Q.prefix(index, "text", "bro")])
    with pytest.raises(ValueError):
        Q.dis_max([many, Q.prefix(index, "text", "bro")])
    with pytest.raises(ValueError):
        Q.range_(index.docs, "id", "id", from_=1, gte=2)


def test_indices_for_the_rest(index):
    hit = Q.term(index, "text", "dog")
    assert set(found(Q.indices(index.docs, [3], hit, "none", "id"))) == {3}
    assert found(Q.indices(index.docs, [3], hit, index_column="id"))[1] == 1.0
    assert len(found(Q.indices(index.docs, [3], hit, index_column="id"))) == 6


def test_words_of_any_field(spark, index):
    rows = spark.createDataFrame([(1, "red", "fox"), (2, None, "red dog"), (3, "fox", None), (4, None, None)], "id long, title string, text string")
    whole = build_index(all_field(rows, include=["title", "text"]), "id", {"_all": A.analyzer("whitespace")})
    assert set(found(Q.anywhere(whole, "red fox", operator="and"))) == {1}
    assert set(found(Q.anywhere(whole, "red fox"))) == {1, 2, 3}
    with pytest.raises(ValueError):
        Q.anywhere(index, "fox")


def test_explanations_add_up(index):
    view = View(index.docs, "id").matching(Q.match(index, "text", "quick fox lazy"))
    rows = view.explain_scores([(w, Q.term(index, "text", w)) for w in ("quick", "fox", "lazy")]).collect()
    assert len(rows) == 5
    for r in rows:
        x = r["explanation"]
        assert abs(sum(d["value"] for d in x["details"]) - x["value"]) < 5e-6


def test_highlights_come_from_the_query(spark, index):
    asked = Q.bool_(must=[Q.match_phrase(index, "text", "quick fox")], should=[Q.prefix(index, "text", "ju"), Q.fuzzy(index, "text", "brawn", 1)],
                    must_not=[Q.term(index, "text", "lazy")])
    rows = View(index.docs, "id").matching(asked).highlight(None, {"text": {"number_of_fragments": 0}}, {"pre_tag": "<", "post_tag": ">"}).collect()
    assert {r["id"]: r["highlight"]["text"] for r in rows} == {
        2: ["quick <quick> <fox>"], 4: ["<brown> dog and the <quick> <fox> <jumps>"]}
    cut = View(index.docs, "id").matching(asked).highlight(None, {"text": {"fragment_words": 3, "number_of_fragments": 1}}).collect()
    assert {r["id"]: r["highlight"]["text"] for r in cut}[4] == ["<em>brown</em> dog and"]
    stemmed = build_index(spark.createDataFrame([(1, "He runs & ran.")], "id long, text string"), "id", {"text": A.analyzer("english")})
    out = View(stemmed.docs, "id").matching(Q.match(stemmed, "text", "run")).highlight(None, {"text": None}, {"encoder": "html"}).first()
    assert out["highlight"]["text"] == ["He <em>runs</em> &amp; ran."]


def test_a_table_of_queries_is_scored_document_by_document(spark, index, monkeypatch):
    texts = ["quick fox", "the lazy absent", "quick quick dog", None, "", "zzz", "brown dog and the quick fox jumps"]
    table = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "qid string, text string")
    want = {f"q{i}": found(Q.match(index, "text", t)) for i, t in enumerate(texts) if t}
    monkeypatch.setattr(tables, "HELD", 3)
    monkeypatch.setattr(tables, "CELLS", 8)
    for rows in (1 << 18, 2):  # one pass, and a few
        monkeypatch.setattr(tables, "ROWS", rows)
        got = by_query(Q.match(index, "text", table))
        assert got.keys() == {q for q, hits in want.items() if hits}
        for q, hits in got.items():
            same(hits, want[q])
        for size in (1, 2, 9):
            best = {(r["qid"], r["rank"]): r["id"] for r in Q.match(index, "text", table).best(size).collect()}
            assert best == {(q, k + 1): i for q, hits in want.items() for k, i in enumerate(sorted(hits, key=lambda i: (-hits[i], i))[:size])}
    plan = Q.match(index, "text", table).best(2)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(qid#\d+, id#", plan)  # no pair of a query and a document is shuffled


def test_documents_of_one_key_are_one_document(spark):
    rows = [(1, "quick fox"), (1, "quick dog dog"), (None, "quick"), (None, "fox fox"), (2, "fox")]
    twice = build_index(spark.createDataFrame(rows, "id long, text string"), "id", {"text": A.tok_whitespace})
    texts = ["quick fox dog", "quick fox"]
    got = by_query(Q.match(twice, "text", many(spark, texts)))
    for q, t in enumerate(texts):
        same(got[q], found(Q.match(twice, "text", t)))
    want = {(q, r["id"]): r["score"] for q, t in enumerate(texts) for r in Q.match(twice, "text", t).best(2).collect()}
    assert {(r["qid"], r["id"]): r["score"] for r in Q.match(twice, "text", many(spark, texts)).best(2).collect()} == pytest.approx(want)


@pytest.mark.parametrize("make", [Q.match_phrase, lambda i, f, t: Q.match_phrase(i, f, t, 2), Q.match_phrase_prefix])
def test_positions_are_read_where_all_words_of_a_phrase_stand(spark, index, monkeypatch, make):
    written, plain = {}, Q.materialise
    monkeypatch.setattr(Q, "materialise", lambda df, name: written.setdefault(name, plain(df, name)))
    rows = by_query(make(index, "text", many(spark, ["quick brown fox", "the dog", "lazy lazy"])))
    assert set(rows[0]) >= {1}
    holds = {(0, 1), (0, 4), (0, 5), (1, 3), (1, 4), (2, 3)}
    got = {tuple(r) for r in written["phrase-documents"].select("qid", "id").collect()}
    # the last word of a phrase with a prefix is looked for afterwards
    assert got == (holds if make is not Q.match_phrase_prefix else {(0, 1), (0, 4), (0, 5), (1, 1), (1, 3), (1, 4), (2, 3)})


def test_a_table_of_fuzzy_words_stores_no_deletions(spark):
    own = build_index(spark.createDataFrame(list(TEXTS.items()), "id long, text string"), "id", {"text": A.tok_whitespace})
    asked = many(spark, ["quik fx", "lasy"])
    like, fuzzy = Q.fuzzy_like_this(own, "text", asked, 1), Q.match(own, "text", asked, fuzziness=1)
    assert set(by_query(fuzzy)) == {0, 1} and not by_query(like) and not own.has_deletions


def test_what_holds_for_a_table_of_queries_is_met_by_document(spark, index):
    q, p, texts = (lambda t: Q.match(index, "text", t)), (lambda t: Q.prefix(index, "text", t)), ["quick fox", "the lazy", "brown"]
    for options in ({"must": [p("bro")], "must_not": [q("jumps")]}, {"should": [p("do"), p("la")]},
                    {"should": [p("do")], "minimum_should_match": 1}, {"must": [p("bro")], "should": [p("do")], "disable_coord": True}):
        others = options.pop("must", [])
        table = by_query(Q.bool_(must=[Q.match(index, "text", many(spark, texts)), *others], **options))
        for k, t in enumerate(texts):
            same(table.get(k, {}), found(Q.bool_(must=[q(t), *others], **options)))
    clause = Q.bool_(must=[Q.match(index, "text", many(spark, texts)), p("bro")], must_not=[q("jumps")])
    plan = clause.best(2)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(qid#\d+, id#", plan)
