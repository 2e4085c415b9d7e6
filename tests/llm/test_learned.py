"""Language identification, personal data and page extraction: brute force, held-out accuracy, odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusgrid.llm import crf, html_extract, langid, pii
from corpusgrid.llm.lattice import UNKNOWN, Lattice, word_pieces

SF = "/root/testdata/sf0.001"


def all_cuts(text):
    for marks in itertools.product([0, 1], repeat=len(text) - 1):
        edges = [0, *[i + 1 for i, m in enumerate(marks) if m], len(text)]
        yield [text[a:b] for a, b in zip(edges, edges[1:])]


def test_forward_sums_all_segmentations():
    pieces = word_pieces()
    lattice, rng = Lattice(pieces), np.random.default_rng(1)
    table = rng.random((len(pieces) + 1, 2)) / 1000
    table[-1] = UNKNOWN
    at = {p: i for i, p in enumerate(pieces)}
    words = ["the", "était", "zß你x", "a", "information"]
    got = lattice.log_likelihood(words, table)
    for word, row in zip(words, got):
        total = np.zeros(2)
        for cut in all_cuts("▁" + word):
            if all(p in at or len(p) == 1 for p in cut):
                total += np.prod([table[at.get(p, len(pieces))] for p in cut], axis=0)
        assert np.allclose(row, np.log(total))
    long = "information" * 9
    one = lattice.long_word(long, table)
    codes_ok = lattice.long_word("information", table)
    assert np.allclose(codes_ok, got[4]) and np.isfinite(one).all() and (one < 5 * got[4]).all()


def test_expected_counts_add_up():
    pieces = word_pieces()
    lattice = Lattice(pieces)
    p = np.full(len(pieces) + 1, 1 / len(pieces))
    p[-1] = UNKNOWN
    used = lattice.expected(["the", "the"], np.array([1.0, 2.0]), p)
    sizes = np.array([*map(len, pieces), 1])
    assert abs((used * sizes).sum() - 3 * 4) < 1e-9  # every use covers its letters once


def test_long_symbol_runs_keep_finite_sums():
    pieces = word_pieces()
    lattice = Lattice(pieces)
    p = np.full(len(pieces) + 1, 1 / len(pieces))
    p[-1] = UNKNOWN
    for rule in ("\u2500" * 38, "\u2500" * 40, "\u2500" * 70, "information" * 9, "the\u2500" * 30):
        scores = lattice.log_likelihood([rule], np.stack([p, p], 1))[0]
        assert np.isfinite(scores).all() and np.allclose(scores, lattice.long_word(rule, np.stack([p, p], 1)))
        used = lattice.expected([rule, "the"], np.array([2.0, 1.0]), p)
        assert np.isfinite(used).all() and abs((used * np.array([*map(len, pieces), 1])).sum() - 2 * (len(rule) + 1) - 4) < 1e-6
    words, counts = ["the", "information", "\u2500abc"], np.array([1.0, 3.0, 2.0])
    assert np.allclose(lattice.expected(words, counts, p), lattice.expected_long(words, counts, p))


def test_symbol_runs_in_training_and_in_scored_texts(spark):
    from corpusgrid.llm.langid import Scorer, fit
    import pyarrow as pa
    rule = "\u2500" * 38
    texts = {"en": "the and of that with this ", "fr": "le la des une que dans "}
    rows = [(i, texts[lang] * 5 + rule + " " + "\u2500" * 60, lang) for i, lang in enumerate(["en", "fr"] * 20)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.isfinite(model.table).all()
    got, sure = Scorer(model).score(pa.array([texts["fr"] + rule, texts["en"] + rule, texts["fr"]]))
    assert got == ["fr", "en", "fr"] and np.isfinite(sure).all() and (sure > 0.9).all()


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).where(langid.held_out(F.col("doc_id"))).collect()
    right = [r.lang == r.lang_pred for r in rows if r.lang and r.lang_pred != "und"]
    assert len(right) >= 20 and np.mean(right) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    odd = [(None, "en"), ("", "en"), ("123 ... !", "en"), ("é", None), ("日本", None), ("the and of that " * 3, "en"), ("x" * 3000, None),
           ("un le la des " * 4000, "fr"), ("İ ŞK", None)]
    rows = [(i, t, lang, 1.0, "s") for i, (t, lang) in enumerate(odd * 3)] + [
        (100 + i, ("the and of that with " if i % 2 else "le la des une que ") * 5, "en" if i % 2 else "fr", 1.0, "s") for i in range(40)] + [
        (None, "the of and", "en", 0.0, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    out = langid.identify(df).collect()
    assert len(out) == len(rows)
    for r in out:
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.text.startswith("the and"):
            assert r.lang_pred == "en"
        elif r.text.startswith(("le la", "un le")):
            assert r.lang_pred == "fr"
    assert langid.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    return [(k, *m.span()) for k in pii.KINDS for m in re.finditer(PLAIN[k], text) if pii.valid(k, m[0])]


def test_base_spans_match_plain_patterns():
    rng = random.Random(5)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "1.2.3.400", "4111 1111 1111 1111", "4111111111111112", "+1 (487) 555-7209", "+49 30 1", " ", "-",
             "12", "9", ".", "é", "😀", "a@b.c@d.e", "+", "001.002.003.004.5", "\n", "z%+"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("a" * 200_000 + "1" * 200_000 + "@") == []


def test_gradient_of_the_crf():
    rng = np.random.default_rng(0)
    p = crf.initial(10, 3)
    codes, tags = rng.integers(0, 10, (4, 6)), rng.integers(0, 3, (4, 6))
    _, g = crf.gradient(p, codes, tags)
    for name in ("embed", "xf", "hb", "out", "step", "begin", "cf"):
        at = tuple(int(rng.integers(n)) for n in p[name].shape)
        keep, values = p[name][at], []
        for d in (1e-5, -1e-5):
            p[name][at] = keep + d
            values.append(crf.gradient(p, codes, tags)[0])
        p[name][at] = keep
        assert abs((values[0] - values[1]) / 2e-5 - g[name][at]) < 1e-5, name


@pytest.fixture(scope="module")
def tagger():
    return pii.fit(pii.seeds(np.random.default_rng(1), 900))


def test_tagger_on_held_out_stretches(tagger):
    hits = total = 0
    for text, spans in pii.seeds(np.random.default_rng(2), 300):
        found = pii.model_spans(tagger, [text])[0]
        hits += len(set(found) & set(spans))
        total += len(spans)
    assert hits / total >= 0.8


def test_regions_reach_over_whole_local_parts():
    text = "write to firstname.middlename.lastname.department @ example.com soon, " + "plain words " * 9 + "or call 5"
    (a, b), (c, d) = pii.regions(text)
    assert text[a:b].startswith("firstname.") and text[c:d] == "plain words or call 5" and d == len(text)
    assert pii.regions("a" * 200_000 + "@" + "b" * 200_000 + "1" * 50) == [(0, 400_051)]
    assert pii.regions("7") == [(0, 1)] and pii.regions("") == []


def test_windows_are_joined_over_the_whole_text(tagger):
    text = "word " * 50 + "mail joe.smith12@mail.example.com here " + "word " * 30 + "+1 (487) 555-7209 end"
    found = pii.all_spans(pii.base_spans(text), pii.model_spans(tagger, [text])[0])
    assert [text[a:b] for _, a, b in found] == ["joe.smith12@mail.example.com", "+1 (487) 555-7209"]
    assert pii.model_spans(tagger, ["", "no numbers here"]) == [[], []]


def test_find_and_mask_odd_rows(spark):
    texts = [None, "", "plain", "a@b.co", "a@b.co" * 2, "x 1.2.3.4 y\nz +1 (487) 555-7209", "9" * 50_000, "é😀 4111 1111 1111 1111"]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts * 2)] + [(None, "a@b.co", "own")],
                               "doc_id long, text string, spans string")
    found = pii.find(df, sample=100, windows=50)
    rows = found.collect()
    for r in rows:
        assert [tuple(s) for s in r.base] == brute_spans(r.text or "")
        assert set(r.base) <= set(r.spans)
    masked = {r.doc_id: r.text for r in pii.mask(found).collect()}
    assert masked[0] is None and masked[2] == "plain" and masked[3] == "[EMAIL]" and masked[5] == "x [IP] y\nz [PHONE]"
    assert pii.find(df.limit(0)).collect() == []


def test_marginals_match_brute_force():
    model = html_extract.Model({"tag p": [0.2, 0.9, 0.1], "tag #text": [0.3, 0.1, 0.5], "tag div": [0.7, 0.0, 0.2]},
                               np.random.default_rng(3).normal(size=(2, 3, 3)))
    nodes = html_extract.parse("<div><p>a</p>b</div><p>c</p>")
    unary = model.unary(nodes)
    got = np.array(model.sweep(nodes, unary)[0])
    total = np.zeros((len(nodes), 3))
    for states in itertools.product(range(3), repeat=len(nodes)):
        weight = np.prod([unary[i][s] for i, s in enumerate(states)])
        for i, n in enumerate(nodes[1:], 1):
            weight *= model.ties[html_extract.tie(n)][states[n.parent]][states[i]]
        total[np.arange(len(nodes)), states] += weight
    assert np.allclose(got, total / total.sum(1, keepdims=True))


@pytest.fixture(scope="module")
def extractor():
    return html_extract.default_model()


def test_extraction_on_held_out_pages(extractor):
    same = union = 0
    for page, kept in html_extract.labelled_pages(120, seed=77):
        got = set(filter(None, extractor.text(page).split("\n\n")))
        same, union = same + len(got & kept), union + len(got | kept)
    assert same / union >= 0.95


def test_extraction_of_the_given_pages(spark, extractor):
    import html
    for r in html_extract.extract(spark.read.parquet(f"{SF}/pages.parquet"), extractor).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        expected = "\n\n".join(x for p in parts if (x := " ".join(html.unescape(p).split())))
        assert r.text == expected and r.n_chars == len(expected)


def test_unclosed_heads_and_skips_lose_no_text(extractor):
    body = "<article><h1>A title</h1>{}<p>" + "One sentence of the article, and one more of it. " * 6 + "</p></article><footer>Imprint</footer>"
    whole = extractor.text(f"<html><head><title>t</title></head><body>{body.format('')}</body></html>")
    assert whole.startswith("A title\n\nOne sentence") and "Imprint" not in whole
    for start in ("<head><title>t</title>", "<head><meta charset=utf-8><script>x()</script>", "<html><head>", ""):
        assert extractor.text(start + body.format("")) == whole
    for part in ("<div><svg><path d=x></div>", "<div><svg><g><text>no</text></svg></div>", "<div><svg><foreignObject><div>no</div></foreignObject></svg></div>"):
        assert extractor.text(f"<html><head></head><body>{body.format(part)}</body></html>") == whole
    assert "E = mc" in extractor.text(body.format("<p>Here is <math><mi>E</mi> = <mi>mc</mi></math> in a sentence of the article.</p>"))
    assert "fallback words" in extractor.text(body.format("<p>An <object data=x>fallback words</object> in a sentence of the article.</p>"))


def test_extraction_of_odd_pages(spark, extractor):
    pages = [None, "", "   ", "<", "a < b & c &amp; d. This is plain text.", "<div>" * 8 + "<p>Deep text stands here.</p>" + "</div>" * 8, "<script>var a='<p>x</p>'",
             "<p>one<p>two &eacute;&#x1F600;<br>three</p></p></div>", "<article><p>Body  of\n the text.</p><p>More of it.</p><ul class='comments'><li>Nice one.</li></ul></article>",
             "<html><head><title>t</title><body><article><p>x &lt;b&gt; y.</p><p>And z.</p><aside>More.</aside></article>"]
    rows = [(i, "u", p, 5) for i, p in enumerate(pages)] + [(None, None, pages[-1], 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = {r.page_id: r.text for r in html_extract.extract(df, extractor).collect()}
    assert out[0] == out[1] == out[2] == out[6] == "" and out[5] == "Deep text stands here."
    assert out[7] == "one\n\ntwo é😀 three" and out[8] == "Body of the text.\n\nMore of it." and out[9] == out[None] == "x <b> y.\n\nAnd z."
    assert html_extract.extract(df.limit(0), extractor).collect() == []
    assert hashlib.sha256(out[4].encode()).hexdigest() == hashlib.sha256(b"a < b & c & d. This is plain text.").hexdigest()
    assert isinstance(extractor.text("<div>" * 20_000 + "x" + "<p>" * 20_000), str)
