"""The two-way index against counting, and phrases against a loop over all of them."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusgrid.llm.fm_index import FmIndex, Phrases
from corpusgrid.llm import phrases as mining
from corpusgrid.llm.phrases import Shard, collocations, frequent_phrases, packed, shards, unpacked


@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_both_sides_extend_to_the_counts_of_a_loop(kinds):
    rng = np.random.default_rng(kinds)
    for _ in range(60):
        text = rng.integers(0, kinds + 1, rng.integers(2, 200)).astype(np.int32)
        text[-1] = 0
        index = FmIndex.of(text)
        phrases = index.single()
        named = [(int(s),) for s in phrases.symbol]
        for length in range(2, 6):
            some = rng.random(len(phrases)) < 0.9  # only these count as frequent
            phrases = Phrases(*(c[some] for c in (phrases.lo, phrases.back, phrases.size, phrases.base, phrases.symbol)))
            named, left = [p for p, s in zip(named, some) if s], bool(rng.integers(0, 2))
            longer = index.extend(phrases, left)
            names = [(int(s), *named[b]) if left else (*named[b], int(s)) for b, s in zip(longer.base, longer.symbol)]
            met = Counter(tuple(text[i:i + length].tolist()) for i in range(len(text) - length + 1))
            want = {p: n for p, n in met.items() if 0 not in p and p[1:] in named and p[:-1] in named}
            assert len(set(names)) == len(names) and dict(zip(names, longer.size.tolist())) == want
            phrases, named = longer, names


def test_words_of_a_shard():
    s = Shard()
    s.add(["A b.\tB  a", "", "É É\x00,;c d\ne"])
    row = s.row(1, "en").to_pylist()[0]
    codes = unpacked(row["text"], row["size"]).tolist()
    assert [row["words"][c - 1] if c else "|" for c in codes] == "a b | b a | É É\x00 | c d | e |".split(" ")
    assert row["counts"] == [2, 2, 1, 1, 1, 1, 1]


def loop(rows, least, top):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(5, len(w) - i) + 1):
                    of = counts.setdefault(lang, Counter())
                    of[tuple(w[i:i + k])] += 1
    out = []
    for lang, of in counts.items():
        found = {p: f for p, f in of.items() if len(p) > 1 and f >= least}
        held = lambda p, q: len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
        scored = []
        for p, a in found.items():
            if any(f >= a and held(p, q) for q, f in found.items()):
                continue
            score, k = min((1000 * a * words[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, words[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(n=150):
    rng = random.Random(5)
    rows = [(None, None), ("en", ""), ("en", None), (None, "One two One two. one\ttwo, One"), ("de", "ß Ä" * 3)]
    for _ in range(n):
        words = [rng.choice(["the", "The", "red", "fox", "é", "of", "new", "york"]) + rng.choice([" "] * 6 + [". ", "\n", "\t"])
                 for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(words) + rng.choice(["", "a fixed phrase of five words"])))
    return rows + [rows[-1]] * 20


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, lang, "x", 1) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, phrase string, f int").repartition(parts)


@pytest.mark.parametrize("shard_words", [1, 300, 1 << 21])
def test_equal_to_a_loop_however_the_corpus_is_sharded(spark, shard_words):
    rows = corpus()
    got = collocations(frame(spark, rows), least=8, top=12, shard_words=shard_words).drop("cut")
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = loop(rows, 8, 12)
    assert len({w[0] for w in want}) == 3 and sorted(map(tuple, got.collect())) == want


def test_extensions(spark):
    phrases, totals = frequent_phrases(frame(spark, [("en", "a b c. x b c. b d")] * 3), least=3)
    got = {r.phrase: (r.f, r.left, r.right) for r in phrases.collect()}
    assert got["b"] == (9, 3, 6) and got["b c"] == (6, 3, 0) and got["a b c"] == (3, 0, 0)
    assert [tuple(r) for r in totals.collect()] == [("en", 24)]


def test_sums_over_shards_alone_reach_the_threshold(spark):
    docs = frame(spark, [("en", "rare pair")] * 12, 12)
    assert shards(docs, 1).count() > 1
    assert [r.phrase for r in collocations(docs, least=12, shard_words=1).collect()] == ["rare pair"]


def test_no_phrases(spark):
    assert collocations(frame(spark, [("en", "a b")]).limit(0)).count() == 0
    assert collocations(frame(spark, [("en", "a b"), (None, None)])).count() == 0
    with pytest.raises(ValueError):
        frequent_phrases(frame(spark, [("en", "a b")]), longest=6)


def test_large_counts_do_not_overflow(spark):
    from pyspark.sql import functions as F
    row = spark.sql("SELECT 4000000000000L AS a, 9000000000000L AS n, 5000000000000L AS l, 4000000000000L AS r")
    exact = row.select(F.expr("cast(1000 AS decimal(38, 0)) * a * n div (cast(l AS decimal(38, 0)) * r)").alias("s")).first().s
    assert exact == 1000 * 4000000000000 * 9000000000000 // (5000000000000 * 4000000000000)


def test_a_shard_sends_a_row_for_each_part_whatever_phrases_it_holds(spark, monkeypatch):
    sent, written = [], mining.written

    def counted(*args):
        name, rows = written(*args)
        found = rows.where("kind = 'found'")
        sent.append((found.count(), found.select("shard").distinct().count()))
        return name, rows

    monkeypatch.setattr(mining, "written", counted)
    rows = corpus()
    docs = frame(spark, rows)
    n_shards = shards(docs, 300).count()
    assert sorted(map(tuple, collocations(docs, least=8, top=12, shard_words=300).drop("cut").collect())) == loop(rows, 8, 12)
    assert len(sent) == 4 and n_shards > 5
    assert all(n <= senders * n_shards for n, senders in sent)  # as many parts as shards here


def test_parts_have_each_phrase_of_a_shard_once():
    rng = np.random.default_rng(3)
    base, word = np.divmod(np.unique(rng.integers(0, 1 << 40, 5000)), 1 << 20)
    n = rng.integers(1, 1 << 20, len(base))
    rows = mining.sent(7, base, word, n, 9).to_pylist()
    assert sorted(r["part"] for r in rows) == list(range(9)) and {r["kind"] for r in rows} == {"found"}
    got = []
    for r in rows:
        steps, words, counts = unpacked(r["packed"], 3 * r["size"]).reshape(3, -1)
        got += zip(np.cumsum(steps, dtype=np.int64).tolist(), words.tolist(), counts.tolist())
    assert sorted(got) == sorted(zip(base.tolist(), word.tolist(), n.tolist()))


def test_packed_numbers():
    for a in ([], [0], [-1, 1 << 30, -(1 << 31), (1 << 31) - 1, 255, 256]):
        assert unpacked(packed(np.array(a, np.int64)), len(a)).tolist() == a


def test_words_that_are_too_many_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mining, "FEW", 0)
    rows = corpus()
    assert sorted(map(tuple, collocations(frame(spark, rows), least=8, top=12, shard_words=300).drop("cut").collect())) == loop(rows, 8, 12)
