"""Tokens, packing and piece encoding against the libraries and against plain searches."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from corpusgrid.llm import packing
from corpusgrid.llm import sentencepiece as S
from corpusgrid.llm.packing import best_fit, crossover, cut, evolve, fill, pack
from corpusgrid.llm.tokens import coder

ODD = ["", " ", "a", "a  b   c", "x \n y\n ", " lead", "trail ", "<|endoftext|> x", "don't 12 é😀 日本　z", "\n \n a", "w" * 5000, "\ta\r\n b \x00",
       "a  b", "  x   y", "a  b", "▁x ▁ y▁", "   "]


def test_ids_equal_the_library():
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(["the", " ", "  ", "\n", "Quick", ".", "é", " ", "7"]) for _ in range(80)) for _ in range(200)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, coder().many(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_packing_places_every_piece_once(spark):
    rng = random.Random(2)
    texts = [None, "", *ODD, *[" ".join(["word"] * rng.randint(1, 5000)) for _ in range(120)]]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(3, texts[3], "extra"), (None, "null id", "x")]
    out = pack(spark.createDataFrame(rows, "doc_id long, text string, length string")).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted((-1 if i is None else i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
                      for i, t, _ in rows for ids in [library.encode(t or "", add_special_tokens=False).ids + [0]]
                      for k, (s, n) in enumerate(cut(len(ids), 2048)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(r.length for r in out) / 2048 * 1.05 + 1
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_genetic_search_keeps_bins_within_capacity_and_is_not_worse_than_best_fit():
    rng = np.random.default_rng(0)
    for trial in range(5):
        lengths = rng.integers(1, 1500, 300)
        order = np.argsort(-lengths, kind="stable")
        plain = best_fit(np.zeros(0, np.int64), order, lengths, 2048)[1]
        people = evolve(lengths, [], 2048, np.random.default_rng(trial))
        assert fill(people[0], lengths).max() <= 2048 and len(fill(people[0], lengths)) <= plain
        child = crossover(people[0], people[-1], lengths, 2048, rng)
        assert (child >= 0).all() and fill(child, lengths).max() <= 2048 and fill(child, lengths).sum() == lengths.sum()


def test_crossover_finds_fewer_bins_than_best_fit(monkeypatch):
    """Best fit leaves a bin too many here; mutation is switched off."""
    monkeypatch.setattr(packing, "mutate", lambda people, *rest: people)
    for lengths, best_possible in (([47, 28, 32, 59, 24, 43, 32, 37, 57, 27, 51, 49], 5),
                                   ([50, 46, 37, 37, 54, 23, 47, 28, 23, 41, 59, 49, 50, 48], 6)):
        lengths = np.array(lengths)
        plain = best_fit(np.zeros(0, np.int64), np.argsort(-lengths, kind="stable"), lengths, 100)[1]
        found = evolve(lengths, [], 100, np.random.default_rng(0))
        assert len(fill(found[0], lengths)) == best_possible == -(-lengths.sum() // 100) < plain
        assert fill(found[0], lengths).max() <= 100


def brute_score(v, text):
    """The best sum of scores, by the plain recursion over all pieces."""
    text = S.SPACE + text.replace(S.SPACE, S.HELD).replace(" ", S.SPACE)
    best = [0.0]
    for end in range(1, len(text) + 1):
        char = text[end - 1]
        ways = [best[end - 1] + v.byte_score * len((S.SPACE if char == S.HELD else char).encode())]
        ways += [best[a] + v.scores[text[a:end]] for a in range(max(0, end - v.longest), end) if text[a:end] in v.scores]
        best.append(max(ways))
    return best[-1]


def test_piece_encoding_is_optimal_and_exact(spark):
    tool = S.encoder()
    names = {i: p for p, i in tool.v.ids.items()}
    rng = random.Random(4)
    texts = ODD + ["日本語" * 40, "thequickbrownfox" * 30, "x" * 400] + [
        "".join(rng.choice("the quick ▁né\n") for _ in range(150)) for _ in range(40)]
    for text, ids in zip(texts, tool.many(texts)):
        assert tool.text(ids) == text
        if text:
            score = sum(tool.v.scores[names[i]] if i in names else tool.v.byte_score for i in ids.tolist())
            assert abs(score - brute_score(tool.v, text)) < 1e-6
    rows = [(i, t, 1) for i, t in enumerate([None, *texts])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = {r.doc_id: r.text for r in S.decode(S.encode(df)).collect()}
    assert out == {i: t or "" for i, t, _ in rows}
    assert S.decode(S.encode(df.limit(0))).collect() == []


def test_streaming_window_commits_early_and_agrees():
    v = S.encoder().v
    search = S.StreamingViterbi(v)
    text = "thequickbrownfox" * 50
    search.feed(text)
    assert search.commits > 5 and len(search.buffer) < 8 * v.longest
    ids = search.finish()
    names = {i: p for p, i in v.ids.items()}
    assert "".join(names[i] for i in ids) == text
    best = [0.0]
    for end in range(1, len(text) + 1):
        best.append(max(best[a] + v.scores[text[a:end]] for a in range(max(0, end - v.longest), end) if text[a:end] in v.scores))
    assert abs(sum(v.scores[names[i]] for i in ids) - best[-1]) < 1e-6
