"""Periodic runs against a search over all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from corpusgrid.llm.catalog import QUERIES
from corpusgrid.llm.runs import Diagonals, Run, detect_runs, edited, kept_words, runs_of, strongest

HEX = lambda s: hashlib.sha256(s.encode()).hexdigest()


def all_lags(words, least=24, times=3):
    found = []
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(least, times * q) and not any(
                    all(words[j] == words[j - d] for j in range(start + d, i)) for d in range(1, q)):
                found.append(Run(start, length, q))
            i += i == first
    return sorted(found, key=lambda r: (r.start, r.period))


def repetitive(rng):
    n, kinds = rng.randint(0, 150), rng.choice([1, 2, 3, 30])
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, 40)
        for i in range(a + p, min(n, a + rng.randint(1, n))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least, times", [(24, 3), (5, 3), (8, 4)])
def test_equal_to_a_search_over_all_lags(least, times):
    rng, met = random.Random(7), 0
    for _ in range(300):
        texts = [repetitive(rng) for _ in range(rng.randint(0, 5))]
        want = [all_lags(t, least, times) for t in texts]
        assert runs_of([np.array(t, np.int64) for t in texts], least, times) == want
        met += sum(map(len, want))
    assert met > 100


def test_a_text_of_one_word_is_one_run_whatever_its_length():
    assert runs_of([np.zeros(100_000, np.int64)]) == [[Run(0, 100_000, 1)]]


def test_a_diagonal_is_emitted_when_it_ends():
    d = Diagonals()
    for i in range(1, 30):
        d.step(i, 1, 1)
    assert not d.runs
    d.step(40, 4, 3)
    assert d.runs == [Run(0, 30, 1)] and list(d.active) == [3]


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        runs_of([np.zeros(9, np.int64)], times=2)


def test_edited_tail():
    words = [f"w{i}" for i in range(50)]
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert ids
    for i in ids:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert edited(words, i) == [words[j] if j < a else words[a + (j - a) % p] for j in range(50)]
    assert edited(words, None) == words and edited([], ids[0]) == []


def test_strongest_and_ties():
    assert strongest([Run(0, 24, 2), Run(5, 36, 3), Run(9, 25, 2)]) == Run(9, 25, 2)
    assert strongest([Run(0, 24, 2), Run(5, 36, 3)]) == Run(0, 24, 2) and strongest([]) is None


def test_query_against_a_loop(spark, tmp_path):
    rng = random.Random(3)
    space = lambda: rng.choice([" ", "\n", "\t ", "\x0b", " "])
    rows = [(i, "".join(f"{w}é{space()}" for w in repetitive(rng)), "en") for i in range(120)]
    rows += [(200, None, None), (201, "", "en"), (None, "a b " * 40, "de"), (5, rows[5][1], "fr"), (202, "x " * 60_000, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")

    def want(i, text):
        words = edited([w.decode() for w in (text or "").encode().split()], i)
        runs = all_lags(words) if len(words) < 1000 else runs_of([np.unique(words, return_inverse=True)[1]])[0]
        best = strongest(runs)
        lost = {j for s, n, q in runs for j in range(s + q, s + n)}
        kept = [w for j, w in enumerate(words) if j not in lost]
        assert kept == list(kept_words(words, runs))
        return (i, len(runs), *(best or [None] * 3), 1000 * best.length // best.period if best else None,
                HEX("".join(f"{s},{n},{q}\n" for s, n, q in runs)), HEX(" ".join(kept)))

    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(want(i, t)) for i, t, _ in rows)
    assert detect_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
