"""Near duplicates, fingerprints and nearest neighbours against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpusgrid.llm import fingerprints as P
from corpusgrid.llm import minhash as M
from corpusgrid.llm import neighbors as N
from corpusgrid.llm.components import components
from corpusgrid.llm.words import Words, shingles


def text_of(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_words_and_shingles_match_a_loop():
    import re
    rng = random.Random(1)
    texts = [None, "", "  ", "One", "a B c", "Êtes-vous là? été 12", "a b c d e", "a b c d e f a b c d e f", "x" * 9000,
             *["".join(rng.choice("aB é.\n1") for _ in range(60)) for _ in range(50)]]
    words = Words(pa.array(texts, pa.string()))
    seen = {}
    for i, t in enumerate(texts):
        own = re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        got = [words.word(k) for k in range(words.bounds[i], words.bounds[i + 1])]
        assert got == own
        for w, h in zip(own, words.hash[words.bounds[i]:words.bounds[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    text, key, times = shingles(words)
    for i, t in enumerate(texts):
        own = re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        expected = Counter(tuple(own[k:k + 5]) for k in range(max(1, len(own) - 4))) if own else Counter()
        assert sorted(times[text == i].tolist()) == sorted(expected.values())


def brute_classes(rows, weights):
    """Components of all pairs at the threshold; equal texts are one; wordless rows stay alone."""
    sets = M.weighted(pa.array([t for _, t in rows], pa.string()), weights)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a][0]) and len(sets[b][0]) and M.similarity(sets[a], sets[b]) >= M.THRESHOLD:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[top(k)].append(k)
    return {frozenset(v) for v in members.values()}


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    rows = []
    for k in range(12):
        base = text_of(rng, rng.randint(30, 400))
        rows += [edited(rng, base, rng.randint(0, max(1, len(base.split()) // 12))) for _ in range(rng.randint(1, 12))]
    chain = text_of(rng, 200)
    for _ in range(15):  # each one near the one before, the ends far apart
        chain = edited(rng, chain, 3)
        rows.append(chain)
    rows += [rows[0]] * 30 + [None, None, "", " ", "!!", "one", "one", "one two", text_of(rng, 30_000)]
    ids = rng.sample(range(10_000), len(rows))
    data = [(i, t, 1) for i, t in zip(ids, rows)] + [(ids[0], rows[0], 2), (None, "null id", 3)]
    df = spark.createDataFrame(data, "doc_id long, text string, h1 int")
    out = M.near_duplicates(df).collect()
    assert len(out) == len(data)
    weights = M.idf(df.select("doc_id", "text"))
    expected = brute_classes([(i, t) for i, t, _ in data], weights)
    by_id = {r.doc_id: r.class_id for r in out}
    for members in expected:
        named = {data[k][0] for k in members}
        assert {by_id[i] for i in named} == {min(named, key=lambda v: (v is None, v or 0))}
    assert len(set(by_id.values())) == len({frozenset(data[k][0] for k in m) for m in expected})
    kept = Counter(r.class_id for r in out if r.kept)
    assert set(kept) == set(by_id.values())
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_near_duplicates_of_few_agreeing_samples_are_verified(spark):
    rng = random.Random(25001)  # of its 64 samples 37 agree, one band among them, though the similarity is 0.804
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(18)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["other"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = M.idf(df)
    assert brute_classes(rows, weights) == {frozenset([0, 1])}
    _, samples = M.Sampler(weights).samples(*shingles(Words(pa.array([t for _, t in rows]))))
    assert (samples[0] == samples[1]).sum() < M.AGREE
    assert {r.class_id for r in M.near_duplicates(df).collect()} == {1}


def test_copies_in_a_large_group_are_found_whatever_its_size(spark):
    rng = random.Random(77)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    base = " ".join(words)
    others = [" ".join([*words[:a], *(f"e{a}x{k}" for k in range(8)), *words[a + 8:]]) for a in (20, 60, 100)]
    rows = list(enumerate([base] * 400 + others + [text_of(rng, 60, 10 ** 6) for _ in range(200)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    x, *near = M.weighted(pa.array([base, *others]), M.idf(df))
    for y in near:  # 134 of 158 shingles are common; their idf is that of 400 copies
        common = np.isin(x[0], y[0])
        assert x[1][common].sum() / (x[1].sum() + y[1].sum() - x[1][common].sum()) < 0.6 and M.similarity(x, y) >= M.THRESHOLD
    assert [r.class_id for r in M.near_duplicates(df).collect() if 400 <= r.doc_id < 403] == [0, 0, 0]


def test_pairs_ruled_out_by_their_masses_are_below_the_threshold():
    rng = random.Random(31)
    weights = np.random.default_rng(2).uniform(1e-3, 9, 1 << M.DF_BITS)
    texts = ["one", "one", "two"]
    for n in (6, 40, 300, 3000):
        base = text_of(rng, n)
        texts += [base, base + " more"] + [edited(rng, base, max(1, n * k // 200)) for k in range(1, 12)] + [" ".join([base] * 2)]
    column = pa.array(texts)
    text, key, times = shingles(Words(column))
    rows = M.masses(text, key, M.weigh(key, times, weights))
    mass, sets = M.read_masses(pa.array(rows, pa.binary())), M.weighted(column, weights)
    above = ruled_out = 0
    for a in range(len(texts)):
        open_ = M.possible(mass, a, np.arange(len(texts)))
        near = np.array([M.similarity(sets[a], s) >= M.THRESHOLD for s in sets])
        assert open_[near].all()
        above, ruled_out = above + near.sum() - 1, ruled_out + (~open_).sum()
    assert above > 30 and ruled_out > 1000


def test_document_frequencies_are_exact(spark, monkeypatch):
    rng = random.Random(21)
    common = text_of(rng, 30)
    texts = [common + " " + text_of(rng, 300, 10 ** 6) for _ in range(900)] + [common] * 3 + [None, "", "one", "one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    words = Words(pa.array(texts, pa.string()))
    _, key, times = shingles(words)
    distinct, counts = np.unique(key, return_counts=True)
    assert len(distinct) > 1 << M.DF_BITS  # more shingles than the hashed vector had places
    expected = np.log1p(905 / counts)
    assert np.allclose(M.weigh(distinct, np.ones(len(distinct)), M.idf(df)), expected)
    monkeypatch.setattr(M, "KEPT", 26)  # the 26 shingles of the common start
    found = M.weigh(distinct, np.ones(len(distinct)), M.idf(df))
    frequent = counts > 800
    assert frequent.sum() == 26 and np.allclose(found[frequent], expected[frequent])
    assert np.allclose(found[~frequent], np.log1p(905 / counts[~frequent].mean()))


def test_blocks_of_a_large_group_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)
    nodes = spark.createDataFrame([(n, [11, 100 + n]) for n in range(50)] + [(60, [7, 8])], "node long, bands array<long>")
    met = defaultdict(set)
    for r in M.blocks(nodes).collect():
        met[r.key, r.i, r.j].add(r.node)
    pairs = {frozenset((a, b)) for m in met.values() for a in m for b in m if a != b}
    assert len(pairs) == 50 * 49 // 2 and max(map(len, met.values())) <= 40


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = random.Random(3)
    weights = np.random.default_rng(1).uniform(1, 6, 1 << M.DF_BITS)
    base = text_of(rng, 500)
    texts = [base] + [edited(rng, base, n) for n in (5, 15, 30, 60)]
    sets = M.weighted(pa.array(texts), weights)
    _, samples = M.Sampler(weights).samples(*shingles(Words(pa.array(texts))))
    for k in range(1, 5):
        agree = (samples[k] == samples[0]).mean()
        assert abs(agree - M.similarity(sets[0], sets[k])) < 0.2


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(7, 7), (300, 200), (200, 300)]
    out = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert out == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(60), 0), 200: 200, 300: 200}


def slow_walk(text):
    n, k = len(text), P.level_of(len(text))
    kept = P.choose(np.arange(P.n_places(n)), k, 0).tolist()
    symbols, at, said = P.symbols(text), 0, []
    for j in range(P.STEPS_PER_CHAR * n):
        said.append(int(symbols[at]))
        at += int(P.moves(j // 64)[j % 64][symbols[at]])
    return [said[s] if s < len(said) else 0 for s in kept]


def test_walk_and_likeness():
    rng = random.Random(5)
    letters = "abcdefgh ijk é"
    texts = ["", "a", "ab", *["".join(rng.choice(letters) for _ in range(rng.randint(1, 600))) for _ in range(20)]]
    for text, places in zip(texts, P.walk(texts)):
        assert places.tolist() == slow_walk(text)
    long = "".join(rng.choice(letters) for _ in range(4000))
    near, far = long[:900] + "xyz" + long[900:3000] + long[3010:], "".join(rng.choice(letters) for _ in range(3500))
    a, b, c = P.prints([long, near, far])
    assert P.likeness(a, a) == 1.0 and P.likeness(a, b) > 0.7 > 0.3 > P.likeness(a, c)
    assert P.likeness(*P.prints(["", ""])) == 1.0 and P.likeness(*P.prints(["", "abc"])) == 0.0
    assert 0 <= P.likeness(*P.prints([long, long[:40]])) <= 1


def test_fingerprints_follow_the_order_of_ids(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abc dé😀") for _ in range(rng.randint(0, 300)))) for i in rng.sample(range(1000), 90)]
    rows += [(2000, None), (2001, ""), (rows[3][0], rows[3][1]), (2002, "x" * 40_000)]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, part int").repartition(5)
    out = P.fingerprint(df).collect()
    assert len(out) == len(rows)
    ordered = sorted(rows, key=lambda r: -r[0])
    expected = Counter()
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        whole = P.edit(t, after)
        assert len(whole) == len(t) or len(after) < len(t) // 3
        f, g, h = P.prints([t, whole, after])
        expected[i, len(t), hashlib.sha256(whole.encode()).hexdigest(), f, g, P.likeness(f, g), P.likeness(f, h), tuple(P.band_keys(f))] += 1
    assert Counter((*r[:-1], tuple(r.bands)) for r in out) == expected
    single = P.fingerprint(spark.createDataFrame([(1, "only one row here")], "doc_id long, text string")).collect()
    assert single[0].near_next == 1.0 and len(single) == 1
    assert P.fingerprint(df.limit(0)).collect() == []


def test_bands_find_alike_fingerprints(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcdefghij k") for _ in range(rng.randint(50, 900)))) for i in range(60)]
    rows += [(100 + i, t[:len(t) // 2] + "!" + t[len(t) // 2:]) for i, t in rows[:40]]
    marked = P.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "fingerprint", "bands")
    found = {r.fingerprint: r.near_doc_id for r in P.neighbours(marked).collect()}
    prints = {r.doc_id: r.fingerprint for r in marked.collect()}
    alike = [i for i in range(40) if P.likeness(prints[i], prints[100 + i]) >= P.LEAST and prints[i] != prints[100 + i]]
    hit = [i for i in alike if found.get(prints[100 + i]) == i]
    assert len(alike) > 20 and len(hit) >= 0.95 * len(alike)
    assert set(found) <= {prints[100 + i] for i in range(40)}


def test_query_finds_alike_documents(spark, tmp_path):
    from corpusgrid.llm.catalog import QUERIES
    rng = random.Random(12)
    rows = [(i, "".join(rng.choice("abcdefghij k") for _ in range(700))) for i in range(12)]
    rows += [(100 + i, t[:350] + "!" + t[350:]) for i, t in rows[:8]] + [(200, rows[9][1]), (201, None), (None, rows[9][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op8_fingerprints"](spark, str(tmp_path)).collect()
    near = [(r.doc_id, r.near_doc_id) for r in out]
    assert len(out) == len(rows) and all(len(r.fingerprint.partition(":")[2]) > 256 for r in out if r.n_chars)
    assert sorted(p for p in near if p[1] is not None and p[0] is not None) == [(100 + i, i) for i in range(8)] + [(200, 9)]
    assert (None, 9) in near


def test_bands_meet_texts_cut_at_their_end():
    rng = random.Random(13)
    met = alike = 0
    for _ in range(60):
        text = "".join(rng.choice("abcdefghij k") for _ in range(rng.randint(300, 3000)))
        f, g = P.prints([text, text[:int(len(text) * 0.8)]])
        if P.likeness(f, g) >= P.LEAST:
            alike += 1
            met += bool(set(P.band_keys(f)) & set(P.band_keys(g)))
    assert alike > 40 and met >= 0.9 * alike


def test_members_unlike_their_leader_are_settled(spark, monkeypatch):
    """One band holds all fingerprints, the leader is unlike the others, and blocks are small."""
    rng = random.Random(14)
    texts = ["".join(rng.choice("abcdefghij k") for _ in range(600)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(texts)] + [
        (10 * k + i, t[:300] + "!" * k + t[300:]) for k in (1, 2, 3) for i, t in enumerate(texts) if i != 0]
    marks = P.prints([t for _, t in rows])
    octets = [bytes([P.parsed(f)[0]]) + P.parsed(f)[1].tobytes() for f in marks]
    data = [(7, i, j, n, n, octets[n]) for i, j in ((0, 0),) for n in range(len(rows))]
    df = spark.createDataFrame(data, "key long, i int, j int, node long, label long, fingerprint binary").coalesce(1)
    links = [(r.u, r.v) for r in df.mapInArrow(P.settle(P.LEAST), "u long, v long").collect()]
    classes = {n: n for n in range(len(rows))}
    for u, v in links:
        low, high = sorted((classes[u], classes[v]))
        classes = {n: low if c == high else c for n, c in classes.items()}
    expected = {n: n for n in range(len(rows))}
    for u in range(len(rows)):
        for v in range(u):
            if P.likeness(marks[u], marks[v]) >= P.LEAST:
                low, high = sorted((expected[u], expected[v]))
                expected = {n: low if c == high else c for n, c in expected.items()}
    assert classes == expected and len(links) == len(rows) - 6

    def one_band(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([7] * batch.num_rows, pa.int64()), batch.column("node")], names=["key", "node"])

    monkeypatch.setattr(P, "key_rows", one_band)
    monkeypatch.setattr(P, "BLOCK", 4)
    marked = spark.createDataFrame([(i, f) for (i, _), f in zip(rows, marks)], "doc_id long, fingerprint string")
    near = {r.fingerprint: r.near_doc_id for r in P.neighbours(marked).collect()}
    assert near == {f: i % 10 for (i, _), f in zip(rows, marks) if i >= 10}


@pytest.mark.parametrize("norms", [False, True])
def test_neighbours_match_brute_force(spark, norms):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(900, 16))
    vectors[:300] = vectors[300:600] + rng.normal(size=(300, 16)) / 20
    if not norms:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32)
    vectors[700:730] = vectors[700]  # ties
    rows = [(int(i), v.tolist(), 0.0) for i, v in enumerate(vectors)]
    odd = [(2000, None, 0.0), (2020, [], 0.0), (2040, [0.0] * 16, 0.0), (2060, [float("nan")] * 16, 0.0), (2080, [float("inf")] * 16, 0.0),
           (2100, [None] + [1.0] * 15, 0.0), (None, [1.0] * 16, 0.0), rows[40], (2120, [1.0, 2.0], 0.0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score double")
    got = defaultdict(dict)
    for r in N.search(df).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 900, 20))
    exact = vectors.astype(float)
    hits = total = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(900), -np.round(scores, 12)))[:20]
        hits, total = hits + len(set(best.tolist()) & {i for i, _ in found.values()}), total + 20
        order = [(-found[k][1], found[k][0]) for k in sorted(found)]
        assert order == sorted(order) and all(abs(scores[i] - s) < 1e-9 for i, s in found.values())
    assert hits / total >= 0.95
    assert N.search(df.limit(0)).collect() == []
