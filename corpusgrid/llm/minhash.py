"""Near duplicates by consistent weighted sampling of TF-IDF shingles.

A shingle is five successive words (see ``words``); a shorter text has one. Its weight in
a text is tf * ln(1 + N / df), with document frequencies over all texts, counted
exactly by shingle. Those of the most frequent shingles, ``KEPT`` at most, are broadcast;
the least frequency among them is the lowest for which they fit. All shingles below it
have the idf of their mean frequency, which is exact while only those met once are below.
Two texts are near duplicates if their weighted Jaccard
similarity, computed on the whole texts, is at least ``THRESHOLD``, or the Jaccard
similarity of their sets of shingles is; classes are the connected components. The second
measure is there for copies of a text that has many: they raise the document frequencies
of their own shingles, so the weighted similarity of two of them falls with the size of
their group and of the corpus, though the same part of both texts is equal.

1. Equal texts are folded by a 128-bit hash (a minimum per hash, aggregated before the
   shuffle), so a group of copies is one node however large it is.
2. Each text gets ``SAMPLES`` samples by improved consistent weighted sampling; the draws
   (r, c, beta) of a shingle come from a seeded pool by hash, weights are on a grid of
   2^(1/8) for sampling alone. Beside them stand ``SAMPLES`` least hashes of its set of
   shingles. Four samples of a kind make a band, 16 bands of each kind: a pair at 0.8 by
   one measure shares a band of that kind with probability 0.9998.
   Its masses are its whole weight, and its weight in each of ``SLOTS`` classes of
   shingles, rounded up; and the same with a weight of 1 for each shingle of its set. From
   two masses follow upper bounds of both similarities (``possible``), so a pair below the
   threshold by both needs no texts.
3. Nodes that share a band key meet in blocks of at most ``2 * BLOCK`` members. Of each
   block the maximum spanning forest of the possible pairs, by agreeing samples of the kind of which
   more agree, is proposed: a number of pairs linear in the members, which reaches every node that has
   a possible pair.
4. Proposed pairs of which ``AGREE`` of ``SAMPLES`` samples of a kind agree are verified on
   their texts, and components of the links found. That number only says what is tried first.
5. The exact rest: possible pairs that share a band, but ended in different components,
   are all verified however few samples agree, in blocks that hold the texts; so no link
   is lost to steps 3 and 4.

The texts of proposed nodes are joined by a plain shuffle at every size: once the corpus.
A key held by n members makes (n / BLOCK)^2 / 2 block tasks; nothing emits all pairs.

Defined results: a text without words (null and empty ones too) is a class of its own.
The class id is the least ``doc_id`` of the class; a null id sorts first among none. Rows
repeated are in one class. An empty table gives no class. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgrid.llm.components import components
from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.words import Words, mix, shingles, text_slices
from corpusgrid.session import materialise

THRESHOLD, SAMPLES, ROWS = 0.8, 64, 4
BANDS = SAMPLES // ROWS
DF_BITS, POOL_BITS, GRID = 18, 16, 8
KEPT, PART_BITS, HELD, MOST_AT_ONCE = 1 << 20, 12, 2_000_000, (1 << 16) - 1
LOW_LEVEL, HIGH_LEVEL = -2 * GRID, 30 * GRID
BLOCK, AGREE, SLOTS = 1024, 38, 64


# -- weights
@dataclass
class Idf:
    """ln(1 + N / df) of the frequent shingles (sorted), and of all others."""

    keys: np.ndarray
    values: np.ndarray
    below: float


def count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per shingle, by leading bits of the shingle: octets of (shingle, number); under -1 the number of texts with words."""
    held: list[np.ndarray] = []
    size = texts = 0
    edges = np.arange((1 << PART_BITS) + 1, dtype=np.uint64) << np.uint64(48 - PART_BITS)

    def flush() -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        while len(key):
            now = np.minimum(n, MOST_AT_ONCE)
            coded, cuts = (key << np.uint64(16)) | now.astype(np.uint64), np.searchsorted(key, edges)
            used = np.flatnonzero(np.diff(cuts))
            yield pa.record_batch([pa.array(used, pa.int32()), pa.array([coded[cuts[i]:cuts[i + 1]].tobytes() for i in used.tolist()], pa.binary())],
                                  names=["part", "counts"])
            n = n - now
            key, n = key[n > 0], n[n > 0]

    for batch in batches:
        for _, part in text_slices(batch.column(0)):
            words = Words(part)
            _, key, _ = shingles(words)
            texts += int((np.diff(words.bounds) > 0).sum())
            held.append(key)
            size += len(key)
            if size >= HELD:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()
    yield pa.record_batch([pa.array([-1], pa.int32()), pa.array([np.uint64(texts).tobytes()], pa.binary())], names=["part", "counts"])
    tidy()


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``df, n, keys``: how many shingles have a frequency, and which, if over 1; under -1 the number of texts."""
    def summed(part: int, held: list[bytes]) -> pa.RecordBatch:
        coded = np.frombuffer(b"".join(held), np.uint64)
        if part < 0:
            rows = [(-1, int(coded.sum()), None)]
        else:
            coded = np.sort(coded)
            key = coded >> np.uint64(16)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            df = np.add.reduceat((coded & np.uint64(MOST_AT_ONCE)).astype(np.int64), first)
            order = np.argsort(df, kind="stable")
            key, df = key[first][order], df[order]
            values, at = np.unique(df, return_index=True)
            ends = [*at[1:].tolist(), len(df)]
            rows = [(v, b - a, key[a:b].tobytes() if v > 1 else None) for v, a, b in zip(values.tolist(), at.tolist(), ends)]
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                pa.array([r[2] for r in rows], pa.binary())], names=["df", "n", "keys"])

    last, held = None, []
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and part != last:
                yield summed(last, held)
                held = []
            last = part
            held.append(counts)
    if held:
        yield summed(last, held)
    tidy()


def idf(docs: DataFrame) -> Idf:
    """Frequencies are counted exactly; ``KEPT`` of them at most are collected."""
    rows = small_batches(docs).select("text").mapInArrow(count_shingles, "part int, counts binary")
    found = materialise(rows.repartition("part").sortWithinPartitions("part").mapInArrow(add_up, "df long, n long, keys binary"),
                        "frequencies")
    sizes = {r["df"]: r["n"] for r in found.groupBy("df").agg(F.sum("n").alias("n")).collect()}  # a row per frequency
    texts = max(1, sizes.pop(-1, 0))
    least, room = max(sizes, default=1) + 1, KEPT
    for df in sorted(sizes, reverse=True):
        room -= sizes[df]
        if room < 0 or df == 1:
            break
        least = df
    rare = {df: n for df, n in sizes.items() if df < least}
    mean = sum(df * n for df, n in rare.items()) / max(1, sum(rare.values()))
    kept = found.where((F.col("df") >= least) & F.col("keys").isNotNull()).select("df", "keys").collect()
    keys = np.frombuffer(b"".join(r["keys"] for r in kept), np.uint64)
    df = np.repeat(np.array([r["df"] for r in kept], float), [len(r["keys"]) // 8 for r in kept])
    order = np.argsort(keys)
    return Idf(keys[order], np.log1p(texts / df[order]), float(np.log1p(texts / max(1.0, mean))))


def weigh(key: np.ndarray, times: np.ndarray, weights: Idf | np.ndarray) -> np.ndarray:
    """tf times idf; a plain vector has one idf for each value of the last ``DF_BITS`` bits."""
    if isinstance(weights, np.ndarray):
        return times * weights[(key & np.uint64((1 << DF_BITS) - 1)).astype(np.int64)]
    if not len(weights.keys):
        return times * weights.below
    at = np.minimum(np.searchsorted(weights.keys, key), len(weights.keys) - 1)
    return times * np.where(weights.keys[at] == key, weights.values[at], weights.below)


# -- sampling
class Sampler:
    """Consistent weighted samples of the texts of a slice."""

    def __init__(self, weights: Idf | np.ndarray):
        self.weights = weights
        rng = np.random.default_rng(2010)
        size = 1 << POOL_BITS
        self.r, self.c, self.beta = rng.gamma(2.0, 1.0, size), rng.gamma(2.0, 1.0, size), rng.random(size)
        self.turns, self.set_turns = (rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
        self.place = np.full(HIGH_LEVEL - LOW_LEVEL + 1, -1, np.int64)
        self.pool = np.zeros((0, size), np.uint64)

    def row(self, level: int) -> np.ndarray:
        """The value c / (y e^r) of every draw at one weight; positive floats sort by their bits."""
        t = np.floor(level / GRID * np.log(2) / self.r + self.beta)
        a = self.c / (np.exp(self.r * (t - self.beta)) * np.exp(self.r))
        return a.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)

    def rows_of(self, level: np.ndarray) -> np.ndarray:
        for new in np.unique(level):
            if self.place[new - LOW_LEVEL] < 0:
                self.place[new - LOW_LEVEL] = len(self.pool)
                self.pool = np.concatenate([self.pool, self.row(int(new))[None]])
        return self.place[level - LOW_LEVEL]

    def samples(self, text: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts that have shingles, samples): the drawn value and the shingle that holds it."""
        return self.drawn(text, key, weigh(key, times, self.weights))

    def drawn(self, text: np.ndarray, key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner, first = np.unique(text, return_index=True)
        level = np.rint(GRID * np.log2(weight)).astype(np.int64)
        base = self.rows_of(np.clip(level, LOW_LEVEL, HIGH_LEVEL)) << POOL_BITS
        flat, low = self.pool.reshape(-1), mix(key) >> np.uint64(32)
        out = np.zeros((len(owner), SAMPLES), np.uint64)
        for k in range(SAMPLES):
            at = ((key * self.turns[k]) >> np.uint64(64 - POOL_BITS)).astype(np.int64)
            at += base
            out[:, k] = np.minimum.reduceat(flat[at] | low, first)
        return owner, out


    def least(self, text: np.ndarray, key: np.ndarray) -> np.ndarray:
        """(texts that have shingles, least hashes) of the sets of shingles, which are hashes already."""
        first = np.unique(text, return_index=True)[1]
        return np.stack([np.minimum.reduceat(key * turn, first) for turn in self.set_turns], 1)


def band_keys(samples: np.ndarray, kind: int = 0) -> np.ndarray:
    keys = np.zeros((len(samples), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix(keys + samples[:, k::ROWS])
    return mix(keys + np.arange(kind * BANDS, (kind + 1) * BANDS, dtype=np.uint64))


# -- bounds
def masses(text: np.ndarray, key: np.ndarray, weight: np.ndarray) -> list[bytes]:
    """Of each text that has shingles, by weights and then by its set: the whole as a double, and that in each slot as the
    upper half of a float, rounded up."""
    owner, at = np.unique(text, return_inverse=True)
    place = at * SLOTS + (key >> np.uint64(32)).astype(np.int64) % SLOTS
    parts = []
    for each in (weight, np.ones(len(key))):
        held = np.bincount(place, weights=each, minlength=len(owner) * SLOTS)
        up = np.nextafter(held.astype(np.float32), np.float32(np.inf)).view(np.uint32)
        slots = ((up + np.uint32(0xFFFF)) >> np.uint32(16)).astype("<u2").reshape(-1, SLOTS)
        slots[held.reshape(-1, SLOTS) == 0] = 0
        parts += [np.bincount(at, weights=each).astype("<f8"), slots]
    return [b"".join(x.tobytes() for x in row) for row in zip(*parts)]


def read_masses(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(wholes, by slot) of the weights and of the sets."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2, 8 + 2 * SLOTS)

    def read(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = part[:, 8:].copy().view("<u2").astype(np.uint32) << np.uint32(16)
        return part[:, :8].copy().view("<f8")[:, 0], slots.view(np.float32)

    return [read(rows[:, k]) for k in range(2)]


def possible(mass: list[tuple[np.ndarray, np.ndarray]], one: int, others: np.ndarray) -> np.ndarray:
    """Whether a similarity of a text to others may reach ``THRESHOLD``: never false if one does.

    Two texts have no more in common in a slot than the smaller weight there.
    """
    out = np.zeros(len(others), bool)
    for whole, slots in mass:
        need = (whole[others] + whole[one]) * (THRESHOLD / (1 + THRESHOLD) * (1 - 1e-6))
        near = np.flatnonzero(~out & (np.minimum(whole[others], whole[one]) >= need))
        out[near] = np.minimum(slots[others[near]], slots[one]).sum(1, dtype=np.float64) >= need[near]
    return out


def sketches(docs: DataFrame, weights: Idf) -> DataFrame:
    """``doc_id, h1, h2, bands, sig, mass``; the last three are null for a text without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(shared.value)
        for batch in batches:
            for start, part in text_slices(batch.column(3)):
                text, key, times = shingles(Words(part))
                bands, sig, mass = ([None] * len(part) for _ in range(3))
                if len(key):
                    weight = weigh(key, times, sampler.weights)
                    owner, found = sampler.drawn(text, key, weight)
                    least = sampler.least(text, key)
                    short = (mix(np.concatenate([found, least], 1)) >> np.uint64(48)).astype("<u2")
                    both = np.concatenate([band_keys(found), band_keys(least, 1)], 1).view(np.int64)
                    for i, keys, s, m in zip(owner.tolist(), both, short, masses(text, key, weight)):
                        bands[i], sig[i], mass[i] = keys, s.tobytes(), m
                same = batch.slice(start, len(part))
                yield pa.record_batch([same.column(0), same.column(1), same.column(2), pa.array(bands, pa.list_(pa.int64())),
                                       pa.array(sig, pa.binary()), pa.array(mass, pa.binary())],
                                      names=["doc_id", "h1", "h2", "bands", "sig", "mass"])
        del sampler
        tidy()

    rows = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, h1 long, h2 long, bands array<long>, sig binary, mass binary")


# -- blocks of nodes that share a band
def blocks(nodes: DataFrame) -> DataFrame:
    """``key, band, i, j, node``: the members of every block of every key that several nodes share."""
    spread = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = materialise(spread.groupBy("key").count().where("count > 1"), "shared-bands")
    cut = F.ceil(F.col("count") / BLOCK).cast("int")
    members = spread.join(shared, "key").select("key", "band", "node", cut.alias("n"),
                                                F.pmod(F.xxhash64("node"), cut).cast("int").alias("own"))
    other = members.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    return other.select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")


BLOCK_KEY = ["key", "i", "j"]


def grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "node")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal key in sorted rows; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in BLOCK_KEY], 1)
        change = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        edges = [0, *change.tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            if held and tuple(key[a]) != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(key[a])
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, 2 * SAMPLES)


def spanning(sig: np.ndarray, mass: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, bool]]:
    """Edges of the maximum spanning forest of the possible pairs by agreeing samples, and whether ``AGREE`` or more do."""
    n, edges = len(sig), []
    best, link = np.full(n, -1), np.zeros(n, np.int64)
    free = np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        free[at] = False
        agree = (sig == sig[at]).reshape(n, 2, SAMPLES).sum(2).max(1)
        better = np.flatnonzero(free & (agree > best))
        better = better[possible(mass, at, better)]
        best[better], link[better] = agree[better], at
        at = int(np.where(free, best, -2).argmax())
        if best[at] >= 0:
            edges.append((int(link[at]), at, bool(best[at] >= AGREE)))
    return edges


def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        rows = pairs_batch([(u, v) for u, v, _ in out])
        return pa.record_batch([*rows.columns, pa.array([x for *_, x in out], pa.bool_())], names=["u", "v", "likely"])

    out: list[tuple[int, int, bool]] = []
    for group in groups(batches):
        node = group["node"].to_numpy()
        keep = np.unique(node, return_index=True)[1]
        mass = read_masses(group["mass"].take(pa.array(keep)))
        node, sig = node[keep], signatures(group["sig"])[keep]
        out += [(*sorted((int(node[a]), int(node[b]))), likely) for a, b, likely in spanning(sig, mass)]
        if len(out) > 50_000:
            yield batch()
            out = []
    yield batch()


def pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])


# -- verification
def similarity(x: tuple, y: tuple) -> float:
    """The larger of the weighted Jaccard and that of the sets, of two sorted (keys, weights)."""
    at = np.minimum(np.searchsorted(x[0], y[0]), len(x[0]) - 1)
    same = x[0][at] == y[0]
    common, both = float(np.minimum(x[1][at[same]], y[1][same]).sum()), int(same.sum())
    return max(common / max(1e-300, x[1].sum() + y[1].sum() - common), both / max(1, len(x[0]) + len(y[0]) - both))


def weighted(texts: pa.Array, weights: Idf | np.ndarray) -> list[tuple]:
    """Sorted shingles and weights of each text."""
    out: list[tuple] = []
    for _, part in text_slices(texts):
        text, key, times = shingles(Words(part))
        w = weigh(key, times, weights)
        edges = np.searchsorted(text, np.arange(len(part) + 1))
        out += [(key[a:b], w[a:b]) for a, b in zip(edges, edges[1:])]
    return out


def verify(pairs: DataFrame, texts: DataFrame, weights: Idf) -> DataFrame:
    """The pairs ``u, v`` whose texts are similar enough."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                left, right = (weighted(part.column(c), shared.value) for c in ("a", "b"))
                keep = [similarity(x, y) >= THRESHOLD for x, y in zip(left, right)]
                yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v")], names=["u", "v"]).filter(pa.array(keep))
        tidy()

    left, right = (texts.select(F.col("node").alias(n), F.col("text").alias(t)) for n, t in (("u", "a"), ("v", "b")))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def crossing(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The possible pairs of a block that are in different components, each in its first shared band only."""
    node = group["node"].to_numpy()
    keep = np.unique(node, return_index=True)[1]
    label, band = group["label"].to_numpy()[keep], int(group["band"][0].as_py())
    left, right = [], []
    if len(np.unique(label)) > 1:
        mass = read_masses(group["mass"].take(pa.array(keep)))
        bands = group["bands"].take(pa.array(keep)).combine_chunks().flatten().to_numpy().reshape(-1, 2 * BANDS)
        for x in range(len(keep) - 1):
            hit = np.flatnonzero(label[x + 1:] != label[x]) + x + 1
            hit = hit[possible(mass, x, hit)]
            hit = hit[~(bands[hit, :band] == bands[x, :band]).any(1)]
            left += [x] * len(hit)
            right += hit.tolist()
    return keep, np.array(left, np.int64), np.array(right, np.int64)


def open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of blocks that still have a pair to verify."""
    for group in groups(batches):
        keep, left, right = crossing(group)
        if len(left):
            rows = keep[np.unique(np.concatenate([left, right]))]
            yield from group.take(pa.array(rows)).to_batches()


def settle(weights: Idf):
    """Verifies the crossing pairs of each block on its texts; a pair already joined is skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            keep, left, right = crossing(group)
            rows = group.take(pa.array(keep))
            node, label = rows["node"].to_numpy(), rows["label"].to_numpy()
            sets = weighted(rows["text"].combine_chunks(), weights)
            root = {int(x): int(x) for x in label}

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            links = []
            for a, b in zip(left.tolist(), right.tolist()):
                x, y = top(int(label[a])), top(int(label[b]))
                if x != y and similarity(sets[a], sets[b]) >= THRESHOLD:
                    root[max(x, y)] = min(x, y)
                    links.append((int(node[a]), int(node[b])))
            yield pairs_batch(links)
    return run


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, h1, class_id, kept`` of every row; ``kept`` marks the rows equal to the representative."""
    docs = docs.select("doc_id", "text")
    weights = idf(docs)
    rows = materialise(sketches(docs, weights), "sketches")
    nodes = materialise(
        rows.where("bands IS NOT NULL").groupBy("h1", "h2").agg(
            F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("bands", "sig", "mass")])
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = materialise(blocks(nodes), "blocks")
    signed = members.join(nodes.select("node", "sig", "mass"), "node").select(*BLOCK_KEY, "node", "sig", "mass")
    pairs = materialise(grouped(signed).mapInArrow(propose, "u long, v long, likely boolean").distinct(), "pairs")
    involved = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = materialise(nodes.join(involved, "node").select("node", "h1", "h2", "rep"), "involved")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    texts = keyed.join(wanted.hint("merge"), ["h1", "h2"]).where(F.col("doc_id").eqNullSafe(F.col("rep")))
    texts = materialise(texts.select("node", "text"), "texts").dropDuplicates(["node"])
    links = materialise(verify(pairs.where("likely").select("u", "v"), texts, weights), "links")
    first = materialise(components(links), "components")
    label = F.coalesce("label", "node").alias("label")
    columns = ["key", "band", "i", "j", "node", "label", "bands", "mass"]
    still = (members.join(wanted.select("node"), "node", "left_semi").join(first, "node", "left")
             .select("key", "band", "i", "j", "node", label).join(nodes.select("node", "bands", "mass"), "node").select(*columns))
    schema = "key long, band int, i int, j int, node long, label long, bands array<long>, mass binary"
    unsettled = materialise(grouped(still).mapInArrow(open_members, schema), "unsettled")
    more = materialise(grouped(unsettled.join(texts, "node").select(*columns, "text")).mapInArrow(
        settle(weights), "u long, v long"), "links")
    final = components(links.unionByName(more))
    classes = nodes.select("h1", "h2", "rep", "node").join(final, "node", "left").select(
        "h1", "h2", "rep", F.coalesce("label", "node").alias("label"))
    heads = classes.groupBy("label").agg(F.min(F.struct("rep", "h1", "h2")).alias("head"))
    classes = materialise(classes.join(heads, "label").select("h1", "h2", "head"), "classes")
    found = rows.select("doc_id", "h1", "h2", F.col("bands").isNotNull().alias("worded"))
    joined = found.where("worded").join(classes, ["h1", "h2"]).select(
        "doc_id", "h1", F.col("head.rep").alias("class_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.rep")) & (F.col("h1") == F.col("head.h1"))
         & (F.col("h2") == F.col("head.h2"))).alias("kept"))
    return joined.unionByName(found.where("NOT worded").select(
        "doc_id", "h1", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")))
