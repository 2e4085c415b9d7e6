"""Packing of documents into sequences by a grouping genetic algorithm on islands.

Every row is tokenised (null text: empty), gets an end id, and is cut into pieces of at
most ``capacity`` ids; only the first piece may be shorter. Full pieces are sequences of
their own. The others are dealt by a hash of a row number into shards of about
``SHARD`` pieces, so equal documents spread. Each shard is evolved on several islands,
each an independent population in a task of its own: crossover injects well-filled bins
of one parent into the other, bins that then hold duplicates are dissolved, and the
displaced pieces go to the best-fitting bins. Between epochs the elite of each island
migrates to the next island of its shard. A state row holds one shard on one island, of
bounded size; states are written between epochs, and all draws are seeded by shard and
island, so a repeated task gives the same rows.

Defined results: an empty or null text is the end id alone. Repeated rows are packed
each. A null ``doc_id`` is carried. Extra columns are ignored. An empty table gives no
piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.tokens import blocks, coder
from corpusgrid.session import materialise

CAPACITY, END_ID = 2048, 0
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 2, 2, 4, 4


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = coder(json_path, ranks_path), np.array([END_ID], "<u4")
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts):
                lists = [np.append(tokens, end) for tokens in bpe.many(texts[a:b])]
                places = [cut(len(raw), capacity) for raw in lists]
                counts = np.array([len(p) for p in places], np.int64)
                row, total = np.repeat(np.arange(a, b), counts), int(counts.sum())
                start, length = np.array([sn for p in places for sn in p], np.int64).reshape(total, 2).T
                sums = np.fromiter((zlib.crc32(raw[s:s + n]) for raw, p in zip(lists, places) for s, n in p), np.int64, total)
                piece = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.record_batch([ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                                       pa.array(sums)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        tidy()

    return small_batches(docs).select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(rest: np.ndarray, order: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[list[int], int]:
    """Bins for the items of ``order``, one by one into the fullest bin that holds them.

    ``rest`` has the room of the bins there are; new bins follow them. Bit r of ``mask``
    tells that some bin has room r.
    """
    slots: list[list[int]] = [[] for _ in range(capacity + 1)]
    for b, r in enumerate(rest.tolist()):
        slots[r].append(b)
    mask = sum(1 << r for r, s in enumerate(slots) if s)
    placed, bins = [], len(rest)
    for size in lengths[order].tolist():
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = slots[room].pop()
            if not slots[room]:
                mask ^= 1 << room
        else:
            b, room, bins = bins, capacity, bins + 1
        slots[room - size].append(b)
        mask |= 1 << (room - size)
        placed.append(b)
    return placed, bins


def fill(assignment: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(assignment, weights=lengths).astype(np.int64)


def quality(assignment: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Larger is better: fewer bins first, then fuller and emptier bins rather than even ones."""
    used = fill(assignment, lengths)
    return -len(used), float(np.mean((used / capacity) ** 2))


def complete(assignment: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Places the items marked -1 by best fit, longest first with equal lengths shuffled."""
    bins, compact = np.unique(assignment[assignment >= 0], return_inverse=True)
    child = assignment.copy()
    child[assignment >= 0] = compact
    rest = capacity - np.bincount(compact, weights=lengths[assignment >= 0], minlength=len(bins)).astype(np.int64)
    loose = rng.permutation(np.flatnonzero(assignment < 0))
    loose = loose[np.argsort(-lengths[loose], kind="stable")]
    child[loose] = best_fit(rest, loose, lengths, capacity)[0]
    return child


def crossover(receiver: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    used = fill(donor, lengths)
    well = np.flatnonzero(used >= np.median(used))
    chosen = np.zeros(len(used), bool)
    chosen[rng.choice(well, max(1, len(well) // 2), replace=False)] = True
    injected = chosen[donor]
    broken = np.zeros(int(receiver.max()) + 1, bool)
    broken[receiver[injected]] = True
    child = np.where(broken[receiver], -1, receiver)
    child[injected] = donor[injected] + len(broken)
    return complete(child, lengths, capacity, rng)


def mutate(assignment: np.ndarray, lengths: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Dissolves the emptiest bins and as many drawn ones."""
    used = fill(assignment, lengths)
    few = max(1, len(used) // 50)
    gone = np.zeros(len(used), bool)
    gone[np.argsort(used, kind="stable")[:few]] = True
    gone[rng.integers(0, len(used), few)] = True
    return complete(np.where(gone[assignment], -1, assignment), lengths, capacity, rng)


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, rng,
           population: int = POPULATION, generations: int = GENERATIONS) -> list[np.ndarray]:
    """The population after some generations, best first."""
    empty = np.full(len(lengths), -1, np.int64)
    rank = lambda p: sorted(p, key=lambda a: quality(a, lengths, capacity), reverse=True)
    people = [np.asarray(e, np.int64) for e in elites]
    while len(people) < population:
        if not people:
            people.append(complete(empty, lengths, capacity, rng))
        else:
            order = rng.permutation(len(lengths))  # a random first-come packing, for variety
            some = empty.copy()
            half = order[: len(order) // 2]
            some[half] = best_fit(np.zeros(0, np.int64), half, lengths, capacity)[0]
            people.append(complete(some, lengths, capacity, rng))
    people = rank(people)[:population]
    floor = -(-int(lengths.sum()) // capacity)
    for _ in range(generations):
        if fill(people[0], lengths).size <= floor:
            break
        a, b = rng.choice(len(people), 2, replace=False) if len(people) > 1 else (0, 0)
        children = [crossover(people[max(a, b)], people[min(a, b)], lengths, capacity, rng),
                    crossover(people[min(a, b)], people[max(a, b)], lengths, capacity, rng),
                    mutate(people[0], lengths, capacity, rng)]
        people = rank(people + children)[:population]
    return people


STATE = "shard long, island int, rows array<long>, lengths array<int>, elites array<array<int>>, bins int, fullness double"


def epoch(states: DataFrame, number: int, capacity: int) -> DataFrame:
    def run(frames):
        for frame in frames:
            out = []
            for s in frame.itertuples():
                rng = np.random.default_rng([int(s.shard), int(s.island), number])
                lengths = np.array(s.lengths, np.int64)
                best = evolve(lengths, list(s.elites), capacity, rng)
                bins, fullness = quality(best[0], lengths, capacity)
                out.append((s.shard, s.island, s.rows, s.lengths, [b.astype(np.int32) for b in best[:2]], -bins, fullness))
            yield type(frame)(out, columns=["shard", "island", "rows", "lengths", "elites", "bins", "fullness"])

    return states.select("shard", "island", "rows", "lengths", "elites").mapInPandas(run, STATE)


def migrate(states: DataFrame, islands: int) -> DataFrame:
    """Each island's best packing joins the elites of the next island."""
    guests = states.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.get("elites", F.lit(0)).alias("guest"))
    return states.join(guests, ["shard", "island"]).withColumn("elites", F.concat("elites", F.array("guest")))


def pack(docs: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS,
         json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    cut_up = materialise(pieces(docs, capacity, json_path, ranks_path).withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = cut_up.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // SHARD))
    item = F.struct("row", F.col("length").cast("int").alias("length"))
    dealt = (short.groupBy(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
             .agg(F.array_sort(F.collect_list(item)).alias("items")))
    states = dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                          F.col("items.row").alias("rows"), F.col("items.length").alias("lengths"),
                          F.array().cast("array<array<int>>").alias("elites")).repartition("shard", "island")
    for number in range(epochs):
        states = materialise(epoch(states if not number else migrate(states, islands), number, capacity), "islands")
    best = states.groupBy("shard").agg(F.max_by(F.struct("rows", "lengths", F.get("elites", F.lit(0)).alias("bin")),
                                                F.struct(-F.col("bins"), "fullness", -F.col("island"))).alias("s"))
    flat = best.select("shard", F.inline(F.arrays_zip(
        F.col("s.rows").alias("row"), F.col("s.lengths").alias("length"), F.col("s.bin").alias("bin"))))
    flat = flat.toDF("shard", "row", "length", "bin")
    before = F.sum("length").over(Window.partitionBy("shard", "bin").orderBy("row")) - F.col("length")  # at most capacity rows
    placed = flat.select((F.col("shard") * (1 << 20) + F.col("bin")).alias("sequence_id"), "row", before.cast("long").alias("offset"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    some = short.join(placed, "row").select(*columns, "sequence_id", "offset")
    full = cut_up.where(F.col("length") >= capacity).select(
        *columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(some)
