"""Frequent phrases and their extensions, mined from an FM-index per shard over word ids.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and numbered word
by word into shards of one language and about ``SHARD`` words, without moving a text. Every
frequent word gets an id, and every shard builds a two-way FM-index of ids once, written with
its transforms compressed. Other words part pieces there, as no phrase is met more often than
its words.

Phrases grow by one word a round, to the right and to the left in turn: each shard extends
the intervals of the phrases that are frequent over all shards, where both the phrase
without its first word and that without its last word are, and sums across shards tell
which of the new ones are frequent. A shard deals the phrases it finds, with their counts,
to parts by their hash, as one row of packed numbers for each part. A part has all counts of
its phrases; it sums them and answers every row by a row of numbers in the same order, 0 for
rare phrases. The shard finds the same intervals in the same order again and reads off which
are frequent, so no row is made for a phrase and a shard that holds it, and what goes back
grows as what was sent. The transforms stay in buckets of shards, so a round moves phrases
with their counts, never texts. The rounds are as many as the longest phrase has words,
whatever the size of the corpus.

A shard is bounded (or is one longer text), and parts are so many that one has about as many
counts as ``OF_PART`` shards have phrases: a shard sends one count of a phrase. Ids have 31 bits,
which is enough for 2^31 frequent phrases of one length, so for 2 * 10^11 words at least.
Every table between rounds is written to the shared folder.

Defined results: a null text is empty, a null language is ``und``; repeated rows count each;
extra columns are ignored; a null ``doc_id`` has no influence; an empty table, or one
without frequent phrases, gives no phrase.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.llm.fm_index import DEPTH, FmIndex, Phrases
from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.tokens import blocks
from corpusgrid.llm.words import mix
from corpusgrid.session import materialise, table_path

SHARD, LEAST, LONGEST, TOP = 1 << 20, 100, 5, 2000
OF_PART = 4  # shards
FEW = 1 << 18  # words that are broadcast at most
BREAK = b"\xff"  # no byte of UTF-8
AS_READ = bytes(ord(BREAK) if chr(b) in ".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def packed(a: np.ndarray) -> bytes:
    """Compressed numbers of 32 bits, all their first bytes before all second ones, as high bytes are alike."""
    return pa.compress(a.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * size, codec="zstd", asbytes=True), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4")[:, 0]


def single_breaks(codes: np.ndarray) -> np.ndarray:
    """Without a 0 after another one, and with one at the end."""
    codes = np.append(codes, np.zeros(1, codes.dtype))
    return codes[(codes > 0) | (np.append(1, codes[:-1]) > 0)]


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


class Shard:
    """Words of texts of one language, numbered from 1 as they are met; 0 parts pieces."""

    def __init__(self):
        self.numbers, self.parts, self.size = Numbers({BREAK: 0}), [], 0

    def add(self, texts: list[str]) -> None:
        read = BREAK.join([t.encode() for t in texts]).translate(AS_READ).replace(BREAK, b" " + BREAK + b" ").split()
        codes = single_breaks(np.fromiter(map(self.numbers.__getitem__, read), np.int32, len(read)))
        self.parts.append(codes)
        self.size += len(codes)

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.parts)
        words = pa.array(list(self.numbers)[1:], pa.binary()).cast(pa.string())
        counts = np.bincount(codes, minlength=len(self.numbers))[1:]
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        return pa.record_batch([pa.array([shard]), pa.array([lang]), one(words), one(pa.array(counts, pa.int64())),
                                pa.array([len(codes)], pa.int64()), pa.array([packed(codes)])],
                               names=["shard", "lang", "words", "counts", "size", "text"])


def shards(docs: DataFrame, shard_words: int = SHARD) -> DataFrame:
    """``shard, lang, words, counts, size, text``: the numbered words of parts of the corpus."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, of = 0, {}
        task = TaskContext.get().partitionId() << 24
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for a, b in blocks(texts):
                grouped: dict[str, list[str]] = {}
                for lang, text in zip(langs[a:b], texts[a:b]):
                    grouped.setdefault(lang, []).append(text)
                for lang, some in grouped.items():
                    of.setdefault(lang, Shard()).add(some)
                while of:
                    lang = max(of, key=lambda k: of[k].size)
                    if of[lang].size < shard_words and sum(s.size for s in of.values()) < 2 * shard_words:
                        break
                    yield of.pop(lang).row(task + made, lang)
                    made += 1
        for lang in list(of):
            yield of.pop(lang).row(task + made, lang)
            made += 1
        tidy()

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return small_batches(texts).mapInArrow(
        number, "shard long, lang string, words array<string>, counts array<long>, size long, text binary")


INDEX, PACKED = "forward binary, backward binary, size long, ids binary", "part int, packed binary, size long"
KINDS = "shard long, part int, packed binary, forward binary, backward binary, size long, ids binary, kind string"
SETTLED = "shard long, part int, packed binary, size long, base long, word long, id long, f long, kind string"
ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def names_of(schema: str) -> list[str]:
    return re.findall(r"(\w+) \w+", schema)


def rows_of(schema: str, kind: str, **columns) -> pa.RecordBatch:
    """Rows of ``schema``, null where ``columns`` has nothing."""
    types = dict(re.findall(r"(\w+) (\w+)", schema))
    n = len(next(iter(columns.values())))
    columns["kind"] = [kind] * n
    return pa.record_batch([pa.array(columns[c], ARROW[t]) if c in columns else pa.nulls(n, ARROW[t]) for c, t in types.items()],
                           names=list(types))


def dealt(base: np.ndarray, word: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of phrases by the part of their hash, and where the parts begin and end in it."""
    part = (mix(base.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def sent(shard: int, base: np.ndarray, word: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part with phrases, ``size`` of them packed as steps between bases, words and counts."""
    order, ends = dealt(base, word, parts)
    columns = [c[order] for c in (base, word, n)]
    full = np.flatnonzero(np.diff(ends))
    packs = []
    for p in full:
        bases, words, counts = (c[ends[p]:ends[p + 1]] for c in columns)
        packs.append(packed(np.concatenate([np.diff(bases, prepend=0), words, counts])))
    return rows_of(KINDS, "found", shard=[shard] * len(full), part=full, packed=packs, size=np.diff(ends)[full])


def build(joined: DataFrame, parts: int) -> DataFrame:
    """The index of every shard, and its phrases of two frequent words, from ``shard, size, text, known``.

    ``known`` has the place of each frequent word in the upper and its id in the lower 32 bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                shard, size, text = (batch.column(k)[row].as_py() for k in range(3))
                known = batch.column(3)[row].values.to_numpy()
                place, ids = known >> 32, known & 0xFFFFFFFF
                codes = unpacked(text, size)
                symbol = np.zeros(int(codes.max(initial=0)) + 1, np.int32)
                order = np.argsort(ids)  # symbols are in the order of ids
                symbol[place[order] + 1] = np.arange(1, len(place) + 1)
                index, ids = FmIndex.of(single_breaks(symbol[codes])), ids[order]
                yield rows_of(KINDS, "index", shard=[shard], forward=[packed(index.forward)], backward=[packed(index.backward)],
                              size=[len(index.forward)], ids=[ids.astype("<i8").tobytes()])
                single = index.single()
                found = index.extend(single, left=False)
                yield sent(shard, ids[single.symbol[found.base] - 1], ids[found.symbol - 1], found.size, parts)
                del index, single, found, codes, known
                tidy()

    return joined.select("shard", "size", "text", "known").mapInArrow(run, KINDS)


def settled(found: DataFrame, least: int, parts: int, last: bool) -> DataFrame:
    """Rows ``frequent`` with ``base, word, id, f`` of the phrases met ``least`` times over all shards, and the answers.

    An answer has a number for each phrase of the row of a shard, in its order: 0 if it is
    rare, else 1 more than its id. After the ``last`` round there is none.
    """
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part, sizes = key[0].as_py(), rows["size"].to_numpy()
        held = [unpacked(blob.as_py(), 3 * size).reshape(3, size) for blob, size in zip(rows["packed"], sizes)]
        phrase = np.concatenate([np.cumsum(h[0], dtype=np.int64) << 32 | h[1] for h in held])
        n = np.concatenate([h[2] for h in held]).astype(np.int64)
        order = np.argsort(phrase)
        phrase = phrase[order]
        first = np.flatnonzero(np.concatenate([[True], phrase[1:] != phrase[:-1]]))
        f = np.add.reduceat(n[order], first)
        frequent = f >= least
        name = (np.cumsum(frequent) - 1) * parts + part
        if name[-1] >= (1 << 31) - 1:
            raise OverflowError("more frequent phrases of one length than ids of 31 bits")
        phrase = phrase[first][frequent]
        out = [rows_of(SETTLED, "frequent", base=phrase >> 32, word=phrase & 0xFFFFFFFF, id=name[frequent], f=f[frequent])]
        if not last:
            answer = np.empty(len(order), np.int32)
            answer[order] = np.repeat(np.where(frequent, name + 1, 0), np.diff(np.append(first, len(order))))
            packs = [packed(a) for a in np.split(answer, np.cumsum(sizes)[:-1])]
            out.append(rows_of(SETTLED, "answer", shard=rows["shard"].to_numpy(), part=[part] * len(packs), packed=packs, size=sizes))
        return pa.Table.from_batches(out)

    rows = found.groupBy("part").applyInArrow(run, SETTLED)
    path = table_path(found.sparkSession, "settled")
    rows.write.partitionBy("kind").parquet(path)
    return found.sparkSession.read.schema(rows.schema).parquet(path)


def grow(joined: DataFrame, grown_left: bool, left: bool, parts: int) -> DataFrame:
    """The frequent phrases of each shard with their intervals, and the phrases one word longer.

    A row has an index, the ``answers`` on the phrases it was extended to last and the
    intervals of their bases in ``state``, or null where the bases are words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                shard, forward, backward, size, ids, answers, state = (c[row].as_py() for c in batch.columns)
                ids, index = np.frombuffer(ids, "<i8"), FmIndex(unpacked(forward, size), unpacked(backward, size))
                if state is None:
                    bases = index.single()
                    old = ids[bases.symbol - 1]
                else:
                    old, *held = unpacked(state["packed"], 4 * state["size"]).reshape(4, -1).astype(np.int64)
                    bases = Phrases(*held, old, old)
                longer = index.extend(bases, grown_left)
                order, _ = dealt(old[longer.base], ids[longer.symbol - 1], parts)
                answers.sort(key=lambda a: a["part"])
                name = np.empty(len(longer), np.int64)
                name[order] = np.concatenate([unpacked(a["packed"], a["size"]) for a in answers])
                phrases, name = longer.of(name > 0), name[name > 0] - 1
                yield rows_of(KINDS, "state", shard=[shard], size=[len(name)],
                              packed=[packed(np.concatenate([name, phrases.lo, phrases.back, phrases.size]))])
                found = index.extend(phrases, left)
                yield sent(shard, name[found.base], ids[found.symbol - 1], found.size, parts)
                del index, found, longer, phrases
                tidy()

    return joined.select("shard", *names_of(INDEX), "answers", "state").mapInArrow(run, KINDS)


def written(rows: DataFrame, tasks: int) -> tuple[str, DataFrame]:
    """Rows of ``KINDS`` as an external table of the shared folder, by kind and in buckets of shards.

    An index then meets the phrases of its shard without being shuffled again.
    """
    name = f"phrase_shards_{uuid.uuid4().hex}"
    (rows.write.partitionBy("kind").bucketBy(tasks, "shard").option("compression", "zstd").option("path", table_path(rows.sparkSession, "phrase-shards"))
     .format("parquet").saveAsTable(name))
    return name, rows.sparkSession.table(name)


def frequent_words(local: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, f, id`` of the words met ``least`` times, with small ids."""
    words = materialise(local.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
                        .withColumn("id", F.monotonically_increasing_id()), "words")
    tasks = ((words.agg(F.max("id")).first()[0] or 0) >> 33) + 1
    small = F.expr(f"(id & {(1 << 33) - 1}) * {tasks} + shiftright(id, 33)")  # the rows of a task are counted in its low bits
    return words.withColumn("id", F.when(small < (1 << 31) - 1, small).otherwise(F.raise_error(F.lit("more frequent words than ids of 31 bits"))))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_words: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(phrases, words per language).

    ``lang, phrase, n_words, f, left, right``: all phrases of up to ``longest`` words met
    ``least`` times, and the greatest count of one word more on either side, 0 if that is
    below ``least``; ``lang, n`` counts all words.
    """
    if not 2 <= longest < DEPTH:
        raise ValueError(f"the longest phrase has 2 to {DEPTH - 1} words")
    texts = materialise(shards(docs, shard_words), "shards", compression="zstd")
    n_shards = texts.count()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n_shards, 16 * cores), n_shards // 16)
    parts = max(tasks, n_shards // OF_PART)
    local = texts.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "shard", "lang", F.col("pos").alias("place"), F.col("col.words").alias("phrase"), F.col("col.counts").alias("n"))
    totals = texts.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (a, n) -> a + n)")).alias("n")).where("n > 0")
    words = frequent_words(local, least)
    ids = words.select("lang", "phrase", "id")
    if words.count() <= FEW:  # else both are shuffled
        ids = F.broadcast(ids)
    place_and_id = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("id"))  # null for rare words, which a list leaves out
    known = (local.select("shard", "lang", "place", "phrase").join(ids, ["lang", "phrase"], "left")
             .groupBy("shard").agg(F.collect_list(place_and_id).alias("known")).repartition(tasks, "shard"))
    name, rows = written(build(texts.select("shard", "size", "text").repartition(tasks, "shard").join(known, "shard"), parts), tasks)
    tables, index, state = [name], rows.where("kind = 'index'").select("shard", *names_of(INDEX)), None
    levels = [words]
    word = words.select(F.col("id").alias("word"), F.col("phrase").alias("added"))
    for length in range(2, longest + 1):
        found, left = rows.where("kind = 'found'").select("shard", *names_of(PACKED)), length % 2 == 1
        sums = settled(found, least, parts, length == longest)
        parents = levels[-1].select(F.col("id").alias("base"), "lang", "phrase")
        longer = F.concat_ws(" ", *(["added", "phrase"] if left else ["phrase", "added"]))
        level = materialise(sums.where("kind = 'frequent'").select("base", "word", "id", "f").join(parents, "base").join(word, "word").select(
            "lang", longer.alias("phrase"), "f", "id"), "phrases")
        levels.append(level)
        if length == longest or not level.count():
            break
        answers = (sums.where("kind = 'answer'").select("shard", *names_of(PACKED)).repartition(tasks, "shard")
                   .groupBy("shard").agg(F.collect_list(F.struct(*names_of(PACKED))).alias("answers")))
        met = index.join(answers, "shard")
        if state is None:
            met = met.withColumn("state", F.lit(None).cast("struct<packed: binary, size: long>"))
        else:
            met = met.join(state, "shard")
        name, rows = written(grow(met, left, not left, parts), tasks)
        tables.append(name)
        state = rows.where("kind = 'state'").select("shard", F.struct("packed", "size").alias("state"))
    phrases = reduce(DataFrame.unionByName, [t.select("lang", "phrase", F.lit(k).alias("n_words"), "f") for k, t in enumerate(levels, 1)])
    for name in tables:  # the files stay in the shared folder
        docs.sparkSession.sql(f"DROP TABLE {name}")
    return with_extensions(phrases), totals


def part(words: Column | str, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def with_extensions(phrases: DataFrame) -> DataFrame:
    """Adds ``left`` and ``right``, the greatest counts of phrases with one word more on that side."""
    words = phrases.where("n_words > 1").select("lang", F.split("phrase", " ").alias("w"), F.col("n_words").alias("k"), "f")
    shorter = [F.struct(part("w", 2, F.col("k") - 1).alias("phrase"), F.col("f").alias("left"), F.lit(0).alias("right")),
               F.struct(part("w", 1, F.col("k") - 1).alias("phrase"), F.lit(0).alias("left"), F.col("f").alias("right"))]
    most = (words.select("lang", F.inline(F.array(*shorter))).groupBy("lang", "phrase")
            .agg(F.max("left").alias("left"), F.max("right").alias("right")))
    return phrases.join(most, ["lang", "phrase"], "left").select(
        "lang", "phrase", "n_words", "f", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("left", "right")])


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard_words: int = SHARD) -> DataFrame:
    """The ``top`` phrases of each language by the score of their weakest cut.

    A cut after k words scores floor(1000 * a * n / (l * r)), with the counts of the phrase
    and of its two parts, in decimals of 38 digits. A phrase that a longer one always holds
    is left out.
    """
    phrases, totals = frequent_phrases(docs, least, longest, shard_words)
    phrases = materialise(phrases, "frequent")
    whole = phrases.where("n_words > 1 AND left < f AND right < f").select(
        "lang", "phrase", F.col("f").alias("a"), "n_words", F.split("phrase", " ").alias("w"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang", "phrase", "a", "k", part("w", 1, F.col("k")).alias("first"),
        part("w", F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    of = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"]).join(totals, "lang").withColumn(
        "score", F.expr("cast(1000 AS decimal(38, 0)) * a * n div (cast(l AS decimal(38, 0)) * r)"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (weakest.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score", F.col("c.k").alias("cut"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut"))
