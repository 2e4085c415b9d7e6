"""Document fingerprints by a randomised edit embedding.

A text is read by a random walk that all texts share: at step j the walk stands on a
character, writes it, and moves on if a random bit drawn for (j, character) says so.
After an edit two walks soon fall into step again, so their outputs agree in most
places: edit distance becomes Hamming distance. A walk has at most three steps a
character.

A fingerprint samples the output: steps are cut into blocks of 2^k, with k such that a
text of that length has 129 to 256 blocks, and one step of each block is kept. Which one
is drawn once for all texts, and a block keeps the choice of one of its halves, so the
fingerprint of a shorter text can be thinned to the k of a longer one. Each kept place is
one byte, 0 where the walk had ended. Likeness is the share of equal places among those
where at least one walk still went on.

Bands are hashes of sampled places, taken at the text's own k and at the next one, so
that near lengths meet. A band has its own fixed order of all block numbers and takes the
first ``BAND_PLACES`` of them that the walk reached, so a text and one cut or continued at
its end choose the same places as often as they share them: a band agrees with about
likeness^6, and 12 of them are drawn at each k.

``near_classes`` folds equal fingerprints, then verifies each member of a band with the
band's leader (a minimum aggregated before the shuffle). Bands whose members are not all
in one component after that are settled exactly: their members meet in blocks of at most
``2 * BLOCK``, where every pair of different components is verified. Classes are the
connected components of what is alike; no pair that shares a band is left out.

Defined results: a null or empty text has a fingerprint without places; the likeness of
two such is 1. Equal texts have equal fingerprints. Rows are ordered by ``doc_id``
descending (null last), ties by a hash of the text; the row after the last is the first,
and a single row follows itself. Repeated rows stay. Extra columns are ignored. An empty
table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.llm.components import components
from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.minhash import BLOCK, groups, grouped, pairs_batch
from corpusgrid.llm.tokens import blocks
from corpusgrid.llm.words import mix
from corpusgrid.session import materialise

MOST_PLACES, STEPS_PER_CHAR = 256, 3
SEED = np.uint64(1618033988749894848)
BATCH_CHARS = 8_000_000
BANDS, BAND_PLACES, LEAST = 12, 6, 0.7


def level_of(n: int) -> int:
    """The k of a text of ``n`` characters."""
    return max(0, (max(1, -(-STEPS_PER_CHAR * n // MOST_PLACES)) - 1).bit_length())


def choose(places: np.ndarray, high: int, low: int) -> np.ndarray:
    """The blocks of level ``low`` (0: steps) that blocks of level ``high`` keep."""
    at = places.astype(np.uint64)
    for level in range(high, low, -1):
        bit = mix(at * np.uint64(64) + np.uint64(level) + SEED) >> np.uint64(63)
        at = at * np.uint64(2) + bit
    return at.astype(np.int64)


def n_places(n: int) -> int:
    return -(-STEPS_PER_CHAR * n // (1 << level_of(n)))


def symbols(text: str) -> np.ndarray:
    """One byte per character, 1 to 255, and a final 0 on which a walk rests."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    coded = (points * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return np.append(coded % np.uint32(255) + np.uint32(1), np.uint32(0)).astype(np.uint8)


def moves(block: int) -> np.ndarray:
    """The random bits of 64 steps for every symbol; the walk rests on 0."""
    words = mix(np.arange(256, dtype=np.uint64) + np.uint64(block) * np.uint64(256) + SEED)
    bits = ((words[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.int32)
    bits[:, 0] = 0
    return bits


def walk(texts: list[str]) -> list[np.ndarray]:
    """The kept places of each text, all texts walking at once."""
    out = [np.zeros(n_places(len(t)), np.uint8) for t in texts]
    order = [i for i in sorted(range(len(texts)), key=lambda i: len(texts[i])) if texts[i]]
    if not order:
        return out
    coded = [symbols(texts[i]) for i in order]
    sizes = np.array([len(c) for c in coded])
    flat = np.concatenate(coded)
    at = (np.cumsum(sizes) - sizes).astype(np.int64)
    limit = STEPS_PER_CHAR * (sizes - 1)
    levels = np.array([level_of(int(n) - 1) for n in sizes])  # ascending, as the sizes are
    kept: dict[int, np.ndarray] = {}
    for k in np.unique(levels).tolist():
        most = int(limit[levels == k].max())
        kept[k] = choose(np.arange(-(-most // (1 << k))), k, 0)
    cursor = dict.fromkeys(kept, 0)
    live = np.arange(len(order))
    rows = {k: np.zeros((int((levels == k).sum()), len(v)), np.uint8) for k, v in kept.items()}
    first = {k: int(np.searchsorted(levels, k)) for k in kept}
    block = 0
    while len(live):
        bits, here, base = moves(block), at[live], block * 64
        marks: dict[int, list[int]] = {}
        for k, steps in kept.items():
            while cursor[k] < len(steps) and steps[cursor[k]] < base + 64:
                marks.setdefault(int(steps[cursor[k]]) - base, []).append(k)
                cursor[k] += 1
        spans = {k: np.searchsorted(levels[live], [k, k + 1]) for k in kept} if marks else {}
        for j in range(64):
            symbol = flat[here]
            for k in marks.get(j, ()):
                a, b = spans[k]
                column = int(np.searchsorted(kept[k], base + j)) if k == 0 else (base + j) >> k
                rows[k][live[a:b] - first[k], column] = symbol[a:b]
            here += bits[j][symbol]
        at[live] = here
        block += 1
        live = live[(flat[here] != 0) & (limit[live] > block * 64)]
    for r, i in enumerate(order):
        k = int(levels[r])
        steps = kept[k][:len(out[i])]
        out[i] = np.where(steps < limit[r], rows[k][r - first[k], :len(out[i])], 0).astype(np.uint8)
    return out


def written(n: int, places: np.ndarray) -> str:
    return f"{level_of(n)}:{places.tobytes().hex()}"


def parsed(fingerprint: str) -> tuple[int, np.ndarray]:
    level, _, places = fingerprint.partition(":")
    return int(level), np.frombuffer(bytes.fromhex(places), np.uint8)


@lru_cache(maxsize=2048)
def kept_of(level: int, to: int) -> np.ndarray:
    """Which places of a fingerprint at ``level`` the blocks of a coarser one keep."""
    return choose(np.arange(-(-MOST_PLACES // (1 << (to - level)))), to, level)


def thinned(level: int, places: np.ndarray, to: int) -> np.ndarray:
    if level == to:
        return places
    padded = np.zeros(MOST_PLACES, np.uint8)
    padded[:len(places)] = places
    blocks_left = -(-len(places) // (1 << (to - level)))
    wanted = kept_of(level, to)[:blocks_left]
    return np.where(wanted < MOST_PLACES, padded[np.minimum(wanted, MOST_PLACES - 1)], 0).astype(np.uint8)


def likeness(x: str, y: str) -> float:
    if x == y:
        return 1.0
    (kx, px), (ky, py) = parsed(x), parsed(y)
    px, py = thinned(kx, px, max(kx, ky)), thinned(ky, py, max(kx, ky))
    n = max(len(px), len(py))
    px, py = np.pad(px, (0, n - len(px))), np.pad(py, (0, n - len(py)))
    on = (px > 0) | (py > 0)
    return float((px[on] == py[on]).mean()) if on.any() else 1.0


def prints(texts: list[str]) -> list[str]:
    return [written(len(t), p) for t, p in zip(texts, walk(texts))]


def edit(text: str, following: str) -> str:
    """The last third replaced by the first as many characters of the following text."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


FIELDS = [("doc_id", "long"), ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
          ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]
ARROW = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}


def record(rows: list[tuple], fields: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.record_batch([pa.array(c, ARROW[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def schema(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"{n} {t}" for n, t in fields)


def finished(ids: list, texts: list[str], own: list[str], next_texts: list[str], next_own: list[str]) -> list[tuple]:
    edited = [edit(t, f) for t, f in zip(texts, next_texts)]
    marks = prints(edited)
    return [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, h))
            for i, t, e, f, g, h in zip(ids, texts, edited, own, marks, next_own)]


OPEN = [*FIELDS, ("part", "int"), ("role", "string"), ("text", "string")]


def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range; its first row is also a ``head`` and its last one stays ``open``."""
    part = TaskContext.get().partitionId()
    last, started = None, False

    def loose(role: str, row: tuple) -> tuple:
        return (row[0], len(row[1]), None, row[2], None, None, None, part, role, row[1])

    for batch in batches:
        all_ids, all_texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for a, b in blocks(all_texts, BATCH_CHARS):
            ids, texts = all_ids[a:b], all_texts[a:b]
            own = prints(texts)
            if not started:
                started = True
                yield record([loose("head", (ids[0], texts[0], own[0]))], OPEN)
            if last is not None:
                ids, texts, own = [last[0], *ids], [last[1], *texts], [last[2], *own]
            done = finished(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:])
            yield record([(*row, part, "done", None) for row in done], OPEN)
            last = (ids[-1], texts[-1], own[-1])
    if last is not None:
        yield record([loose("open", last)], OPEN)
    tidy()


def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of a range beside the head of the next one."""
    for batch in batches:
        for row in batch.to_pylist():
            yield record(finished([row["doc_id"]], [row["text"]], [row["fingerprint"]], [row["head_text"]],
                                  [row["head_print"]]), FIELDS)


def packed(mark: Column) -> Column:
    """A written fingerprint as octets, the level first: half the size on disk."""
    level = F.substring_index(mark, ":", 1).cast("int")
    return F.unhex(F.concat(F.lpad(F.hex(level), 2, "0"), F.substring_index(mark, ":", -1)))


def unpacked(octets: Column) -> Column:
    level = F.conv(F.hex(F.substring(octets, 1, 1)), 16, 10)
    return F.concat(level, F.lit(":"), F.lower(F.hex(F.substring(octets, 2, MOST_PLACES))))


MARKS = ("fingerprint", "edited_fingerprint")


def compact(rows: DataFrame) -> DataFrame:
    return rows.withColumns({m: packed(F.col(m)) for m in MARKS} | {"edited_sha256": F.unhex("edited_sha256")})


def readable(rows: DataFrame) -> DataFrame:
    return rows.withColumns({m: unpacked(F.col(m)) for m in MARKS} | {"edited_sha256": F.lower(F.hex("edited_sha256"))})


def compact_rows(docs: DataFrame) -> DataFrame:
    """One row per document, with its likeness to its edited text and to the next document; hex texts as octets."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tag")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = materialise(compact(ranged.mapInArrow(stream, schema(OPEN))), "fingerprints")
    names = [n for n, _ in FIELDS]
    heads = found.where("role = 'head'").select("part", "text", unpacked(F.col("fingerprint")).alias("fingerprint"))
    ends = heads.select("part")  # one row per range
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = ends.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                            F.first("part").over(whole)).alias("after"))
    open_rows = found.where("role = 'open'").select(
        "part", "doc_id", "text", unpacked(F.col("fingerprint")).alias("fingerprint")).join(follow, "part")
    after = heads.select(F.col("part").alias("after"), F.col("text").alias("head_text"), F.col("fingerprint").alias("head_print"))
    closed = open_rows.join(after, "after").select("doc_id", "text", "fingerprint", "head_text", "head_print")
    return found.where("role = 'done'").select(*names).unionByName(compact(closed.mapInArrow(close, schema(FIELDS))))


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document, with its likenesses and its band keys."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([band_keys(f) for f in batch.column("fingerprint").to_pylist()], ARROW["array<long>"])
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "bands"])

    return readable(compact_rows(docs)).mapInArrow(add, schema([*FIELDS, ("bands", "array<long>")]))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints and likenesses; ``near_doc_id`` is the least document of the class, null in that document's own row."""
    rows = compact_rows(docs)
    classes = near_classes(rows.select("doc_id", "fingerprint")).select("fingerprint", "class_id")
    near = F.when(~F.col("doc_id").eqNullSafe(F.col("class_id")), F.col("class_id")).alias("near_doc_id")
    return readable(rows.join(classes, "fingerprint", "left").select(*rows.columns, near))


# -- bands
WEIGHTS = np.uint64(1) << (np.uint64(8) * np.arange(BAND_PLACES, dtype=np.uint64))
ORDERS = mix(np.arange(BANDS * MOST_PLACES, dtype=np.uint64) + SEED).reshape(BANDS, MOST_PLACES).argsort(axis=1)


def picks() -> tuple[np.ndarray, np.ndarray]:
    """The places of each band by the number of places reached (-1: none), and a hash of them."""
    out = np.full((MOST_PLACES + 1, BANDS, BAND_PLACES), -1, np.int64)
    for used in range(1, MOST_PLACES + 1):
        n = min(used, BAND_PLACES)
        out[used, :, :n] = ORDERS[ORDERS < used].reshape(BANDS, used)[:, :n]
    salt = np.zeros(out.shape[:2], np.uint64)
    for k in range(BAND_PLACES):
        salt = mix(salt + out[:, :, k].astype(np.uint64))
    return out, salt


PICKS, SALT = picks()


def octets_of(marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Levels, and places in rows padded with zeros to one more than ``MOST_PLACES``."""
    wide = b"".join(m[1:].ljust(MOST_PLACES + 1, b"\0") for m in marks)
    return np.array([m[0] for m in marks], np.int64), np.frombuffer(wide, np.uint8).reshape(len(marks), MOST_PLACES + 1)


def thin_rows(places: np.ndarray, level: int, to: int) -> np.ndarray:
    """``thinned`` for rows of ``octets_of``."""
    if level == to:
        return places
    kept = kept_of(level, to)
    out = np.zeros_like(places)
    out[:, :len(kept)] = places[:, np.minimum(kept, MOST_PLACES)]
    return out


def keys_of(marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints: at their own level and the next, so that near lengths meet."""
    levels, places = octets_of(marks)
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for level in np.unique(levels).tolist():
        mine = np.flatnonzero(levels == level)
        for k in (level, level + 1):
            some = thin_rows(places[mine], level, k)
            used = np.count_nonzero(some, axis=1)
            rows, some, used = mine[used > 0], some[used > 0], used[used > 0]
            chosen = some[np.arange(len(rows))[:, None, None], PICKS[used]].astype(np.uint64)
            family = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * k + 1)
            keys.append(mix(mix(SALT[used] + family) + (chosen * WEIGHTS).sum(2)).view(np.int64).reshape(-1))
            owners.append(np.repeat(rows, BANDS))
    return np.concatenate(owners), np.concatenate(keys)


def band_keys(mark: str) -> list[int]:
    """Keys of one fingerprint."""
    level, places = parsed(mark)
    return keys_of([bytes([level]) + places.tobytes()])[1].tolist()


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            part = batch.slice(a, 1000)
            owner, key = keys_of(part.column("fingerprint").to_pylist())
            yield pa.record_batch([pa.array(key), part.column("node").take(pa.array(owner))], names=["key", "node"])


# -- verification
def shares(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Likeness of rows of places of one level."""
    on = ((one > 0) | (many > 0)).sum(-1)
    equal = ((one == many) & (many > 0)).sum(-1)
    return np.where(on > 0, equal / np.maximum(on, 1), 1.0)


def leaders_alike(least: float):
    """The pairs ``u, v`` whose fingerprints ``a, b`` are alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                (la, a), (lb, b) = (octets_of(part.column(c).to_pylist()) for c in ("a", "b"))
                keep = np.zeros(part.num_rows, bool)
                for x, y in set(zip(la.tolist(), lb.tolist())):
                    at = np.flatnonzero((la == x) & (lb == y))
                    keep[at] = shares(thin_rows(a[at], x, max(x, y)), thin_rows(b[at], y, max(x, y))) >= least
                yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v")], names=["u", "v"]).filter(pa.array(keep))
    return run


def settle(least: float):
    """Verifies all pairs of different components in each block; a pair already joined is skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            node = group["node"].to_numpy()
            keep = np.unique(node, return_index=True)[1]
            node, root = node[keep], np.unique(group["label"].to_numpy()[keep], return_inverse=True)[1]
            levels, places = octets_of(group["fingerprint"].take(pa.array(keep)).to_pylist())
            at: dict[tuple[int, int], np.ndarray] = {}
            kinds = np.unique(levels).tolist()
            own = {k: np.flatnonzero(levels == k) for k in kinds}
            spot = np.zeros(len(node), np.int64)
            for k in kinds:
                spot[own[k]] = np.arange(len(own[k]))
                at |= {(k, to): thin_rows(places[own[k]], k, to) for to in kinds if to >= k}
            links = []
            for x in range(len(node) - 1):
                for k in kinds:
                    to, mine = max(k, int(levels[x])), own[k]
                    rest = np.flatnonzero((mine > x) & (root[mine] != root[x]))
                    if not len(rest):
                        continue
                    hits = mine[rest[shares(at[int(levels[x]), to][spot[x]], at[k, to][rest]) >= least]]
                    for y in hits.tolist():
                        if root[y] != root[x]:
                            root[root == root[y]] = root[x]
                            links.append((int(node[x]), int(node[y])))
            yield pairs_batch(links)
    return run


def near_classes(marked: DataFrame, least: float = LEAST) -> DataFrame:
    """``fingerprint, rep, class_id`` of packed fingerprints (``doc_id, fingerprint``) that are not alone:
    the least document of the fingerprint and of its class."""
    distinct = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("times"))
                           .withColumn("node", F.monotonically_increasing_id()), "distinct-fingerprints")
    marks = distinct.select("node", "fingerprint")
    keys = marks.mapInArrow(key_rows, "key long, node long")
    leaders = materialise(keys.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("most"))
                          .where("leader <> most").select("key", "leader"), "band-leaders")
    members = materialise(keys.join(leaders, "key").select("key", "node", "leader"), "band-members")
    pairs = members.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct()
    left, right = (marks.select(F.col("node").alias(n), F.col("fingerprint").alias(f)) for n, f in (("u", "a"), ("v", "b")))
    links = materialise(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
                        .mapInArrow(leaders_alike(least), "u long, v long"), "led")
    labelled = materialise(members.select("key", "node").join(materialise(components(links), "components"), "node", "left")
                           .select("key", "node", F.coalesce("label", "node").alias("label")), "labelled")
    mixed = materialise(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"))
                        .where("low <> high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("n")), "mixed-bands")
    rest = labelled.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("node"), "n").cast("int"))
    rest = rest.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    rest = rest.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label")
    more = materialise(grouped(rest.join(marks, "node")).mapInArrow(settle(least), "u long, v long"), "settled")
    final = materialise(components(links.unionByName(more)), "components")
    found = materialise(distinct.join(final, "node", "left").where("label IS NOT NULL OR times > 1")
                        .select("fingerprint", "rep", F.coalesce("label", "node").alias("label")), "alike")
    heads = found.groupBy("label").agg(F.min("rep").alias("class_id"))
    return found.join(heads, "label").select("fingerprint", "rep", "class_id")


def neighbours(marked: DataFrame, least: float = LEAST) -> DataFrame:
    """``fingerprint, near_doc_id`` from rows ``doc_id, fingerprint``: the least document of the class,
    for fingerprints other than its own."""
    classes = near_classes(marked.select("doc_id", packed(F.col("fingerprint")).alias("fingerprint")), least)
    return classes.where("NOT rep <=> class_id").select(unpacked(F.col("fingerprint")).alias("fingerprint"),
                                                        F.col("class_id").alias("near_doc_id"))
