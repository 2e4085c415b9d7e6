"""Versioned writes: a batch of actions against the current rows of a collection.

Rows carry ``_type``, ``_id``, ``_version`` and the document fields; a batch also
has ``_seq``, its order. In a batch ``_version`` says what is wanted: null creates,
0 overwrites, any other number updates that very version.

Outcomes are found with joins and partial aggregations on the narrow key columns;
documents only travel in the final snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.operators.components import components
from corpusgrid.session import materialise, table_path

KEY = ["_type", "_id"]


class WriteFailed(Exception):
    """Raised for failed actions that no handler takes."""


@dataclass(frozen=True)
class WriteResult:
    """``snapshot`` is the new collection, ``success`` the stored rows (in batch
    order by ``_seq``), ``conflicts`` pairs ``attempted`` with ``current``."""

    snapshot: DataFrame
    success: DataFrame
    conflicts: DataFrame
    errors: DataFrame

    def handle(self, on_success: Callable | None = None, on_conflict: Callable | None = None,
               on_error: Callable | None = None) -> dict[str, DataFrame]:
        """Hand each output to its handler (DataFrame to DataFrame).

        Without a conflict handler conflicts count as errors; errors without a
        handler fail the job and show the first two.
        """
        out = {}
        errors = self.errors
        if on_conflict is not None:
            out["conflict"] = on_conflict(self.conflicts)
        else:
            errors = errors.unionByName(_as_errors(self.conflicts))
        if on_error is not None:
            out["error"] = on_error(errors)
        else:
            shown = errors.orderBy("_seq").limit(2).collect()
            if shown:
                raise WriteFailed(f"{errors.count()} uncaught errors, first: "
                                  + "; ".join(f"{r['_type']}/{r['_id']}: {r['error']}" for r in shown))
        if on_success is not None:
            out["success"] = on_success(self.success)
        return out


def _as_errors(conflicts: DataFrame) -> DataFrame:
    return conflicts.select("_type", "_id", "_seq", "error")


def _reject_partial(batch: DataFrame) -> None:
    if "is_partial" in batch.columns:
        raise ValueError("partial documents cannot be written")


def touch(df: DataFrame, now: Column, field: str = "timestamp") -> DataFrame:
    """Set the write time, in milliseconds."""
    return df.withColumn(field, F.date_trunc("millisecond", now))


def assign_ids(df: DataFrame) -> DataFrame:
    """Give rows without ``_id`` one derived from their content and order, so a
    retried task hands out the same ids."""
    rest = F.to_json(F.struct(*[c for c in df.columns if c != "_id"]))
    return df.withColumn("_id", F.coalesce("_id", F.sha2(rest, 256)))


def _versions(current: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored versions of the given ids. The semi join comes first: with a small
    batch its ids are broadcast, and the collection is scanned but not shuffled."""
    return current.select(*KEY, F.col("_version").alias("_stored")).join(ids.select(*KEY), KEY, "left_semi")


def _step(version: int, wanted) -> int | None:
    """The version after an action that fits, None for one that does not."""
    if wanted is None or pd.isna(wanted):
        return 1 if version == 0 else None
    fits = wanted == 0 or (wanted == version and version > 0)
    return version + 1 if fits else None


class _Effect:
    """What a run of actions makes of any version it starts from.

    Overwrites add one to every version. A create or an update moves only the start
    that stands at its version just then, and that start runs together with the next
    one. So the effect is one growth and a list of exceptions, no longer than the
    creates and updates of the run.
    """

    def __init__(self):
        self.growth, self.at, self.moved = 0, {}, set()

    def add(self, wanted) -> None:
        create = wanted is None or pd.isna(wanted)
        if not create and wanted == 0:
            self.growth += 1
            return
        if create and self.growth:
            return  # something is stored by now
        place = 0 if create else int(wanted) - self.growth  # the place before the growth
        group = self.at.pop(place, [])
        if place >= 0 and place not in self.moved:
            group.append(place)
            self.moved.add(place)
        if group:
            there = self.at.get(place + 1, [])
            longer, shorter = (group, there) if len(group) > len(there) else (there, group)
            longer += shorter
            self.at[place + 1] = longer

    def exceptions(self) -> tuple[list[int], list[int]]:
        pairs = sorted((start, place + self.growth) for place, group in self.at.items() for start in group)
        return [p[0] for p in pairs], [p[1] for p in pairs]


_OPENED = ("_type string, _id string, _seq long, _new long, _wanted long, _stored long, _part int, _kind string, "
           "_growth long, _from array<long>, _to array<long>")


def _fold(rows: DataFrame) -> DataFrame:
    """Outcome of ids with several actions, in order; documents are not moved.

    Actions are range-partitioned by (type, id, order), so an id with very many of them
    spans ranges. Sorted rows stream through each task and one version is held. Only
    the first id of a range may have begun in the range before: its rows are set aside
    with their effect as a whole, the effects of an id are chained in range order, and
    the rows are settled once their first version is known.
    """
    order = [*KEY, "_seq"]
    ranged = rows.select(*order, "_wanted", "_stored").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        first, key, version, effect, stored = None, None, 0, _Effect(), None
        for pdf in batches:
            out = []
            for t, i, q, wanted, held in pdf[[*order, "_wanted", "_stored"]].itertuples(index=False):
                if first is None:
                    first, stored = (t, i), held
                if (t, i) == first:
                    effect.add(wanted)
                    out.append((t, i, q, None, wanted, held, part, "open", None, None, None))
                    continue
                if (t, i) != key:
                    key, version = (t, i), 0 if pd.isna(held) else int(held)
                new = _step(version, wanted)
                version = version if new is None else new
                out.append((t, i, q, new, None, None, part, "done", None, None, None))
            yield _opened(out)
        if first is not None:
            ends = [(*first, None, None, None, stored, part, "effect", effect.growth, *effect.exceptions())]
            if key is not None:  # the last id may go on in the next range
                ends.append((*key, None, version, None, None, part, "exit", None, None, None))
            yield _opened(ends)

    found = materialise(ranged.mapInPandas(run, _OPENED), "folded")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """The version before each range of one id."""
        out, version = [], None
        columns = [*KEY, "_part", "_kind", "_new", "_stored", "_growth", "_from", "_to"]
        for t, i, part, kind, new, stored, growth, starts, ends in pdf.sort_values("_part")[columns].itertuples(index=False):
            if kind == "exit":
                version = int(new)
                continue
            if version is None:
                version = 0 if pd.isna(stored) else int(stored)
            out.append((t, i, part, version))
            at = int(np.searchsorted(starts, version)) if len(starts) else 0
            hit = at < len(starts) and starts[at] == version
            version = int(ends[at]) if hit else version + int(growth)
        return pd.DataFrame(out, columns=[*KEY, "_part", "_entry"])

    entries = found.filter("_kind in ('effect', 'exit')").groupBy(*KEY).applyInPandas(
        chain, "_type string, _id string, _part int, _entry long")
    waiting = found.filter("_kind = 'open'").select(*order, "_wanted", "_part").join(entries, [*KEY, "_part"])
    waiting = waiting.repartition("_part", *KEY).sortWithinPartitions("_part", *order)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, version = None, 0
        for pdf in batches:
            out = []
            for t, i, p, q, wanted, entry in pdf[[*KEY, "_part", "_seq", "_wanted", "_entry"]].itertuples(index=False):
                if (t, i, p) != last:
                    last, version = (t, i, p), int(entry)
                new = _step(version, wanted)
                version = version if new is None else new
                out.append((t, i, q, new))
            frame = pd.DataFrame(out, columns=[*order, "_new"])
            yield frame.astype({"_new": "Int64"})

    settled = waiting.mapInPandas(settle, "_type string, _id string, _seq long, _new long")
    return found.filter("_kind = 'done'").select(*order, "_new").unionByName(settled)


def _opened(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _OPENED.split(", ")])
    return frame.astype({c: "Int64" for c in ("_seq", "_new", "_wanted", "_stored", "_growth")})


def write(current: DataFrame, batch: DataFrame) -> WriteResult:
    """Create, update and overwrite actions of one batch, in ``_seq`` order.

    Rows without a type or an id, and negative versions, are errors.
    """
    _reject_partial(batch)
    docs = [c for c in batch.columns if c not in ("_seq", "_version")]
    bad = F.when(F.col("_type").isNull() | F.col("_id").isNull(), F.lit("no type or id")).when(
        F.col("_version") < 0, F.lit("negative version"))
    errors = batch.select("_type", "_id", "_seq", bad.alias("error")).filter("error is not null")
    batch = batch.filter(bad.isNull())
    asked = batch.select(*KEY, "_seq", F.col("_version").alias("_wanted"))
    per_id = asked.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    # ids joined once with the stored version, then with the batch
    known = per_id.join(_versions(current, per_id), KEY, "left")
    narrow = asked.join(known, KEY)
    stored, wanted = F.coalesce("_stored", F.lit(0)), F.col("_wanted")
    fits = F.when(wanted.isNull(), stored == 0).when(wanted == 0, True).otherwise(
        (wanted == stored) & (stored > 0))
    single = narrow.filter("_n = 1").select(
        *KEY, "_seq", F.when(fits, stored + 1).cast("long").alias("_new"))
    several = narrow.filter("_n > 1").select(*KEY, "_seq", "_wanted", "_stored")
    outcome = single.unionByName(_fold(several))
    return replace(_assemble(current, batch, docs, outcome), errors=errors)


def _assemble(current: DataFrame, batch: DataFrame, docs: list[str], outcome: DataFrame) -> WriteResult:
    """Outputs from the narrow ``(key, _seq, _new)`` outcomes.

    The outcomes are written once, as every output needs them; a document of the
    batch is moved once, for the output that asks for it.
    """
    outcome = materialise(outcome, "outcome")
    won = outcome.filter("_new is not null")
    success = batch.join(won, [*KEY, "_seq"]).select(*docs, F.col("_new").alias("_version"), "_seq")
    # versions grow with the order, so both maxima belong to the last action
    last = won.groupBy(*KEY).agg(F.max("_seq").alias("_seq"), F.max("_new").alias("_new"))
    rows = batch.join(last, [*KEY, "_seq"]).select(*docs, F.col("_new").alias("_version"))
    snapshot = current.join(last.select(*KEY), KEY, "left_anti").unionByName(rows, allowMissingColumns=True)
    failed = batch.join(outcome.filter("_new is null").drop("_new"), [*KEY, "_seq"])
    # only rows that lost are looked up, so the collection is met by their few keys
    lost = outcome.filter("_new is null").select(*KEY).distinct()
    stored = current.join(lost, KEY, "left_semi").select(*KEY, F.struct(*current.columns).alias("current"))
    conflicts = failed.select(*KEY, "_seq", F.struct(*batch.columns).alias("attempted"),
                              F.when(F.col("_version").isNull(), F.lit("document exists"))
                              .otherwise(F.lit("version conflict")).alias("error")).join(stored, KEY, "left")
    errors = batch.select("_type", "_id", "_seq", F.lit("").alias("error")).filter(F.lit(False))
    return WriteResult(snapshot, success, conflicts, errors)


def create(current: DataFrame, batch: DataFrame) -> WriteResult:
    """Insert only. The first action on a new id wins; no ordering of the batch
    is needed, only a minimum per id."""
    _reject_partial(batch)
    batch = batch.drop("_version").withColumn("_version", F.lit(None).cast("long"))
    first = batch.groupBy(*KEY).agg(F.min("_seq").alias("_first"))
    fresh = first.join(_versions(current, first), KEY, "left")
    outcome = batch.select(*KEY, "_seq").join(fresh, KEY).select(
        *KEY, "_seq", F.when(F.col("_stored").isNull() & (F.col("_seq") == F.col("_first")), F.lit(1))
        .cast("long").alias("_new"))
    return _assemble(current, batch, [c for c in batch.columns if c not in ("_seq", "_version")], outcome)


def save(current: DataFrame, batch: DataFrame) -> WriteResult:
    """Update under optimistic locking; a null version creates."""
    return write(current, batch)


def overwritten(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Final rows of a batch of overwrites.

    Every action succeeds, so an id's version grows by its number of actions and
    its last action is what stays: one partial aggregation.
    """
    _reject_partial(batch)
    body = [c for c in batch.columns if c not in (*KEY, "_seq", "_version")]
    last = batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"),
                                   F.max_by(F.struct(*body), "_seq").alias("r"))
    return last.join(_versions(current, last), KEY, "left").select(
        *KEY, (F.coalesce("_stored", F.lit(0)) + F.col("_n")).cast("long").alias("_version"), "r.*")


def overwrite(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Write whatever is stored; the new snapshot."""
    rows = overwritten(current, batch)
    return current.join(rows.select(*KEY), KEY, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete(current: DataFrame, batch: DataFrame, ignore_missing: bool = False) -> WriteResult:
    """Remove by id. Null or 0 skips the version check; the version is bumped.

    A missing document is an error, or ignored (``try_delete``).
    """
    asked = batch.select(*KEY, "_seq", F.coalesce("_version", F.lit(0)).alias("_wanted"))
    narrow = asked.join(_versions(current, asked), KEY, "left")
    fits = F.col("_stored").isNotNull() & (F.col("_wanted").isin(0) | (F.col("_wanted") == F.col("_stored")))
    winner = narrow.filter(fits).groupBy(*KEY).agg(F.min("_seq").alias("_won"))
    seen = narrow.join(winner, KEY, "left")
    gone = F.col("_stored").isNull() | (F.col("_seq") > F.coalesce("_won", F.lit(2**62)))
    success = seen.filter(F.col("_seq") == F.col("_won")).select(
        *KEY, (F.col("_stored") + 1).alias("_version"), "_seq")
    missing = seen.filter(gone).select(*KEY, "_seq", F.lit("missing").alias("error"))
    if ignore_missing:
        missing = missing.filter(F.lit(False))
    stale = seen.filter(~gone & ((F.col("_seq") != F.col("_won")) | F.col("_won").isNull()))
    # the few rows that failed are looked up; the collection is not packed or shuffled for them
    stored = current.join(stale.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, F.struct(*current.columns).alias("current"))
    conflicts = stale.select(*KEY, "_seq", F.struct("_type", "_id", F.col("_wanted").alias("_version")).alias("attempted"),
                             F.lit("version conflict").alias("error")).join(stored, KEY, "left")
    return WriteResult(current.join(winner.select(*KEY), KEY, "left_anti"), success, conflicts, missing)


def resolve(result: WriteResult, resolver: Callable[[DataFrame], DataFrame]) -> WriteResult:
    """Apply a caller's resolution: it turns conflicts into a new batch."""
    return write(result.snapshot, materialise(resolver(result.conflicts), "resolved"))


# --- change detection -------------------------------------------------------

def _text(c: Column, nested: bool) -> Column:
    return F.to_json(c) if nested else c.cast("string")


def diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Changed attributes with their old values: ``(key, old_values map)``.

    Nested values compare deeply and show as JSON; an attribute without an old
    value maps to null. Rows without a change are left out.
    """
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]
    nested = {f.name for d in (old, new) for f in d.schema.fields
              if f.dataType.typeName() in ("struct", "array", "map")}
    o = old.select(*key, F.struct(*[c for c in columns if c in old.columns]).alias("o"))
    n = new.select(*key, F.struct(*[c for c in columns if c in new.columns]).alias("n"))

    def side(name: str, df: DataFrame, c: str) -> Column:
        return _text(F.col(f"{name}.{c}"), c in nested) if c in df.columns else F.lit(None).cast("string")

    entries = F.array(*[F.struct(F.lit(c).alias("key"), side("o", old, c).alias("value"),
                                 (~side("o", old, c).eqNullSafe(side("n", new, c))).alias("changed"))
                        for c in columns])
    changed = F.filter(entries, lambda e: e["changed"])
    return (o.join(n, key).select(*key, changed.alias("c")).filter("size(c) > 0")
            .select(*key, F.map_from_entries(F.transform("c", lambda e: F.struct(e["key"], e["value"]))).alias("old_values")))


def has_been_deleted(rows: DataFrame, store: DataFrame) -> DataFrame:
    return rows.join(store.select(*KEY), KEY, "left_anti")


# --- unique constraints -----------------------------------------------------

@dataclass(frozen=True)
class UniqueResult:
    accepted: DataFrame
    rejected: DataFrame
    keys: DataFrame


def unique_keys(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``(_type, _id, _seq, key_name, value)``; null and empty values are exempt."""
    entries = F.array(*[F.struct(F.lit(n).alias("key_name"), c.cast("string").alias("value"))
                        for n, c in keys.items()])
    return (df.select(*KEY, "_seq", F.explode(entries).alias("k")).select(*KEY, "_seq", "k.*")
            .filter("value is not null and value <> ''"))


def enforce_unique(batch: DataFrame, keys: dict[str, Column], held: DataFrame | None = None) -> UniqueResult:
    """Unique constraints, greedy in ``_seq`` order: a row gets all its keys or none.

    ``held(key_name, value, _type, _id)`` are keys of stored documents. A row that
    updates its own document keeps unchanged keys, and frees changed ones for the
    rows after it. Each id occurs once in the batch.

    Every round accepts the rows that come first for all their keys and drops the
    rows that lost one. A round is a partial minimum per key, so a key shared by a
    third of all rows is settled at once. What is open after ``FIRST_ROUNDS`` is rows
    chained by several keys: components of up to ``COMPONENT_ROWS`` are settled whole, each
    in one pass by ``_seq``; larger ones go on by rounds until nothing is open.
    """
    waits = held is not None
    if held is None:
        held = batch.sparkSession.createDataFrame([], "key_name string, value string, _type string, _id string")
    pair = ["key_name", "value"]
    wanted = unique_keys(batch, keys)
    # own unchanged keys need no check
    changed = wanted.join(held, [*KEY, *pair], "left_anti")
    freed = (held.join(batch.select(*KEY, "_seq"), KEY)
             .join(wanted.select(*KEY, *pair), [*KEY, *pair], "left_anti")
             .select(*pair, F.col("_seq").alias("freed_by")))
    owners = held.select(*pair, F.lit(True).alias("is_held"))
    open_ = (changed.join(owners, pair, "left").join(freed, pair, "left").select(
        "_seq", *pair,
        F.when(F.col("freed_by") < F.col("_seq"), F.col("freed_by")).alias("wait_for"),
        (F.coalesce("is_held", F.lit(False)) & ~F.coalesce(F.col("freed_by") < F.col("_seq"), F.lit(False))).alias("lost")))
    open_ = materialise(open_, "unique-open")
    # rows with nothing to check are in; every round adds a folder, the plan stays one scan
    root = table_path(batch.sparkSession, "unique-decided")
    seq = batch.schema["_seq"].dataType.simpleString()
    batch.select("_seq").join(open_.select("_seq"), "_seq", "left_anti").withColumn("ok", F.lit(True)).write.parquet(f"{root}/round=0")

    def decided() -> DataFrame:
        return batch.sparkSession.read.schema(f"_seq {seq}, ok boolean, round int").parquet(root).drop("round")

    round_ = 0
    while not open_.isEmpty():
        round_ += 1
        known = decided().withColumnRenamed("_seq", "wait_for")
        told = open_.join(known, "wait_for", "left") if waits else open_.withColumn("ok", F.lit(None).cast("boolean"))
        new = _settle_components(open_, told, seq) if round_ == FIRST_ROUNDS + 1 else _settle_firsts(told)
        new.write.parquet(f"{root}/round={round_}")
        settled = batch.sparkSession.read.schema(f"_seq {seq}, ok boolean").parquet(f"{root}/round={round_}")
        open_ = materialise(open_.join(settled, "_seq", "left_anti"), "unique-open")
    accepted = decided().filter("ok").select("_seq")
    kept = batch.join(accepted, "_seq", "left_semi")
    dropped = batch.join(accepted, "_seq", "left_anti")
    won = wanted.join(accepted, "_seq", "left_semi")
    # a losing row reports each key held by an earlier winner or a stored document
    earlier = (won.groupBy(*pair).agg(F.min("_seq").alias("at")))
    frees = freed.join(accepted.select(F.col("_seq").alias("freed_by")), "freed_by", "left_semi")
    blocked = (changed.join(accepted, "_seq", "left_anti").join(earlier, pair, "left")
               .join(owners, pair, "left").join(frees, pair, "left")
               .filter((F.col("at") < F.col("_seq"))
                       | (F.col("is_held") & (F.col("freed_by").isNull() | (F.col("freed_by") > F.col("_seq"))))))
    failed = blocked.groupBy("_seq").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(*pair)))).alias("failed"))
    replaced = held.join(kept.select(*KEY), KEY, "left_anti")
    table = replaced.unionByName(won.select(*pair, *KEY))
    return UniqueResult(kept, dropped.join(failed, "_seq", "left"), table)


def _settle_firsts(told: DataFrame) -> DataFrame:
    """``(_seq, ok)`` of open rows that come first for all their keys or lose one."""
    first = told.groupBy("key_name", "value").agg(F.min("_seq").alias("first"))
    verdict = told.join(first, ["key_name", "value"])
    waiting = F.col("wait_for").isNotNull() & F.col("ok").isNull()
    lost = F.col("lost") | F.coalesce(~F.col("ok"), F.lit(False))
    settled = verdict.groupBy("_seq").agg(
        F.bool_or(lost).alias("lost"),
        F.bool_and((F.col("_seq") == F.col("first")) & ~waiting).alias("ready")).select(
        "_seq", "lost", (F.col("ready") & ~F.col("lost")).alias("win"))
    # a row whose key goes to a winner is out
    winners = settled.filter("win").select(F.col("_seq").alias("first"))
    robbed = (verdict.filter("first <> _seq").join(winners, "first", "left_semi")
              .select("_seq", F.lit(True).alias("lost"), F.lit(False).alias("win")))
    return settled.filter("win or lost").unionByName(robbed).groupBy("_seq").agg(F.bool_or("win").alias("ok"))


FIRST_ROUNDS = 4
COMPONENT_ROWS = 100_000  # rows (_seq, key) of a component that one task settles


def _settle_components(open_: DataFrame, told: DataFrame, seq: str) -> DataFrame:
    """``(_seq, ok)`` of all open rows in components of a bounded size.

    Rows are linked to the first row of each of their keys and to the open row that is to
    free one, so what a row depends on is in its component.
    """
    first = open_.groupBy("key_name", "value").agg(F.min("_seq").alias("b"))
    links = open_.join(first, ["key_name", "value"]).select(F.col("_seq").alias("a"), "b")
    frees = open_.filter("wait_for is not null").select(F.col("_seq").alias("a"), F.col("wait_for").alias("b"))
    frees = frees.join(open_.select(F.col("_seq").alias("b")), "b", "left_semi").select("a", "b")
    named = components(links.unionByName(frees)).withColumnRenamed("node", "_seq")
    sizes = open_.join(named, "_seq").groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    small = named.join(sizes.filter(F.col("n") <= COMPONENT_ROWS), "component").select("_seq", "component")
    # no nulls, so that numbers stay whole ones
    rows = told.join(small, "_seq").select(
        "component", "_seq", "key_name", "value", "lost", F.col("wait_for").isNotNull().alias("waits"),
        F.coalesce("wait_for", "_seq").alias("wait_for"), F.coalesce("ok", F.lit(False)).alias("ok"))
    return rows.groupBy("component").applyInPandas(_settle_in_order, f"_seq {seq}, ok boolean")


def _settle_in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Greedy by ``_seq`` inside one component; what a row waits for comes before it."""
    taken, out = set(), {}
    columns = ("_seq", "key_name", "value", "lost", "waits", "wait_for", "ok")
    wants = zip(*(rows.sort_values("_seq")[c].tolist() for c in columns))
    for seq, group in groupby(wants, key=lambda w: w[0]):
        pairs, ok = set(), True
        for _, name, value, lost, waits, wait_for, freed in group:
            pairs.add((name, value))
            ok = ok and not lost and (name, value) not in taken and (not waits or out.get(wait_for, freed))
        out[seq] = ok
        if ok:
            taken |= pairs
    return pd.DataFrame({"_seq": list(out), "ok": list(out.values())})


def write_unique(current: DataFrame, batch: DataFrame, keys: dict[str, Column], held: DataFrame) -> tuple[WriteResult, DataFrame]:
    """Write and unique keys as one: ``(result, key table)``. Each id occurs once in the batch.

    A row is stored if its version fits and it gets all its keys. A row with a version
    conflict claims no key and frees none; a row that loses a key is an error, its
    document and its old keys stay. Keys are taken and freed for the stored rows alone.
    """
    tried = write(current, batch)
    fitting = batch.join(tried.success.select("_seq"), "_seq", "left_semi")
    unique = enforce_unique(fitting, keys, held)
    stored = write(current, unique.accepted.select(*batch.columns))
    taken = F.concat(F.lit("unique keys taken: "), F.array_join(F.map_keys("failed"), ", "))
    lost = unique.rejected.select("_type", "_id", "_seq", taken.alias("error"))
    return replace(stored, conflicts=tried.conflicts, errors=tried.errors.unionByName(lost)), unique.keys


def release_keys(held: DataFrame, deleted: DataFrame) -> DataFrame:
    """Key table after documents were deleted."""
    return held.join(deleted.select(*KEY), KEY, "left_anti")
