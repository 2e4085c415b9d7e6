"""A stream into buckets and deltas, with deletions and compactions; aliases that switch."""

import re

import pytest
from pyspark.sql import functions as F

from corpusgrid.sources.aliases import Aliases
from corpusgrid.sources.snapshots import BucketStore
from corpusgrid.streaming import levels as L

FIELDS = "_type string, _id string, _version long, name string, _seq long, _deleted boolean"


def batch(spark, *rows):
    return spark.createDataFrame([("user", i, v, n, k, gone) for k, (i, v, n, gone) in enumerate(rows)], FIELDS)


def start(spark, path):
    L.create_levels(spark, path, batch(spark, ("x", 0, "x", False)).drop("_seq").schema, 4)


def now(spark, path):
    return {r._id: (r._version, r.name) for r in L.read_levels(spark, path).collect()}


def test_four_batches_with_deletes_and_a_compaction_between(spark, tmp_path):
    path = f"{tmp_path}/c"
    start(spark, path)
    rows = [batch(spark, *[(str(i), 0, "a", False) for i in range(10)]), batch(spark, ("1", 0, "b", False), ("2", 0, "", True)),
            batch(spark, ("2", 0, "c", False), ("3", 0, "", True), ("3", 0, "d", False), ("4", 0, "", True)), batch(spark, ("5", 0, "", True), ("1", 0, "e", False))]
    want = {str(i): (1, "a") for i in range(10)}
    L.apply_batch(rows[0], 0, path, "overwrite")
    L.apply_batch(rows[1], 1, path, "overwrite")
    want["1"] = (2, "b")
    del want["2"]
    assert now(spark, path) == want
    before = BucketStore.open(spark, f"{path}/base")
    after = L.compact(spark, path)
    assert after.version == before.version + 1 and after.note == "1" and now(spark, path) == want
    assert after.read().filter(L.live()).count() == 9 and after.read().count() == 10 and L.deltas(after, path).count() == 0
    L.apply_batch(rows[1], 1, path, "overwrite")  # repeated after it was folded
    assert now(spark, path) == want
    for _ in range(2):  # the same batch twice
        L.apply_batch(rows[2], 2, path, "overwrite")
    want |= {"2": (3, "c"), "3": (3, "d")}
    del want["4"]
    assert now(spark, path) == want
    L.apply_batch(rows[3], 3, path, "overwrite")
    want["1"] = (3, "e")
    del want["5"]
    assert now(spark, path) == want and L.compact(spark, path, purge=True).read().filter(L.live()).count() == len(want) and now(spark, path) == want


def test_create_after_a_deletion(spark, tmp_path):
    path = f"{tmp_path}/c"
    start(spark, path)
    L.apply_batch(batch(spark, ("1", None, "a", False), ("2", None, "a", False)), 0, path, "save")
    L.apply_batch(batch(spark, ("1", 1, "", True), ("2", 7, "", True)), 1, path, "save")
    assert now(spark, path) == {"2": (1, "a")}
    assert spark.read.parquet(f"{path}/conflicts").filter("_batch = 1").count() == 1
    L.apply_batch(batch(spark, ("1", None, "again", False)), 2, path, "save")
    assert now(spark, path) == {"1": (1, "again"), "2": (1, "a")}


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/c"
    start(spark, path)
    L.apply_batch(batch(spark, *[(str(i), 0, "a", False) for i in range(50)]), 0, path, "overwrite")
    base = L.compact(spark, path)
    L.apply_batch(batch(spark, *[(str(i), 0, "b", False) for i in range(50)]), 1, path, "overwrite")
    few = L.newest(base, path, [1])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert 0 < few.count() < 30 and re.search(r"PartitionFilters: \[[^]]*_bucket#\d+ (=|IN)", plan)


def test_an_alias_switches_whole(spark, tmp_path):
    docs = spark.range(30).select(F.lit("one").alias("_index"), F.lit("user").alias("_type"), F.col("id").cast("string").alias("_id"),
                                  F.lit(1).cast("long").alias("_version"), F.lit("old").alias("name"))
    aliases = Aliases(spark, f"{tmp_path}/aliases")
    with pytest.raises(ValueError):
        aliases.read("people")
    aliases.point("people", {"one": BucketStore.create(docs, f"{tmp_path}/one", ["_type", "_id"], 4)})
    before = aliases.read("people")
    with pytest.raises(ZeroDivisionError):
        aliases.reindex("people", "bad", f"{tmp_path}/bad", transform=lambda df: df.limit(1 // 0))
    assert {r._index for r in aliases.read("people").collect()} == {"one"}
    aliases.reindex("people", "two", f"{tmp_path}/two", transform=lambda df: df.withColumn("name", F.lit("new")))
    assert {(r._index, r.name) for r in aliases.read("people").collect()} == {("two", "new")} and aliases.read("people").count() == 30
    assert {(r._index, r.name) for r in before.collect()} == {("one", "old")}  # an open reader keeps its version
