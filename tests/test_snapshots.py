"""Collections in buckets: pruned pages, untouched files, versions, races."""

import glob
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusgrid.operators import queries as Q
from corpusgrid.operators import writes as W
from corpusgrid.operators.index import build_index
from corpusgrid.functions import analysis as A
from corpusgrid.plans.search import View
from corpusgrid.sources.snapshots import BucketStore, WriteRace


def people(spark, n, first=0, version=1):
    return spark.range(first, first + n).select(
        F.lit("user").alias("_type"), F.col("id").cast("string").alias("_id"), F.lit(version).cast("long").alias("_version"),
        F.concat(F.lit("name "), "id").alias("name"))


def batch(rows, version=0):
    return rows.withColumn("_version", F.lit(version).cast("long")).withColumn("name", F.lit("new")).withColumn("_seq", F.col("_id").cast("long"))


def files(store):
    found = defaultdict(set)
    for b, g in store.buckets.items():
        found[b] = set(glob.glob(f"{store.path}/rows/_generation={g}/_bucket={b}/*.parquet"))
    return found


def test_an_overwrite_of_one_percent_leaves_other_buckets_alone(spark, tmp_path):
    store = BucketStore.create(people(spark, 1000), f"{tmp_path}/c", W.KEY, 64)
    some = batch(people(spark, 10, 500))
    after, _ = store.update(some, W.overwrite)
    touched = set(store.touched(some))
    assert 0 < len(touched) <= 10
    before, now = files(store), files(after)
    assert {b for b in before if before[b] != now[b]} == touched and all(now.values())
    want = {str(i): (2, "new") if 500 <= i < 510 else (1, f"name {i}") for i in range(1000)}
    assert {r._id: (r._version, r.name) for r in after.read().collect()} == want


def test_a_write_reads_only_the_touched_buckets(spark, tmp_path):
    store = BucketStore.create(people(spark, 1000), f"{tmp_path}/c", W.KEY, 64)
    seen = []

    def change(current, rows):
        seen.append(current.count())
        return W.save(current, rows)

    store.update(batch(people(spark, 3)), change)
    assert seen[0] < 200


def test_versions_and_outputs(spark, tmp_path):
    path = f"{tmp_path}/c"
    first = BucketStore.create(people(spark, 20), path, W.KEY, 4)
    second, result = first.update(batch(people(spark, 30), 7), W.save)
    assert result.conflicts.count() == 30 and second.read().count() == 20
    third, result = second.update(batch(people(spark, 5)), W.delete)
    assert result.success.count() == 5 and third.read().count() == 15
    assert BucketStore.open(spark, path).version == 3 and BucketStore.open(spark, path, 1).read().count() == 20
    gone, _ = third.update(batch(people(spark, 20)), lambda current, rows: W.delete(current, rows, ignore_missing=True))
    assert gone.read().count() == 0 and gone.buckets == {}
    again, _ = gone.update(batch(people(spark, 2)), W.overwrite)
    assert sorted(r._id for r in again.read().collect()) == ["0", "1"]
    with pytest.raises(ValueError):
        BucketStore.open(spark, path, 99)


def test_of_two_writers_one_is_refused(spark, tmp_path):
    store = BucketStore.create(people(spark, 20), f"{tmp_path}/c", W.KEY, 4)
    lost = 0
    for name in ("a", "b"):
        rows = batch(people(spark, 4)).withColumn("name", F.lit(name))
        try:
            store.update(rows, W.overwrite)
        except WriteRace:
            lost += 1
    assert lost == 1 and BucketStore.open(spark, store.path).version == 2
    assert {r.name for r in BucketStore.open(spark, store.path).read().where("_version = 2").collect()} == {"a"}


def test_rows_outside_of_the_replaced_buckets_are_refused(spark, tmp_path):
    store = BucketStore.create(people(spark, 50), f"{tmp_path}/c", W.KEY, 8)
    with pytest.raises(ValueError):
        store.update(batch(people(spark, 1)), lambda current, rows: people(spark, 50))
    assert BucketStore.open(spark, store.path).version == 1


def test_a_page_prunes_buckets_while_it_runs(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 3, "red fox").otherwise("grey cat").alias("text"))
    index = build_index(docs, "doc_id", {"text": A.custom_analyzer("standard", filters=["lowercase"])})
    store = BucketStore.create(docs, f"{tmp_path}/docs", ["doc_id"], 32)
    view = View.of_store(store).matching(Q.match(index, "text", "fox")).page(0, 2)
    hits = view.hits()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert [(r.doc_id, r.text) for r in hits.collect()] == [(3, "red fox"), (103, "red fox")]
    scans = [r for r in hits._jdf.queryExecution().executedPlan().toString().splitlines() if "dynamicpruning" in r.lower()]
    assert scans and "_bucket" in scans[0]


def test_many_keys_are_shuffled_and_repeated_keys_kept(spark, tmp_path):
    store = BucketStore.create(people(spark, 100), f"{tmp_path}/c", W.KEY, 8)
    asked = people(spark, 200).select("_type", "_id").unionByName(people(spark, 1).select("_type", "_id"))
    found = store.find(asked.withColumn("n", F.lit(1)))
    assert found.count() == 101 and found.columns[-1] == "n"
    assert store.find(asked.limit(0), few=1).count() == 0


def test_empty_collection(spark, tmp_path):
    store = BucketStore.create(people(spark, 0), f"{tmp_path}/c", W.KEY, 8)
    assert store.read().count() == 0 and store.read().columns == ["_type", "_id", "_version", "name"]
    assert store.find(people(spark, 1).select("_type", "_id"), few=1).count() == 0
