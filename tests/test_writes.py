import random

import pytest
from pyspark.sql import functions as F

from corpusgrid.operators import components as C
from corpusgrid.operators import lifecycle as X
from corpusgrid.operators import schema as S
from corpusgrid.operators import writes as W
from corpusgrid.operators.refs import resolve_refs
from corpusgrid.session import materialise
from corpusgrid.sources import domain as D
from corpusgrid.streaming import upsert as N

DOC = "_type string, _id string, _version long, name string"


def docs(spark, *rows):
    return spark.createDataFrame([("user", str(i), v, n) for i, v, n in rows], DOC)


def batch(spark, *rows):
    return spark.createDataFrame([("user", str(i), v, n, s) for s, (i, v, n) in enumerate(rows)], DOC + ", _seq long")


def state(df):
    return {r["_id"]: (r["_version"], r["name"]) for r in df.collect()}


def test_version_sequence(spark):
    """Create, update and overwrite twice in a row."""
    result = W.write(docs(spark), batch(spark, (1, None, "a"), (1, 1, "b"), (1, 0, "c"), (1, 0, "d")))
    assert state(result.snapshot) == {"1": (4, "d")}
    assert [r["_version"] for r in result.success.orderBy("_seq").collect()] == [1, 2, 3, 4]


def conflicting(spark):
    stored = docs(spark, (1, 2, "one"), (2, 2, "two"), (3, 1, "three"), (4, 1, "four"))
    return W.write(stored, batch(spark, (1, 1, "stale"), (2, 0, "forced"), (3, None, "exists"), (4, 0, "replaced")))


def test_conflict_outputs(spark):
    result = conflicting(spark)
    assert state(result.snapshot) == {"1": (2, "one"), "2": (3, "forced"), "3": (1, "three"), "4": (2, "replaced")}
    pairs = {r["_id"]: (r["attempted"]["name"], r["current"]["name"]) for r in result.conflicts.collect()}
    assert pairs == {"1": ("stale", "one"), "3": ("exists", "three")}


def test_conflict_handlers(spark):
    result = conflicting(spark)
    out = result.handle(on_conflict=lambda d: d, on_error=lambda d: d)
    assert out["conflict"].count() == 2 and out["error"].count() == 0
    assert result.handle(on_error=lambda d: d)["error"].count() == 2
    with pytest.raises(W.WriteFailed, match="2 uncaught"):
        result.handle()


def test_create_only_once(spark):
    result = W.create(docs(spark, (1, 1, "old")), batch(spark, (1, None, "x"), (2, None, "first"), (2, None, "second")))
    assert state(result.snapshot) == {"1": (1, "old"), "2": (1, "first")}
    assert result.conflicts.count() == 2


def test_overwrite_agrees_with_write(spark):
    stored = docs(spark, (1, 3, "old"), (9, 1, "kept"))
    b = batch(spark, (1, 0, "a"), (2, 0, "b"), (1, 0, "c"), (2, 0, "d"), (2, 0, "e"))
    assert state(W.overwrite(stored, b)) == state(W.write(stored, b).snapshot) == {"1": (5, "c"), "2": (3, "e"), "9": (1, "kept")}


def test_random_batches_against_a_loop(spark):
    rng = random.Random(4)
    stored = {str(i): (rng.randint(1, 3), "s") for i in range(8)}
    # half of all actions hit one id
    actions = [(0 if rng.random() < 0.5 else rng.randint(0, 12), rng.choice([None, 0, 1, 2, 3, 4]), f"n{s}") for s in range(120)]
    want, refused = dict(stored), 0
    for i, wanted, name in actions:
        version = want.get(str(i), (0, ""))[0]
        if (wanted is None and version == 0) or wanted == 0 or (wanted and wanted == version):
            want[str(i)] = (version + 1, name)
        else:
            refused += 1
    result = W.write(docs(spark, *[(int(i), v, n) for i, (v, n) in stored.items()]), batch(spark, *actions))
    assert state(result.snapshot) == want and result.conflicts.count() == refused


@pytest.mark.parametrize("seed", range(4))
def test_a_hot_id_spans_ranges(spark, seed):
    """Most actions hit one id, which fills several ranges; every outcome equals the loop's."""
    rng = random.Random(seed)
    stored = {"5": 2} if seed % 2 else {}
    actions = [("5" if rng.random() < 0.8 else str(rng.randint(0, 9)), rng.choice([None, 0, 0] if seed < 1 else [None, 0, *range(1, 60)])) for _ in range(600)]
    versions, want = dict(stored), {}
    for s, (i, wanted) in enumerate(actions):
        version = versions.get(i, 0)
        fits = version == 0 if wanted is None else wanted == 0 or (wanted == version and version > 0)
        want[s] = versions[i] = version + 1 if fits else version
        want[s] = want[s] if fits else None
    rows = spark.createDataFrame([("user", i, s, w, stored.get(i)) for s, (i, w) in enumerate(actions)],
                                 "_type string, _id string, _seq long, _wanted long, _stored long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = W._fold(rows)
        assert {r["_seq"]: r["_new"] for r in out.collect()} == want
        parts = rows.repartitionByRange("_type", "_id", "_seq").filter("_id = '5'").select(F.spark_partition_id()).distinct().count()
        assert parts > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_without_an_id_are_errors(spark):
    made = spark.createDataFrame([("user", None, None, "a", 0), (None, "1", 0, "b", 1), ("user", "2", -1, "c", 2), ("user", "3", None, "d", 3)],
                                 DOC + ", _seq long")
    result = W.write(docs(spark), made)
    assert state(result.snapshot) == {"3": (1, "d")} and {r["_seq"] for r in result.errors.collect()} == {0, 1, 2}


def test_delete(spark):
    stored = docs(spark, (1, 2, "a"), (2, 2, "b"), (3, 1, "c"))
    result = W.delete(stored, batch(spark, (1, 0, ""), (2, 1, ""), (3, 1, ""), (4, 0, ""), (1, 0, "")))
    assert state(result.snapshot) == {"2": (2, "b")}
    assert {r["_id"]: r["_version"] for r in result.success.collect()} == {"1": 3, "3": 2}
    assert [r["_id"] for r in result.conflicts.collect()] == ["2"]
    assert sorted(r["_id"] for r in result.errors.collect()) == ["1", "4"]
    assert W.delete(stored, batch(spark, (4, 0, "")), ignore_missing=True).errors.count() == 0


def test_partial_documents_are_refused(spark):
    partial = S.source_filter(batch(spark, (1, 0, "a")), ["name", "_seq"])
    with pytest.raises(ValueError, match="partial"):
        W.write(docs(spark), partial)


def test_diff_of_itself_is_empty(spark):
    d = docs(spark, (1, 1, "a"), (2, 1, None)).withColumn("deep", F.struct("name", F.array("_version").alias("v")))
    assert W.diff(d, d, ["_type", "_id"]).count() == 0


# --- unique keys
USER = "_type string, _id string, _seq long, email string, account string"


def keys():
    return {"key_email": F.col("email"), "key_account": F.col("account"),
            "key_both": F.when(F.col("account").isNotNull() & F.col("email").isNotNull(), F.concat_ws(":", "account", "email"))}


def users(spark, *rows):
    return spark.createDataFrame([("user", str(i), s, e, a) for s, (i, e, a) in enumerate(rows)], USER)


def test_unique_reports_only_failing_keys(spark):
    result = W.enforce_unique(users(spark, (1, "john@x.org", "facebook"), (2, "mary@x.org", "facebook")), keys())
    assert [r["_id"] for r in result.accepted.collect()] == ["1"]
    assert result.rejected.first()["failed"] == {"key_account": "facebook"}
    assert {r["value"] for r in result.keys.collect()} == {"john@x.org", "facebook", "facebook:john@x.org"}


def test_loser_does_not_block_others(spark):
    """The second row loses one key, so its other key stays free for the third."""
    result = W.enforce_unique(users(spark, (1, "a", None), (2, "a", "acc"), (3, "c", "acc")), keys())
    assert sorted(r["_id"] for r in result.accepted.collect()) == ["1", "3"]


def test_empty_values_are_exempt(spark):
    assert W.enforce_unique(users(spark, (1, None, ""), (2, "", None), (3, None, None)), keys()).accepted.count() == 3


def held(spark, *rows):
    return spark.createDataFrame([(n, v, "user", str(i)) for n, v, i in rows], "key_name string, value string, _type string, _id string")


def test_update_keeps_and_frees_keys(spark):
    """User 1 gives up its mail; user 2 may take it, user 0 came too early."""
    mine = held(spark, ("key_email", "old", 1), ("key_account", "fb", 1))
    result = W.enforce_unique(users(spark, (0, "old", None), (1, "new", "fb"), (2, "old", None)), keys(), mine)
    assert sorted(r["_id"] for r in result.accepted.collect()) == ["1", "2"]
    table = {(r["key_name"], r["value"]): r["_id"] for r in result.keys.collect()}
    assert table[("key_email", "old")] == "2" and table[("key_email", "new")] == "1" and table[("key_account", "fb")] == "1"


def test_keys_stay_when_the_holder_loses(spark):
    taken = held(spark, ("key_email", "old", 1), ("key_account", "x", 7))
    result = W.enforce_unique(users(spark, (1, "new", "x"), (2, "old", None)), keys(), taken)
    assert result.accepted.count() == 0
    assert {r["_id"]: r["failed"] for r in result.rejected.collect()} == {"1": {"key_account": "x"}, "2": {"key_email": "old"}}


def test_unique_against_a_loop(spark):
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < 0.3 else f"m{rng.randint(0, 25)}", rng.choice([None, f"a{rng.randint(0, 25)}"])) for i in range(80)]
    used, want = set(), []
    for i, e, a in rows:
        mine = {("e", e)} | ({("a", a), ("b", (a, e))} if a else set())
        if not mine & used:
            used |= mine
            want.append(str(i))
    got = W.enforce_unique(users(spark, *rows), keys()).accepted
    assert sorted(r["_id"] for r in got.collect()) == sorted(want)


def chain(n, first=0):
    """Each row shares a key with the one before and a key with the one after it."""
    return [(f"{first + i}", f"m{first}-{(i + 1) // 2}", f"a{first}-{i // 2}") for i in range(n)]


def two_keys():
    return {"key_email": F.col("email"), "key_account": F.col("account")}


def test_a_long_chain_takes_few_writes(spark, monkeypatch):
    written = []
    for module in (W, C):
        monkeypatch.setattr(module, "materialise", lambda df, name: written.append(name) or materialise(df, name))
    batch = users(spark, *chain(10_000))
    got = W.enforce_unique(batch, two_keys()).accepted
    assert sorted(int(r["_id"]) for r in got.select("_id").collect()) == list(range(0, 10_000, 2))
    assert len(written) < 80


def test_chains_by_components_and_by_rounds_agree(spark, monkeypatch):
    rng = random.Random(3)
    rows = [r for i, n in enumerate([30, 1, 13, 22]) for r in chain(n, 1000 * i)]
    rows += [(f"x{i}", f"m0-{rng.randint(0, 20)}", rng.choice([None, f"a1000-{i}", f"a2000-{rng.randint(0, 9)}"])) for i in range(30)]
    rng.shuffle(rows)
    used, want = set(), set()
    for i, e, a in rows:
        mine = {("e", e)} | ({("a", a)} if a else set())
        if not mine & used:
            used |= mine
            want.add(i)
    for bound in (100_000, 25, 0):
        monkeypatch.setattr(W, "COMPONENT_ROWS", bound)
        assert {r["_id"] for r in W.enforce_unique(users(spark, *rows), two_keys()).accepted.collect()} == want


def test_a_chain_of_freed_keys(spark, monkeypatch):
    """Each user takes the mail that the one before gives up; the first gets a new one or a taken one."""
    for first, kept in (("fresh", 12), ("taken", 0)):
        rows = [(i, first if i == 0 else f"m{i - 1}", None) for i in range(12)]
        mine = held(spark, *[("key_email", f"m{i}", i) for i in range(12)], ("key_email", "taken", 99))
        assert W.enforce_unique(users(spark, *rows), two_keys(), mine).accepted.count() == kept


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 2), (9, 9), (5, 7), (7, 6), (6, 5), (20, 3)] + [(i, i + 1) for i in range(100, 200)] + [(300, i) for i in range(301, 340)]
    rows = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    by = {r["node"]: r["component"] for r in rows}
    assert {n: c for n, c in by.items() if n < 100} == {1: 1, 2: 1, 3: 1, 20: 1, 9: 9, 5: 5, 6: 5, 7: 5}
    assert {by[i] for i in range(100, 201)} == {100} and {by[i] for i in range(300, 340)} == {300}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- lifecycle
def collection(spark, n=196):
    i = F.col("id")
    home = F.when(i % 3 < 2, "left").otherwise("right")
    base = spark.range(1, n + 1)
    people = base.select(home.alias("_index"), F.lit("user").alias("_type"), i.cast("string").alias("_id"), F.lit(1).cast("long").alias("_version"))
    uid = S.uid_struct(home, F.lit("user"), i)
    posts = base.select(F.lit("right").alias("_index"), F.lit("post").alias("_type"), (i + 199).cast("string").alias("_id"),
                        F.lit(1).cast("long").alias("_version"), F.struct(uid.alias("uid"), F.lit("n").alias("name")).alias("user"))
    return people, posts


def refs(df):
    return {r["r"]: r["n"] for r in df.groupBy(F.col("user.uid.index").alias("r")).agg(F.count("*").alias("n")).collect()}


def test_reindex_moves_references(spark):
    people, posts = collection(spark)
    both = people.unionByName(posts, allowMissingColumns=True)
    assert refs(X.reindex(both, "new")[0].filter("_type = 'post'")) == {"new": 196}
    right_only = refs(X.reindex(both.filter("_index = 'right'"), "new")[0].filter("_type = 'post'"))
    assert right_only == {"new": 65, "left": 131}
    moved = X.reindex(both.filter("_index = 'left'"), "new")[1]
    out, changed = X.repoint_external(posts, "user.uid", moved, "new")
    assert refs(out) == {"right": 65, "new": 131} and changed.count() == 131
    assert out.agg(F.sum("_version")).first()[0] == 196 + 131


def test_reindex_without_transform_is_identity(spark):
    people, _ = collection(spark, 20)
    rows = X.reindex(people, "new")[0]
    assert sorted(map(tuple, rows.drop("_index").collect())) == sorted(map(tuple, people.drop("_index").collect()))


def test_uid_paths(spark):
    df = collection(spark, 1)[1].withColumn("links", F.array(F.struct(F.col("user.uid").alias("uid"))))
    assert X.uid_paths(df.schema) == ["user.uid", "links.uid"]


def test_evolution(spark):
    old = spark.createDataFrame([(1, "a")], "id int, s string")
    new = spark.createDataFrame([(2, "b", 3.0)], "id int, s string, n double")
    assert sorted(map(tuple, S.append_evolving(old, new).collect())) == [(1, "a", None), (2, "b", 3.0)]
    with pytest.raises(ValueError, match="changed from"):
        S.append_evolving(old, spark.createDataFrame([("2",)], "id string"))


def test_strict_schema(spark):
    df = spark.createDataFrame([("1", "x")], "id string, extra string")
    declared = spark.createDataFrame([], "id int").schema
    with pytest.raises(ValueError, match="extra"):
        S.enforce_schema(df, declared)
    assert S.enforce_schema(df, declared, dynamic=False)[0].columns == ["id"]


def test_get_and_lost_references(spark):
    stored = docs(spark, (1, 1, "a"))
    asked = spark.createDataFrame([("user", "1"), ("user", "2")], "_type string, _id string")
    with pytest.raises(Exception, match="missing document user/2"):
        D.get(stored, asked, ["_type", "_id"]).collect()
    assert D.get(stored, asked, ["_type", "_id"], strict=False).filter("name is null").count() == 1
    with pytest.raises(Exception, match="deleted document: 2"):
        resolve_refs(asked, "_id", stored, "_id", strict=True).collect()


def test_alias_writes_and_shards(spark, tmp_path):
    target = D.AliasTarget(docs(spark, (1, 1, "a")))
    assert D.write_target({"one": target}) == "one"
    with pytest.raises(ValueError):
        D.write_target({"one": target, "two": target})
    rows = docs(spark, *[(i, 1, "n") for i in range(40)]).withColumn("_routing", F.when(F.col("_id").cast("int") < 30, "tenant"))
    D.write_index(rows, str(tmp_path / "ix"))
    back = D.read_index(spark, str(tmp_path / "ix"))
    assert back.count() == 40 and back.filter("_routing = 'tenant'").select("_shard").distinct().count() == 1
    assert D.routed(back, ["tenant"]).count() == 30


# --- streaming
def test_stream_upsert_is_idempotent(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = batch(spark).schema

    def feed(rows, name):
        batch(spark, *rows).write.parquet(f"{src}/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        N.stream_upsert(stream, out, f"{out}/checkpoint").awaitTermination()

    feed([(1, None, "a"), (2, None, "b")], "first")
    feed([(1, 1, "a2"), (2, 7, "stale"), (3, None, "c")], "second")
    assert state(N.read_upserted(spark, out)) == {"1": (2, "a2"), "2": (1, "b"), "3": (1, "c")}
    assert [r["_id"] for r in spark.read.parquet(f"{out}/conflicts").collect()] == ["2"]
    N.compact(spark, out, str(tmp_path / "compact"))
    assert state(spark.read.parquet(str(tmp_path / "compact"))) == state(N.read_upserted(spark, out))
    with pytest.raises(ValueError):
        N.stream_upsert(None, out, out, mode="other")


def test_unique_keys_follow_the_write(spark):
    """A stale row frees nothing, a row that loses a key changes nothing."""
    stored = docs(spark, (1, 1, "a"), (2, 2, "b"), (3, 1, "c"))
    held = spark.createDataFrame([("name", n, "user", i) for i, n in (("1", "a"), ("2", "b"), ("3", "c"))],
                                 "key_name string, value string, _type string, _id string")
    rows = batch(spark, (2, 1, "x"), (1, 1, "b"), (3, 1, "d"), (4, None, "c"), (5, None, "d"))
    result, keys = W.write_unique(stored, rows, {"name": F.col("name")}, held)
    assert state(result.snapshot) == {"1": (1, "a"), "2": (2, "b"), "3": (2, "d"), "4": (1, "c")}
    assert {r["_id"] for r in result.conflicts.collect()} == {"2"}
    assert {r["_id"]: r["error"] for r in result.errors.collect()} == dict.fromkeys(("1", "5"), "unique keys taken: name")
    assert {(r["_id"], r["value"]) for r in keys.collect()} == {("1", "a"), ("2", "b"), ("3", "d"), ("4", "c")}
