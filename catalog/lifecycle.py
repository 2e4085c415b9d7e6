"""Reindexing and streaming loads."""

from pyspark.sql import functions as F

from catalog.base import TEXT, Tables, query
from corpusgrid.operators import lifecycle as X
from corpusgrid.operators.schema import uid_struct
from corpusgrid.operators.writes import KEY
from corpusgrid.session import table_path
from corpusgrid.sources.aliases import Aliases
from corpusgrid.sources.domain import as_documents, union_all
from corpusgrid.sources.snapshots import BucketStore
from corpusgrid.streaming import levels as L
from corpusgrid.streaming import upsert as N


def users(t: Tables, index: str, rest: list[int]):
    """Customers of one index: two thirds in ``one``, a third in ``two``."""
    k = F.col("c_custkey")
    return as_documents(t.customer.filter((k % 3).isin(rest)), index, "user", "c_custkey", version=1 + k % 4).drop("c_custkey")


def posts(t: Tables):
    """An order is a post that embeds its user."""
    k = F.col("o_custkey")
    user = F.struct(uid_struct(F.when(k % 3 < 2, "one").otherwise("two"), F.lit("user"), k).alias("uid"), F.col("o_orderstatus").alias("status"))
    return as_documents(t.orders.withColumn("user", user), "two", "post", "o_orderkey").drop("o_orderkey", "o_custkey")


def counts(df):
    return df.groupBy(F.col("user.uid.index").alias("ref")).agg(F.count(F.lit(1)).alias("n"))


@query("x01_reindex", """SELECT 'three' AS _index, CAST(c_custkey AS VARCHAR) AS _id, 1 + c_custkey % 4 AS _version, c_name FROM customer""")
def _(t):
    both = union_all([users(t, "one", [0, 1]), users(t, "two", [2])])
    return X.reindex(both, "three")[0].select("_index", "_id", "_version", "c_name")


@query("x01_reindex_published", """SELECT 'three' AS _index, CAST(c_custkey AS VARCHAR) AS _id, 1 + c_custkey % 4 AS _version, c_name, count(*) OVER () AS before FROM customer""")
def _(t):
    """Read through an alias, which names the destination once that is written and published."""
    path, aliases = table_path(t.spark, "collections"), Aliases(t.spark, table_path(t.spark, "aliases"))
    aliases.point("people", {name: BucketStore.create(users(t, name, rest), f"{path}/{name}", KEY) for name, rest in (("one", [0, 1]), ("two", [2]))})
    before = aliases.read("people").filter("_index <> 'three'").count()
    aliases.reindex("people", "three", f"{path}/three")
    return aliases.read("people").select("_index", "_id", "_version", "c_name", F.lit(before).alias("before"))


EXISTING = "(SELECT c_custkey AS id, 3 AS version, upper(c_name) AS name FROM customer WHERE c_custkey % 10 = 0)"


@query("x01_reindex_merge", f"""SELECT id, greatest(version, coalesce(v, version)) AS version, CASE WHEN v >= version THEN n ELSE name END AS name
    FROM (SELECT c_custkey AS id, 1 + c_custkey % 4 AS version, c_name AS name FROM customer) LEFT JOIN (SELECT id, version AS v, name AS n FROM {EXISTING}) USING (id)""")
def _(t):
    """A destination row stays when its version is not lower."""
    existing = as_documents(t.customer.filter("c_custkey % 10 = 0"), "three", "user", "c_custkey", version=F.lit(3)).drop("c_custkey").withColumn("c_name", F.upper("c_name"))
    source = union_all([users(t, "one", [0, 1]), users(t, "two", [2])])
    return X.reindex(source, "three", existing)[0].select(F.col("_id").cast("long").alias("id"), F.col("_version").alias("version"), F.col("c_name").alias("name"))


@query("x01_reindex_conflicts", """SELECT c_custkey AS id, 1 + c_custkey % 4 AS source_version FROM customer WHERE c_custkey % 10 = 0 AND 1 + c_custkey % 4 <= 3""")
def _(t):
    existing = as_documents(t.customer.filter("c_custkey % 10 = 0"), "three", "user", "c_custkey", version=F.lit(3)).drop("c_custkey")
    source = union_all([users(t, "one", [0, 1]), users(t, "two", [2])])
    return X.reindex(source, "three", existing)[2].select(F.col("_id").cast("long").alias("id"), "source_version")


@query("x02_repoint_internal", "SELECT CASE WHEN o_custkey % 3 < 2 THEN 'one' ELSE 'new' END AS ref, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    """Only references into the copied index move."""
    return counts(X.reindex(posts(t), "new")[0])


@query("x02_repoint_nested", """SELECT doc_id, lang, count(*) AS n FROM (SELECT doc_id, CASE WHEN w = 'the' THEN 'new' ELSE 'other' END AS lang FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '\\S+')) AS w FROM documents)) GROUP BY ALL""")
def _(t):
    """References in an array of objects, one per word."""
    words = F.transform(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0)), lambda w: F.struct(
        w.alias("word"), uid_struct(F.when(w == "the", "old").otherwise("other"), F.lit("word"), w).alias("uid")))
    moved = X.repoint_internal(t.docs.select("doc_id", words.alias("words")), ["old"], "new")
    refs = moved.select("doc_id", F.explode_outer("words.uid.index").alias("lang")).filter("lang is not null")
    return refs.groupBy("doc_id", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("x03_repoint_external", "SELECT CAST(o_orderkey AS VARCHAR) AS _id, CASE WHEN o_custkey % 3 < 2 THEN 'new' ELSE 'two' END AS ref, CASE WHEN o_custkey % 3 < 2 THEN 2 ELSE 1 END::BIGINT AS _version FROM orders")
def _(t):
    """Posts of another index follow their users; changed posts get a new version."""
    moved = X.reindex(users(t, "one", [0, 1]), "new")[1]
    out, _changed = X.repoint_external(posts(t), "user.uid", moved, "new")
    return out.select("_id", F.col("user.uid.index").alias("ref"), "_version")


@query("x03_repoint_external_changed", "SELECT count(*) AS n FROM orders WHERE o_custkey % 3 < 2")
def _(t):
    moved = X.reindex(users(t, "one", [0, 1]), "new")[1]
    return X.repoint_external(posts(t), "user.uid", moved, "new")[1].agg(F.count(F.lit(1)).alias("n"))


@query("x03_repoint_external_array", """SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN 'new' ELSE 'two' END AS a, CASE WHEN (p_partkey + 1) % 3 = 2 THEN 'two' WHEN q THEN 'new' ELSE 'one' END AS b,
    CASE WHEN p_partkey % 3 < 2 OR ((p_partkey + 1) % 3 < 2 AND q) THEN 2 ELSE 1 END::BIGINT AS _version
    FROM (SELECT p_partkey, p_partkey + 1 IN (SELECT p_partkey FROM part) AS q FROM part)""")
def _(t):
    """Two references per part, to itself and its successor, in an array."""
    def ref(k):
        return F.struct(uid_struct(F.when(k % 3 < 2, "one").otherwise("two"), F.lit("part"), k).alias("uid"), k.alias("n"))
    p = F.col("p_partkey")
    docs = as_documents(t.part.withColumn("links", F.array(ref(p), ref(p + 1))), "two", "part", "p_partkey")
    moved = t.part.filter(p % 3 < 2).select(F.lit("one").alias("index"), F.lit("part").alias("type"), p.cast("string").alias("id"))
    out = X.repoint_external_array(docs, "links", "uid", moved, "new")
    return out.select("p_partkey", F.col("links")[0]["uid"]["index"].alias("a"), F.col("links")[1]["uid"]["index"].alias("b"), "_version")


@query("x03_repoint_everywhere", """SELECT CAST(p_partkey AS VARCHAR) AS _id, CASE WHEN p_partkey % 3 < 2 THEN 'new' ELSE 'two' END AS own,
    CASE WHEN (p_partkey + 1) % 3 = 2 THEN 'two' WHEN q THEN 'new' ELSE 'one' END AS next, CASE WHEN p_partkey % 3 < 2 OR ((p_partkey + 1) % 3 < 2 AND q) THEN 2 ELSE 1 END::BIGINT AS _version
    FROM (SELECT p_partkey, p_partkey + 1 IN (SELECT p_partkey FROM part) AS q FROM part)""")
def _(t):
    """No path is named: one reference stands deep in an object, one in an array inside an array."""
    def ref(k):
        return uid_struct(F.when(k % 3 < 2, "one").otherwise("two"), F.lit("part"), k).alias("uid")
    p = F.col("p_partkey")
    deep = F.struct(F.struct(ref(p), F.lit(1).alias("n")).alias("inner"))
    lists = F.array(F.struct(F.array(F.struct(ref(p + 1))).alias("list")))
    docs = as_documents(t.part.withColumns({"deep": deep, "lists": lists}), "two", "part", "p_partkey")
    moved = t.part.filter(p % 3 < 2).select(F.lit("one").alias("index"), F.lit("part").alias("type"), p.cast("string").alias("id"))
    out, _changed = X.repoint_everywhere(docs, moved, "new")
    return out.select("_id", F.col("deep.inner.uid.index").alias("own"), F.col("lists")[0]["list"][0]["uid"]["index"].alias("next"), "_version")


@query("x05_transform", "SELECT epoch_us(min(ts)) + 1000000 AS low, epoch_us(max(ts)) + 1000000 AS high, count(*) AS n FROM events")
def _(t):
    """A transform shifts every time stamp by 1000 ms."""
    docs = as_documents(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "old", "event", "event_id")
    out = X.reindex(docs, "new", transform=lambda d: d.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND")))[0]
    return out.agg(F.unix_micros(F.min("ts")).alias("low"), F.unix_micros(F.max("ts")).alias("high"), F.count(F.lit(1)).alias("n"))


# --- streaming
def event_stream(t: Tables):
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.dir)


def event_batches(t: Tables):
    """The events as three files that arrive one after the other: three micro-batches."""
    path = table_path(t.spark, "arriving")
    last = t.events.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * 3 / (last + 1))
    for k in range(3):
        t.events.filter(part == k).coalesce(1).write.mode("append").parquet(path)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("n01_stream_upsert_batches", "SELECT CAST(user_id AS VARCHAR) AS _id, count(*) AS _version, arg_max(value, event_id) AS value, 3::BIGINT AS batches FROM events GROUP BY user_id")
def _(t):
    """Each micro-batch looks up what the earlier ones stored."""
    path = table_path(t.spark, "stream")
    actions = event_batches(t).select(F.lit("user").alias("_type"), F.col("user_id").cast("string").alias("_id"), F.lit(0).cast("long").alias("_version"),
                                      "value", F.col("event_id").alias("_seq"))
    N.stream_upsert(actions, path, f"{path}/checkpoint", "overwrite").awaitTermination()
    batches = t.spark.read.parquet(f"{path}/rows").agg(F.countDistinct("_batch")).first()[0]
    return N.read_upserted(t.spark, path).select("_id", "_version", "value", F.lit(batches).alias("batches"))


@query("n01_stream_levels", """SELECT CAST(user_id AS VARCHAR) AS _id, count(*) AS _version, arg_max(value, event_id) AS value, 3::BIGINT AS version
    FROM events GROUP BY user_id HAVING arg_max(event_id, event_id) % 7 <> 0""")
def _(t):
    """Every event overwrites its user's row, every seventh deletes it; folded into the buckets after the second batch."""
    path = table_path(t.spark, "levels")
    actions = event_batches(t).select(F.lit("user").alias("_type"), F.col("user_id").cast("string").alias("_id"), F.lit(0).cast("long").alias("_version"),
                                      "value", F.col("event_id").alias("_seq"), (F.col("event_id") % 7 == 0).alias("_deleted"))
    L.stream_levels(actions, path, f"{path}/checkpoint", "overwrite", compact_every=2).awaitTermination()
    base = BucketStore.open(t.spark, f"{path}/base").version
    return L.read_levels(t.spark, path).select("_id", "_version", "value", F.lit(base).cast("long").alias("version"))


@query("n01_stream_upsert", "SELECT CAST(user_id AS VARCHAR) AS _id, count(*) AS _version, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def _(t):
    """Every event overwrites its user's row; the stream runs until all is read."""
    path = table_path(t.spark, "stream")
    actions = event_stream(t).select(F.lit("user").alias("_type"), F.col("user_id").cast("string").alias("_id"), F.lit(0).cast("long").alias("_version"),
                                     "value", F.col("event_id").alias("_seq"))
    N.stream_upsert(actions, path, f"{path}/checkpoint", "overwrite").awaitTermination()
    return N.read_upserted(t.spark, path).select("_id", "_version", "value")


@query("n02_stream_filter", r"""SELECT event_id, array_to_string(regexp_extract_all(lower(event_type), '[a-z]+'), '|') AS tokens FROM events WHERE value > 5 AND event_type <> 'error'""")
def _(t):
    path = table_path(t.spark, "filtered")
    kept = N.stream_filter(event_stream(t), (F.col("value") > 5) & (F.col("event_type") != "error"), {"tokens": F.array_join(TEXT(F.col("event_type")), "|")})
    out = kept.select("event_id", "tokens").writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    out.start(f"{path}/rows").awaitTermination()
    return t.spark.read.parquet(f"{path}/rows")


