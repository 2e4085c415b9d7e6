"""Versioned writes of customers."""

from pyspark.sql import functions as F

from catalog.base import Tables, query
from corpusgrid.operators import writes as W
from corpusgrid.session import table_path
from corpusgrid.sources.snapshots import BucketStore

STORED = "(SELECT c_custkey AS id, 1 + c_custkey % 3 AS version, c_acctbal AS balance FROM customer)"


def stored(t: Tables):
    return t.customers().select("_type", "_id", "_version", F.col("c_acctbal").alias("balance"))


def doc(df, id_, version, balance, seq):
    return df.select(F.lit("customer").alias("_type"), id_.cast("string").alias("_id"), version.cast("long").alias("_version"),
                     balance.cast("double").alias("balance"), seq.cast("long").alias("_seq"))


def stale_batch(t: Tables):
    """Every fifth customer, with version 1 and a changed balance."""
    k = F.col("c_custkey")
    return doc(t.customer.filter(k % 5 == 0), k, F.lit(1), F.col("c_acctbal") + 100, k)


def order_batch(t: Tables, version):
    """An action per order on its customer, and on ids that do not exist yet."""
    o = F.col("o_orderkey")
    return doc(t.orders, F.when(o % 3 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")), version, F.col("o_totalprice"), o)


def rows(df):
    return df.select(F.col("_id").cast("long").alias("id"), F.col("_version").alias("version"), "balance")


ORDERS = "(SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS id, o_totalprice AS balance, o_orderkey AS seq FROM orders)"
NEW = f"(SELECT id, 1 AS version, arg_min(balance, seq) AS balance, min(seq) AS seq FROM {ORDERS} WHERE id NOT IN (SELECT id FROM {STORED}) GROUP BY id)"


@query("w01_create", f"SELECT id, version, balance FROM {STORED} UNION ALL SELECT id, version, balance FROM {NEW}")
def _(t):
    return rows(W.create(stored(t), order_batch(t, F.lit(None))).snapshot)


@query("w01_create_conflicts", f"SELECT id, o.seq FROM {ORDERS} o LEFT JOIN {NEW} n USING (id) WHERE n.seq IS NULL OR n.seq <> o.seq")
def _(t):
    failed = W.create(stored(t), order_batch(t, F.lit(None))).conflicts
    return failed.select(F.col("_id").cast("long").alias("id"), F.col("_seq").alias("seq"))


@query("w01_auto_id", "SELECT count(*) AS n, count(*) AS ids, 64 AS digits FROM orders")
def _(t):
    batch = order_batch(t, F.lit(None)).withColumn("_id", F.lit(None).cast("string"))
    return W.assign_ids(batch).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids"), F.min(F.length("_id")).alias("digits"))


@query("w02_save", f"SELECT id, CASE WHEN id % 5 = 0 AND version = 1 THEN 2 ELSE version END AS version, CASE WHEN id % 5 = 0 AND version = 1 THEN balance + 100 ELSE balance END AS balance FROM {STORED}")
def _(t):
    return rows(W.save(stored(t), stale_batch(t)).snapshot)


LAST = f"(SELECT id, count(*) AS n, arg_max(balance, seq) AS balance FROM {ORDERS} GROUP BY id)"


@query("w03_overwrite", f"""SELECT id, coalesce(s.version, 0) + coalesce(n, 0) AS version, coalesce(l.balance, s.balance) AS balance
    FROM {STORED} s FULL JOIN {LAST} l USING (id)""")
def _(t):
    return rows(W.overwrite(stored(t), order_batch(t, F.lit(0))))


@query("s06_bulk_write", f"""SELECT id, coalesce(s.version, 0) + coalesce(n, 0) AS version, coalesce(l.balance, s.balance) AS balance
    FROM {STORED} s FULL JOIN {LAST} l USING (id)""")
def _(t):
    """The general write path on the same actions, in batch order per id."""
    return rows(W.write(stored(t), order_batch(t, F.lit(0))).snapshot)


@query("s06_bulk_mixed", f"""WITH RECURSIVE a AS (SELECT id, balance, CASE seq % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END AS wanted,
        row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM {ORDERS}),
    r AS (SELECT s.id, s.version::BIGINT AS version, s.balance, 0::BIGINT AS n FROM (SELECT * FROM {STORED} UNION ALL SELECT DISTINCT id, 0, 0 FROM {NEW}) s
        UNION ALL SELECT r.id, CASE WHEN ok THEN r.version + 1 ELSE r.version END, CASE WHEN ok THEN a.balance ELSE r.balance END, a.n
        FROM r JOIN a ON a.id = r.id AND a.n = r.n + 1, LATERAL (SELECT CASE WHEN a.wanted IS NULL THEN r.version = 0 WHEN a.wanted = 0 THEN true
            ELSE r.version > 0 AND a.wanted = r.version END AS ok))
    SELECT id, version, balance FROM r WHERE version > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC) = 1""")
def _(t):
    """Creates, overwrites and updates of version 2 on the same ids, in order."""
    o = F.col("o_orderkey")
    wanted = F.when(o % 3 == 1, 0).when(o % 3 == 2, 2)
    return rows(W.write(stored(t), order_batch(t, wanted)).snapshot)


HOT = "(SELECT CASE WHEN o_orderkey % 3 = 0 THEN 5000000 ELSE o_orderkey END AS id, o_totalprice AS balance, o_orderkey AS seq, o_orderkey % 7 <> 0 AS plain FROM orders)"


@query("s06_bulk_hot", f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM {HOT}),
    w AS (SELECT * FROM a LEFT JOIN {STORED} s USING (id) WHERE plain OR (n = 1 AND s.version IS NULL))
    SELECT id, max(coalesce(version, 0)) + count(*) AS version, arg_max(w.balance, seq) AS balance FROM w GROUP BY id
    UNION ALL SELECT id, version, balance FROM {STORED} WHERE id NOT IN (SELECT id FROM w)""")
def _(t):
    """A third of all actions hit one id: overwrites, and creates that come too late."""
    o = F.col("o_orderkey")
    batch = doc(t.orders, F.when(o % 3 == 0, 5000000).otherwise(o), F.when(o % 7 != 0, 0), F.col("o_totalprice"), o)
    return rows(W.write(stored(t), batch).snapshot)


@query("w04_delete", f"SELECT id, version, balance FROM {STORED} WHERE NOT (id % 5 = 0 AND version = 1)")
def _(t):
    return rows(W.delete(stored(t), stale_batch(t)).snapshot)


@query("w04_delete_missing", f"""SELECT id, seq FROM {ORDERS} WHERE id NOT IN (SELECT id FROM {STORED})
    UNION ALL SELECT id, seq FROM {ORDERS} WHERE id IN (SELECT id FROM {STORED}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) > 1""")
def _(t):
    """Deletes of ids that were never there, or went with an earlier action."""
    errors = W.delete(stored(t), order_batch(t, F.lit(0))).errors
    return errors.select(F.col("_id").cast("long").alias("id"), F.col("_seq").alias("seq"))


@query("w04_try_delete", f"SELECT id, version, balance FROM {STORED} WHERE NOT (version = 2 AND id IN (SELECT id FROM {ORDERS}))")
def _(t):
    """Deletes of version 2; other versions stay, missing ids are ignored."""
    result = W.delete(stored(t), order_batch(t, F.lit(2)), ignore_missing=True)
    return rows(result.snapshot.join(result.errors, ["_type", "_id"], "left_anti"))


def in_buckets(t: Tables) -> BucketStore:
    return BucketStore.create(stored(t), table_path(t.spark, "customers"), W.KEY)


@query("w03_overwrite_stored", f"""SELECT id, coalesce(s.version, 0) + coalesce(n, 0) AS version, coalesce(l.balance, s.balance) AS balance
    FROM {STORED} s FULL JOIN {LAST} l USING (id)""")
def _(t):
    """In a collection by key bucket: the buckets of the batch are replaced, by one publication."""
    store, _ = in_buckets(t).update(order_batch(t, F.lit(0)), W.overwrite)
    return rows(store.read())


@query("w02_save_stored", f"SELECT id, CASE WHEN id % 5 = 0 AND version = 1 THEN 2 ELSE version END AS version, CASE WHEN id % 5 = 0 AND version = 1 THEN balance + 100 ELSE balance END AS balance FROM {STORED}")
def _(t):
    store, _ = in_buckets(t).update(stale_batch(t), W.save)
    return rows(BucketStore.open(t.spark, store.path).read())


@query("w04_delete_stored", f"SELECT id, version, balance FROM {STORED} WHERE NOT (id % 5 = 0 AND version = 1)")
def _(t):
    store, _ = in_buckets(t).update(stale_batch(t), W.delete)
    return rows(store.read())


@query("s04_get_stored", f"SELECT id, version, balance, seq FROM {STORED} JOIN (SELECT c_custkey AS id, c_custkey AS seq FROM customer WHERE c_custkey % 5 = 0) USING (id)")
def _(t):
    """Look-up of a table of keys by bucket and key."""
    found = in_buckets(t).find(stale_batch(t).select("_type", "_id", F.col("_seq").alias("seq")))
    return found.select(F.col("_id").cast("long").alias("id"), F.col("_version").alias("version"), "balance", "seq")


@query("w05_conflicts", f"SELECT id, balance + 100 AS attempted, balance AS current, version FROM {STORED} WHERE id % 5 = 0 AND version <> 1")
def _(t):
    c = W.save(stored(t), stale_batch(t)).conflicts
    return c.select(F.col("_id").cast("long").alias("id"), F.col("attempted.balance").alias("attempted"),
                    F.col("current.balance").alias("current"), F.col("current._version").alias("version"))


@query("w05_resolve", f"SELECT id, CASE WHEN id % 5 = 0 THEN version + 1 ELSE version END AS version, CASE WHEN id % 5 = 0 THEN balance + 100 ELSE balance END AS balance FROM {STORED}")
def _(t):
    """The caller takes its own values on top of the current version."""
    def mine(conflicts):
        return conflicts.select("_type", "_id", F.col("current._version").alias("_version"), "attempted.balance", "_seq")
    return rows(W.resolve(W.save(stored(t), stale_batch(t)), mine).snapshot)


@query("w06_outputs", f"""SELECT CASE WHEN version = 1 THEN 'success' ELSE 'conflict' END AS outcome, count(*) AS n FROM {STORED} WHERE id % 5 = 0 GROUP BY 1""")
def _(t):
    out = W.save(stored(t), stale_batch(t)).handle(
        on_success=lambda d: d.select(F.lit("success").alias("outcome")), on_conflict=lambda d: d.select(F.lit("conflict").alias("outcome")))
    return out["success"].unionByName(out["conflict"]).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# --- unique keys
def sign_ups(t: Tables):
    """Customers whose shortened names and segment-nation pairs clash."""
    k = F.col("c_custkey")
    return t.customer.select(
        F.lit("customer").alias("_type"), k.cast("string").alias("_id"), k.alias("_seq"),
        F.concat(F.lit("u"), (k % 700).cast("string")).alias("name"),
        F.when(k % 4 != 0, F.concat_ws(":", "c_mktsegment", (k % 311).cast("string"))).alias("account"))


def user_keys():
    return {"key_name": F.col("name"), "key_account": F.col("account")}


@query("w07_unique", """WITH RECURSIVE s AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) AS n, 'u' || c_custkey % 700 AS name,
        CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment || ':' || c_custkey % 311 END AS account FROM customer),
    k AS (SELECT *, CASE WHEN account IS NULL THEN [name] ELSE [name, account] END AS keys FROM s),
    r AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS used, false AS ok
        UNION ALL SELECT k.n, CASE WHEN list_has_any(r.used, k.keys) THEN r.used ELSE list_concat(r.used, k.keys) END, NOT list_has_any(r.used, k.keys)
        FROM r JOIN k ON k.n = r.n + 1)
    SELECT CAST(id AS VARCHAR) AS _id, name, account FROM r JOIN k USING (n) WHERE ok""")
def _(t):
    """Two keys per user, greedy in order."""
    return W.enforce_unique(sign_ups(t), user_keys()).accepted.select("_id", "name", "account")


@query("w07_unique_chain", """SELECT id FROM (SELECT c_custkey AS id, row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey) AS n FROM customer)
    WHERE n % 2 = 1""")
def _(t):
    """Every customer wants a key of the one before and a key of the one after, in chains of up to 1000."""
    chain, link = F.floor(F.col("c_custkey") / 1000), F.col("c_custkey") % 1000
    batch = t.customer.select(F.lit("user").alias("_type"), F.col("c_custkey").cast("string").alias("_id"), F.col("c_custkey").cast("long").alias("_seq"),
                              F.concat_ws("-", chain, F.floor((link + 1) / 2)).alias("name"), F.concat_ws("-", chain, F.floor(link / 2)).alias("account"))
    kept = W.enforce_unique(batch, {"key_name": F.col("name"), "key_account": F.col("account")}).accepted
    return kept.select(F.col("_seq").alias("id"))


@query("w07_unique_single_key", "SELECT min(c_custkey) AS id, 'u' || c_custkey % 700 AS name FROM customer GROUP BY 2")
def _(t):
    """With one key the greedy order keeps the first row of each value."""
    kept = W.enforce_unique(sign_ups(t), {"key_name": F.col("name")}).accepted
    return kept.select(F.col("_id").cast("long").alias("id"), "name")


@query("w07_unique_rejected", "SELECT c_custkey AS id, 'u' || c_custkey % 700 AS failed FROM customer WHERE c_custkey >= 700")
def _(t):
    lost = W.enforce_unique(sign_ups(t), {"key_name": F.col("name")}).rejected
    return lost.select(F.col("_id").cast("long").alias("id"), F.col("failed")["key_name"].alias("failed"))


def held_keys(t: Tables):
    """Each name is held by the lowest customer that wants it."""
    k = F.col("c_custkey")
    holders = t.customer.groupBy((k % 700).alias("name")).agg(F.min("c_custkey").alias("id"))
    return holders.select(F.lit("key_name").alias("key_name"), F.concat(F.lit("u"), F.col("name").cast("string")).alias("value"),
                          F.lit("customer").alias("_type"), F.col("id").cast("string").alias("_id"))


def renamed(t: Tables):
    """Holders in debt take another name, which frees theirs for the next customer."""
    k = F.col("c_custkey")
    debtors = t.customer.filter("c_acctbal < 2000").select(k.cast("string").alias("_id"), F.concat(F.lit("v"), k.cast("string")).alias("other"))
    first = held_keys(t).select("_id").join(debtors, "_id")
    return sign_ups(t).join(first, "_id", "left").withColumn("name", F.coalesce("other", "name")).drop("other")


@query("w08_unique_update", """WITH c AS (SELECT c_custkey AS id, c_custkey % 700 AS name, row_number() OVER (PARTITION BY c_custkey % 700 ORDER BY c_custkey) AS n,
        first_value(c_acctbal < 2000) OVER (PARTITION BY c_custkey % 700 ORDER BY c_custkey) AS moved FROM customer)
    SELECT 'u' || name AS value, id FROM c WHERE n = CASE WHEN moved THEN 2 ELSE 1 END UNION ALL SELECT 'v' || id, id FROM c WHERE n = 1 AND moved""")
def _(t):
    """The key table after holders kept or changed their names."""
    keys = W.enforce_unique(renamed(t), {"key_name": F.col("name")}, held_keys(t)).keys
    return keys.select("value", F.col("_id").cast("long").alias("id"))


@query("w08_release_keys", "SELECT 'u' || c_custkey % 700 AS value FROM customer GROUP BY c_custkey % 700 HAVING min(c_custkey) % 5 <> 0")
def _(t):
    gone = W.delete(stored(t), stale_batch(t).withColumn("_version", F.lit(0).cast("long"))).success
    return W.release_keys(held_keys(t), gone).select("value")


# --- change detection
@query("w09_touch", "SELECT c_custkey, '2024-05-06 07:08:09.123' AS stamp FROM customer")
def _(t):
    now = F.lit("2024-05-06 07:08:09.123456").cast("timestamp")
    return W.touch(t.customer, now).select("c_custkey", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("stamp"))


@query("w10_diff", """SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 4 = 0 THEN 'c_mktsegment=' || c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN 'c_nationkey=' || c_nationkey END)
    AS old FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0""")
def _(t):
    old = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", F.struct("c_name", F.array("c_acctbal").alias("b")).alias("deep"))
    k = F.col("c_custkey")
    new = old.withColumns({"c_nationkey": F.when(k % 3 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")),
                           "c_mktsegment": F.when(k % 4 != 0, F.col("c_mktsegment"))})
    out = W.diff(old, new, ["c_custkey"])
    pairs = F.transform(F.array_sort(F.map_entries("old_values")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("c_custkey", F.array_join(pairs, "|").alias("old"))


@query("w10_diff_added_nested", """SELECT c_custkey, c_custkey % 2 = 0 AS deep_changed, true AS added FROM customer""")
def _(t):
    old = t.customer.select("c_custkey", F.struct("c_name", F.array("c_acctbal").alias("b")).alias("deep"))
    k = F.col("c_custkey")
    new = old.select("c_custkey", F.when(k % 2 == 0, F.struct(F.col("deep.c_name"), F.array(F.col("deep.b")[0] + 1).alias("b"))).otherwise(F.col("deep")).alias("deep"),
                     F.lit("x").alias("extra"))
    out = W.diff(old, new, ["c_custkey"])
    keys = F.map_keys("old_values")
    return out.select("c_custkey", F.array_contains(keys, "deep").alias("deep_changed"),
                      (F.array_contains(keys, "extra") & F.col("old_values")["extra"].isNull()).alias("added"))


@query("w11_has_been_deleted", "SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0 AND c_custkey % 3 = 0")
def _(t):
    left = W.delete(stored(t), stale_batch(t)).snapshot
    return W.has_been_deleted(t.customers(), left).select("c_custkey")


@query("w07_write_unique", """WITH s AS (SELECT c_custkey AS id, 1 + c_custkey % 3 AS version FROM customer),
    b AS (SELECT id, CASE WHEN id % 2 = 0 THEN 'k' || (id + 1) ELSE 'new' || (id // 300) END AS key FROM s WHERE id % 5 = 0 AND version = 1),
    w AS (SELECT id, key FROM b WHERE CASE WHEN id % 2 = 0 THEN id + 1 NOT IN (SELECT id FROM s) ELSE true END QUALIFY row_number() OVER (PARTITION BY key ORDER BY id) = 1)
    SELECT s.id, version + (w.id IS NOT NULL)::INT AS version, coalesce(key, 'k' || s.id) AS key FROM s LEFT JOIN w ON w.id = s.id""")
def _(t):
    """Every fifth customer asks for a new key: some are stale, some ask for a held key, some for the same new one."""
    k = F.col("c_custkey")
    held = t.customer.select(F.lit("key").alias("key_name"), F.concat(F.lit("k"), k).alias("value"),
                             F.lit("customer").alias("_type"), k.cast("string").alias("_id"))
    batch = stale_batch(t)
    i = F.col("_id").cast("long")
    wanted = F.when(i % 2 == 0, F.concat(F.lit("k"), i + 1)).otherwise(F.concat(F.lit("new"), F.floor(i / 300)))
    result, keys = W.write_unique(stored(t), batch, {"key": wanted}, held)
    return result.snapshot.join(keys, ["_type", "_id"]).select(F.col("_id").cast("long").alias("id"), F.col("_version").alias("version"),
                                                              F.col("value").alias("key"))
