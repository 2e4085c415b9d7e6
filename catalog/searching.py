"""Reading and search requests."""

from pyspark.sql import functions as F

from catalog.base import Tables, leaf_sql, norm_sql, postings_sql, query
from catalog.filters import PEOPLE_SQL
from corpusgrid.functions import filters as flt
from corpusgrid.functions import geo
from corpusgrid.operators import highlight as H
from corpusgrid.operators import queries as Q
from corpusgrid.operators.index import term_vector
from corpusgrid.plans.search import View, combine, search
from corpusgrid.session import table_path
from corpusgrid.sources import domain as D

POST = postings_sql()
HITS = f"WITH {POST}, {leaf_sql(1, ['the', 'hand'])}, hits AS (SELECT documents.*, round(s * {norm_sql(1)}, 6) AS score FROM c1 JOIN documents USING (doc_id))"


def the(t: Tables) -> View:
    i = t.text_index()
    return View(i.docs, "doc_id").matching(Q.match(i, "text", "the hand"))


def hit(name: str, sql: str, make) -> None:
    @query(name, f"{HITS} {sql}")
    def _(t: Tables):
        return make(the(t))


def scored(df):
    return df.select("doc_id", F.col("_score").alias("score"))


# --- sources
def people_index(t: Tables) -> dict:
    return {"customers": t.customers(), "suppliers": D.as_documents(t.supplier, "suppliers", "supplier", "s_suppkey", F.col("s_nationkey"))}


@query("s01_read_domain", f"SELECT _index, _type, _id, name FROM {PEOPLE_SQL}")
def _(t):
    return D.read_domain(people_index(t)).select("_index", "_type", "_id", F.coalesce("c_name", "s_name").alias("name"))


@query("s01_read_domain_type", f"SELECT _id, name FROM {PEOPLE_SQL} WHERE _type = 'supplier'")
def _(t):
    return D.read_domain(people_index(t), types=["supplier"]).select("_id", F.col("s_name").alias("name"))


@query("s02_scan", "SELECT o_orderkey, 0.0::DOUBLE AS score FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return View(t.orders, "o_orderkey").where(F.col("o_orderstatus") == "F").scan().select("o_orderkey", F.col("_score").alias("score"))


@query("s03_scroll", """SELECT o_orderkey, rank, (rank - 1) // 1000 AS tranche FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)""")
def _(t):
    return View(t.orders, "o_orderkey").sort("-o_totalprice").scroll(1000).select("o_orderkey", "rank", "tranche")


ASKED = "(SELECT DISTINCT l_partkey + 500 AS k FROM lineitem)"


@query("s04_get", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(t):
    asked = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return D.get(t.part, asked, ["p_partkey"]).select("l_orderkey", "l_linenumber", "p_name")


@query("s04_try_get", f"SELECT k AS p_partkey, p_name FROM {ASKED} LEFT JOIN part ON k = p_partkey")
def _(t):
    asked = t.lineitem.select((F.col("l_partkey") + 500).alias("p_partkey")).distinct()
    return D.get(t.part, asked, ["p_partkey"], strict=False).select("p_partkey", "p_name")


@query("s05_exists", f"SELECT k AS p_partkey, k IN (SELECT p_partkey FROM part) AS \"exists\" FROM {ASKED}")
def _(t):
    asked = t.lineitem.select((F.col("l_partkey") + 500).alias("p_partkey")).distinct()
    return D.exists(t.part, asked, ["p_partkey"])


@query("s07_write_index", "SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name, CAST(c_nationkey AS VARCHAR) AS _routing FROM customer")
def _(t):
    """Written in shards by routing and read back."""
    path = table_path(t.spark, "customers")
    D.write_index(t.customers(), path)
    return D.read_index(t.spark, path).select("_id", "c_name", "_routing")


# --- requests
EN = " WHERE lang = 'en'"


@query("r01_search", f"{HITS} SELECT doc_id, score FROM hits {EN} ORDER BY score DESC, doc_id LIMIT 10")
def _(t):
    return scored(search(the(t).where(F.col("lang") == "en"))["hits"])


@query("r01_search_summary", f"{HITS} SELECT count(*) AS total, max(score) AS max_score FROM hits {EN}")
def _(t):
    return search(the(t).where(F.col("lang") == "en"))["summary"]


@query("r02_combine_filter_only", "SELECT doc_id, 1.0::DOUBLE AS score FROM documents WHERE lang = 'en'")
def _(t):
    return combine(t.docs, "doc_id", None, F.col("lang") == "en").scores().drop("qid")


@query("r02_combine_none", "SELECT doc_id, 1.0::DOUBLE AS score FROM documents")
def _(t):
    return combine(t.docs, "doc_id", None, None).scores().drop("qid")


@query("r02_combine_both", f"{HITS} SELECT doc_id, score FROM hits {EN}")
def _(t):
    i = t.text_index()
    return combine(i.docs, "doc_id", Q.match(i, "text", "the hand"), F.col("lang") == "en").scores().drop("qid")


hit("r03_page", "SELECT doc_id, score FROM hits ORDER BY score DESC, doc_id LIMIT 15 OFFSET 20", lambda v: scored(v.page(20, 15).hits()))


def stored_hit(name: str, sql: str, make) -> None:
    """Whole documents of a page, from a collection stored by key bucket."""
    @query(name, f"{HITS} SELECT doc_id, text, lang, source, n_chars, score FROM hits {sql}")
    def _(t: Tables):
        view = View.of_store(t.stored_docs()).matching(Q.match(t.text_index(), "text", "the hand"))
        return make(view).withColumnRenamed("_score", "score").select("doc_id", "text", "lang", "source", "n_chars", "score")


stored_hit("r01_search_stored", f"{EN} ORDER BY score DESC, doc_id LIMIT 10", lambda v: v.where(F.col("lang") == "en").hits())
stored_hit("r03_page_stored", "ORDER BY score DESC, doc_id LIMIT 15 OFFSET 20", lambda v: v.page(20, 15).hits())
stored_hit("r13_first_stored", "ORDER BY score DESC, doc_id LIMIT 1", lambda v: v.first())
hit("r04_sort", "SELECT doc_id, lang, n_chars FROM hits ORDER BY lang, n_chars DESC, doc_id LIMIT 40",
    lambda v: v.sort("lang", "-n_chars").page(0, 40).hits().select("doc_id", "lang", "n_chars"))
hit("r05_sort_script", "SELECT doc_id FROM hits ORDER BY n_chars % 97 DESC, doc_id LIMIT 25",
    lambda v: v.sort((F.col("n_chars") % 97).desc()).page(0, 25).hits().select("doc_id"))


@query("r05_sort_geo", """SELECT c_custkey FROM customer ORDER BY round(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians((c_custkey * 7) % 180 - 90 - 40.5) / 2), 2)
    + cos(radians((c_custkey * 7) % 180 - 90)) * cos(radians(40.5)) * pow(sin(radians((c_custkey * 13) % 360 - 180 + 3.25) / 2), 2)))), 1), c_custkey LIMIT 30""")
def _(t):
    nearest = F.round(geo.haversine(F.col("p"), 40.5, -3.25), 1).asc()
    return View(t.places(), "c_custkey").sort(nearest).page(0, 30).hits().select("c_custkey")


@query("r06_post_filter", f"{HITS} SELECT lang, count(*) AS n, (SELECT count(*) FROM hits {EN}) AS hits FROM hits GROUP BY lang")
def _(t):
    """Aggregations over all matches, hits only from the post filter."""
    v = the(t).post_filter(F.col("lang") == "en")
    return v.base().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("hits", v.total().scalar())


hit("r07_min_score", "SELECT doc_id, score FROM hits WHERE score >= 0.05", lambda v: scored(v.min_score(0.05).matches()))


@query("r08_index_boosts", f"{HITS} SELECT doc_id, round(score * CASE lang WHEN 'en' THEN 2 WHEN 'de' THEN 0.5::DOUBLE ELSE 1 END, 6) AS score FROM hits")
def _(t):
    i = t.text_index()
    v = View(i.docs.withColumn("_index", F.col("lang")), "doc_id").matching(Q.match(i, "text", "the hand"))
    return scored(v.index_boosts({"en": 2, "de": 0.5}).matches())


def marked_sql(token: str, test: str = "lower(word) IN ('hand', 'only')") -> str:
    """Whole texts with the words that pass a test tagged, cut at every token."""
    return rf"""WITH parts AS (SELECT doc_id, text, unnest(spans) AS span, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (
        SELECT doc_id, text, regexp_extract_all(text, '(?s)(.*?)({token})') AS spans, regexp_extract_all(text, '{token}') AS words FROM documents))
    SELECT doc_id, string_agg(CASE WHEN {test} THEN left(span, length(span) - length(word)) || '<em>' || word || '</em>' ELSE span END, '' ORDER BY pos)
        || substr(any_value(text), (sum(length(span)) + 1)::BIGINT) AS body
    FROM parts GROUP BY doc_id HAVING bool_or({test})"""


@query("r09_highlight", marked_sql(r"[\p{L}\p{N}]+"))
def _(t):
    """Whole-field highlights, also of words glued to others by a mark."""
    hits = t.docs.filter(F.col("text").rlike(r"(?i)hand|only"))
    out = H.highlight(hits, ["hand", "only"], {"text": {"number_of_fragments": 0}})
    return out.select("doc_id", F.try_element_at("highlight", F.lit("text"))[0].alias("body")).filter("body is not null")


@query("r09_highlight_offsets", marked_sql(r"[\p{L}\p{N}]+(?:[.''][\p{L}\p{N}]+)*"))
def _(t):
    """The same from stored token offsets."""
    places = (term_vector(t.docs, "doc_id", "text").filter(F.col("term").isin("hand", "only")).groupBy("doc_id")
              .agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    return t.docs.join(places, "doc_id").select("doc_id", H.wrap_offsets(F.col("text"), F.col("spans")).alias("body"))


@query("r09_highlight_query", marked_sql(r"[\p{L}\p{N}]+(?:[.''][\p{L}\p{N}]+)*", "lower(word) IN ('hand', 'only') OR lower(word) LIKE 'thaned%' OR levenshtein(regexp_replace(lower(word), '[^\\x00-\\x7f]', '#', 'g'), 'attion') <= 1")
       + " ORDER BY doc_id LIMIT 50")
def _(t):
    """Marks taken from the query: words, expansions of a prefix and of a fuzzy word."""
    i = t.text_index()
    asked = Q.bool_(should=[Q.match(i, "text", "HAND only"), Q.prefix(i, "text", "thaned"), Q.fuzzy(i, "text", "attion", 1)],
                    must_not=[Q.term(i, "text", "zzzzabsent")])
    out = View(i.docs, "doc_id").matching(asked).sort("doc_id").page(0, 50).highlight(None, {"text": {"number_of_fragments": 0}})
    return out.select("doc_id", F.col("highlight")["text"][0].alias("body"))


@query("r09_highlight_whitespace", marked_sql(r"\S+", "word IN ('hand', 'only', 'of')"))
def _(t):
    """A field cut at white space, with its own tokens and offsets."""
    i = t.words_index()
    out = View(i.docs, "doc_id").matching(Q.terms(i, "text", ["hand", "only", "of"])).page(0, 1 << 30).highlight(None, {"text": {"number_of_fragments": 0}})
    return out.select("doc_id", F.col("highlight")["text"][0].alias("body"))


@query("r09_highlight_phrase", rf"""WITH cut AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)(.*?)([\p{{L}}\p{{N}}]+(?:[.''][\p{{L}}\p{{N}}]+)*)') AS spans,
        regexp_extract_all(text, '[\p{{L}}\p{{N}}]+(?:[.''][\p{{L}}\p{{N}}]+)*') AS words FROM documents),
    parts AS (SELECT doc_id, text, unnest(spans) AS span, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM cut),
    near AS (SELECT *, lower(word) = 'the' AND lag(lower(word)) OVER w = 'of' AS last_, lower(word) = 'of' AND lead(lower(word)) OVER w = 'the' AS first_
        FROM parts WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
    SELECT doc_id, string_agg(CASE WHEN first_ OR last_ THEN left(span, length(span) - length(word)) || '<em>' || word || '</em>' ELSE span END, '' ORDER BY pos)
        || substr(any_value(text), (sum(length(span)) + 1)::BIGINT) AS body
    FROM near GROUP BY doc_id HAVING bool_or(first_)""")
def _(t):
    """Only the places where the words stand one after the other."""
    i = t.text_index()
    out = View(i.docs, "doc_id").matching(Q.match_phrase(i, "text", "of the")).page(0, 1 << 30).highlight(None, {"text": {"number_of_fragments": 0}})
    return out.select("doc_id", F.col("highlight")["text"][0].alias("body"))


@query("r09_highlight_fragments")
def _(t):
    i = t.text_index()
    v = View(i.docs, "doc_id").matching(Q.match(i, "text", "hand only")).page(0, 50)
    out = H.highlight(v.hits(), ["hand", "only"], {"text": None, "title": {"number_of_fragments": 0}},
                      {"pre_tag": "<b>", "post_tag": "</b>", "encoder": "html"})
    return out.select("doc_id", F.array_join(F.try_element_at("highlight", F.lit("text")), " ... ").alias("text"))


@query("r11_explain", f"""WITH {POST}, {leaf_sql(1, ['the'])}, {leaf_sql(2, ['hand'])}, {leaf_sql(3, ['the', 'hand'])},
    parts AS (SELECT doc_id, 'hand' AS name, s FROM c2 UNION ALL SELECT doc_id, 'the', s FROM c1),
    d AS (SELECT doc_id, name, round(s * {norm_sql(3)} * count(*) OVER (PARTITION BY doc_id) / 2, 6) AS v FROM parts),
    top AS (SELECT doc_id, round(s * {norm_sql(3)}, 6) AS score FROM c3 ORDER BY score DESC, doc_id LIMIT 10)
    SELECT top.doc_id, score, name, v AS value FROM top JOIN d USING (doc_id)""")
def _(t):
    i = t.text_index()
    out = the(t).explain_scores([(w, Q.term(i, "text", w)) for w in ("the", "hand")])
    return out.select("doc_id", F.col("explanation.value").alias("score"), F.explode("explanation.details").alias("d")).select(
        "doc_id", "score", F.col("d.description").alias("name"), F.col("d.value").alias("value"))


TREE = f"""WITH {POST}, {leaf_sql(1, ['the'])}, {leaf_sql(2, ['hand'])}, {leaf_sql(3, ['only'])},
    leaf AS (SELECT doc_id, 'text:the' AS name, s * {norm_sql(1, 2, 3)} AS v FROM c1 UNION ALL SELECT doc_id, 'text:hand', s * {norm_sql(1, 2, 3)} FROM c2
        UNION ALL SELECT doc_id, 'text:only', s * {norm_sql(1, 2, 3)} FROM c3),
    must AS (SELECT doc_id, sum(v) * count(*) / 2 AS v, count(*) / 2 AS coord FROM leaf
        WHERE name <> 'text:only' AND doc_id IN (SELECT doc_id FROM c1) GROUP BY doc_id),
    best AS (SELECT doc_id, max(v) + 0.3 * (sum(v) - max(v)) AS v FROM (SELECT doc_id, v FROM must
        UNION ALL SELECT doc_id, v FROM leaf WHERE name = 'text:only') GROUP BY doc_id),
    bad AS (SELECT DISTINCT doc_id FROM post WHERE term = 'more'),
    whole AS (SELECT doc_id, v * CASE WHEN doc_id IN (FROM bad) THEN 0.2 ELSE 1 END AS v FROM best),
    top AS (SELECT doc_id, round(v, 6) AS score FROM whole ORDER BY score DESC, doc_id LIMIT 10),
    terms AS (SELECT doc_id, 'text:' || p.term AS name, sqrt(tf) AS tf, idf * idf AS idf2, 1 / sqrt(field_len) AS field_norm
        FROM post p JOIN (FROM w1 UNION ALL FROM w2 UNION ALL FROM w3) w USING (term)),
    placed AS (SELECT doc_id, name, v, CASE name WHEN 'text:the' THEN '0.0.0' WHEN 'text:hand' THEN '0.0.1' ELSE '0.1' END AS path
        FROM leaf WHERE name <> 'text:hand' OR doc_id IN (SELECT doc_id FROM must)),
    nodes AS (SELECT doc_id, '' AS path, 'product of:' AS name, v FROM whole
        UNION ALL SELECT doc_id, '1', 'negative boost', 0.2 FROM bad
        UNION ALL SELECT doc_id, '0', 'max plus 0.3 times the others of:', v FROM best
        UNION ALL SELECT doc_id, '0.0', 'sum of:', v FROM must UNION ALL SELECT doc_id, '0.0.2', 'coord of 2', coord FROM must
        UNION ALL SELECT doc_id, path, name, v FROM placed
        UNION ALL SELECT doc_id, path || '.0', 'tf', tf FROM placed JOIN terms USING (doc_id, name)
        UNION ALL SELECT doc_id, path || '.1', 'idf squared', idf2 FROM placed JOIN terms USING (doc_id, name)
        UNION ALL SELECT doc_id, path || '.2', 'field norm', field_norm FROM placed JOIN terms USING (doc_id, name)
        UNION ALL SELECT doc_id, path || '.3', 'query norm', {norm_sql(1, 2, 3)} FROM placed)"""


@query("r11_explain_tree", f"{TREE} SELECT doc_id, score, path, name, round(v, 6) AS value FROM top JOIN nodes USING (doc_id)")
def _(t):
    """A bool in a dis_max in a boosting, told node by node."""
    i = t.text_index()
    the_, hand, only, more = (Q.term(i, "text", w) for w in ("the", "hand", "only", "more"))
    asked = Q.boosting(Q.dis_max([Q.bool_(must=[the_], should=[hand]), only], tie_breaker=0.3), more, 0.2)
    page = View(i.docs, "doc_id").matching(asked).explain()
    return page.select("doc_id", F.col("_score").alias("score"), F.explode("explanation").alias("n")).select(
        "doc_id", "score", F.array_join(F.col("n.path").cast("array<string>"), ".").alias("path"),
        F.col("n.description").alias("name"), F.round("n.value", 6).alias("value"))


hit("r12_track_scores", "SELECT doc_id, score FROM hits ORDER BY n_chars, doc_id LIMIT 20", lambda v: scored(v.sort("n_chars").track_scores().page(0, 20).hits()))
hit("r12_untracked_scores", "SELECT doc_id, NULL::DOUBLE AS score FROM hits ORDER BY n_chars, doc_id LIMIT 20", lambda v: scored(v.sort("n_chars").page(0, 20).hits()))
hit("r13_first", "SELECT doc_id, score FROM hits ORDER BY score DESC, doc_id LIMIT 1", lambda v: scored(v.first()))
hit("r14_total", "SELECT count(*) AS total FROM hits", lambda v: v.total())
hit("r17_max_score", "SELECT max(score) AS max_score FROM hits", lambda v: v.max_score())
hit("r19_slice", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM hits) WHERE r BETWEEN 17 AND 19",
    lambda v: v.page(0, 20).slice(-4, 3).select("doc_id"))
hit("r19_slice_to_the_end", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM hits) WHERE r BETWEEN 16 AND 20",
    lambda v: v.page(0, 20).slice(15).select("doc_id"))


@query("r15_routing", "SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 5)")
def _(t):
    """Reads only the shards of two routing values."""
    path = table_path(t.spark, "routed")
    D.write_index(t.customers(), path)
    return D.routed(D.read_index(t.spark, path), ["3", "5"]).select("c_custkey")


@query("r15_routing_view", "SELECT c_custkey, 1.0::DOUBLE AS score FROM customer WHERE c_nationkey IN (3, 5) AND c_acctbal > 0")
def _(t):
    v = View(t.customers(), "c_custkey").routing("3", "5").where(F.col("c_acctbal") > 0)
    return v.matches().select("c_custkey", F.col("_score").alias("score"))


@query("r16_metadata", """SELECT 'customers' AS _index, 'customer' AS _type, CAST(c_custkey AS VARCHAR) AS _id, 1 + c_custkey % 3 AS _version, CAST(c_nationkey AS VARCHAR) AS _routing
    FROM customer WHERE c_acctbal > 5000""")
def _(t):
    return View(t.customers(), "_id").where(F.col("c_acctbal") > 5000).matches().select("_index", "_type", "_id", "_version", "_routing")


@query("r18_delete_by_query", f"SELECT _id FROM {PEOPLE_SQL} WHERE NOT (balance < 1000)")
def _(t):
    docs = t.people().withColumn("balance", F.coalesce("c_acctbal", "s_acctbal")).withColumn("_key", F.concat("_type", F.lit("/"), "_id"))
    kept, _gone = View(docs, "_key").where(F.col("balance") < 1000).delete_by_query()
    return kept.select("_id")


@query("r18_delete_report", f"SELECT _index, count(*) AS deleted FROM {PEOPLE_SQL} WHERE balance < 1000 GROUP BY _index")
def _(t):
    docs = t.people().withColumn("balance", F.coalesce("c_acctbal", "s_acctbal")).withColumn("_key", F.concat("_type", F.lit("/"), "_id"))
    return View(docs, "_key").where(F.col("balance") < 1000).delete_by_query()[1]


# --- aliases
@query("x07_read_alias", """SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name AS name FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (1, 2)
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def _(t):
    idx = people_index(t)
    D.create_alias(t.spark, "rich_people", {
        "customers": D.AliasTarget(idx["customers"], flt.range_("c_acctbal", gt=0), ("1", "2")), "suppliers": D.AliasTarget(idx["suppliers"])})
    return t.spark.table("rich_people").select("_id", F.coalesce("c_name", "s_name").alias("name"))


@query("x09_time_based", "SELECT event_id, strftime(ts, '%Y_%m_%d') AS period FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-31'")
def _(t):
    """One index per day; an alias of two days reads two partitions."""
    path = table_path(t.spark, "events")
    D.write_periods(t.events, path, "ts", "day")
    days = t.spark.read.parquet(path).filter(F.col("_period").isin("2024_01_29", "2024_01_30"))
    return days.select("event_id", F.col("_period").alias("period"))


@query("x10_routed_alias", "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
def _(t):
    """A tenant's rows share a shard; the alias prunes to it."""
    path = table_path(t.spark, "orders")
    D.write_index(D.as_documents(t.orders, "orders", "order", "o_orderkey", F.col("o_orderpriority")), path)
    alias = D.read_alias({"orders": D.AliasTarget(D.read_index(t.spark, path), F.col("o_totalprice") > 200000, ("1-URGENT",))})
    return alias.select("o_orderkey")
