"""G01-G11."""

from pyspark.sql import functions as F

from catalog.base import leaf_sql, postings_sql, query, segment
from corpusgrid.operators import aggs as G
from corpusgrid.operators import queries as Q
from corpusgrid.plans.search import View

POST = postings_sql()


@query("g01_terms", "SELECT event_type AS term, count(*) AS count FROM events GROUP BY event_type ORDER BY count DESC, term LIMIT 10")
def _(t):
    return G.terms(t.events, "event_type")


@query("g01_terms_many", "SELECT term, count(*) AS count FROM (SELECT unnest([p_brand, p_type]) AS term FROM part) GROUP BY term ORDER BY count DESC, term LIMIT 12")
def _(t):
    return G.terms(t.parts(), "tags", 12, many=True)


@query("g01_terms_facet", """WITH s AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS s FROM customer),
    c AS (SELECT s, count(*) AS n FROM s WHERE s IS NOT NULL GROUP BY s ORDER BY n DESC, s LIMIT 3)
    SELECT (SELECT count(s) FROM s) AS total, (SELECT count(*) FROM s WHERE s IS NULL) AS missing,
    ((SELECT count(s) FROM s) - (SELECT sum(n) FROM c))::BIGINT AS other, (SELECT string_agg(s || ':' || n, '|' ORDER BY n DESC, s) FROM c) AS terms""")
def _(t):
    out = G.terms_facet(t.customer.select(segment().alias("s")), "s", 3)
    return out.select("total", "missing", "other", F.array_join(F.transform(
        "terms", lambda x: F.concat(x["term"], F.lit(":"), x["count"].cast("string"))), "|").alias("terms"))


@query("g02_filter_bucket", "SELECT count(*) AS doc_count, round(sum(l_quantity), 2) AS quantity FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    return G.filter_bucket(t.lineitem, F.col("l_returnflag") == "R", quantity=F.round(F.sum("l_quantity"), 2))


@query("g03_nested_aggs", """SELECT c_mktsegment AS segment, o_orderstatus AS status, (1 + (GROUPING(o_orderstatus) = 0)::INT)::INT AS level,
    count(*) AS doc_count, round(avg(o_totalprice), 2) AS price FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY GROUPING SETS ((c_mktsegment), (c_mktsegment, o_orderstatus))""")
def _(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"), "o_totalprice")
    return G.nested_buckets(rows, ["segment", "status"], price=F.round(F.avg("o_totalprice"), 2))


@query("g03_bucket_tree", """WITH f AS (SELECT o_orderpriority AS p, date_trunc('year', o_orderdate) AS y, o_totalprice AS v FROM orders WHERE o_totalprice > 100000),
    t AS (SELECT p, count(*) AS n FROM f GROUP BY p ORDER BY n DESC, p LIMIT 3),
    y AS (SELECT p, y, count(*) AS n, avg(v) AS price FROM f WHERE p IN (SELECT p FROM t) GROUP BY p, y QUALIFY row_number() OVER (PARTITION BY p ORDER BY n DESC, y) <= 2)
    SELECT 'large=true' AS path, count(*) AS doc_count, round(max(v), 2) AS price FROM f
    UNION ALL SELECT 'large=true/priority=' || p, n, NULL FROM t
    UNION ALL SELECT 'large=true/priority=' || p || '/year=' || strftime(y, '%Y-%m-%d %H:%M:%S'), n, round(price, 2) FROM y
    UNION ALL SELECT 'status=' || o_orderstatus, count(*), NULL FROM orders GROUP BY o_orderstatus""")
def _(t):
    """Terms of size 3 inside a filter, and years of size 2 inside those; beside them plain terms."""
    spec = {"large": {"filter": F.col("o_totalprice") > 100000, "metrics": {"price": F.max("o_totalprice")}, "aggs": {
                "priority": {"terms": "o_orderpriority", "size": 3, "aggs": {
                    "year": {"date_histogram": "o_orderdate", "interval": "year", "size": 2, "metrics": {"price": F.avg("o_totalprice")}}}}}},
            "status": {"terms": "o_orderstatus"}}
    return G.bucket_tree(t.orders, spec).select(F.array_join("path", "/").alias("path"), "doc_count",
                                                F.round(F.try_element_at("metrics", F.lit("price")), 2).alias("price"))


STATS = """count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean,
    round(sum(o_totalprice * o_totalprice) / 1e6, 2) AS sum_of_squares, round(var_pop(o_totalprice) / 1e6, 4) AS variance, round(stddev_pop(o_totalprice), 4) AS std_deviation"""


def rounded(df):
    return df.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 4), "sum_of_squares": F.round(F.col("sum_of_squares") / 1e6, 2),
                           "variance": F.round(F.col("variance") / 1e6, 4), "std_deviation": F.round("std_deviation", 4)})


@query("g04_statistical", f"SELECT {STATS} FROM orders")
def _(t):
    return rounded(G.statistical(t.orders, "o_totalprice"))


@query("g04_statistical_by", f"SELECT o_orderpriority, {STATS} FROM orders GROUP BY o_orderpriority")
def _(t):
    return rounded(G.statistical(t.orders, "o_totalprice", ["o_orderpriority"]))


@query("g05_avg", "SELECT p_brand, round(avg(p_retailprice), 4) AS avg FROM part GROUP BY p_brand")
def _(t):
    return G.avg(t.part, "p_retailprice", ["p_brand"]).withColumn("avg", F.round("avg", 4))


@query("g06_date_histogram", """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS bucket, count(*) AS count, round(sum(o_totalprice), 2) AS revenue
    FROM orders GROUP BY 1""")
def _(t):
    out = G.date_histogram(t.orders, "o_orderdate", "month", revenue=F.round(F.sum("o_totalprice"), 2))
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


@query("g06_date_histogram_day", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS bucket, count(*) AS count FROM events GROUP BY 1")
def _(t):
    return G.date_histogram(t.events, "ts", "day").withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


@query("g07_query_facet", f"WITH {POST} SELECT count(DISTINCT doc_id) AS count FROM post WHERE term IN ('hand', 'attion')")
def _(t):
    return G.query_facet(Q.match(t.text_index(), "text", "hand attion").scores())


@query("g08_filter_facet", """SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_totalprice > 300000) AS dear,
    count(*) FILTER (o_orderpriority LIKE '1%') AS urgent FROM orders""")
def _(t):
    return G.filter_facets(t.orders, f=F.col("o_orderstatus") == "F", dear=F.col("o_totalprice") > 300000, urgent=F.col("o_orderpriority").startswith("1"))


@query("g09_facet_filter", """SELECT event_type AS term, count(*) AS count FROM events WHERE value > 10 GROUP BY 1 ORDER BY count DESC, term LIMIT 3""")
def _(t):
    return G.terms(t.events, "event_type", 3, facet_filter=F.col("value") > 10)


@query("g10_many_aggs", """SELECT l_returnflag, count(*) AS n, round(avg(l_discount), 4) AS discount, round(max(l_extendedprice), 2) AS top, count(*) FILTER (l_quantity > 40) AS bulk
    FROM lineitem GROUP BY l_returnflag""")
def _(t):
    aggs = (G.Aggs(n=F.count(F.lit(1)), discount=F.round(F.avg("l_discount"), 4), tax=F.avg("l_tax"))
            .add("top", F.round(F.max("l_extendedprice"), 2)).add("bulk", F.count_if(F.col("l_quantity") > 40)).remove("tax"))
    return aggs.run(t.lineitem, ["l_returnflag"])


@query("g11_aggs_only", f"""WITH {POST}, {leaf_sql(1, ['hand'])} SELECT count(*) AS n, round(avg(n_chars), 4) AS chars FROM documents JOIN c1 USING (doc_id) WHERE lang = 'en'""")
def _(t):
    i = t.text_index()
    view = View(i.docs, "doc_id").matching(Q.match(i, "text", "hand")).where(F.col("lang") == "en")
    return view.aggs(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("chars"))


