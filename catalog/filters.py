"""F01-F28, J01-J07, U01-U02."""

from pyspark.sql import functions as F

from catalog.base import LINES_SQL, Tables, query, segment
from corpusgrid.functions import filters as f
from corpusgrid.operators.refs import semi_by_values

SEG_SQL = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"


def segments(t: Tables):
    return t.customer.select("c_custkey", segment().alias("segment"), "c_nationkey", "c_acctbal")


def keyed(name: str, predicate: str, make) -> None:
    """Customers kept by a filter on the segment."""
    @query(name, f"SELECT c_custkey FROM (SELECT c_custkey, c_nationkey, c_acctbal, {SEG_SQL} AS segment FROM customer) WHERE {predicate}")
    def _(t: Tables):
        return segments(t).filter(make()).select("c_custkey")


keyed("f01_term", "segment = 'BUILDING'", lambda: f.term("segment", "BUILDING"))
keyed("f02_terms", "segment IN ('BUILDING', 'MACHINERY')", lambda: f.terms("segment", ["BUILDING", "MACHINERY"]))
keyed("f02_terms_with_null", "segment = 'BUILDING' OR segment IS NULL", lambda: f.terms("segment", ["BUILDING", None]))
keyed("f03_not_term", "segment <> 'BUILDING' OR segment IS NULL", lambda: f.not_term("segment", "BUILDING"))
keyed("f03_not_terms_with_null", "segment NOT IN ('BUILDING', 'MACHINERY') AND segment IS NOT NULL",
      lambda: f.not_terms("segment", ["BUILDING", "MACHINERY", None]))
keyed("f04_missing", "segment IS NULL", lambda: f.missing("segment"))
keyed("f04_missing_null_value", "segment IS NULL OR segment = 'FURNITURE'", lambda: f.missing("segment", null_value="FURNITURE"))
keyed("f04_missing_stand_in", "segment = 'FURNITURE'", lambda: f.missing("segment", null_value="FURNITURE", existence=False))
keyed("f05_exists", "segment IS NOT NULL", lambda: f.exists("segment"))
keyed("f06_prefix_null_field", "segment LIKE 'BU%'", lambda: f.prefix("segment", "BU"))
keyed("f09_and", "segment = 'BUILDING' AND c_acctbal > 0", lambda: f.and_({"segment": "BUILDING"}, f.range_("c_acctbal", gt=0)))
keyed("f10_or", "coalesce(segment = 'BUILDING', false) OR c_nationkey = 3", lambda: f.or_({"segment": "BUILDING"}, f.term("c_nationkey", 3)))
keyed("f11_not_hash", "NOT coalesce(segment = 'BUILDING' AND c_nationkey = 3, false)", lambda: f.not_({"segment": "BUILDING", "c_nationkey": 3}))
keyed("f11_not_list", "NOT (coalesce(segment = 'BUILDING', false) OR c_nationkey = 3)",
      lambda: f.not_([f.term("segment", "BUILDING"), f.term("c_nationkey", 3)]))
keyed("f20_script", "c_acctbal * 2 > 5000 + c_nationkey", lambda: f.script("c_acctbal * :factor > :base + c_nationkey", factor=2, base=5000))
keyed("f26_match_all", "true", f.match_all)


@query("f01_term_many", "SELECT p_partkey FROM part WHERE list_contains([p_brand, p_type], 'PROMO')")
def _(t):
    return t.parts().filter(f.term("tags", "PROMO", many=True)).select("p_partkey")


@query("f02_terms_and_many", "SELECT p_partkey FROM part WHERE list_has_all(string_split(p_name, ' '), ['red', 'bolt'])")
def _(t):
    return t.parts().filter(f.terms("words", ["red", "bolt"], execution="and", many=True)).select("p_partkey")


@query("f06_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 're%' OR p_name LIKE 'bl%'")
def _(t):
    return t.part.filter(f.prefix("p_name", ["re", "bl"])).select("p_partkey", "p_name")


@query("f06_not_prefix_many", "SELECT p_partkey FROM part WHERE len(list_filter(string_split(p_name, ' '), lambda w: w LIKE 'b%')) = 0")
def _(t):
    return t.parts().filter(f.not_prefix("words", "b", many=True)).select("p_partkey")


@query("f07_range", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""")
def _(t):
    bounds = [F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1998-01-01")]
    return t.lineitem.filter(f.range_("l_shipdate", gte=bounds[0], lt=bounds[1])).select("l_orderkey", "l_linenumber")


@query("f07_range_text", "SELECT p_partkey FROM part WHERE p_name > 'hot' AND p_name <= 'red gear'")
def _(t):
    return t.part.filter(f.range_("p_name", gt="hot", lte="red gear")).select("p_partkey")


@query("f07_range_many_one_element", f"SELECT DISTINCT doc_id FROM {LINES_SQL} WHERE words > 20 AND words < 23")
def _(t):
    return t.lines().filter(f.range_(F.col("lines.words"), gt=20, lt=23, many=True)).select("doc_id")


@query("f07_range_many_flat", f"SELECT doc_id FROM {LINES_SQL} GROUP BY doc_id HAVING max(words) > 20 AND min(words) < 23")
def _(t):
    return t.lines().filter(f.range_(F.col("lines.words"), gt=20, lt=23, many=True, flat=True)).select("doc_id")


@query("f08_numeric_range", """SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) > 20
    AND CAST(json_extract_string(props, '$.k') AS DOUBLE) <= 40""")
def _(t):
    k = F.get_json_object("props", "$.k")
    return t.events.filter(f.numeric_range(k, (">", 20), ("<=", 40))).select("event_id")


# --- geo --------------------------------------------------------------------

LAT, LON = "((c_custkey * 7) % 180 - 90)", "((c_custkey * 13) % 360 - 180)"


def distance_sql(lat: float, lon: float) -> str:
    return (f"(2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians({LAT} - ({lat})) / 2), 2) + cos(radians({LAT})) "
            f"* cos(radians({lat})) * pow(sin(radians({LON} - ({lon})) / 2), 2)))))")


def place(name: str, predicate: str, make) -> None:
    @query(name, f"SELECT c_custkey FROM customer WHERE {predicate}")
    def _(t: Tables):
        return t.places().filter(make()).select("c_custkey")


RING = f"{distance_sql(40.5, -3.25)} > 1000000 AND {distance_sql(40.5, -3.25)} <= 4000000"
BOX = f"{LAT} BETWEEN -20 AND 30 AND {LON} BETWEEN 10 AND 90"
WRAP = f"{LAT} BETWEEN -20 AND 30 AND ({LON} >= 150 OR {LON} <= -150)"
TRIANGLE = [(-30.5, -60.5), (50.5, 10.5), (-30.5, 80.5)]


def ray_sql(points) -> str:
    parts = []
    for (a, b), (c, d) in zip(points, points[1:] + points[:1]):
        if a != c:
            parts.append(f"CASE WHEN (({LAT} < {a}) <> ({LAT} < {c})) AND {LON} < {b} + ({LAT} - ({a})) * ({d} - ({b})) / ({c} - ({a})) THEN 1 ELSE 0 END")
    return f"(({' + '.join(parts)}) % 2 = 1)"


place("f12_geo_distance", f"{distance_sql(40.5, -3.25)} <= 2500000", lambda: f.geo_distance("p", 40.5, -3.25, "2500km"))
place("f13_geo_distance_range", RING, lambda: f.geo_distance_range("p", 40.5, -3.25, gt="1000km", lte="4000km"))
place("f14_geo_bounding_box", BOX, lambda: f.geo_bbox("p", (30, 10), (-20, 90)))
place("f14_geo_bounding_box_wrap", WRAP, lambda: f.geo_bbox("p", (30, 150), (-20, -150)))
place("f15_geo_polygon", ray_sql(TRIANGLE), lambda: f.geo_polygon("p", TRIANGLE))
place("f16_not_geo_distance", f"NOT ({distance_sql(40.5, -3.25)} <= 2500000)", lambda: f.not_geo_distance("p", 40.5, -3.25, "2500km"))
place("f16_not_geo_distance_range", f"NOT ({RING})", lambda: f.not_geo_distance_range("p", 40.5, -3.25, gt="1000km", lte="4000km"))
place("f16_not_geo_bounding_box", f"NOT ({BOX})", lambda: f.not_geo_bounding_box("p", (30, 10), (-20, 90)))
place("f16_not_geo_polygon", f"NOT {ray_sql(TRIANGLE)}", lambda: f.not_geo_polygon("p", TRIANGLE))


# --- metadata ---------------------------------------------------------------

PEOPLE_SQL = """(SELECT 'customers' AS _index, 'customer' AS _type, CAST(c_custkey AS VARCHAR) AS _id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'suppliers', 'supplier', CAST(s_suppkey AS VARCHAR), s_name, s_acctbal FROM supplier)"""


def people(name: str, predicate: str, make) -> None:
    @query(name, f"SELECT _type, _id FROM {PEOPLE_SQL} WHERE {predicate}")
    def _(t: Tables):
        return t.people().filter(make()).select("_type", "_id")


people("f17_ids", "_id IN ('3', '5', '8') AND _type = 'customer'", lambda: f.ids([3, 5, 8], "customer"))
people("f17_not_ids", "NOT (_id IN ('3', '5', '8'))", lambda: f.not_ids([3, 5, 8]))
people("f18_type", "_type = 'supplier'", lambda: f.type_("supplier"))
people("f18_not_type", "_type <> 'supplier'", lambda: f.not_type(["supplier"]))
people("f21_indices", "CASE WHEN _index = 'suppliers' THEN balance > 0 ELSE balance > 9000 END",
       lambda: f.indices("suppliers", F.col("s_acctbal") > 0, F.col("c_acctbal") > 9000))
people("f21_indices_none", "_index = 'suppliers' AND balance > 0", lambda: f.indices(["suppliers"], F.col("s_acctbal") > 0, "none"))


@query("f17_ids_table", """SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    wanted = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return f.ids_in(t.customer, wanted, "c_custkey").select("c_custkey")


@query("f19_limit", """SELECT o_orderpriority, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 20""")
def _(t):
    return f.limit_per_shard(t.orders, 20, "o_orderpriority", "o_orderkey").select("o_orderpriority", "o_orderkey")


@query("f23_nested", f"SELECT DISTINCT doc_id FROM {LINES_SQL} WHERE words > 25 AND last = '.'")
def _(t):
    return t.lines().filter(f.nested("lines", lambda e: (e["words"] > 25) & (e["last"] == "."))).select("doc_id")


@query("f23_not_nested", f"SELECT doc_id FROM {LINES_SQL} GROUP BY doc_id HAVING NOT bool_or(words > 25 AND last = '.')")
def _(t):
    return t.lines().filter(f.not_nested("lines", lambda e: (e["words"] > 25) & (e["last"] == "."))).select("doc_id")


@query("f27_named", f"""SELECT c_custkey, concat_ws('|', CASE WHEN segment = 'BUILDING' THEN 'building' END,
    CASE WHEN c_acctbal > 5000 THEN 'rich' END) AS matched
    FROM (SELECT c_custkey, c_acctbal, {SEG_SQL} AS segment FROM customer) WHERE segment = 'BUILDING' OR c_acctbal > 5000""")
def _(t):
    tests = {"building": f.term("segment", "BUILDING"), "rich": f.range_("c_acctbal", gt=5000)}
    return segments(t).filter(f.or_(*tests.values())).select(
        "c_custkey", F.array_join(f.matched_filters(**tests), "|").alias("matched"))


def customer_refs(t):
    """Customers with the reference of their nation."""
    ref = F.struct(F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("odd").alias("index"),
                   F.lit("nation").alias("type"), F.col("c_nationkey").cast("string").alias("id"))
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, ref).alias("ref"))


@query("f28_ref_is", "SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0 AND c_nationkey IN (3, 4)")
def _(t):
    uids = [{"index": "odd", "type": "nation", "id": "3"}, {"index": "even", "type": "nation", "id": "4"}]
    return customer_refs(t).filter(f.ref_is("ref", uids)).select("c_custkey")


@query("f28_not_ref", "SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 OR c_nationkey <> 3")
def _(t):
    return customer_refs(t).filter(f.not_ref("ref", {"index": "odd", "type": "nation", "id": "3"})).select("c_custkey")


@query("f28_ref_in_table", """SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_custkey % 7 <> 0 AND n_regionkey = 1""")
def _(t):
    uids = t.nation.filter("n_regionkey = 1").select(
        F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd").alias("index"),
        F.lit("nation").alias("type"), F.col("n_nationkey").cast("string").alias("id"))
    return f.ref_in(customer_refs(t), "ref", uids).select("c_custkey")


# --- parent and child -------------------------------------------------------

def failed_orders(t):
    return t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))


HAS = "c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)"


@query("f24_has_child", f"SELECT c_custkey FROM customer WHERE {HAS}")
def _(t):
    return t.customer.join(failed_orders(t), "c_custkey", "left_semi").select("c_custkey")


@query("f24_not_has_child", f"SELECT c_custkey FROM customer WHERE NOT ({HAS})")
def _(t):
    return t.customer.join(failed_orders(t), "c_custkey", "left_anti").select("c_custkey")


@query("f25_has_parent", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    parents = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(parents, "o_custkey", "left_semi").select("o_orderkey")


@query("f25_not_has_parent", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    parents = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(parents, "o_custkey", "left_anti").select("o_orderkey")


@query("j01_semi_by_grandchild", """SELECT c_custkey FROM customer WHERE c_custkey IN (
    SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48))""")
def _(t):
    lines = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 48")
    orders = semi_by_values(t.orders, "o_orderkey", lines, "l_orderkey")
    return semi_by_values(t.customer, "c_custkey", orders, "o_custkey").select("c_custkey")


@query("j02_semi_by_grandparent", """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (
    SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9500))""")
def _(t):
    orders = semi_by_values(t.orders, "o_custkey", t.customer.filter("c_acctbal > 9500"), "c_custkey")
    return semi_by_values(t.lineitem, "l_orderkey", orders, "o_orderkey").select("l_orderkey", "l_linenumber")


@query("j03_anti", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.08)")
def _(t):
    sold = t.lineitem.filter("l_discount > 0.08").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(sold, "p_partkey", "left_anti").select("p_partkey")


@query("j07_two_step", """SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2))""")
def _(t):
    nations = t.nation.filter("n_regionkey = 2")
    customers = semi_by_values(t.customer, "c_nationkey", nations, "n_nationkey")
    return semi_by_values(t.orders, "o_custkey", customers, "c_custkey").select("o_orderkey")


@query("u01_union", f"SELECT _type, _id, name FROM {PEOPLE_SQL}")
def _(t):
    return t.people().select("_type", "_id", F.coalesce("c_name", "s_name").alias("name"))


@query("u02_difference", f"""SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND NOT ({HAS})""")
def _(t):
    return f.ids_in(t.customer.filter("c_acctbal > 0"), failed_orders(t), "c_custkey", negated=True).select("c_custkey")
