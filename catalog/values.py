"""Conversions, projections, document shape."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import Tables, query, segment
from corpusgrid.functions import analysis as A
from corpusgrid.functions import geo
from corpusgrid.functions import values as V
from corpusgrid.operators import refs, schema

K = "json_extract_string(props, '$.k')"


def raw_events(t: Tables):
    """Events as loose text fields, some of them bad."""
    k = F.get_json_object("props", "$.k")
    return t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 11 == 0, "n/a").otherwise(k).alias("k"),
        F.col("value").cast("string").alias("value"), F.col("event_type").alias("kind"))


EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType()),
                      T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType())])


@query("t02_enforce_schema", f"SELECT event_id, {K}::INTEGER AS k, value, event_type AS kind FROM events WHERE event_id % 11 <> 0")
def _(t):
    return schema.enforce_schema(raw_events(t), EVENT)[0]


@query("t02_enforce_schema_rejects", "SELECT CAST(event_id AS VARCHAR) AS event_id, 'k' AS errors FROM events WHERE event_id % 11 = 0")
def _(t):
    bad = schema.enforce_schema(raw_events(t), EVENT)[1]
    return bad.select("event_id", F.array_join("_errors", ",").alias("errors"))


@query("t02_enforce_schema_dynamic", f"""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE {K} END AS text,
    CASE WHEN event_id % 11 <> 0 THEN {K}::DOUBLE END AS number FROM events""")
def _(t):
    short = T.StructType([f for f in EVENT.fields if f.name == "event_id"])
    kept = schema.enforce_schema(raw_events(t).select("event_id", "k"), short, dynamic=True)[0]
    return kept.select("event_id", "k.text", "k.number")


FLAG = "CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN 'false' WHEN 3 THEN 'yes' END"


@query("t03_to_boolean", "SELECT event_id, event_id % 5 = 3 AS strict, CASE WHEN event_id % 5 <> 4 THEN event_id % 5 = 3 END AS nullable FROM events")
def _(t):
    flagged = t.events.select("event_id", F.expr(FLAG).alias("f"))
    return flagged.select("event_id", V.to_boolean(F.col("f")).alias("strict"), V.to_boolean(F.col("f"), True).alias("nullable"))


@query("t04_to_date", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS iso FROM events")
def _(t):
    """Three layouts: epoch milliseconds, slashes with a zone, and a custom one."""
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    text = (F.when(F.col("event_id") % 3 == 0, F.unix_millis(ts).cast("string"))
            .when(F.col("event_id") % 3 == 1, F.concat(F.date_format(ts, "yyyy/MM/dd HH:mm:ss"), F.lit(" +0000")))
            .otherwise(F.date_format(ts, "dd.MM.yyyy HH-mm-ss")))
    parsed = F.coalesce(V.to_date(F.col("s")), V.to_date(F.col("s"), "dd.MM.yyyy HH-mm-ss"))
    return t.events.select("event_id", text.alias("s")).select("event_id", V.iso_date(parsed).alias("iso"))


@query("t05_timestamp_millis", """SELECT event_id, CAST(floor(epoch_us(ts) / 1000000.0::DOUBLE * 1000 + 0.5) AS BIGINT) AS millis,
    round(CAST(floor(epoch_us(ts) / 1000000.0::DOUBLE * 1000 + 0.5) AS BIGINT) / 1000, 3) AS seconds FROM events""")
def _(t):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000000.0)
    return t.events.select("event_id", V.timestamp_to_millis(seconds).alias("millis")).withColumn(
        "seconds", V.millis_to_timestamp(F.col("millis")))


@query("t06_binary", "SELECT page_id, regexp_replace(to_base64(encode(html)), '(.{1,76})', '\\1' || chr(10), 'g') AS encoded, html AS decoded FROM pages")
def _(t):
    coded = t.pages.select("page_id", V.encode_binary(F.col("html")).alias("encoded"))
    return coded.withColumn("decoded", V.decode_binary(F.col("encoded")).cast("string"))


LAT, LON = "((c_custkey * 7) % 180 - 90)::DOUBLE", "((c_custkey * 13) % 360 - 180)::DOUBLE"


@query("t07_to_geo_point", f"""SELECT c_custkey, {LAT} AS lat, {LON} AS lon FROM customer WHERE c_custkey % 9 <> 0""")
def _(t):
    """Text, GeoJSON array and struct spellings; out-of-range points drop out."""
    src = t.places().select("c_custkey", (F.col("p.lat") + F.when(F.col("c_custkey") % 9 == 0, 200).otherwise(0)).alias("lat"), F.col("p.lon").alias("lon"))
    parsed = (F.when(F.col("c_custkey") % 3 == 0, geo.point_from_text(F.concat_ws(",", "lat", "lon")))
              .when(F.col("c_custkey") % 3 == 1, geo.point_from_array(F.array("lon", "lat")))
              .otherwise(geo.point_from_struct(F.struct("lat", "lon"))))
    return src.select("c_custkey", parsed.alias("p")).filter("p is not null").select("c_custkey", "p.lat", "p.lon")


def geohash_sql(precision: int) -> str:
    n = precision * 5
    lon_bits, lat_bits = (n + 1) // 2, n // 2
    lon = f"CAST(floor(({LON} + 180) / 360 * {2**lon_bits}) AS BIGINT)"
    lat = f"CAST(floor(({LAT} + 90) / 180 * {2**lat_bits}) AS BIGINT)"
    chars = []
    for c in range(precision):
        bits = []
        for k in range(5):
            i = c * 5 + k
            src, shift = (lon, lon_bits - 1 - i // 2) if i % 2 == 0 else (lat, lat_bits - 1 - i // 2)
            bits.append(f"(({src} >> {shift}) & 1) * {16 >> k}")
        chars.append(f"substr('{geo.GEOHASH_ALPHABET}', CAST({' + '.join(bits)} + 1 AS BIGINT), 1)")
    return " || ".join(chars)


@query("t08_geohash", f"SELECT c_custkey, {geohash_sql(8)} AS hash FROM customer")
def _(t):
    return t.places().select("c_custkey", geo.geohash(F.col("p"), 8).alias("hash"))


@query("t09_lat_lon", f"SELECT c_custkey, {LAT} AS lat, {LON} AS lon FROM customer")
def _(t):
    lat, lon = geo.lat_lon(F.col("p"))
    return t.places().select("c_custkey", lat.alias("lat"), lon.alias("lon"))


IP = "concat_ws('.', CAST(user_id % 256 AS VARCHAR), CAST(event_id // 65536 % 256 AS VARCHAR), CAST(event_id // 256 % 256 AS VARCHAR), CAST(event_id % 300 AS VARCHAR))"


@query("t10_ip_to_long", f"""SELECT event_id, {IP} AS ip, CASE WHEN event_id % 300 < 256 THEN user_id % 256 * 16777216 + event_id // 65536 % 256 * 65536
    + event_id // 256 % 256 * 256 + event_id % 300 END AS number FROM events""")
def _(t):
    e = F.col("event_id")
    octets = [F.col("user_id") % 256, F.floor(e / 65536) % 256, F.floor(e / 256) % 256, e % 300]
    return t.events.select("event_id", F.concat_ws(".", *[o.cast("string") for o in octets]).alias("ip")).withColumn(
        "number", V.ip_to_long(F.col("ip")))


@query("t11_to_numeric", """SELECT o_orderkey, TRY_CAST(s AS TINYINT) AS b, TRY_CAST(s AS SMALLINT) AS sh, TRY_CAST(s AS INTEGER) AS i, TRY_CAST(s AS BIGINT) AS l,
    TRY_CAST(s AS DOUBLE) AS d FROM (SELECT o_orderkey, CAST(o_orderkey * (o_orderkey % 400) - 200 AS VARCHAR) AS s FROM orders)""")
def _(t):
    src = t.orders.select("o_orderkey", (F.col("o_orderkey") * (F.col("o_orderkey") % 400) - 200).cast("string").alias("s"))
    widths = {"b": "byte", "sh": "short", "i": "integer", "l": "long", "d": "double"}
    return src.select("o_orderkey", *[V.to_numeric(F.col("s"), w).alias(n) for n, w in widths.items()])


@query("t12_null_value", """SELECT segment, count(*) AS n FROM (SELECT coalesce(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END, 'NONE') AS segment
    FROM customer) GROUP BY segment""")
def _(t):
    return t.customer.select(V.null_value(segment(), "NONE").alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query("t13_multi_field", """SELECT c_custkey, c_name, c_name AS c_name__c_name, c_name AS c_name__untouched,
    array_to_string(list_transform(range(2, least(20, length(c_name)) + 1), lambda n: substr(lower(c_name), 1, n)), '|') AS c_name__ngrams FROM customer""")
def _(t):
    subs = {"ngrams": lambda c: F.array_join(A.tok_edge_ngram(2, 20)(F.lower(c)), "|"), "untouched": lambda c: c}
    return schema.multi_field(t.customer.select("c_custkey", "c_name"), "c_name", subs)


@query("t14_all_field", "SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS _all FROM part")
def _(t):
    return schema.all_field(t.part, include=["p_name", "p_brand", "p_type"]).select("p_partkey", "_all")


@query("t14_all_field_nested", "SELECT doc_id, concat_ws(' ', CAST(doc_id AS VARCHAR), lang) AS _all FROM documents")
def _(t):
    """An excluded object keeps its children out."""
    src = t.documents.select("doc_id", "lang", F.struct("source", F.struct("n_chars").alias("size")).alias("meta"))
    return schema.all_field(src, exclude=["meta"]).select("doc_id", "_all")


@query("t15_flatten_object", r"""SELECT doc_id, array_to_string(list(words ORDER BY no), ',') AS words, array_to_string(list(chars ORDER BY no), ',') AS chars FROM (
    SELECT doc_id, no, length(s) AS chars, len(regexp_extract_all(s, '\S+')) AS words FROM (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS no
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))) GROUP BY doc_id""")
def _(t):
    flat = schema.flatten_object(t.lines(), ["doc_id", "lines"], "_")
    return flat.select("doc_id", *[F.array_join(F.col(f"lines_{c}").cast("array<string>"), ",").alias(c) for c in ("words", "chars")])


@query("t16_nested_field", r"""SELECT doc_id, bool_or(words > 20 AND last = ',') AS nested, bool_or(words > 20) AND bool_or(last = ',') AS flat FROM (
    SELECT doc_id, len(regexp_extract_all(s, '\S+')) AS words, right(s, 1) AS last FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents))
    GROUP BY doc_id""")
def _(t):
    """Per-element match against the cross-matching flat copy in the parent."""
    both = schema.nested_field(t.lines(), "lines", include_in_parent=True)
    return both.select("doc_id", F.exists("lines", lambda e: (e["words"] > 20) & (e["last"] == ",")).alias("nested"),
                       (F.exists("lines__words", lambda w: w > 20) & F.exists("lines__last", lambda c: c == ",")).alias("flat"))


def nation_uid():
    return schema.uid_struct(F.lit("places"), F.lit("nation"), F.col("n_nationkey"))


@query("t17_embed", """SELECT c_custkey, 'places' AS uid_index, CAST(n_nationkey AS VARCHAR) AS uid_id, n_name AS name FROM customer LEFT JOIN nation
    ON c_nationkey = n_nationkey""")
def _(t):
    out = schema.embed(t.customer, t.nation, "c_nationkey", "n_nationkey", "nation", nation_uid(), exclude_attrs=["n_regionkey", "n_nationkey"])
    return out.select("c_custkey", F.col("nation.uid.index").alias("uid_index"), F.col("nation.uid.id").alias("uid_id"), F.col("nation.n_name").alias("name"))


@query("t18_exclude", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return schema.exclude(t.customer, ["c_acctbal", "c_mktsegment", "c_nationkey"])


@query("t19_tuple_object", "SELECT p_partkey, p_brand AS a, p_type AS b, p_brand || '|' || p_type AS back FROM part")
def _(t):
    objects = t.part.select("p_partkey", F.array("p_brand", "p_type").alias("t")).select("p_partkey", V.tuple_to_object(F.col("t"), 2).alias("o"))
    return objects.select("p_partkey", F.col("o.0").alias("a"), F.col("o.1").alias("b"),
                          F.array_join(V.object_to_tuple(F.col("o"), 2), "|").alias("back"))


@query("t20_convert", "SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer")
def _(t):
    return t.customer.select("c_custkey", V.convert(F.col("c_acctbal"), lambda c: F.round(c * 100).cast("long")).alias("cents"))


@query("t21_append_evolving", """SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS segment FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""")
def _(t):
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return schema.append_evolving(base.filter("id % 2 = 0").drop("segment"), base.filter("id % 2 = 1"))


@query("t21_drop_type", "SELECT CAST(c_custkey AS VARCHAR) AS _id FROM customer")
def _(t):
    return schema.drop_type(t.people(), "supplier").select("_id")


@query("t23_source_filter", "SELECT p_partkey, p_name AS name, p_size AS size, true AS is_partial FROM part")
def _(t):
    doc = t.part.select(F.struct("p_partkey", F.struct(F.col("p_name").alias("name"), F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
                        .alias("detail")).alias("body"), "p_brand").alias("doc"))
    out = schema.source_filter(doc, ["doc.p_partkey", "doc.body.*"], ["doc.body.detail.price"])
    return out.select("doc.p_partkey", "doc.body.name", "doc.body.detail.size", "is_partial")


@query("t23_source_filter_array", "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda s: length(s)), ',') AS chars, 'chars,last' AS left_over, true AS is_partial FROM documents")
def _(t):
    """Paths inside an array of objects."""
    out = schema.source_filter(t.lines(), ["doc_id", "lines.*"], ["lines.words"])
    kept = ",".join(out.schema["lines"].dataType.elementType.names)
    return out.select("doc_id", F.array_join(F.col("lines.chars").cast("array<string>"), ",").alias("chars"), F.lit(kept).alias("left_over"), "is_partial")


@query("t24_fields", "SELECT p_partkey, p_name AS name, array_to_string(string_split(p_name, ' '), '|') AS words FROM part")
def _(t):
    out = schema.fields(t.parts(), ["p_name", "words"], "p_partkey")
    return out.select("p_partkey", F.array_join("p_name", "|").alias("name"), F.array_join("words", "|").alias("words"))


@query("t25_script_fields", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * 1.2::DOUBLE, 4) AS net FROM lineitem")
def _(t):
    out = schema.script_fields(t.lineitem, {"net": "round(l_extendedprice * (1 - l_discount) * :rate, 4)"}, rate=1.2)
    return out.select("l_orderkey", "l_linenumber", "net")


@query("t26_expire", "SELECT event_id FROM events WHERE ts + INTERVAL 10 DAY > TIMESTAMP '2024-01-25 12:00:00'")
def _(t):
    return schema.expire(t.events, "10 days", F.lit("2024-01-25 12:00:00").cast("timestamp"), "ts").select("event_id")


@query("t26_expire_by_type", """SELECT event_id FROM events WHERE CASE event_type WHEN 'click' THEN ts + INTERVAL 10 DAY > TIMESTAMP '2024-01-25 12:00:00'
    WHEN 'view' THEN ts + INTERVAL 3 DAY > TIMESTAMP '2024-01-25 12:00:00' ELSE true END""")
def _(t):
    now = F.lit("2024-01-25 12:00:00").cast("timestamp")
    return schema.expire(t.events, {"click": "10 days", "view": "3 days"}, now, "ts", "event_type").select("event_id")


@query("t16_nested_in_root", r"""SELECT doc_id, list_max(list_transform(words, lambda w: length(w))) AS longest, len(words) AS words
    FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS words FROM documents)""")
def _(t):
    """Objects inside objects, flat at the top of the row: the words of the lines."""
    lines = F.transform(F.split("text", "\n"), lambda s: F.struct(F.transform(
        F.regexp_extract_all(s, F.lit(r"\S+"), F.lit(0)), lambda w: F.struct(F.length(w).alias("chars"))).alias("words")))
    flat = schema.nested_field(t.docs.select("doc_id", lines.alias("lines")), "lines", include_in_root=True)
    return flat.select("doc_id", F.array_max("lines__words__chars").cast("long").alias("longest"), F.size("lines__words__chars").cast("long").alias("words"))


@query("c01_uid_key", "SELECT p_partkey, replace(p_type || ';x', ';', ';;') || ';' || CAST(p_partkey AS VARCHAR) AS k FROM part")
def _(t):
    return t.part.select("p_partkey", V.uid_key(F.concat("p_type", F.lit(";x")), F.col("p_partkey")).alias("k"))


# --- references
@query("j06_resolve_refs", """SELECT l_orderkey, l_linenumber, p_name AS name, p_partkey IS NULL AS deleted FROM lineitem
    LEFT JOIN (SELECT * FROM part WHERE p_brand <> 'Brand#3') ON l_partkey = p_partkey""")
def _(t):
    parts = t.part.filter("p_brand <> 'Brand#3'")
    out = refs.resolve_refs(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", parts, "p_partkey")
    return out.select("l_orderkey", "l_linenumber", F.col("doc.p_name").alias("name"), "deleted")


@query("j08_reembed", "SELECT c_custkey, upper(n_name) || '!' AS name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    """Copies refreshed after every nation got a new name."""
    stale = schema.embed(t.customer.select("c_custkey", "c_nationkey"), t.nation, "c_nationkey", "n_nationkey", "nation", nation_uid(), ["n_name"])
    renamed = t.nation.withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!")))
    fresh = refs.reembed(stale, "nation", F.col("nation.uid.id").cast("int"), renamed, "n_nationkey", nation_uid(), ["n_name"])
    return fresh.select("c_custkey", F.col("nation.n_name").alias("name"))


