import pytest
from pyspark.sql import functions as F

from corpusgrid.functions import filters as f
from corpusgrid.functions import geo
from corpusgrid.functions import values as V


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "a", ["x", "y"], 5.0), (2, "b", ["y"], 15.0), (3, None, [], None), (4, "ab", None, 25.0)]
    return spark.createDataFrame(data, "id int, s string, tags array<string>, n double")


def ids(rows, predicate):
    return [r["id"] for r in rows.filter(predicate).orderBy("id").collect()]


def test_terms(rows):
    assert ids(rows, f.term("s", "a")) == [1]
    assert ids(rows, f.terms("s", ["a", "b"])) == [1, 2]
    assert ids(rows, f.terms("s", ["a", None])) == [1, 3]
    assert ids(rows, f.term("s", None)) == [3]
    assert ids(rows, f.terms("s", [])) == [3]
    assert ids(rows, f.term("tags", "y", many=True)) == [1, 2]
    assert ids(rows, f.terms("tags", ["x", "y"], execution="and", many=True)) == [1]
    assert ids(rows, f.missing("tags", many=True)) == [3, 4]


def test_negations_keep_missing_rows(rows):
    assert ids(rows, f.not_term("s", "a")) == [2, 3, 4]
    assert ids(rows, f.not_terms("s", ["a", None])) == [2, 4]
    assert ids(rows, f.not_prefix("s", "a")) == [2, 3]
    assert ids(rows, f.not_range("n", gt=10)) == [1, 3]


@pytest.mark.parametrize("make", [
    lambda: f.term("s", "a"), lambda: f.terms("s", ["a", None]), lambda: f.prefix("s", ["a", "b"]), lambda: f.range_("n", gte=5, lt=15),
    lambda: f.term("tags", "y", many=True), lambda: f.exists("s"), lambda: f.and_({"s": "a"}, f.range_("n", gt=1)), lambda: f.or_({"s": "a"}, {"s": "b"})])
def test_filter_and_its_negation_cover_all(rows, make):
    inside, outside = ids(rows, make()), ids(rows, f.negate(make()))
    assert sorted(inside + outside) == [1, 2, 3, 4] and not set(inside) & set(outside)


def test_logic(rows):
    assert ids(rows, f.and_()) == [1, 2, 3, 4] and ids(rows, f.or_()) == [1, 2, 3, 4]
    assert ids(rows, f.not_({})) == [1, 2, 3, 4]
    assert ids(rows, f.not_({"s": "a", "id": 2})) == [1, 2, 3, 4]
    assert ids(rows, f.not_([f.term("s", "a"), f.term("id", 2)])) == [3, 4]
    with pytest.raises(TypeError):
        f.and_("scalar")


def test_ranges(rows):
    assert ids(rows, f.range_("s", gte="a", lt="b")) == [1, 4]
    assert ids(rows, f.numeric_range("n", (">=", 5), ("<", 25))) == [1, 2]
    with pytest.raises(ValueError, match="twice"):
        f.range_("n", (">", 1), ("gt", 2))
    with pytest.raises(ValueError, match="unknown"):
        f.range_("n", near=1)
    with pytest.raises(ValueError, match="needs a value"):
        f.prefix("s", None)


def test_range_on_many_values(spark):
    rows = spark.createDataFrame([(1, [5, 25]), (2, [15])], "id int, v array<int>")
    assert ids(rows, f.range_("v", gt=10, lt=20, many=True)) == [2]
    assert ids(rows, f.range_("v", gt=10, lt=20, many=True, flat=True)) == [1, 2]


def test_references(spark):
    rows = spark.createDataFrame([(1, ("i", "t", "1")), (2, ("i", "t", "2")), (3, None)], "id int, ref struct<index:string,type:string,id:string>")
    uid = {"index": "i", "type": "t", "id": "1"}
    assert ids(rows, f.ref_is("ref", uid)) == [1]
    assert ids(rows, f.ref_is("ref", [uid, None])) == [1, 3]
    assert ids(rows, f.not_ref("ref", uid)) == [2, 3]
    with pytest.raises(ValueError, match="lacks its id"):
        f.ref_is("ref", {"index": "i", "type": "t"})


def test_script_parameters_are_literals(rows):
    assert ids(rows, f.script("s = :v", v="a' OR 'x' = 'x")) == []
    assert ids(rows, f.script("n > :low", low=10)) == [2, 4]
    assert ids(rows, f.script(lambda low: F.col("n") > low, low=20)) == [4]


def test_geo(spark):
    london = spark.range(1).select(geo.point(F.lit(51.5074), F.lit(-0.1278)).alias("p"))
    assert london.select(geo.geohash(F.col("p"), 12)).first()[0] == "gcpvj0duq533"
    metres = london.select(geo.haversine(F.col("p"), 48.8566, 2.3522)).first()[0]
    assert 343_000 < metres < 344_500
    assert geo.metres("50km") == 50_000 and geo.metres("1mi") == 1609.344 and geo.metres(2) == 2000
    with pytest.raises(ValueError):
        geo.metres("5 parsecs")
    with pytest.raises(ValueError):
        geo.in_polygon(F.col("p"), [(0, 0), (1, 1)])


def test_geo_points_out_of_range(spark):
    df = spark.createDataFrame([("91,0",), ("45,-181",), ("45, 10",), ("x",)], "s string")
    got = [r[0] for r in df.select(geo.point_from_text(F.col("s"))).collect()]
    assert got[0] is None and got[1] is None and got[3] is None and tuple(got[2]) == (45.0, 10.0)


def test_values(spark):
    one = spark.range(1)
    assert one.select(V.encode_binary(F.lit(bytearray([0, 1, 5, 130])))).first()[0] == "AAEFgg==\n"
    assert one.select(V.timestamp_to_millis(F.lit(1338634443.3589))).first()[0] == 1338634443359
    assert one.select(V.millis_to_timestamp(F.lit(1338634443359))).first()[0] == 1338634443.359
    assert one.select(V.uid_key(F.lit("a;b"), F.lit(7))).first()[0] == "a;;b;7"
    assert one.select(V.ip_to_long(F.lit("1.2.3.4")), V.ip_to_long(F.lit("1.2.3.400"))).first()[:] == (16909060, None)
    assert one.select(V.to_numeric(F.lit("300"), "byte"), V.to_numeric(F.lit("30"), "byte")).first()[:] == (None, 30)
    dates = ["2012/06/02 10:54:03 +0000", "2012/06/02 +0000", "1338634443000", "junk"]
    got = [r[0] for r in spark.createDataFrame([(d,) for d in dates], "d string").select(V.iso_date(V.to_date(F.col("d")))).collect()]
    assert got == ["2012-06-02T10:54:03.000Z", "2012-06-02T00:00:00.000Z", "2012-06-02T10:54:03.000Z", None]
