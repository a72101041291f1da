"""SQL functions on hand-made geometry."""

import pytest
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions import relate as r
from lamina.functions.registry import definitions, register_functions
from lamina.operators.tables import shapes

DONUT = "GeomFromText('POLYGON((0 0,10 0,10 10,0 10,0 0),(3 3,3 7,7 7,7 3,3 3))')"
LINE = "GeomFromText('LINESTRING(0 0,10 0,10 10)')"


@pytest.fixture(scope="module")
def sql(spark):
    register_functions(spark)

    def one(text):
        return spark.sql(f"SELECT {text} AS v").first()[0]

    return one


@pytest.mark.parametrize("text", [
    "POINT(0 0)", "LINESTRING(0 0,1 0)", "POLYGON((0 0,1 0,1 1,0 0))", "MULTIPOINT((1 1))", "MULTILINESTRING((0 0,1 0),(0 1,1 1))",
    "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((2 2,3 0,3 3,2 2)))", "POINT(1 2 3)", "POLYGON((0 0,9 0,9 9,0 0),(5 1,8 1,8 4,5 1))", "LINESTRING(0.5 -1.25,1000000 3)",
])
def test_text_round_trip(sql, text):
    assert sql(f"ST_AsText(GeomFromText('{text}'))") == text


@pytest.mark.parametrize("text", [
    "", "POINT", "POINT()", "POINT(1)", "POINT(1 b)", "LINESTRING(1 1)", "POLYGON((0 0,1 0,1 1))", "POLYGON((0 0,1 0,1 1,2 2))", "POLYGON(0 0,1 0,1 1,0 0)",
    "MULTIPOLYGON((0 0,1 0,1 1,0 0))", "CIRCLE(1 1)", "POINT(1 1", "POINT(1 1))", "LINESTRING(0 0,,1 1)",
])
def test_broken_text_is_null(sql, text):
    assert sql(f"GeomFromText('{text}')") is None


def test_text_constructors_check_the_type_and_take_a_srid(sql):
    assert sql("PointFromText('LINESTRING(0 0,1 1)')") is None
    assert sql("Srid(PointFromText('POINT(0 0)', 4326))") == 4326
    assert sql("ST_GeometryType(ST_MPolyFromText('multipolygon(((0 0,1 0,1 1,0 0)))'))") == "MULTIPOLYGON"


def test_measures(sql):
    assert sql(f"ST_Area({DONUT})") == 84
    assert sql(f"ST_Perimeter({DONUT})") == 56
    assert sql(f"ST_Length({LINE})") == 20
    assert sql(f"ST_AsText(Centroid({DONUT}))") == "POINT(5 5)"
    assert sql(f"ST_AsText(Centroid({LINE}))") == "POINT(7.5 2.5)"
    assert sql("ST_AsText(Centroid(GeomFromText('MULTIPOINT((0 0),(2 4))')))") == "POINT(1 2)"
    assert [sql(f"{f}({LINE})") for f in ("ST_MinX", "ST_MinY", "ST_MaxX", "MbrMaxY")] == [0, 0, 10, 10]


def test_point_against_polygon_with_hole(spark, sql):
    places = {(5, 5): (False, False), (1, 1): (True, False), (0, 5): (True, True), (3, 5): (True, True), (11, 5): (False, False)}
    df = spark.createDataFrame(list(places), "x int, y int")
    df.createOrReplaceTempView("places")
    got = spark.sql(f"""SELECT x, y, Intersects(p, d) AS meets, ST_Touches(p, d) AS touches, ST_Within(p, d) AS within, ST_Disjoint(p, d) AS apart
                        FROM (SELECT x, y, MakePoint(x, y) AS p, {DONUT} AS d FROM places)""")
    for q in got.collect():
        inside, touching = places[q.x, q.y]
        assert (q.meets, q.touches, q.within, q.apart) == (inside, touching, inside and not touching, not inside)


SQUARE = "POLYGON((0 0,4 0,4 4,0 4,0 0))"


RELATED = [
    (SQUARE, "POLYGON((2 2,6 2,6 6,2 6,2 2))", {"Intersects", "Overlaps"}),
    (SQUARE, "POLYGON((4 0,8 0,8 4,4 4,4 0))", {"Intersects", "Touches"}),
    (SQUARE, "POLYGON((4 4,8 4,8 8,4 8,4 4))", {"Intersects", "Touches"}),
    (SQUARE, "POLYGON((1 1,2 1,2 2,1 2,1 1))", {"Intersects", "Contains"}),
    (SQUARE, "POLYGON((0 0,2 0,2 2,0 2,0 0))", {"Intersects", "Contains"}),
    (SQUARE, SQUARE, {"Intersects", "Contains", "Within", "Equals"}),
    (SQUARE, "POLYGON((9 9,10 9,10 10,9 9))", {"Disjoint"}),
    ("LINESTRING(-1 2,5 2)", SQUARE, {"Intersects", "Crosses"}),
    ("LINESTRING(1 1,3 3)", SQUARE, {"Intersects", "Within"}),
    ("LINESTRING(0 0,4 4)", SQUARE, {"Intersects", "Within"}),
    ("LINESTRING(0 0,4 0)", SQUARE, {"Intersects", "Touches"}),
    ("LINESTRING(-2 0,0 0)", SQUARE, {"Intersects", "Touches"}),
    ("LINESTRING(0 0,2 2)", "LINESTRING(0 2,2 0)", {"Intersects", "Crosses"}),
    ("LINESTRING(0 0,2 2)", "LINESTRING(1 1,2 0)", {"Intersects", "Touches"}),
    ("LINESTRING(0 0,2 0)", "LINESTRING(1 0,3 0)", {"Intersects", "Overlaps"}),
    ("LINESTRING(0 0,3 0)", "LINESTRING(1 0,2 0)", {"Intersects", "Contains"}),
    ("LINESTRING(0 0,1 0)", "LINESTRING(1 0,2 0)", {"Intersects", "Touches"}),
    ("POINT(1 0)", "LINESTRING(0 0,2 0)", {"Intersects", "Within"}),
    ("POINT(0 0)", "LINESTRING(0 0,2 0)", {"Intersects", "Touches"}),
    ("POINT(1 1)", "POINT(1 1)", {"Intersects", "Within", "Contains", "Equals"}),
    # the inner square fills the hole; the next one reaches over the hole
    ("POLYGON((0 0,9 0,9 9,0 9,0 0),(3 3,3 6,6 6,6 3,3 3))", "POLYGON((3 3,6 3,6 6,3 6,3 3))", {"Intersects", "Touches"}),
    ("POLYGON((0 0,9 0,9 9,0 9,0 0),(3 3,3 6,6 6,6 3,3 3))", "POLYGON((2 2,7 2,7 7,2 7,2 2))", {"Intersects", "Overlaps"}),
    ("POLYGON((0 0,6 0,6 6,4 6,4 2,2 2,2 6,0 6,0 0))", "POLYGON((2 2,4 2,4 6,2 6,2 2))", {"Intersects", "Touches"}),
]


def test_named_relations(spark):
    rows = [(i, a, b) for i, (a, b, _) in enumerate(RELATED)]
    df = spark.createDataFrame(rows, "i int, a string, b string")

    def side(c):
        g = df.select(F.col("i").alias("fid"), F.expr(x.from_wkt(c)).alias("geom"))
        s = shapes(g)
        return s.select("fid", *(F.col(n).alias(f"{c}_{n}") for n in s.columns if n != "fid"))

    names = ("intersects", "disjoint", "within", "contains", "touches", "overlaps", "crosses")
    both = side("a").join(side("b"), "fid")
    got = both.select("fid", *(F.expr(r.predicate(n)).alias(n) for n in names), F.expr(f"{r.edge_key('a_es')} = {r.edge_key('b_es')}").alias("equals"))
    for row in got.collect():
        true = {n.capitalize() for n in (*names, "equals") if row[n]}
        assert true == RELATED[row.fid][2], RELATED[row.fid]


def test_relation_functions_in_sql(spark, sql):
    text = ", ".join(f"ST_{n}(a, b) AS {n}" for n in ("Within", "Touches", "Overlaps", "Crosses", "Equals"))
    row = spark.sql(f"SELECT {text} FROM (SELECT GeomFromText('{SQUARE}') AS a, GeomFromText('POLYGON((2 2,6 2,6 6,2 6,2 2))') AS b)").first()
    assert tuple(row) == (False, False, True, False, False)


def test_editing(sql):
    assert sql(f"ST_AsText(AddPoint({LINE}, MakePoint(5, 5), 1))") == "LINESTRING(0 0,5 5,10 0,10 10)"
    assert sql(f"ST_AsText(AddPoint({LINE}, MakePoint(5, 5)))") == "LINESTRING(0 0,10 0,10 10,5 5)"
    assert sql(f"ST_AsText(SetPoint({LINE}, 1, MakePoint(5, 5)))") == "LINESTRING(0 0,5 5,10 10)"
    assert sql(f"ST_AsText(RemovePoint({LINE}, 1))") == "LINESTRING(0 0,10 10)"
    assert sql(f"RemovePoint({LINE}, 7)") is None
    assert sql(f"ST_AsText(ST_Reverse({LINE}))") == "LINESTRING(10 10,10 0,0 0)"
    assert sql(f"ST_AsText(PointN({LINE}, 2))") == "POINT(10 0)"
    assert sql(f"PointN({LINE}, 4)") is None
    assert sql(f"ST_AsText(InteriorRingN({DONUT}, 1))") == "LINESTRING(3 3,3 7,7 7,7 3,3 3)"
    assert sql(f"ST_AsText(ForceLHR({DONUT}))").startswith("POLYGON((0 0,0 10,10 10,10 0,0 0),(3 3,7 3")
    assert sql("ST_AsText(MakePolygon(GeomFromText('LINESTRING(0 0,4 0,4 4,0 0)')))") == "POLYGON((0 0,4 0,4 4,0 0))"
    assert sql(f"MakePolygon({LINE})") is None
    assert sql("ST_AsText(MakeLine(MakePoint(0, 0), MakePoint(1, 2)))") == "LINESTRING(0 0,1 2)"


def test_types_and_dimensions(sql):
    assert sql(f"CastToPoint({LINE})") is None
    assert sql(f"ST_AsText(CastToMulti({LINE}))") == "MULTILINESTRING((0 0,10 0,10 10))"
    assert sql(f"ST_AsText(CastToSingle(CastToMulti({LINE})))") == sql(f"ST_AsText({LINE})")
    assert sql("ST_AsText(CastToXYZ(MakePoint(1, 2)))") == "POINT(1 2 0)"
    assert sql("ST_AsText(CastToXY(MakePointZ(1, 2, 3)))") == "POINT(1 2)"
    assert sql("ST_AsText(GeometryN(GeomFromText('MULTIPOINT((0 0),(1 1))'), 2))") == "POINT(1 1)"
    assert sql("GeometryN(GeomFromText('MULTIPOINT((0 0),(1 1))'), 3)") is None
    assert sql(f"ST_AsText(ST_Boundary({LINE}))") == "MULTIPOINT((0 0),(10 10))"


def test_transformations(sql):
    back = "ST_Transform(ST_Transform(SetSrid(MakePoint(2.5, 48.5), 4326), 3857), 4326)"
    assert sql(f"round(ST_X({back}), 9)") == 2.5
    assert sql(f"round(ST_Y({back}), 9)") == 48.5
    with pytest.raises(Exception, match="no transformation"):
        sql("ST_Transform(MakePoint(1, 2, 2154), 4326)")
    assert sql("ST_AsText(NormalizeLonLat(MakePoint(190, 100)))") == "POINT(10 80)"
    assert sql("ST_AsText(NormalizeLonLat(MakePoint(180, -95)))") == "POINT(0 -85)"
    assert sql("ST_AsText(ST_Shift_Longitude(MakePoint(-10, 5)))") == "POINT(350 5)"
    assert sql("ST_AsText(SwapCoords(ScaleCoords(MakePoint(1, 2), 3)))") == "POINT(6 3)"


def test_distance(sql):
    seg = "GeomFromText('LINESTRING(3 -1,3 4)')"
    assert sql(f"ST_Distance(MakePoint(0, 0), {seg})") == 3
    assert sql(f"ST_AsText(ShortestLine(MakePoint(0, 0), {seg}))") == "LINESTRING(0 0,3 0)"
    crossing = "GeomFromText('LINESTRING(0 0,4 4)')", "GeomFromText('LINESTRING(0 4,4 0)')"
    assert sql(f"ClosestPoint({crossing[0]}, {crossing[1]}) IS NULL AND ShortestLine({crossing[0]}, {crossing[1]}) IS NULL")
    assert sql("ST_AsText(ClosestPoint(MakePoint(1, 1), GeomFromText('LINESTRING(0 0,2 2)')))") == "POINT(1 1)"
    with pytest.raises(Exception, match="single points"):
        sql(f"ST_Area(Buffer({crossing[0]}, 1D))")
    assert sql(f"ST_Area(ST_Expand({crossing[0]}, 1D))") == 36.0
    assert sql(f"ST_Distance(MakePoint(1, 1), {DONUT})") == 0
    assert sql(f"ST_Distance(MakePoint(5, 5), {DONUT})") == 2


def test_places_clips_and_validity(sql):
    assert sql(f"ST_AsText(Line_Interpolate_Point({LINE}, 0.75))") == "POINT(10 5)"
    assert sql(f"ST_AsText(ST_Line_Substring({LINE}, 0.25, 0.75))") == "LINESTRING(5 0,10 0,10 5)"
    assert sql(f"ST_AsText(Line_Interpolate_Equidistant_Points({LINE}, 8))") == "MULTIPOINT((0 0),(8 0),(10 6))"
    assert sql(f"ST_AsText(PointOnSurface({DONUT}))") == "POINT(1.5 5)"
    assert sql(f"ST_AsText(Intersection({LINE}, BuildMbr(5, -5, 15, 5)))") == "LINESTRING(5 0,10 0,10 5)"
    assert sql(f"ST_Area(ST_Intersection({DONUT}, BuildMbr(0, 0, 5, 5)))") == 21
    assert sql(f"Intersection({LINE}, BuildMbr(50, 50, 60, 60))") is None
    with pytest.raises(Exception, match="convex"):
        sql(f"Intersection({LINE}, {DONUT})")
    assert sql(f"ST_IsValid({DONUT}) AND ST_IsSimple({LINE}) AND NOT ST_IsRing({LINE})") is True
    assert sql("ST_IsValid(GeomFromText('POLYGON((0 0,2 2,2 0,0 2,0 0))'))") is False
    assert sql("ST_IsSimple(GeomFromText('LINESTRING(0 0,2 0,1 0)'))") is False
    assert sql("ST_IsRing(GeomFromText('LINESTRING(0 0,2 0,2 2,0 0)'))") is True


def test_scalar_names(sql):
    assert sql("julianday(TIMESTAMP_NTZ'2000-01-01 12:00:00')") == 2451545.0
    assert sql("strftime('%Y/%m/%d %H:%M', TIMESTAMP_NTZ'2015-07-01 08:05:09')") == "2015/07/01 08:05"
    assert sql("datetime(TIMESTAMP_NTZ'2015-07-01 08:05:09')") == "2015-07-01 08:05:09"
    assert [sql(f"glob('{p}', 'a.b(c)')") for p in ("a.b*", "a?b(c)", "A*", "axb*", "*[bc])")] == [True, True, False, False, True]


def test_functions_leave_no_python_in_the_plan(spark, sql):
    register_functions(spark)
    plan = spark.sql(f"SELECT ST_Area({DONUT}), Intersects(MakePoint(id, id), {DONUT}) FROM range(3)")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_names_are_defined_once():
    names = [n.lower() for names, *_ in definitions() for n in names]
    assert len(names) == len(set(names)) > 130


def test_srid_travels_with_edits(spark, wkt):
    g = wkt((1, "LINESTRING(0 0,1 1)")).select(F.expr(x.set_srid("geom", 2154)).alias("g"))
    for e in (x.translate("g", "1", "1"), x.reverse_line("g"), x.envelope("g"), x.cast_multi("g"), x.nth_vertex("g", "1")):
        assert g.select(F.expr(f"({e}).srid").alias("s")).first().s == 2154


def test_glob_sets(spark):
    register_functions(spark)
    row = spark.sql("SELECT glob('[^ab]*', 'apple') AS a, glob('[^ab]*', 'cherry') AS b, glob('[a-c]?', 'b1') AS c, glob('a^b', 'a^b') AS d").first()
    assert (row.a, row.b, row.c, row.d) == (False, True, True, True)
