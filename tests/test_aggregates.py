"""Group aggregates, tracks and ids."""

import math
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators import aggregates as ag
from lamina.operators import lines, ordered, validity
from lamina.plans.fixtures import layer, rows

ORDER = ["ts", "event_id"]


def test_dissolve_keeps_area_and_holes(spark):
    cells = layer(spark, SF, "nation_poly").filter("fid <> 12").withColumn("g", F.lit(1))
    merged = ag.dissolve(cells, ["g"])
    got = merged.select(F.expr("size(geom.parts[0].rings)").alias("rings"), F.expr(x.area("geom")).alias("a")).collect()
    assert [tuple(r) for r in got] == [(2, 960_000.0)]


def test_dissolve_separates_squares_that_meet_at_a_corner(wkt):
    two = wkt((1, "POLYGON((0 0,1 0,1 1,0 1,0 0))"), (2, "POLYGON((1 1,2 1,2 2,1 2,1 1))")).withColumn("g", F.lit("a"))
    assert sorted(r.a for r in ag.dissolve(two, ["g"]).select(F.expr(x.area("geom")).alias("a")).collect()) == [1.0, 1.0]


def test_dissolve_gives_each_hole_to_its_own_ring(spark, wkt):
    frame = "POLYGON(({0} 0,{1} 0,{1} 3,{0} 3,{0} 0),({2} 1,{2} 2,{3} 2,{3} 1,{2} 1))"
    far = wkt((1, frame.format(0, 3, 1, 2)), (2, frame.format(10, 13, 11, 12))).withColumn("g", F.lit(0))
    got = ag.dissolve(far, ["g"]).select(F.expr("size(geom.parts[0].rings)").alias("n"), F.expr(x.area("geom")).alias("a"))
    assert [tuple(r) for r in got.collect()] == [(2, 8.0), (2, 8.0)]


def test_polygonize_finds_the_faces(wkt):
    net = wkt((1, "LINESTRING(0 0,4 0,4 4,0 4,0 0)"), (2, "LINESTRING(0 0,4 4)"), (3, "LINESTRING(4 4,9 9)")).withColumn("g", F.lit(1))
    faces = ag.polygonize(net, ["g"]).select(F.expr(x.area("geom")).alias("a")).collect()
    assert sorted(r.a for r in faces) == [8.0, 8.0]


def test_ring_of_many_edges(spark):
    n = 700
    pts = [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    edges = spark.createDataFrame([(1, *pts[i], *pts[(i + 1) % n]) for i in range(n)], "g int, x1 double, y1 double, x2 double, y2 double")
    ring = ag.trace_rings(edges, ["g"]).first()
    assert ring.n == n and len(ring.pts) == n + 1 and ring.pts[0] == ring.pts[-1]
    steps = {round(math.dist((p.x, p.y), (q.x, q.y)), 9) for p, q in zip(ring.pts, ring.pts[1:])}
    assert len(steps) == 1  # every step goes to the neighbour


def test_convex_hull_is_brute_force(spark):
    rnd = random.Random(9)
    pts = [(i, i % 3, float(rnd.randint(0, 40)), float(rnd.randint(0, 40))) for i in range(400)]
    df = spark.createDataFrame(pts, "fid long, g int, x double, y double").withColumn("geom", F.expr(x.point("x", "y")))
    for r in ag.convex_hull(df, "g").collect():
        ring = [(p.x, p.y) for p in r.geom.parts[0].rings[0]]
        assert len(ring) == r.n + 1
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            side = [(bx - ax) * (py - ay) - (by - ay) * (px - ax) for _, g, px, py in pts if g == r.g]
            assert min(side) >= 0  # all points on the left of every hull edge
        assert set(ring) <= {(px, py) for _, g, px, py in pts if g == r.g}


def test_hull_of_few_points(wkt):
    df = wkt((1, "POINT(1 1)"), (2, "LINESTRING(0 0,2 2)")).withColumn("g", F.col("fid"))
    got = {r.g: (r.n, r.t) for r in ag.convex_hull(df, "g").select("g", "n", F.expr(x.to_wkt("geom")).alias("t")).collect()}
    assert got == {1: (1, "POINT(1 1)"), 2: (2, "LINESTRING(0 0,2 2)")}


def test_collect_and_its_summary_agree(spark, wkt):
    df = wkt((1, "POINT(0 0)"), (2, "POINT(1 1)"), (3, "LINESTRING(0 0,1 1)"), (4, "POLYGON((0 0,1 0,1 1,0 0))")).withColumn("g", F.expr("fid div 3"))
    made = ag.collect(df, ["g"]).select("g", "geom.gtype", F.size("geom.parts").alias("n_parts"), F.expr(x.n_points("geom")).alias("n_points"))
    said = ag.collect_summary(df, ["g"]).select("g", "gtype", "n_parts", "n_points")
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, said.collect())) == [(0, 4, 2, 2), (1, 0, 2, 6)]
    # pieces of any size are the group, in order
    one = ag.collect(df, ["g"], piece_parts=1).select("g", "piece", "geom.gtype", F.expr(x.to_wkt("geom")).alias("t"))
    assert sorted((r.g, r.piece, r.gtype) for r in one.collect()) == [(0, 0, 4), (0, 1, 4), (1, 0, 0), (1, 1, 0)]
    assert {r.t for r in one.filter("g = 0").collect()} == {"MULTIPOINT((0 0))", "MULTIPOINT((1 1))"}


@pytest.mark.parametrize("parts", [1, 3])
def test_groups_are_numbered_over_ranges(spark, parts):
    """A group that holds most rows, small ones and a missing one, whatever the ranges."""
    data = [("a", i) for i in range(500)] + [(None, i) for i in range(20)] + [(f"g{i % 7}", i) for i in range(60)]
    df = spark.createDataFrame(data, "k string, i long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts * 8))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered.group_numbers(df, ["k"], ["i"], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for k in {k for k, _ in data}:
        mine = sorted((r.n, r.i) for r in got if r.k == k)
        assert [i for _, i in mine] == sorted(i for q, i in data if q == k) and [n for n, _ in mine] == list(range(len(mine)))


@pytest.mark.parametrize("rows_per_task", [5, 60])
def test_cut_tracks_give_the_same_steps(spark, rows_per_task):
    events = rows(spark, SF, "event_point")

    def steps(**kw):
        df = lines.track_steps(events, ORDER, **kw)
        return sorted((r.fid, r.seq, r.event_id, round(r.step or 0, 6), round(r.dist, 4)) for r in df.collect())

    assert steps(track_rows=rows_per_task) == steps()


def test_make_line_and_tracks_agree(spark):
    events = rows(spark, SF, "event_point")
    made = lines.make_line(events, ORDER).select("fid", F.expr(x.n_points("geom")).alias("n"), F.round(F.expr(x.length("geom")), 4).alias("l"))
    said = lines.track_summary(events, ORDER).select("fid", "n", F.round("length", 4).alias("l"))
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, said.collect()))
    pieces = lines.make_line(events, ORDER, piece_points=3)
    assert pieces.filter(F.expr(x.n_points("geom")) > 4).count() == 0
    whole = pieces.groupBy("fid").agg((F.sum(F.expr(x.n_points("geom"))) - F.count("*") + 1).alias("n"), F.round(F.sum(F.expr(x.length("geom"))), 4).alias("l"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, said.collect()))


def test_build_area_leaves_out_what_lies_in_holes(wkt):
    def ring(a, b):
        return f"LINESTRING({a} {a},{b} {a},{b} {b},{a} {b},{a} {a})"

    net = wkt((1, ring(0, 20)), (2, ring(1, 19)), (3, ring(2, 18)), (4, ring(3, 17)), (5, ring(30, 40)), (6, ring(31, 32)), (7, ring(33, 34)), (8, "LINESTRING(0 0,20 20)")).filter("fid < 8").withColumn("g", F.lit(None).cast("string"))
    got = sorted((r.n, r.a) for r in ag.build_area(net, ["g"]).select(F.expr("size(geom.parts[0].rings)").alias("n"), F.expr(x.area("geom")).alias("a")).collect())
    assert got == [(2, 60.0), (2, 76.0), (3, 98.0)]
    faces = sorted((r.n, r.a) for r in ag.polygonize(net, ["g"]).select(F.expr("size(geom.parts[0].rings)").alias("n"), F.expr(x.area("geom")).alias("a")).collect())
    assert faces == [(1, 1.0), (1, 1.0), (1, 196.0), (2, 60.0), (2, 68.0), (2, 76.0), (3, 98.0)]


def test_positions_along_a_line(wkt):
    df = wkt((1, "LINESTRING(0 0,10 0,10 10)"))

    def text(e):
        return df.select(F.expr(e).alias("g")).select(F.expr(x.to_wkt("g")).alias("t")).first().t

    assert text(x.interpolate_point("geom", "0.75D")) == "POINT(10 5)"
    assert text(x.interpolate_point("geom", "0D")) == "POINT(0 0)"
    assert text(x.interpolate_point("geom", "1D")) == "POINT(10 10)"
    assert text(x.interpolate_point("geom", "1.5D")) is None
    assert text(x.substring("geom", "0.25D", "0.75D")) == "LINESTRING(5 0,10 0,10 5)"
    assert text(x.equidistant_points("geom", "6D")) == "MULTIPOINT((0 0),(6 0),(10 2),(10 8))"


def test_places_on_a_long_line(spark):
    """100,000 vertices along a line, in time that grows with them."""
    n = 100_000
    df = spark.range(1).select(F.expr(x.line(f"transform(sequence(0, {n - 1}), i -> {x.vertex('CAST(i AS DOUBLE)', 'CAST(i % 2 AS DOUBLE)')})")).alias("geom"))
    many = df.select(F.expr(x.equidistant_points("geom", "1.5D")).alias("g"), F.expr(x.interpolate_point("geom", "0.5D")).alias("m"), F.expr(x.substring("geom", "0.25D", "0.75D")).alias("s"))
    got = many.select(F.expr("size(g.parts)").alias("n"), F.expr("m.parts[0].rings[0][0].x").alias("x"), F.expr("size(s.parts[0].rings[0])").alias("k")).first()
    assert got.n == math.floor((n - 1) * math.sqrt(2) / 1.5) + 1 and abs(got.x - (n - 1) / 2) < 1e-6 and abs(got.k - n / 2) <= 2


def test_interpolated_ends_are_the_ends(spark):
    events = rows(spark, SF, "event_point")
    got = lines.interpolate_tracks(events, ORDER, [0.0, 1.0])
    ends = events.groupBy("fid").agg(F.min_by(F.struct("x", "y"), F.struct(*ORDER)).alias("s"), F.max_by(F.struct("x", "y"), F.struct(*ORDER)).alias("e"),
                                     F.count("*").alias("n")).filter("n > 1")
    joined = got.join(ends, "fid").withColumn("want", F.expr("IF(fraction = 0, s, e)"))
    assert got.count() == 2 * ends.count()
    assert joined.filter("abs(x - want.x) > 1e-6 OR abs(y - want.y) > 1e-6").count() == 0


def test_dense_ids(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    got = ordered.dense_ids(df, ["k"])
    assert got.filter("fid <> k").count() == 0 and got.count() == 5000
    read_order = ordered.dense_ids(df)
    assert read_order.agg(F.min("fid"), F.max("fid"), F.countDistinct("fid")).first() == (0, 4999, 5000)


def test_defects(wkt):
    bad = wkt((1, "POLYGON((0 0,2 0,2 2,0 2,0 0))"), (2, "POLYGON((0 0,2 2,2 0,0 2,0 0))"), (3, "LINESTRING(0 0,2 0,1 0)"), (4, "POLYGON((0 0,1 0,2 0,0 0))"),
              (5, "LINESTRING(0 0,1 1,2 0)"))
    got = {(r.fid, r.defect) for r in validity.defects(bad).collect()}
    assert got == {(2, "self_crossing"), (2, "zero_area"), (3, "self_crossing"), (4, "self_crossing"), (4, "zero_area")}
    valid = {r.fid: (r.is_valid, r.is_simple, r.is_closed) for r in validity.validity(bad).collect()}
    assert valid[1] == (True, True, True) and valid[5] == (True, True, False) and valid[3] == (False, False, False)


def test_holes_outside_across_and_over_each_other(wkt):
    shell = "(0 0,9 0,9 9,0 9,0 0)"
    odd = wkt((1, f"POLYGON({shell},(1 1,1 2,2 2,2 1,1 1))"), (2, f"POLYGON({shell},(20 20,20 21,21 21,21 20,20 20))"), (3, f"POLYGON({shell},(8 8,8 10,10 10,10 8,8 8))"), (4, f"POLYGON({shell},(1 1,1 3,3 3,3 1,1 1),(2 2,2 4,4 4,4 2,2 2))"),
              (5, f"POLYGON({shell},(1 1,1 8,8 8,8 1,1 1),(2 2,2 4,4 4,4 2,2 2))"), (6, f"POLYGON({shell},(1 1,1 3,3 3,3 1,1 1),(3 3,3 4,4 4,4 3,3 3))"), (7, f"POLYGON({shell},(0 0,1 2,2 1,0 0))"), (8, f"POLYGON({shell},(1 1,1 2,2 2,2 1,1 1),(1 1,1 2,2 2,2 1,1 1))"),
              (9, "POLYGON((0 0,9 0,9 9,5 1,0 9,0 0),(4 8,6 8,5 2,4 8))"))
    found = {(r.fid, r.defect) for r in validity.defects(odd).collect()}
    outside, overlapping = validity._holes(validity.ring_table(odd))  # by runs, as for long rings
    assert {(r.fid, "hole_outside") for r in outside.collect()} | {(r.fid, "holes_overlap") for r in overlapping.collect()} == found
    assert found == {(2, "hole_outside"), (3, "hole_outside"), (4, "holes_overlap"), (5, "holes_overlap"), (8, "holes_overlap"), (9, "hole_outside")}
    valid = {r.fid: r.v for r in odd.select("fid", F.expr(x.is_valid("geom")).alias("v")).collect()}
    assert valid == {f: f in (1, 6, 7) for f in range(1, 10)}


def test_hull_of_one_geometry(spark, wkt):
    rnd = random.Random(3)
    for n in (1, 2, 3, 4, 60):
        pts = [(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(n)]
        df = wkt((1, "MULTIPOINT(" + ",".join(f"({a} {b})" for a, b in pts) + ")"))
        each = df.select(F.expr(x.to_wkt(f"({x.convex_hull('geom')})")).alias("t")).first().t
        grouped = ag.convex_hull(df.withColumn("g", F.lit(1)), "g").select(F.expr(x.to_wkt("geom")).alias("t")).first().t
        assert each == grouped
    line = wkt((1, "LINESTRING(0 0,1 1,3 3)")).select(F.expr(x.to_wkt(f"({x.convex_hull('geom')})")).alias("t")).first().t
    assert line == "LINESTRING(0 0,3 3)"


def test_hull_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(ag, "HULL_POINTS", 8)
    n = 300
    df = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("fid"), F.expr(x.point(f"cos(2 * pi() * id / {n})", f"sin(2 * pi() * id / {n})")).alias("geom"))
    got = ag.convex_hull(df, "g").first()
    assert got.n == n and abs(got.area - n / 2 * math.sin(2 * math.pi / n)) < 1e-9


def test_hull_of_a_missing_group(spark, wkt):
    layer = wkt((1, "POINT(0 0)"), (2, "POINT(1 0)"), (3, "POINT(0 1)")).withColumn("k", F.lit(None).cast("string"))
    assert [(r.k, r.n, r.area) for r in ag.convex_hull(layer, "k").collect()] == [(None, 3, 0.5)]


def test_rings_of_a_missing_group_are_traced(spark):
    edges = spark.sql("""
        SELECT grp, x1, y1, x2, y2 FROM VALUES ('a'), (CAST(NULL AS STRING)) AS g(grp)
        CROSS JOIN VALUES (0D, 0D, 2D, 0D), (2D, 0D, 0D, 1D), (0D, 1D, 0D, 0D) AS e(x1, y1, x2, y2)""")
    assert sorted((r.grp or "", r.n, r.area) for r in ag.trace_rings(edges, ["grp"]).collect()) == [("", 3, 1.0), ("a", 3, 1.0)]
