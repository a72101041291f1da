"""Joins by place against brute force, on every code path."""

import math
import random

import pytest
from conftest import SF, pairs
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators import clip, grid
from lamina.operators import spatial as sp
from lamina.operators.packed import Tree, anchored
from lamina.operators.tables import polygon_pieces
from lamina.plans.fixtures import layer, rows

PATHS = {"default": {}, "shuffled": {"small_bytes": 0}, "salted": {"small_bytes": 0, "hot_rows": 20}}


def boxes(spark, seed, n, points=0.2):
    """Boxes of very different sizes, some of them points, many in one crowded corner."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        crowded = rnd.random() < 0.4
        px, py = (rnd.uniform(-1, 1), rnd.uniform(-1, 1)) if crowded else (rnd.uniform(-500, 500), rnd.uniform(-500, 500))
        side = 0.0 if rnd.random() < points else 10 ** rnd.uniform(-3, 2.5)
        out.append((i, px, py, px + side * rnd.random(), py + side))
    return out, spark.createDataFrame(out, "fid long, xmin double, ymin double, xmax double, ymax double")


def meets(a, b, d=0.0):
    return a[1] - d <= b[3] and a[3] + d >= b[1] and a[2] - d <= b[4] and a[4] + d >= b[2]


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("reach", [0.0, 7.5])
def test_grid_join_is_the_theta_join(spark, path, reach):
    ra, a = boxes(spark, 1, 300)
    rb, b = boxes(spark, 2, 200)
    found = grid.box_pairs(a, b, reach=reach, **PATHS[path])
    expected = {(p[0], q[0]) for p in ra for q in rb if meets(p, q, reach)}
    assert found.count() == len(expected)  # no duplicates
    assert pairs(found) == expected


@pytest.mark.parametrize("path", PATHS)
def test_points_meet_points_in_equal_places_only(spark, path):
    _, a = boxes(spark, 1, 50, points=1.0)
    found = grid.box_pairs(a, a.union(a.withColumn("fid", F.col("fid") + 100)), **PATHS[path])
    assert pairs(found) == {(i, i) for i in range(50)} | {(i, i + 100) for i in range(50)}


def test_hot_key_is_split(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("l"))
    right = spark.range(30).select((F.col("id") % 3).cast("int").alias("k"), F.col("id").alias("r"))
    joined = grid.salted_join(left, right, ["k"], hot_rows=50)
    assert joined.count() == joined.distinct().count() == 10_000


def star(rnd, cx, cy, n):
    """A simple polygon with n corners around a centre."""
    pts = []
    for i in range(n):
        r, t = rnd.uniform(3, 20), 2 * math.pi * i / n
        pts.append((round(cx + r * math.cos(t), 3), round(cy + r * math.sin(t), 3)))
    return pts


def inside(px, py, pts):
    hit = False
    for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]):
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def stars(spark, seed, n, corners):
    rnd = random.Random(seed)
    shapes = {i: star(rnd, rnd.uniform(0, 100), rnd.uniform(0, 100), corners) for i in range(n)}
    text = [(i, "POLYGON((" + ",".join(f"{px} {py}" for px, py in [*p, p[0]]) + "))") for i, p in shapes.items()]
    df = spark.createDataFrame(text, "fid long, t string").select("fid", F.expr(x.from_wkt("t")).alias("geom"))
    return shapes, df


@pytest.mark.parametrize("corners", [7, 150])  # whole, and sliced into bands
def test_point_in_polygon_is_brute_force(spark, corners):
    shapes, polys = stars(spark, 3, 25, corners)
    rnd = random.Random(4)
    pts = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(400)]
    found = sp.point_in_polygon(spark.createDataFrame(pts, "fid long, x double, y double"), polys)
    assert pairs(found) == {(i, k) for i, px, py in pts for k, p in shapes.items() if inside(px, py, p)}
    assert found.count() == len(pairs(found))
    pieces = polygon_pieces(polys).count()
    assert pieces == 25 if corners == 7 else pieces > 250


def test_band_borders_are_met_once(spark):
    saw = [(i, i % 2) for i in range(100)]
    ring = ",".join(f"{px} {py}" for px, py in [(0, 64), *[(px + 1, py) for px, py in saw], (100, 64), (0, 64)])
    poly = spark.createDataFrame([(1, f"POLYGON(({ring}))")], "fid long, t string").select("fid", F.expr(x.from_wkt("t")).alias("geom"))
    cuts = [r.ymin for r in polygon_pieces(poly).collect()] + [64.0]
    pts = spark.createDataFrame([(i, 50.0, float(y)) for i, y in enumerate(cuts)], "fid long, x double, y double")
    found = sp.point_in_polygon(pts, poly).collect()
    assert len(found) == len({r.a_fid for r in found}) >= len(cuts) - 1


def test_cut_up_features_give_the_same_pairs(spark, monkeypatch):
    _, a = stars(spark, 5, 30, 9)
    _, b = stars(spark, 6, 30, 12)
    whole = pairs(sp.intersecting_pairs(a, b))
    near = {(r.a_fid, r.b_fid): round(r.dist, 9) for r in sp.near_pairs(a, b, 15.0).collect()}
    monkeypatch.setattr(sp.outlines, "RUN", 3)
    monkeypatch.setattr(sp.edge_runs, "__defaults__", (("fid",), "geom", 4))
    assert pairs(sp.intersecting_pairs(a, b)) == whole
    assert {(r.a_fid, r.b_fid): round(r.dist, 9) for r in sp.near_pairs(a, b, 15.0).collect()} == near
    assert whole <= set(near)
    assert {p for p, d in near.items() if d == 0} == whole


ODD_SHAPES = [
    (1, "POLYGON((0 0,10 0,10 10,0 10,0 0))"), (2, "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,2 8,8 8,8 2,2 2))"), (3, "POLYGON((2 2,8 2,8 8,2 8,2 2))"), (4, "POLYGON((10 0,20 0,20 10,10 10,10 0))"),
    (5, "POLYGON((3 3,4 3,4 4,3 4,3 3))"), (6, "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((9 9,12 9,12 12,9 12,9 9)))"), (7, "LINESTRING(0 0,10 0)"), (8, "LINESTRING(-5 5,15 5)"), (9, "LINESTRING(1 1,9 1)"),
    (10, "LINESTRING(5 0,5 20)"), (11, "LINESTRING(0 0,10 0,10 10,0 10,0 0)"), (12, "MULTILINESTRING((2 0,4 0),(6 0,12 0))"), (13, "POINT(5 5)"), (14, "POINT(0 0)"), (15, "MULTIPOINT((5 0),(5 3),(50 50))"),
    (16, "POINT(5 0)"), (17, "LINESTRING(5 5,5 9)"), (18, "POLYGON((10 10,11 10,11 11,10 11,10 10))"), (19, "LINESTRING(10 0,30 0)"), (20, "POLYGON((0 0,5 -5,10 0,10 10,5 15,0 10,0 0))"), (21, "LINESTRING(3 3,3 4,4 4)"),
    (22, "POINT(100 100)"), (23, "LINESTRING(0 20,20 0)"), (24, "POLYGON((4 0,6 0,6 10,4 10,4 0))"), (25, "POLYGON((0 0,10 0,10 5,0 5,0 0))"), (26, "MULTILINESTRING((1 0,1 10),(3 0,3 10),(0 4,10 4))"),
]
RELATIONS = ("intersects", "within", "contains", "touches", "overlaps", "crosses")


@pytest.fixture(scope="module")
def odd_layer(spark):
    """Shapes that meet in all ways, and stars with common vertices; with all relations, each pair whole in a row."""
    _, a = stars(spark, 31, 4, 9)
    odd = spark.createDataFrame(ODD_SHAPES, "fid long, t string").select("fid", F.expr(x.from_wkt("t")).alias("geom"))
    near = a.select((F.col("fid") + 100).alias("fid"), F.expr(x.translate("geom", "-45D", "-45D")).alias("geom"))
    layer_ = odd.unionByName(near).unionByName(near.filter("fid < 103").withColumn("fid", F.col("fid") + 100)).cache()
    both = grid.candidate_pairs(sp.shapes(layer_), sp.shapes(layer_)).select("a_fid", "b_fid", *(F.expr(sp.r.predicate(n)).alias(n) for n in RELATIONS))
    found = both.collect()
    return layer_, {n: {(r.a_fid, r.b_fid) for r in found if r[n]} for n in RELATIONS}


@pytest.mark.parametrize("run, path", [(1, "default"), (3, "default"), (1, "salted")])
def test_runs_of_outlines_give_the_same_relations(spark, odd_layer, monkeypatch, run, path):
    """All pairs by the bits of their runs, with runs of one edge and bands of two."""
    odd, whole = odd_layer
    assert all(len(p) > 3 for p in whole.values())
    monkeypatch.setattr(sp.outlines, "PIECE_EDGES", 2)
    bits = sp.outlines.pair_bits(odd, odd, None, run, **PATHS[path])
    rows_ = bits.select("a_fid", "b_fid", *(F.expr(sp.outlines.holds(n)).alias(n) for n in RELATIONS)).collect()
    for n in RELATIONS:
        found = [(r.a_fid, r.b_fid) for r in rows_ if r[n]]
        assert set(found) == whole[n] and len(found) == len(whole[n]), n


def test_features_beside_big_ones_stay_whole(odd_layer, monkeypatch):
    odd, whole = odd_layer
    monkeypatch.setattr(sp.outlines, "RUN", 5)
    assert pairs(sp.related_pairs(odd, odd, "touches")) == whole["touches"]


def test_two_long_outlines_finish(spark):
    """Two combs of 4,000 edges whose teeth cross each other."""
    n = 1000
    one = f"transform(sequence(0, {2 * n}), i -> {x.vertex('CAST(i AS DOUBLE)', 'IF(i % 2 = 0, 0D, 10D)')})"
    two = f"transform(sequence(0, {2 * n}), i -> {x.vertex('CAST(i AS DOUBLE)', 'IF(i % 2 = 0, 10D, 0.5D)')})"
    shape = spark.range(1).select(F.lit(1).cast("long").alias("fid"), F.expr(x.polygon(f"array(concat({one}, array({x.vertex(f'{2 * n}D', '-5D')}, {x.vertex('0D', '-5D')}, {x.vertex('0D', '0D')})))")).alias("geom"))
    other = spark.range(1).select(F.lit(2).cast("long").alias("fid"), F.expr(x.polygon(f"array(concat({two}, array({x.vertex(f'{2 * n}D', '20D')}, {x.vertex('0D', '20D')}, {x.vertex('0D', '10D')})))")).alias("geom"))
    bits = sp.outlines.pair_bits(shape, other).first()
    assert bits.met and bits.a_bits & 3 == 3 and bits.b_bits & 3 == 3


def test_relations_agree_with_each_other(spark):
    _, a = stars(spark, 7, 40, 6)
    rel = {n: pairs(sp.related_pairs(a, a, n, 2, 2)) for n in ("intersects", "within", "contains", "touches", "overlaps")}
    assert rel["contains"] == {(q, p) for p, q in rel["within"]}
    assert rel["touches"] | rel["overlaps"] | rel["within"] | rel["contains"] == rel["intersects"]
    assert not rel["touches"] & rel["overlaps"] and not rel["overlaps"] & rel["within"]
    assert {(i, i) for i in range(40)} <= rel["within"]
    met = sp.intersecting_pairs(a, a).filter("a_fid <> b_fid")
    alone = {r.fid for r in sp.without_match(a, met).collect()}
    assert alone == set(range(40)) - {p for p, q in rel["intersects"] if p != q}


def test_nearest_is_brute_force(spark):
    rnd = random.Random(8)
    mine = [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(40)] + [(99, 900.0, 900.0)]
    other = [(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(60)]

    def pts(data):
        return spark.createDataFrame(data, "fid long, x double, y double").select("fid", F.expr(x.point("x", "y")).alias("geom"))

    found = {r.a_fid: (r.b_fid, round(r.dist, 9)) for r in sp.nearest(pts(mine), pts(other), 0, 0).collect()}
    expected = {}
    for i, px, py in mine:
        d, k = min((math.hypot(px - qx, py - qy), j) for j, qx, qy in other)
        expected[i] = (k, round(d, 9))
    assert found == expected


@pytest.mark.parametrize("small_bytes", [64 << 20, 0])
def test_nearest_compares_few_pairs_however_crowded(spark, small_bytes):
    """A cluster, a far cluster and outliers: brute force, and under 50 pairs a feature."""
    rnd = random.Random(9)
    mine = [(i, rnd.gauss(0, 1e-3), rnd.gauss(0, 1e-3)) for i in range(700)] + [(1000 + i, rnd.uniform(-1e6, 1e6), rnd.uniform(-1e6, 1e6)) for i in range(60)] + [(2000 + i, 5.0, 5.0) for i in range(200)]
    other = [(i, rnd.gauss(0, 1e-3), rnd.gauss(0, 1e-3)) for i in range(700)] + [(1000 + i, 1e5 + rnd.random(), rnd.random()) for i in range(500)] + [(5000, 1e6, 1e6)] + [(6000 + i, 1e5 + 0.5, 0.5) for i in range(30)]

    def pts(data):
        return spark.createDataFrame(data, "fid long, x double, y double").select("fid", F.expr(x.point("x", "y")).alias("geom"))

    pairs_of = Tree(anchored(pts(other))).near(anchored(pts(mine)), small_bytes=small_bytes)
    counts = pairs_of.groupBy("a_fid").count().agg(F.count("*").alias("n"), F.max("count").alias("most"), F.sum("count").alias("all")).first()
    assert counts.n == len(mine) and counts.most < 50 and counts["all"] < 20 * len(mine)
    found = {r.a_fid: (r.b_fid, r.dist) for r in sp.nearest(pts(mine), pts(other), 0, 0, small_bytes=small_bytes).collect()}
    expected = {}
    for i, px, py in mine:
        d2, k = min(((px - qx) * (px - qx) + (py - qy) * (py - qy), j) for j, qx, qy in other)
        expected[i] = (k, math.sqrt(d2))
    assert found == expected


def test_nearest_of_shapes_is_the_least_of_all_distances(spark):
    _, a = stars(spark, 21, 40, 5)
    _, b = stars(spark, 22, 60, 6)
    every = sp.near_pairs(a, b, 1000.0).groupBy("a_fid").agg(F.min(F.struct("dist", "b_fid")).alias("m"))
    assert {(r.a_fid, r.b_fid, r.dist) for r in sp.nearest(a, b).collect()} == {(r.a_fid, r.m.b_fid, r.m.dist) for r in every.collect()}


def test_nearest_to_nothing_is_empty(spark):
    pts = spark.createDataFrame([(1, 0.0, 0.0)], "fid long, x double, y double").select("fid", F.expr(x.point("x", "y")).alias("geom"))
    assert sp.nearest(pts, pts.filter("fid > 5")).count() == 0


def test_overlap_and_rest_make_the_whole(spark):
    tri, cells = layer(spark, SF, "supplier_tri"), layer(spark, SF, "nation_poly")
    total = tri.agg(F.sum(F.expr(x.area("geom"))).alias("s")).first().s
    got = clip.overlap_areas(tri, cells).agg(F.sum("overlap").alias("s")).first().s
    assert abs(got - total) < 1e-6  # the cells cover all triangles


def test_overlap_needs_convex_cutters(spark, wkt):
    with pytest.raises(Exception, match="convex"):
        clip.overlap_areas(wkt((1, "POLYGON((0 0,9 0,9 9,0 9,0 0))")), wkt((2, "POLYGON((0 0,6 0,1 1,0 6,0 0))"))).collect()
    with pytest.raises(ValueError, match="convex"):
        clip.window_edges([(0, 0), (6, 0), (1, 1), (0, 6)])


def test_clip_lines_and_mixed_windows(wkt):
    zig = wkt((1, "LINESTRING(-1 1,1 1,1 3,3 3,3 1,5 1)"), (2, "LINESTRING(9 9,10 10)"), (3, "POINT(2 2)"), (4, "POINT(4 4)"))
    cut = clip.clip_layer(zig, [(0, 0), (0, 2), (4, 2), (4, 0)]).select("fid", F.expr(x.to_wkt("geom")).alias("t")).orderBy("fid")
    assert [tuple(r) for r in cut.collect()] == [
        (1, "MULTILINESTRING((0 1,1 1,1 2),(3 2,3 1,4 1))"), (3, "POINT(2 2)")]


def test_clip_of_concave_shapes_gives_simple_pieces(spark, wkt):
    """Pieces without bridges: a U, a comb with a hole, shapes that touch the window's lines; areas as by the ring method, on many stars."""
    shapes = wkt((1, "POLYGON((0 0,9 0,9 9,6 9,6 3,3 3,3 9,0 9,0 0))"), (2, "POLYGON((0 0,9 0,9 9,0 9,0 0),(4 4,4 8,5 8,5 4,4 4))"), (3, "POLYGON((0 0,9 0,9 9,0 9,0 0),(1 4.5,1 5.5,8 5.5,8 4.5,1 4.5))"),
                 (4, "POLYGON((0 4,2 6,4 4,6 6,8 4,8 9,0 9,0 4))"), (5, "POLYGON((0 20,1 20,1 21,0 20))"), (6, "POLYGON((1 4.5,2 4.5,2 5.5,1 5.5,1 4.5))"))
    band = [(-5, 4), (20, 4), (20, 6), (-5, 6)]
    cut = {r.fid: r.t for r in clip.clip_layer(shapes, band).select("fid", F.expr(x.to_wkt("geom")).alias("t")).collect()}
    pieces = {r.fid: (r.n, r.k, r.a) for r in clip.clip_layer(shapes, band).select("fid", F.size("geom.parts").alias("n"), F.expr(f"size({x.rings('geom')})").alias("k"), F.expr(x.area("geom")).alias("a")).collect()}
    assert pieces == {1: (2, 2, 12.0), 2: (2, 2, 16.0), 3: (1, 2, 11.0), 4: (3, 3, 8.0), 6: (1, 1, 1.0)}, cut
    valid = clip.clip_layer(shapes, band).select(F.expr(x.is_valid("geom")).alias("v"))
    assert all(r.v for r in valid.collect())
    _, many = stars(spark, 41, 60, 17)
    window = [(20, 20), (70, 25), (60, 80), (25, 60)]
    es = clip.window_edges(window)
    one = f"aggregate({x.rings('geom')}, 0D, (s, r) -> s + abs({x.ring_area('(' + x.clip_ring('r', es) + ')')}))"
    areas = clip.clip_layer(many, window).select("fid", F.expr(x.area("geom")).alias("a"), F.expr(x.is_valid("geom")).alias("v"), F.size("geom.parts").alias("n"))
    want = {r.fid: r.a for r in many.select("fid", F.expr(one).alias("a")).collect()}
    got = areas.collect()
    assert max(r.n for r in got) > 1 and all(r.v for r in got)
    assert all(abs(r.a - want.pop(r.fid)) < 1e-6 for r in got) and all(a < 1e-9 for a in want.values())


def test_snap_moves_only_near_vertices(wkt):
    lines = wkt((1, "LINESTRING(0 0,5 5.2)"), (2, "LINESTRING(50 50,60 60)"))
    ref = wkt((7, "MULTIPOINT((5 5),(5 5.5),(100 100))"))
    got = {r.fid: r.t for r in clip.snap(lines, ref, 0.4).select("fid", F.expr(x.to_wkt("geom")).alias("t")).collect()}
    assert got == {1: "LINESTRING(0 0,5 5)", 2: "LINESTRING(50 50,60 60)"}


def test_snap_compares_few_pairs_in_a_dense_reference(spark, wkt):
    rnd = random.Random(14)
    ref = [(i, rnd.random(), rnd.random()) for i in range(3000)]
    mine = [(i, rnd.uniform(-0.5, 1.5), rnd.uniform(-0.5, 1.5)) for i in range(300)]

    def pts(data):
        return spark.createDataFrame(data, "fid long, x double, y double").select("fid", F.expr(x.point("x", "y")).alias("geom"))

    near = clip.snap_pairs(pts(mine), pts(ref), 0.4)
    assert near.count() < 20 * len(mine)
    got = {r.fid: (r.x, r.y) for r in clip.snap(pts(mine), pts(ref), 0.4).select("fid", "geom.parts").selectExpr("fid", "parts[0].rings[0][0].x AS x", "parts[0].rings[0][0].y AS y").collect()}
    for i, px, py in mine:
        d2, qx, qy = min(((px - qx) ** 2 + (py - qy) ** 2, qx, qy) for _, qx, qy in ref)
        assert got[i] == ((qx, qy) if d2 <= 0.16 else (px, py))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("path", ["default", "shuffled", "salted"])
def test_no_nested_loops_and_no_python_in_spatial_joins(spark, path):
    opts = PATHS[path]
    pts, tri, box = rows(spark, SF, "customer_pt"), layer(spark, SF, "supplier_tri"), layer(spark, SF, "part_box")
    plans = [
        _plan(sp.point_in_polygon(pts.select("fid", "x", "y"), tri, **opts)), _plan(sp.intersecting_pairs(box, tri, **opts)),
        _plan(sp.related_pairs(box, tri, "overlaps", **opts)), _plan(sp.near_pairs(layer(spark, SF, "customer_pt"), tri, 5.0, **opts)),
        _plan(clip.overlap_areas(box, tri.filter("fid < 0").unionByName(tri), **opts)), _plan(grid.box_pairs(box, box, **opts)),
    ]
    for plan in plans:
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "Arrow" not in plan
        if path != "default":
            assert "SortMergeJoin" in plan


def test_box_joins_do_not_read_geometry(spark):
    plan = _plan(grid.box_pairs(layer(spark, SF, "part_box"), rows(spark, SF, "nation_poly")))
    assert "named_struct" not in plan


def test_places_of_features_that_meet_do_not_depend_on_the_path(spark, wkt, monkeypatch):
    a = wkt((1, "POINT(5 5)"), (2, "POINT(10 5)"), (3, "LINESTRING(-2 5,12 5)"), (4, "POINT(13 5)"), (5, "LINESTRING(0 12,10 12)"))
    b = wkt((9, "POLYGON((0 0,10 0,10 10,0 10,0 0))"))

    def found():
        return {r.a_fid: tuple(r)[2:] for r in sp.near_pairs(a, b, 3.0).collect()}

    whole = found()
    assert whole[1] == whole[3] == (0.0, None, None, None, None)
    assert whole[2] == (0.0, 10.0, 5.0, 10.0, 5.0) and whole[4] == (3.0, 13.0, 5.0, 10.0, 5.0)
    assert whole[5] == (2.0, 0.0, 12.0, 0.0, 10.0)
    monkeypatch.setattr(sp.outlines, "RUN", 0)
    monkeypatch.setattr(sp.edge_runs, "__defaults__", (("fid",), "geom", 1))
    assert found() == whole


def test_long_texts_are_not_broadcast(spark):
    rows = spark.range(100).select("id", F.expr("repeat('x', 10000)").alias("t"), F.expr("map('a', id)").alias("m"))
    assert grid._fits(rows.select("id"), 100, 1, 1 << 20)
    assert not grid._fits(rows.select("id", "t"), 100, 1, 900_000) and grid._fits(rows.select("id", "t"), 100, 1, 2_000_000)
    assert not grid._fits(rows.select("id", "m"), 100, 1, 1 << 30)


def test_levels_with_many_rows_keep_their_own_cells():
    assert grid._kept_levels({0: 40_000, 10: 960_000}, {0: 40_000, 10: 960_000}) == [0, 10]
    assert grid._kept_levels({0: 10, 10: 960}, {3: 2_000}) == [3, 10]
