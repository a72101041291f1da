"""Features of one shape are compared once: same pairs, and work that doesn't grow with the copies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators import copies, grid
from lamina.operators import spatial as sp


def _layer(spark, rows):
    return spark.createDataFrame(rows, "fid long, t string").select("fid", F.expr(x.from_wkt("t")).alias("geom"))


def _tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("room", [512, 7])  # ids of a row: one row a shape, and several
def test_copies_are_compared_once_and_all_handed_out(spark, monkeypatch, room):
    monkeypatch.setattr(copies, "COPIES", room)
    a = _layer(spark, [(i, f"POLYGON((0 0,{4 + i % 2} 0,4 4,0 4,0 0))") for i in range(60)] + [(70, None)])
    b = _layer(spark, [(i, f"LINESTRING(-1 {1 + i % 3},9 {1 + i % 3})") for i in range(40)] + [(3, "LINESTRING(-1 1,9 1)")])
    ids = [*range(40), 3]
    classes = sp.related_classes(a, b, "crosses", 2, 1)
    assert classes.count() == 6 if room == 512 else 6 < classes.count() < 60 * 41 / 5
    assert _tuples(sp.related_pairs(a, b, "crosses", 2, 1), "a_fid", "b_fid") == sorted(((i, j) for i in range(60) for j in ids), key=repr)
    near = sp.near_pairs(a, b, 50.0, 2, 1)
    assert near.count() == 60 * 41 and near.filter("dist <> 0").isEmpty()


def test_boxes_in_one_place_are_compared_once(spark):
    rnd = random.Random(1)
    data = [(i, float(k), float(k), k + 2.0, k + 2.0) for i, k in enumerate(rnd.choices(range(5), k=300))] + [(None, 0.0, 0.0, 2.0, 2.0), (7, None, None, None, None)]
    boxes = spark.createDataFrame(data, "fid long, xmin double, ymin double, xmax double, ymax double")
    placed = [r for r in data if r[1] is not None]
    expected = sorted(((p[0], q[0]) for p in placed for q in placed if abs(p[1] - q[1]) <= 2), key=repr)
    assert grid.box_classes(boxes, boxes).count() == 19
    assert _tuples(grid.box_pairs(boxes, boxes), "a_fid", "b_fid") == expected


def test_left_rows_and_rows_without_match(spark):
    pts = spark.createDataFrame([(1, 1.0, 1.0, "p"), (2, 1.0, 1.0, "q"), (2, 9.0, 9.0, "r"), (3, 8.0, 8.0, "s"), (None, 1.0, 1.0, "t")], "fid long, x double, y double, c string")
    polys = _layer(spark, [(i, "POLYGON((0 0,4 0,4 4,0 4,0 0))") for i in (1, 2)])
    plain = sp.left_spatial(pts, sp.point_in_polygon(pts, polys).drop("place"), ["c"])
    found = sp.left_classes(pts, sp.place_classes(pts, polys), ["c"])
    assert _tuples(found, "a_fid", "c", "b_fid") == _tuples(plain, "a_fid", "c", "b_fid")
    assert sp.left_classes(pts, sp.place_classes(pts, polys.filter("fid > 9")), ["c"]).filter("b_fid IS NULL").count() == 5
    spots = pts.select("fid", "c", F.expr(x.point("x", "y")).alias("geom"))
    assert _tuples(sp.disjoint_rows(spots, polys, 0, 2), "fid", "c") == _tuples(sp.without_match(spots, sp.intersecting_pairs(spots, polys)), "fid", "c")


def test_nearest_of_many_copies_is_the_smallest_id(spark):
    a = _layer(spark, [(i, f"POINT({i % 2} 0)") for i in range(50)])
    b = _layer(spark, [(100 - i, f"LINESTRING({i % 2} 1,{i % 2} 5)") for i in range(80)])
    assert _tuples(sp.nearest(a, b), "a_fid", "b_fid", "dist") == sorted(((i, 22 - i % 2, 1.0) if i % 2 == 0 else (i, 21, 1.0) for i in range(50)), key=repr)


def test_equal_outlines_meet_once(spark):
    a = _layer(spark, [(i, "POLYGON((0 0,4 0,4 4,0 4,0 0))") for i in range(30)])
    b = _layer(spark, [(i, "POLYGON((4 4,4 0,0 0,0 4,4 4))") for i in range(20)] + [(50, "POLYGON((4 4,4 0,0 0,4 4))")])
    assert _tuples(sp.equal_pairs(a, b), "a_fid", "b_fid") == sorted(((i, j) for i in range(30) for j in range(20)), key=repr)


def test_geometries_of_a_small_file_are_made_by_all_tasks(spark):
    from lamina.plans import fixtures, spatial

    sf = "/root/testdata/sf0.01"
    cores = spark.sparkContext.defaultParallelism
    made = spatial.layer(spark, sf, "part_box")
    assert made.select(F.spark_partition_id().alias("p")).distinct().count() == cores > 1
    assert _tuples(made, "fid", "p_size", "geom") == _tuples(fixtures.layer(spark, sf, "part_box"), "fid", "p_size", "geom")


def test_a_layer_is_read_and_packed_once_for_all_its_joins(spark, monkeypatch):
    calls = []
    packed = sp.packed
    monkeypatch.setattr(sp, "packed", lambda *args: calls.append(1) or packed(*args))
    lines = _layer(spark, [(i, f"LINESTRING(0 {i},9 {i})") for i in range(5)] + [(9, "LINESTRING(4 -1,4 9)")])
    assert _tuples(sp.related_pairs(lines, lines, "crosses", 1, 1), "a_fid", "b_fid") == sorted([*((i, 9) for i in range(5) if i), *((9, i) for i in range(5) if i), (0, 9), (9, 0)], key=repr)
    assert len(calls) == 1
    ready = sp.by_shape(lines)
    areas = _layer(spark, [(1, "POLYGON((3 -2,5 -2,5 2.5,3 2.5,3 -2))")])
    assert _tuples(sp.intersecting_pairs(ready, areas, 1, 2), "a_fid") == [(0,), (1,), (2,), (9,)]
    assert _tuples(sp.near_pairs(ready, ready, 1.0, 1, 1), "a_fid", "b_fid") == _tuples(sp.near_pairs(lines, lines.limit(9), 1.0, 1, 1), "a_fid", "b_fid")
    assert len(calls) == 5


def test_big_features_of_a_layer_that_is_ready(spark):
    ring = ",".join(f"{i} 0" for i in range(300)) + ",299 9,0 9,0 0"
    a = _layer(spark, [(1, f"POLYGON(({ring}))"), (2, "POLYGON((5 5,7 5,7 7,5 7,5 5))"), (3, None)])
    b = _layer(spark, [(i, f"LINESTRING({i} -3,{i} 12)") for i in (6, 100, 400)])
    expected = [(1, 100), (1, 6), (2, 6)]
    assert _tuples(sp.related_pairs(sp.by_shape(a), sp.by_shape(b), "intersects", 2, 1), "a_fid", "b_fid") == expected
    assert _tuples(sp.related_pairs(sp.by_shape(b), a, "crosses", 1, 2), "a_fid", "b_fid") == sorted(((j, i) for i, j in expected), key=repr)
    assert (1, 1) in _tuples(sp.intersecting_pairs(sp.by_shape(a), sp.by_shape(a)), "a_fid", "b_fid")


def test_rows_are_read_twice_to_be_packed(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(i):
        seen.add(1)
        return i, float(i % 2)

    rows = spark.createDataFrame(spark.sparkContext.range(600, numSlices=3).map(read), "fid long, x double")
    lists = copies.packed(rows, ["x"], copies=50)
    assert lists.selectExpr("sum(size(fid))", "count(*) > 6").first() == (600, True)
    assert seen.value == 1200


def test_rows_are_dealt_evenly_without_a_sort(spark):
    from lamina.operators.tables import spread

    rows = spark.range(4000, numPartitions=1).select(F.lit(7).alias("fid"))
    dealt = spread(rows)
    counts = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert dealt.columns == ["fid"] and sum(counts) == 4000 and len(counts) == spark.sparkContext.defaultParallelism
    assert "RoundRobin" not in dealt._jdf.queryExecution().executedPlan().toString()
