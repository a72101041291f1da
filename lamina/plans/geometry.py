"""Geometry columns: explode, edit, transform, measure and aggregate (rows E10-E15, J, F1-F6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions.registry import register_functions
from lamina.operators import aggregates as ag
from lamina.operators import clip, lines, validity
from lamina.operators.tables import edge_table, part_table, ring_table, vertex_table, with_bounds
from lamina.plans.catalog import query
from lamina.plans.fixtures import layer, rows, spread_rows, with_layers

# ---------------------------------------------------------------- E10-E15: aggregates over groups


@query("geo_extent", with_layers("supplier_tri") + """
    SELECT s_nationkey, min(x0) AS xmin, min(y0) AS ymin, max(x0 + w) AS xmax, max(y0 + h) AS ymax FROM supplier_tri GROUP BY s_nationkey""")
def geo_extent(spark, sf):
    return ag.extent(layer(spark, sf, "supplier_tri"), ["s_nationkey"])


# triangles and, for every third supplier, points
@query("geo_collect", with_layers("supplier_tri") + """
    SELECT s_nationkey, CASE WHEN min(fid % 3 = 0) = max(fid % 3 = 0) THEN max(CASE WHEN fid % 3 = 0 THEN 4 ELSE 6 END) ELSE 0 END AS gtype,
           count(*) AS n_parts, CAST(sum(CASE WHEN fid % 3 = 0 THEN 1 ELSE 4 END) AS BIGINT) AS n_points, 0 AS srid
    FROM supplier_tri GROUP BY s_nationkey""")
def geo_collect(spark, sf):
    mixed = layer(spark, sf, "supplier_tri").withColumn("geom", F.expr(f"IF(fid % 3 = 0, {x.point('x0', 'y0')}, geom)"))
    pieces = ag.collect(mixed, ["s_nationkey"], piece_parts=7)
    return pieces.groupBy("s_nationkey").agg(
        F.max("geom.gtype").alias("gtype"), F.sum(F.size("geom.parts")).alias("n_parts"), F.sum(F.expr(x.n_points("geom"))).alias("n_points"), F.max("geom.srid").alias("srid"))


# the collected geometries themselves, three parts a piece
@query("geo_collect_pieces", with_layers("supplier_tri") + """, n AS (
      SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY fid) - 1 AS i, CAST(x0 AS INT) AS a, CAST(y0 AS INT) AS b, CAST(x0 + w AS INT) AS c, CAST(y0 + h AS INT) AS d FROM supplier_tri)
    SELECT s_nationkey, CAST(i // 3 AS BIGINT) AS piece, 'MULTIPOLYGON(' || string_agg('((' || a || ' ' || b || ',' || c || ' ' || b || ',' || a || ' ' || d || ',' || a || ' ' || b || '))', ',' ORDER BY i) || ')' AS wkt
    FROM n GROUP BY s_nationkey, i // 3""")
def geo_collect_pieces(spark, sf):
    pieces = ag.collect(layer(spark, sf, "supplier_tri"), ["s_nationkey"], piece_parts=3)
    return pieces.select("s_nationkey", "piece", F.expr(x.to_wkt("geom")).alias("wkt"))


_STEPS = """
    SELECT fid, x, y, px, py, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS step, seq FROM (
      SELECT fid, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, row_number() OVER w AS seq FROM event_point
      WINDOW w AS (PARTITION BY fid ORDER BY ts, event_id)) AS t"""


@query("geo_makeline", with_layers("event_point") + f"""
    SELECT fid, count(*) AS n, round(coalesce(sum(step), 0), 4) AS length FROM ({_STEPS}) AS s GROUP BY fid""")
def geo_makeline(spark, sf):
    tracks = lines.make_line(rows(spark, sf, "event_point"), ["ts", "event_id"], piece_points=50)
    # neighbouring pieces share a vertex
    whole = tracks.groupBy("fid").agg((F.sum(F.expr(x.n_points("geom"))) - F.count(F.lit(1)) + 1).alias("n"), F.sum(F.expr(x.length("geom"))).alias("length"))
    return whole.select("fid", "n", F.round("length", 4).alias("length"))


# the lines themselves, four edges a piece
@query("geo_makeline_pieces", with_layers("event_point") + """, n AS (
      SELECT fid, CAST(x AS INT) AS x, CAST(y AS INT) AS y, row_number() OVER (PARTITION BY fid ORDER BY ts, event_id) - 1 AS i FROM event_point),
    p AS (SELECT fid, x, y, i, i // 4 AS piece FROM n UNION ALL SELECT fid, x, y, i, i // 4 - 1 FROM n WHERE i > 0 AND i % 4 = 0)
    SELECT fid, CAST(piece AS BIGINT) AS piece, 'LINESTRING(' || string_agg(x || ' ' || y, ',' ORDER BY i) || ')' AS wkt FROM p GROUP BY fid, piece HAVING piece = 0 OR count(*) > 1""")
def geo_makeline_pieces(spark, sf):
    pieces = lines.make_line(rows(spark, sf, "event_point"), ["ts", "event_id"], piece_points=4)
    return pieces.select("fid", "piece", F.expr(x.to_wkt("geom")).alias("wkt"))


@query("geo_dissolve", with_layers("nation_poly") + """, e AS (
      SELECT n_regionkey, xmin AS ax, ymin AS ay, xmax AS bx, ymin AS b_y FROM nation_poly UNION ALL
      SELECT n_regionkey, xmin, ymax, xmax, ymax FROM nation_poly UNION ALL
      SELECT n_regionkey, xmin, ymin, xmin, ymax FROM nation_poly UNION ALL
      SELECT n_regionkey, xmax, ymin, xmax, ymax FROM nation_poly),
    o AS (SELECT n_regionkey, ax, ay, bx, b_y FROM e GROUP BY ALL HAVING count(*) = 1)
    SELECT n_regionkey, count(*) AS n_edges, CAST(sum(abs(bx - ax) + abs(b_y - ay)) AS BIGINT) AS perimeter,
           CAST((SELECT sum((xmax - xmin) * (ymax - ymin)) FROM nation_poly p WHERE p.n_regionkey = o.n_regionkey) AS BIGINT) AS area
    FROM o GROUP BY n_regionkey""")
def geo_dissolve(spark, sf):
    merged = ag.dissolve_measures(layer(spark, sf, "nation_poly"), ["n_regionkey"])
    return merged.select("n_regionkey", "n_edges", F.col("perimeter").cast("long").alias("perimeter"), F.col("area").cast("long").alias("area"))


# every part square is split in four; the pieces of a part dissolve back into its square
@query("geo_dissolve_rings", with_layers("part_donut") + """
    SELECT fid, CAST(1 AS BIGINT) AS n_rings, CAST(8 AS BIGINT) AS n_edges, CAST(s * s AS BIGINT) AS area FROM part_donut""")
def geo_dissolve_rings(spark, sf):
    square = spread_rows(spark, sf, "part_donut")
    quarters = square.select("fid", "x0", "y0", "s", F.explode(F.expr("sequence(0, 3)")).alias("q")).withColumn("geom", F.expr(
        x.box("x0 + (q % 2) * s / 2", "y0 + (q div 2) * s / 2", "x0 + (q % 2 + 1) * s / 2", "y0 + (q div 2 + 1) * s / 2")))
    rings = ag.trace_rings(ag.outline_edges(quarters, ["fid"]), ["fid"])
    return rings.groupBy("fid").agg(
        F.count(F.lit(1)).alias("n_rings"), F.sum("n").alias("n_edges"), F.sum("area").cast("long").alias("area"))


def _frames(spark, sf):
    """Squares with a square hole, (fid, x, y, s) with s a multiple of four: one per supplier."""
    return spread_rows(spark, sf, "supplier_tri").selectExpr("fid", "4 * x0 AS x", "4 * y0 AS y", "4 * w AS s")


# twelve cells around a hole dissolve into a square with a hole
@query("geo_dissolve_polygons", with_layers("supplier_tri") + """
    SELECT fid, 2 AS n_rings, 17 + 9 AS n_points, CAST(12 * w * w AS BIGINT) AS area FROM supplier_tri""")
def geo_dissolve_polygons(spark, sf):
    cells = _frames(spark, sf).withColumn("c", F.explode(F.expr("filter(sequence(0, 15), i -> NOT (i % 4 IN (1, 2) AND i div 4 IN (1, 2)))")))
    corner = ("x + (c % 4) * s / 4", "y + (c div 4) * s / 4", "x + (c % 4 + 1) * s / 4", "y + (c div 4 + 1) * s / 4")
    merged = ag.dissolve(cells.select(F.col("fid").alias("g"), "fid", F.expr(x.box(*corner)).alias("geom")), ["g"])
    return merged.select(F.col("g").alias("fid"), F.expr("size(geom.parts[0].rings)").alias("n_rings"), F.expr(x.n_points("geom")).alias("n_points"), F.expr(x.area("geom")).cast("long").alias("area"))


def _nested(spark, sf):
    """Three squares inside each other, as lines."""
    square = _frames(spark, sf).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    at = ("x + k * s / 8", "y + k * s / 8", "x + s - k * s / 8", "y + s - k * s / 8")
    return square.select(F.col("fid").alias("g"), F.expr(x.line(x.ring_of((at[0], at[1]), (at[2], at[1]), (at[2], at[3]), (at[0], at[3]), (at[0], at[1])))).alias("geom"))


@query("geo_polygonize", with_layers("supplier_tri") + """
    SELECT fid, CAST(2 AS INT) AS n_rings, CAST(16 * w * w - 9 * w * w AS BIGINT) AS area FROM supplier_tri UNION ALL SELECT fid, 2, CAST(9 * w * w - 4 * w * w AS BIGINT) FROM supplier_tri
    UNION ALL SELECT fid, 1, CAST(4 * w * w AS BIGINT) FROM supplier_tri""")
def geo_polygonize(spark, sf):
    faces = ag.polygonize(_nested(spark, sf), ["g"])
    return faces.select(F.col("g").alias("fid"), F.expr("size(geom.parts[0].rings)").alias("n_rings"), F.expr(x.area("geom")).cast("long").alias("area"))


@query("geo_build_area", with_layers("supplier_tri") + """
    SELECT fid, CAST(2 AS INT) AS n_rings, CAST(16 * w * w - 9 * w * w AS BIGINT) AS area FROM supplier_tri UNION ALL SELECT fid, 1, CAST(4 * w * w AS BIGINT) FROM supplier_tri""")
def geo_build_area(spark, sf):
    areas = ag.build_area(_nested(spark, sf), ["g"])
    return areas.select(F.col("g").alias("fid"), F.expr("size(geom.parts[0].rings)").alias("n_rings"), F.expr(x.area("geom")).cast("long").alias("area"))


@query("geo_hull_each", with_layers("part_donut") + "SELECT fid, 5 AS n_points, CAST(s * s AS BIGINT) AS area FROM part_donut")
def geo_hull_each(spark, sf):
    register_functions(spark, ["ConvexHull", "ST_Area"])
    hulls = layer(spark, sf, "part_donut").selectExpr("fid", "ConvexHull(geom) AS hull")
    return hulls.select("fid", F.expr(x.n_points("hull")).alias("n_points"), F.expr(x.area("hull")).cast("long").alias("area"))


# the corner at (x0, y0) is the only one within the tolerance
@query("geo_snap_each", with_layers("supplier_tri") + "SELECT fid, ((w - 1) * (h - 1) - 1) / 2 AS area FROM supplier_tri")
def geo_snap_each(spark, sf):
    register_functions(spark, ["Snap", "MakePoint", "ST_Area"])
    return layer(spark, sf, "supplier_tri").selectExpr("fid", "ST_Area(Snap(geom, MakePoint(x0 + 1, y0 + 1), 2D)) AS area")


# a hole inside, outside, across the shell, and two that overlap
@query("geo_validity_holes", with_layers("supplier_tri") + """
    SELECT fid, CASE fid % 4 WHEN 3 THEN 'holes_overlap' ELSE 'hole_outside' END AS defect, CAST(1 AS BIGINT) AS n FROM supplier_tri WHERE fid % 4 > 0""")
def geo_validity_holes(spark, sf):
    def hole(low, high):
        return x.ring_of((f"x + {low}", f"y + {low}"), (f"x + {low}", f"y + {high}"), (f"x + {high}", f"y + {high}"), (f"x + {high}", f"y + {low}"), (f"x + {low}", f"y + {low}"))

    holes = f"CASE fid % 4 WHEN 0 THEN array({hole('1', '2')}) WHEN 1 THEN array({hole('s + 1', 's + 2')}) WHEN 2 THEN array({hole('s - 1', 's + 1')}) ELSE array({hole('1', '3')}, {hole('2', '4')}) END"
    shell = x.ring_of(("x", "y"), ("x + s", "y"), ("x + s", "y + s"), ("x", "y + s"), ("x", "y"))
    odd = _frames(spark, sf).select("fid", F.expr(x.polygon(f"concat(array({shell}), {holes})")).alias("geom"))
    return validity.defects(odd)


# the hull edges are the pairs of places with nothing on their right and nothing beyond them on their line
@query("geo_convex_hull", with_layers("customer_pt") + """, p AS (SELECT DISTINCT c_nationkey, x, y FROM customer_pt),
    e AS (SELECT a.c_nationkey, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM p a JOIN p b ON a.c_nationkey = b.c_nationkey AND (a.x <> b.x OR a.y <> b.y)),
    h AS (SELECT e.c_nationkey, x1, y1, x2, y2 FROM e JOIN p r ON e.c_nationkey = r.c_nationkey GROUP BY e.c_nationkey, x1, y1, x2, y2
          HAVING min((x2 - x1) * (r.y - y1) - (y2 - y1) * (r.x - x1)) >= 0 AND NOT bool_or((x2 - x1) * (r.y - y1) - (y2 - y1) * (r.x - x1) = 0
            AND (r.x < least(x1, x2) OR r.x > greatest(x1, x2) OR r.y < least(y1, y2) OR r.y > greatest(y1, y2))))
    SELECT c_nationkey, CAST(count(*) AS INTEGER) AS n_points, round(sum(x1 * y2 - x2 * y1) / 2, 4) AS area FROM h GROUP BY c_nationkey""")
def geo_convex_hull(spark, sf):
    hulls = ag.convex_hull(layer(spark, sf, "customer_pt"), "c_nationkey")
    return hulls.select("c_nationkey", F.col("n").alias("n_points"), F.round("area", 4).alias("area"))


@query("geo_group_measure", with_layers("part_donut") + """
    SELECT p_brand, count(*) AS n, CAST(sum(s * s * 3 / 4) AS BIGINT) AS area, CAST(sum(s * 6) AS BIGINT) AS perimeter,
           CAST(sum(10) AS BIGINT) AS n_points FROM part_donut GROUP BY p_brand""")
def geo_group_measure(spark, sf):
    g = ag.group_measures(layer(spark, sf, "part_donut"), ["p_brand"])
    return g.select("p_brand", "n", F.col("area").cast("long").alias("area"), F.col("perimeter").cast("long").alias("perimeter"), F.col("n_points").cast("long").alias("n_points"))


# ---------------------------------------------------------------- J: tables, edits, transformations


@query("geo_vertices", with_layers("supplier_tri") + """
    SELECT fid, 0 AS part, 0 AS ring, 0 AS seq, x0 AS x, y0 AS y FROM supplier_tri UNION ALL
    SELECT fid, 0, 0, 1, x0 + w, y0 FROM supplier_tri UNION ALL SELECT fid, 0, 0, 2, x0, y0 + h FROM supplier_tri UNION ALL
    SELECT fid, 0, 0, 3, x0, y0 FROM supplier_tri""")
def geo_vertices(spark, sf):
    return vertex_table(layer(spark, sf, "supplier_tri")).drop("z")


@query("geo_vertex_lookup", with_layers("supplier_tri") + """
    SELECT fid, 4 AS n, x0 AS first_x, y0 AS last_y, x0 + w AS second_x, CAST(NULL AS DOUBLE) AS ninth_x FROM supplier_tri""")
def geo_vertex_lookup(spark, sf):
    ring = layer(spark, sf, "supplier_tri").select("fid", F.expr(x.exterior_ring("geom")).alias("g"))
    px = "parts[0].rings[0][0]"
    return ring.select(
        "fid", F.expr(f"size({x.first_ring('g')})").alias("n"), F.expr(f"{x.nth_vertex('g', '1')}.{px}.x").alias("first_x"),
        F.expr(f"{x.nth_vertex('g', '-1')}.{px}.y").alias("last_y"), F.expr(f"{x.nth_vertex('g', '2')}.{px}.x").alias("second_x"),
        F.expr(f"{x.nth_vertex('g', '9')}.{px}.x").alias("ninth_x"))


@query("geo_edges", with_layers("supplier_tri") + """
    SELECT fid, 0 AS part, 0 AS ring, 0 AS seq, x0 AS x1, y0 AS y1, x0 + w AS x2, y0 AS y2 FROM supplier_tri UNION ALL
    SELECT fid, 0, 0, 1, x0 + w, y0, x0, y0 + h FROM supplier_tri UNION ALL SELECT fid, 0, 0, 2, x0, y0 + h, x0, y0 FROM supplier_tri""")
def geo_edges(spark, sf):
    return edge_table(layer(spark, sf, "supplier_tri")).drop("kind")


@query("geo_rings", with_layers("part_donut") + """
    SELECT fid, 'exterior' AS what, s * 4 AS length, 5 AS n FROM part_donut UNION ALL SELECT fid, 'interior', s * 2, 5 FROM part_donut UNION ALL
    SELECT fid, 'boundary', s * 6, 10 FROM part_donut UNION ALL SELECT fid, 'ring 1', s * 2, 5 FROM part_donut""")
def geo_rings(spark, sf):
    donut = layer(spark, sf, "part_donut").select("fid", "geom")
    ringed = ring_table(donut).filter("ring = 1").select(
        "fid", F.lit("ring 1").alias("what"), F.expr(x.ring_length("pts")).alias("length"), F.size("pts").alias("n"))
    for what, g in (("exterior", x.exterior_ring("geom")), ("interior", x.interior_ring("geom", "1")), ("boundary", x.boundary("geom"))):
        one = donut.select("fid", F.expr(g).alias("g"))
        ringed = ringed.unionByName(one.select(
            "fid", F.lit(what).alias("what"), F.expr(x.length("g")).alias("length"), F.expr(x.n_points("g")).alias("n")))
    return ringed


# a triangle and its corner, as one collection
_MIXED = x.geom(0, 0, f"concat(geom.parts, {x.point('x0', 'y0')}.parts)")


@query("geo_parts", with_layers("supplier_tri") + """
    SELECT fid, 'part 0' AS what, 3 AS gtype, 1 AS n_parts, 4 AS n_points FROM supplier_tri UNION ALL
    SELECT fid, 'part 1', 1, 1, 1 FROM supplier_tri UNION ALL SELECT fid, 'whole', 0, 2, 5 FROM supplier_tri UNION ALL
    SELECT fid, 'second', 1, 1, 1 FROM supplier_tri UNION ALL SELECT fid, 'points', 4, 1, 1 FROM supplier_tri UNION ALL
    SELECT fid, 'lines', NULL, NULL, NULL FROM supplier_tri UNION ALL SELECT fid, 'polygons', 6, 1, 4 FROM supplier_tri""")
def geo_parts(spark, sf):
    mixed = layer(spark, sf, "supplier_tri").select("fid", F.expr(_MIXED).alias("geom"))
    out = part_table(mixed).select("fid", F.expr("concat('part ', part)").alias("what"), "geom")
    for what, g in (("whole", "geom"), ("second", x.part_n("geom", "2")), ("points", x.only_kind("geom", 1)),
                    ("lines", x.only_kind("geom", 2)), ("polygons", x.only_kind("geom", 3))):
        out = out.unionByName(mixed.select("fid", F.lit(what).alias("what"), F.expr(g).alias("geom")))
    return out.select("fid", "what", F.col("geom.gtype").alias("gtype"), F.expr("IF(geom IS NULL, NULL, size(geom.parts))").alias("n_parts"),
                      F.expr(f"IF(geom IS NULL, NULL, {x.n_points('geom')})").alias("n_points"))


@query("geo_cast_type", with_layers("supplier_tri") + """
    SELECT fid, CAST(NULL AS INT) AS as_point, CAST(NULL AS INT) AS as_line, 3 AS as_polygon, 6 AS as_multipolygon, 6 AS as_multi, 3 AS back_single,
           CAST(NULL AS INT) AS mixed_polygon, 0 AS mixed_multi, CAST(NULL AS INT) AS mixed_single FROM supplier_tri""")
def geo_cast_type(spark, sf):
    both = layer(spark, sf, "supplier_tri").withColumn("mix", F.expr(_MIXED))
    multi = both.withColumn("multi", F.expr(x.cast_multi("geom")))
    codes = {
        "as_point": x.cast_type("geom", 1), "as_line": x.cast_type("geom", 2), "as_polygon": x.cast_type("geom", 3),
        "as_multipolygon": x.cast_type("geom", 6), "as_multi": "multi", "back_single": x.cast_single("multi"),
        "mixed_polygon": x.cast_type("mix", 6), "mixed_multi": x.cast_multi("mix"), "mixed_single": x.cast_single("mix"),
    }
    return multi.select("fid", *(F.expr(f"({g}).gtype").alias(n) for n, g in codes.items()))


@query("geo_cast_dim", with_layers("customer_pt") + "SELECT fid, c_acctbal AS z, CAST(NULL AS DOUBLE) AS flat, CAST(0 AS DOUBLE) AS raised, x FROM customer_pt")
def geo_cast_dim(spark, sf):
    pts = rows(spark, sf, "customer_pt").select("fid", F.expr(x.point("x", "y", 0, "c_acctbal")).alias("g"))
    flat = pts.select("fid", F.expr(x.to_xyz("g")).alias("g3"), F.expr(x.to_xy("g")).alias("g2"))
    raised = flat.withColumn("g0", F.expr(x.to_xyz("g2")))
    v = "parts[0].rings[0][0]"
    return raised.select("fid", F.expr(f"g3.{v}.z").alias("z"), F.expr(f"g2.{v}.z").alias("flat"), F.expr(f"g0.{v}.z").alias("raised"), F.expr(f"g0.{v}.x").alias("x"))


@query("geo_edit_line", with_layers("part_seg") + """
    SELECT fid, xmin || ' ' || xmax || ' ' || (xmax + 1) AS appended, (xmax + 1) || ' ' || xmin || ' ' || xmax AS put_first,
           xmin || ' ' || (xmax + 1) AS replaced, xmin || ' ' || (xmax + 1) AS removed, xmax || ' ' || xmin AS reversed, CAST(NULL AS VARCHAR) AS too_far FROM part_seg""")
def geo_edit_line(spark, sf):
    seg = layer(spark, sf, "part_seg").select("fid", "geom", F.expr(x.point("xmax + 1", "ymax + 1")).alias("p"))
    longer = seg.withColumn("three", F.expr(x.add_point("geom", "p")))

    def xs(g):
        return F.expr(f"IF(({g}) IS NULL, NULL, array_join(transform(({g}).parts[0].rings[0], el_v -> CAST(el_v.x AS STRING)), ' '))")

    return longer.select(
        "fid", xs("three").alias("appended"), xs(x.add_point("geom", "p", "0")).alias("put_first"), xs(x.set_point("geom", "1", "p")).alias("replaced"),
        xs(x.remove_point("three", "1")).alias("removed"), xs(x.reverse_line("geom")).alias("reversed"), xs(x.set_point("geom", "5", "p")).alias("too_far"))


@query("geo_makepolygon", with_layers("part_donut") + """
    SELECT fid, s * s AS solid, s * s * 3 / 4 AS holed, CAST(NULL AS DOUBLE) AS not_closed, -s * s AS lhr_outer, s * s / 4 AS lhr_hole,
           4 * s * s AS box, 16 * s * s AS circle_box FROM part_donut""")
def geo_makepolygon(spark, sf):
    donut = layer(spark, sf, "part_donut").select(
        "fid", "geom", "x0", "y0", "s", F.expr(x.exterior_ring("geom")).alias("ring"), F.expr(x.interior_ring("geom", "1")).alias("hole"))
    made = donut.select(
        "fid", "x0", "y0", "s", F.expr(x.make_polygon("ring")).alias("solid"), F.expr(x.make_polygon("ring", "hole")).alias("holed"),
        F.expr(x.make_polygon(f"({x.line('slice(ring.parts[0].rings[0], 1, 4)')})")).alias("opened"), F.expr(x.force_lhr("geom")).alias("lhr"))
    return made.select(
        "fid", F.expr(x.area("solid")).alias("solid"), F.expr(x.area("holed")).alias("holed"), F.expr(f"IF(opened IS NULL, NULL, {x.area('opened')})").alias("not_closed"),
        F.expr(x.ring_area("lhr.parts[0].rings[0]")).alias("lhr_outer"), F.expr(x.ring_area("lhr.parts[0].rings[1]")).alias("lhr_hole"),
        F.expr(x.area(x.box("x0 - s", "y0 - s", "x0 + s", "y0 + s"))).alias("box"),
        F.expr(x.area(x.box("x0 - 2 * s", "y0 - 2 * s", "x0 + 2 * s", "y0 + 2 * s"))).alias("circle_box"))


@query("geo_affine", with_layers("supplier_tri") + """
    SELECT fid, 'translate' AS op, x0 + 5 AS x, y0 - 3 AS y, round(w * h / 2, 4) AS area FROM supplier_tri
    UNION ALL SELECT fid, 'scale', x0 * 2, y0 * 3, round(w * h * 3, 4) FROM supplier_tri
    UNION ALL SELECT fid, 'scale_one', x0 * 2, y0 * 2, round(w * h * 2, 4) FROM supplier_tri
    UNION ALL SELECT fid, 'rotate', round(-y0, 4), round(x0, 4), round(w * h / 2, 4) FROM supplier_tri
    UNION ALL SELECT fid, 'reflect', -x0, y0, round(w * h / 2, 4) FROM supplier_tri
    UNION ALL SELECT fid, 'swap', y0, x0, round(w * h / 2, 4) FROM supplier_tri
    UNION ALL SELECT fid, 'shift', CASE WHEN x0 - 450 < 0 THEN x0 - 90 ELSE x0 - 450 END, y0, NULL FROM supplier_tri
    UNION ALL SELECT fid, 'normalize', CASE WHEN x0 > 180 AND x0 <= 540 THEN x0 - 360 WHEN x0 > 540 THEN x0 - 720 ELSE x0 END, y0 / 10, NULL FROM supplier_tri""")
def geo_affine(spark, sf):
    tri = layer(spark, sf, "supplier_tri").select("fid", "x0", "y0", "geom")
    out = None
    for op, g, sized in (
        ("translate", x.translate("geom", "5", "-3"), True), ("scale", x.scale("geom", "2", "3"), True), ("scale_one", x.scale("geom", "2", "2"), True),
        ("rotate", x.rotate("geom", "90"), True), ("reflect", x.reflect("geom", "1", "0"), True), ("swap", x.swap_xy("geom"), True),
        ("shift", x.shift_longitude("moved"), False), ("normalize", x.normalize_lonlat("lonlat"), False),
    ):
        base = tri.withColumn("moved", F.expr(x.point("x0 - 450", "y0"))).withColumn("lonlat", F.expr(x.point("x0", "y0 / 10")))
        one = base.select("fid", F.expr(g).alias("g"))
        v = "g.parts[0].rings[0][0]"
        part = one.select(
            "fid", F.lit(op).alias("op"), F.expr(f"round({v}.x, 4) + 0" if op == "rotate" else f"{v}.x").alias("x"),
            F.expr(f"round({v}.y, 4)" if op == "rotate" else f"{v}.y").alias("y"), (F.expr(f"round({x.area('g')}, 4)") if sized else F.lit(None).cast("double")).alias("area"))
        out = part if out is None else out.unionByName(part)
    return out


@query("geo_srid", with_layers("supplier_tri") + "SELECT fid, 0 AS before, 2154 AS after, 2154 AS moved, 2154 AS centre FROM supplier_tri")
def geo_srid(spark, sf):
    register_functions(spark, ["SetSrid", "Srid", "ST_Translate", "Centroid"])
    layer(spark, sf, "supplier_tri").createOrReplaceTempView("supplier_tri")
    return spark.sql("""
        SELECT fid, Srid(geom) AS before, Srid(SetSrid(geom, 2154)) AS after, Srid(ST_Translate(SetSrid(geom, 2154), 1, 1, 0)) AS moved,
               Srid(Centroid(SetSrid(geom, 2154))) AS centre FROM supplier_tri""")


@query("geo_transform", with_layers("customer_pt") + """
    SELECT fid, round(radians((x - 500) / 10) * 6378137, 3) AS mx, round(ln(tan(pi() / 4 + radians((y - 500) / 10) / 2)) * 6378137, 3) AS my,
           round((x - 500) / 10, 6) AS lon, round((y - 500) / 10, 6) AS lat, 3857 AS srid FROM customer_pt""")
def geo_transform(spark, sf):
    pts = rows(spark, sf, "customer_pt").select("fid", F.expr(x.point("(x - 500) / 10", "(y - 500) / 10", 4326)).alias("g"))
    there = pts.select("fid", F.expr(x.transform_crs("g", 3857)).alias("m"))
    back = there.select("fid", "m", F.expr(x.transform_crs("m", 4326)).alias("g"))
    m, g = "m.parts[0].rings[0][0]", "g.parts[0].rings[0][0]"
    return back.select(
        "fid", F.expr(f"round({m}.x, 3)").alias("mx"), F.expr(f"round({m}.y, 3)").alias("my"), F.expr(f"round({g}.x, 6) + 0").alias("lon"),
        F.expr(f"round({g}.y, 6) + 0").alias("lat"), F.col("m.srid").alias("srid"))


@query("geo_snap", with_layers("customer_pt", "supplier_pt") + """, near AS (
      SELECT c.fid, arg_min(s.x, ((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y), s.x, s.y)) AS nx,
             arg_min(s.y, ((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y), s.x, s.y)) AS ny
      FROM customer_pt c JOIN supplier_pt s ON (s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y) <= 400 GROUP BY c.fid)
    SELECT c.fid, coalesce(n.nx, c.x) AS x, coalesce(n.ny, c.y) AS y, n.nx IS NOT NULL AS near FROM customer_pt c LEFT JOIN near n ON c.fid = n.fid""")
def geo_snap(spark, sf):
    mine, ref = layer(spark, sf, "customer_pt"), layer(spark, sf, "supplier_pt")
    moved = clip.snap(mine.select("fid", "geom"), ref, 20.0)
    v = F.expr("geom.parts[0].rings[0][0]")
    spots = ref.select("x", "y").distinct().withColumn("near", F.lit(True))
    return moved.select("fid", v["x"].alias("x"), v["y"].alias("y")).join(spots, ["x", "y"], "left").select("fid", "x", "y", F.coalesce("near", F.lit(False)).alias("near"))


# area of a right triangle inside a rectangle, by integrating its height over x
@query("geo_clip_box", with_layers("supplier_tri", "part_seg", "customer_pt") + """, t AS (
      SELECT fid, x0, y0, w, h, greatest(x0, 200) AS xl, least(x0 + w, 600) AS xr, greatest(y0, 200) AS lo FROM supplier_tri
      WHERE x0 + w > 200 AND x0 < 600 AND y0 + h > 200 AND y0 < 600),
    u AS (SELECT *, x0 + w * (1 - (600 - y0) / h) AS xa, x0 + w * (1 - (lo - y0) / h) AS xb FROM t),
    v AS (SELECT *, least(greatest(xa, xl), xr) AS x1, least(greatest(xb, xl), xr) AS x2 FROM u),
    a AS (SELECT fid, (x1 - xl) * (600 - lo) + (x2 - x1) * ((y0 + h * (1 - (x1 - x0) / w) - lo) + (y0 + h * (1 - (x2 - x0) / w) - lo)) / 2 AS size FROM v)
    SELECT 'polygon' AS kind, fid, round(size, 6) AS size FROM a WHERE size > 1e-9
    UNION ALL SELECT 'line', fid, least(xmax, 600) - greatest(xmin, 200) + least(ymax, 600) - greatest(ymin, 200) FROM part_seg
      WHERE xmax >= 200 AND xmin <= 600 AND ymax >= 200 AND ymin <= 600
        AND least(xmax, 600) - greatest(xmin, 200) + least(ymax, 600) - greatest(ymin, 200) > 0
    UNION ALL SELECT 'point', fid, 0 FROM customer_pt WHERE x BETWEEN 200 AND 600 AND y BETWEEN 200 AND 600""")
def geo_clip_box(spark, sf):
    window = [(200, 200), (600, 200), (600, 600), (200, 600)]
    out = None
    for kind, name, size in (("polygon", "supplier_tri", x.area("geom")), ("line", "part_seg", x.length("geom")), ("point", "customer_pt", "0D")):
        cut = clip.clip_layer(layer(spark, sf, name).select("fid", "geom"), window).select(
            F.lit(kind).alias("kind"), "fid", F.expr(f"round({size}, 6)").alias("size"))
        out = cut if out is None else out.unionByName(cut)
    return out


@query("geo_overlap_area", with_layers("part_box", "nation_poly") + """, p AS (
      SELECT a.fid AS a_fid, b.fid AS b_fid, (a.xmax - a.xmin) * (a.ymax - a.ymin) AS aa, (b.xmax - b.xmin) * (b.ymax - b.ymin) AS ab,
             (least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS o
      FROM part_box a JOIN nation_poly b ON a.xmin < b.xmax AND a.xmax > b.xmin AND a.ymin < b.ymax AND a.ymax > b.ymin)
    SELECT a_fid, b_fid, CAST(o AS BIGINT) AS overlap, CAST(aa - o AS BIGINT) AS difference, CAST(aa + ab - 2 * o AS BIGINT) AS sym_difference,
           CAST(aa + ab - o AS BIGINT) AS union_area FROM p""")
def geo_overlap_area(spark, sf):
    pairs = clip.overlap_areas(layer(spark, sf, "part_box"), layer(spark, sf, "nation_poly"))

    def whole(e):
        return F.expr(f"CAST({e} AS BIGINT)")

    return pairs.select(
        "a_fid", "b_fid", whole("overlap").alias("overlap"), whole("area_a - overlap").alias("difference"),
        whole("area_a + area_b - 2 * overlap").alias("sym_difference"), whole("area_a + area_b - overlap").alias("union_area"))


@query("geo_line_locate", with_layers("event_point") + f""", s AS ({_STEPS}), r AS (
      SELECT *, sum(step) OVER (PARTITION BY fid ORDER BY seq) AS dist, sum(step) OVER (PARTITION BY fid) AS total FROM s WHERE seq > 1),
    f AS (SELECT r.*, t.fraction FROM r, (VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.5 AS DOUBLE))) AS t(fraction)),
    h AS (SELECT *, row_number() OVER (PARTITION BY fid, fraction ORDER BY seq) AS k FROM f WHERE dist >= fraction * total)
    SELECT fid, fraction, round(px + (fraction * total - (dist - step)) / step * (x - px), 4) AS x,
           round(py + (fraction * total - (dist - step)) / step * (y - py), 4) AS y FROM h WHERE k = 1""")
def geo_line_locate(spark, sf):
    at = lines.interpolate_tracks(rows(spark, sf, "event_point"), ["ts", "event_id"], [0.25, 0.5])
    return at.select("fid", "fraction", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("geo_line_parts", with_layers("part_seg") + """
    SELECT fid, xmin + (xmax - xmin) / 4 AS quarter_x, ymin + (ymax - ymin) / 4 AS quarter_y, (xmax - xmin + ymax - ymin) / 2 AS mid_length,
           CAST(floor((xmax - xmin + ymax - ymin) / 4) AS INT) + 1 AS n_points FROM part_seg""")
def geo_line_parts(spark, sf):
    seg = layer(spark, sf, "part_seg").select("fid", "geom")
    at = seg.select("fid", F.expr(x.interpolate_point("geom", "0.25D")).alias("q"), F.expr(x.substring("geom", "0.25D", "0.75D")).alias("m"),
                    F.expr(x.equidistant_points("geom", "4D")).alias("e"))
    v = "q.parts[0].rings[0][0]"
    return at.select("fid", F.expr(f"{v}.x").alias("quarter_x"), F.expr(f"{v}.y").alias("quarter_y"), F.expr(x.length("m")).alias("mid_length"), F.expr(x.n_points("e")).alias("n_points"))


@query("geo_point_buffer", with_layers("customer_pt") + """
    SELECT fid, round(16 * r * r * sin(2 * pi() / 32), 6) AS area, 33 AS n, round((x - r + x + r) / 2, 6) AS mid_x, 4 * r * r AS box_area
    FROM (SELECT *, CAST(1 + fid % 10 AS DOUBLE) AS r FROM customer_pt) AS c""")
def geo_point_buffer(spark, sf):
    pts = rows(spark, sf, "customer_pt").withColumn("r", F.expr("CAST(1 + fid % 10 AS DOUBLE)"))
    made = pts.select("fid", "r", "x", "y", F.expr(x.circle("x", "y", "r", 32)).alias("g"), F.expr(x.box("x - r", "y - r", "x + r", "y + r")).alias("b"))
    boxed = with_bounds(made, "g")
    return boxed.select("fid", F.expr(f"round({x.area('g')}, 6)").alias("area"), F.expr(x.n_points("g")).alias("n"),
                        F.expr("round((xmin + xmax) / 2, 6)").alias("mid_x"), F.expr(x.area("b")).alias("box_area"))


# boxes of which four in five are broken: crossed, not closed, flat, with too few vertices
@query("geo_validity_report", with_layers("supplier_tri") + """
    SELECT fid, 'self_crossing' AS defect, CAST(1 AS BIGINT) AS n FROM supplier_tri WHERE fid % 5 IN (1, 3)
    UNION ALL SELECT fid, 'zero_area', 1 FROM supplier_tri WHERE fid % 5 IN (1, 3)
    UNION ALL SELECT fid, 'not_closed', 1 FROM supplier_tri WHERE fid % 5 = 2
    UNION ALL SELECT fid, 'too_few_vertices', 1 FROM supplier_tri WHERE fid % 5 = 4
    UNION ALL SELECT fid, 'not_closed', 1 FROM supplier_tri WHERE fid % 5 = 4""")
def geo_validity_report(spark, sf):
    p = {"a": ("x0", "y0"), "b": ("x0 + w", "y0"), "c": ("x0 + w", "y0 + h"), "d": ("x0", "y0 + h")}

    def ring(names):
        return x.ring_of(*(p[n] for n in names))

    shape = (f"CASE fid % 5 WHEN 0 THEN {ring('abcda')} WHEN 1 THEN {ring('acbda')} WHEN 2 THEN {ring('abcd')} "
             f"WHEN 3 THEN {ring('abba')} ELSE {ring('abc')} END")
    made = rows(spark, sf, "supplier_tri").select("fid", F.expr(x.polygon(f"array({shape})")).alias("geom"))
    return validity.defects(made)


# ---------------------------------------------------------------- F1-F6: measures


@query("geo_measure_area", with_layers("part_donut", "supplier_tri") + """
    SELECT 'donut' AS layer, fid, CAST(s * s * 3 / 4 AS BIGINT) AS area2 FROM part_donut UNION ALL SELECT 'tri', fid, CAST(w * h AS BIGINT) FROM supplier_tri""")
def geo_measure_area(spark, sf):
    donut = layer(spark, sf, "part_donut").select(F.lit("donut").alias("layer"), "fid", F.expr(f"CAST({x.area('geom')} AS BIGINT)").alias("area2"))
    tri = layer(spark, sf, "supplier_tri").select(F.lit("tri").alias("layer"), "fid", F.expr(f"CAST({x.area('geom')} * 2 AS BIGINT)").alias("area2"))
    return donut.unionByName(tri)


@query("geo_measure_length", with_layers("supplier_tri", "part_seg") + """
    SELECT 'perimeter' AS what, fid, round(w + h + sqrt(w * w + h * h), 6) AS len FROM supplier_tri
    UNION ALL SELECT 'length', fid, xmax - xmin + ymax - ymin FROM part_seg""")
def geo_measure_length(spark, sf):
    tri = layer(spark, sf, "supplier_tri").select(F.lit("perimeter").alias("what"), "fid", F.expr(f"round({x.perimeter('geom')}, 6)").alias("len"))
    seg = layer(spark, sf, "part_seg").select(F.lit("length").alias("what"), "fid", F.expr(x.length("geom")).alias("len"))
    return tri.unionByName(seg)


@query("geo_centroid", with_layers("supplier_tri", "part_donut", "part_seg", "customer_pt") + """
    SELECT 'tri' AS layer, fid, round(x0 + w / 3, 6) AS cx, round(y0 + h / 3, 6) AS cy FROM supplier_tri
    UNION ALL SELECT 'donut', fid, round(x0 + s / 2, 6), round(y0 + s / 2, 6) FROM part_donut
    UNION ALL SELECT 'seg', fid, (xmin + xmax) / 2, (ymin + ymax) / 2 FROM part_seg UNION ALL SELECT 'pt', fid, x, y FROM customer_pt""")
def geo_centroid(spark, sf):
    out = None
    for label, name in (("tri", "supplier_tri"), ("donut", "part_donut"), ("seg", "part_seg"), ("pt", "customer_pt")):
        one = layer(spark, sf, name).select(F.lit(label).alias("layer"), "fid", F.expr(x.centroid_xy("geom")).alias("c"))
        one = one.select("layer", "fid", F.expr("round(c.x, 6)").alias("cx"), F.expr("round(c.y, 6)").alias("cy"))
        out = one if out is None else out.unionByName(one)
    return out


@query("geo_point_on_surface", with_layers("supplier_tri", "part_donut") + """
    SELECT 'tri' AS layer, fid, x0 + w / 4 AS px, y0 + h / 2 AS py, 1 AS place FROM supplier_tri
    UNION ALL SELECT 'donut', fid, x0 + s / 8, y0 + s / 2, 1 FROM part_donut""")
def geo_point_on_surface(spark, sf):
    out = None
    for label, name in (("tri", "supplier_tri"), ("donut", "part_donut")):
        one = layer(spark, sf, name).select(F.lit(label).alias("layer"), "fid", F.expr(x.edges("geom")).alias("es"), F.expr(x.point_on_surface("geom")).alias("p"))
        one = one.select("layer", "fid", F.col("p.x").alias("px"), F.col("p.y").alias("py"), F.expr(x.locate("p.x", "p.y", "es")).alias("place"))
        out = one if out is None else out.unionByName(one)
    return out


@query("geo_envelope", with_layers("supplier_tri") + """
    SELECT fid, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + h AS ymax, w * h AS env_area, 5 AS env_points FROM supplier_tri""")
def geo_envelope(spark, sf):
    boxed = with_bounds(layer(spark, sf, "supplier_tri").select("fid", "geom")).withColumn("e", F.expr(x.envelope("geom")))
    return boxed.select("fid", "xmin", "ymin", "xmax", "ymax", F.expr(x.area("e")).alias("env_area"), F.expr(x.n_points("e")).alias("env_points"))


@query("geo_accessors", with_layers("customer_pt", "supplier_tri") + """
    SELECT 'pt' AS layer, fid, x AS px, y AS py, 0 AS dim, 'POINT' AS kind, 'POINT(' || CAST(x AS BIGINT) || ' ' || CAST(y AS BIGINT) || ')' AS wkt FROM customer_pt
    UNION ALL SELECT 'tri', fid, NULL, NULL, 2, 'POLYGON', 'POLYGON((' || CAST(x0 AS BIGINT) || ' ' || CAST(y0 AS BIGINT) || ',' || CAST(x0 + w AS BIGINT) || ' '
      || CAST(y0 AS BIGINT) || ',' || CAST(x0 AS BIGINT) || ' ' || CAST(y0 + h AS BIGINT) || ',' || CAST(x0 AS BIGINT) || ' ' || CAST(y0 AS BIGINT) || '))' FROM supplier_tri""")
def geo_accessors(spark, sf):
    register_functions(spark, ["ST_X", "ST_Y", "ST_Dimension", "ST_GeometryType", "ST_AsText"])
    for name in ("customer_pt", "supplier_tri"):
        layer(spark, sf, name).createOrReplaceTempView(name)
    cols = "fid, ST_X(geom) AS px, ST_Y(geom) AS py, ST_Dimension(geom) AS dim, ST_GeometryType(geom) AS kind, ST_AsText(geom) AS wkt"
    return spark.sql(f"SELECT 'pt' AS layer, {cols} FROM customer_pt UNION ALL SELECT 'tri' AS layer, {cols} FROM supplier_tri")
