"""Joins by place and spatial relations (rows D10-D14, F7-F22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators import grid
from lamina.operators import spatial as sp
from lamina.operators.copies import each, ids
from lamina.operators.tables import BOUNDS
from lamina.plans.catalog import query
from lamina.plans.fixtures import spread_layer as layer
from lamina.plans.fixtures import spread_rows as rows
from lamina.plans.fixtures import with_layers

_MEET = "a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin"
_INNER = "a.xmin < b.xmax AND a.xmax > b.xmin AND a.ymin < b.ymax AND a.ymax > b.ymin"
_A_IN_B = "a.xmin >= b.xmin AND a.xmax <= b.xmax AND a.ymin >= b.ymin AND a.ymax <= b.ymax"
_B_IN_A = "b.xmin >= a.xmin AND b.xmax <= a.xmax AND b.ymin >= a.ymin AND b.ymax <= a.ymax"
_SAME = "a.xmin = b.xmin AND a.xmax = b.xmax AND a.ymin = b.ymin AND a.ymax = b.ymax"
# a point in a right triangle, and a box against one, in closed form
_IN_TRI = "c.x >= t.x0 AND c.y >= t.y0 AND (c.x - t.x0) * t.h + (c.y - t.y0) * t.w <= t.w * t.h"
_BOX_TRI = (
    "b.xmax >= t.x0 AND b.ymax >= t.y0 AND "
    "(greatest(b.xmin, t.x0) - t.x0) * t.h + (greatest(b.ymin, t.y0) - t.y0) * t.w <= t.w * t.h"
)
_TRI_DIST2 = """least(
    power(greatest(t.x0 - c.x, c.x - t.x0 - t.w, 0), 2) + power(c.y - t.y0, 2),
    power(c.x - t.x0, 2) + power(greatest(t.y0 - c.y, c.y - t.y0 - t.h, 0), 2),
    power(t.x0 + t.w - k * t.w - c.x, 2) + power(t.y0 + k * t.h - c.y, 2))"""
_TRI_K = "least(1, greatest(0, ((c.x - t.x0 - t.w) * -t.w + (c.y - t.y0) * t.h) / (t.w * t.w + t.h * t.h)))"


def _points(spark, sf, name):
    return rows(spark, sf, name).select("fid", "x", "y")


# ---------------------------------------------------------------- D10-D14


@query("join_bbox", with_layers("part_box", "nation_poly") + f"""
    SELECT a.fid AS a_fid, b.fid AS b_fid FROM part_box a JOIN nation_poly b ON {_MEET}""")
def join_bbox(spark, sf):
    return grid.box_pairs(rows(spark, sf, "part_box"), rows(spark, sf, "nation_poly"))


@query("join_point_in_polygon", with_layers("customer_pt", "supplier_tri") + f"""
    SELECT c.fid AS a_fid, t.fid AS b_fid, CASE WHEN c.x > t.x0 AND c.y > t.y0 AND (c.x - t.x0) * t.h + (c.y - t.y0) * t.w < t.w * t.h
      THEN 'inside' ELSE 'boundary' END AS place FROM customer_pt c JOIN supplier_tri t ON {_IN_TRI}""")
def join_point_in_polygon(spark, sf):
    return sp.point_in_polygon(_points(spark, sf, "customer_pt"), layer(spark, sf, "supplier_tri"))


@query("customers_per_cell", with_layers("customer_pt", "nation_poly") + """
    SELECT n.fid AS cell, n.n_name, count(*) AS customers, round(sum(c.c_acctbal), 2) AS balance FROM customer_pt c
    JOIN nation_poly n ON c.x >= n.xmin AND c.x <= n.xmax AND c.y >= n.ymin AND c.y <= n.ymax GROUP BY n.fid, n.n_name""")
def customers_per_cell(spark, sf):
    pairs = sp.point_in_polygon(
        rows(spark, sf, "customer_pt"), layer(spark, sf, "nation_poly"), ("c_acctbal",), ("n_name",))
    return pairs.groupBy(F.col("b_fid").alias("cell"), F.col("b_n_name").alias("n_name")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("a_c_acctbal"), 2).alias("balance"))


@query("join_intersects", with_layers("part_box", "supplier_tri", "part_seg") + f"""
    SELECT 'box x tri' AS kinds, b.fid AS a_fid, t.fid AS b_fid FROM part_box b JOIN supplier_tri t ON {_BOX_TRI}
    UNION ALL SELECT 'seg x box', a.fid, b.fid FROM part_seg a JOIN part_box b ON {_MEET}""")
def join_intersects(spark, sf):
    boxes, tris, segs = (sp.by_shape(layer(spark, sf, n)) for n in ("part_box", "supplier_tri", "part_seg"))
    areas = sp.intersecting_pairs(boxes, tris, 2, 2).withColumn("kinds", F.lit("box x tri"))
    return areas.unionByName(sp.intersecting_pairs(segs, boxes, 1, 2).withColumn("kinds", F.lit("seg x box")))


@query("join_left_spatial", with_layers("customer_pt", "supplier_tri") + f"""
    SELECT c.fid AS a_fid, c.c_nationkey, t.fid AS b_fid FROM customer_pt c LEFT JOIN supplier_tri t ON {_IN_TRI}""")
def join_left_spatial(spark, sf):
    pairs = sp.place_classes(_points(spark, sf, "customer_pt"), layer(spark, sf, "supplier_tri"))
    return sp.left_classes(rows(spark, sf, "customer_pt"), pairs, ["c_nationkey"])


@query("join_within_distance", with_layers("customer_pt", "supplier_pt") + """
    SELECT c.fid AS a_fid, s.fid AS b_fid, round(sqrt((c.x - s.x) * (c.x - s.x) + (c.y - s.y) * (c.y - s.y)), 6) AS dist
    FROM customer_pt c JOIN supplier_pt s ON (c.x - s.x) * (c.x - s.x) + (c.y - s.y) * (c.y - s.y) < 900""")
def join_within_distance(spark, sf):
    near = sp.near_classes(layer(spark, sf, "customer_pt"), layer(spark, sf, "supplier_pt"), 30.0, 0, 0)
    return each(near.filter("dist < 30").select("a_fid", "b_fid", F.round("dist", 6).alias("dist")))


# ---------------------------------------------------------------- F7-F13: boxes


def _box_query(key, other, where, spark_where):
    """Boxes of the parts against the boxes of another layer."""
    names = ("part_box",) if other == "part_box" else ("part_box", other)

    @query(key, with_layers(*names) + f"SELECT a.fid AS a_fid, b.fid AS b_fid FROM part_box a JOIN {other} b ON {where}")
    def run(spark, sf):
        boxes = rows(spark, sf, "part_box")
        return grid.box_pairs(boxes, boxes if other == "part_box" else rows(spark, sf, other), spark_where)


_box_query("mbr_touches", "nation_poly", f"{_MEET} AND NOT ({_INNER})", x.mbr_touching("a", "b", "_"))
_box_query("mbr_within", "part_box", _A_IN_B, x.mbr_inside("a", "b", "_"))
_box_query("mbr_overlaps", "nation_poly", f"{_INNER} AND NOT ({_A_IN_B}) AND NOT ({_B_IN_A})", x.mbr_overlapping("a", "b", "_"))
_box_query("mbr_intersects", "part_box", _MEET, None)
_box_query("mbr_contains", "part_box", _B_IN_A, x.mbr_inside("b", "a", "_"))


@query("mbr_equal", with_layers("part_box") + f"SELECT a.fid AS a_fid, b.fid AS b_fid FROM part_box a JOIN part_box b ON {_SAME} AND a.fid < b.fid")
def mbr_equal(spark, sf):
    boxes = rows(spark, sf, "part_box")
    keys = ["xmin", "ymin", "xmax", "ymax"]
    return boxes.select(F.col("fid").alias("a_fid"), *keys).join(boxes.select(F.col("fid").alias("b_fid"), *keys), keys).filter(
        "a_fid < b_fid").select("a_fid", "b_fid")


@query("mbr_disjoint", with_layers("part_box", "supplier_tri") + """
    SELECT b.fid, b.xmin, b.ymin FROM part_box b WHERE NOT EXISTS (SELECT 1 FROM supplier_tri t
      WHERE b.xmin <= t.x0 + t.w AND b.xmax >= t.x0 AND b.ymin <= t.y0 + t.h AND b.ymax >= t.y0)""")
def mbr_disjoint(spark, sf):
    boxes = rows(spark, sf, "part_box").select("fid", "xmin", "ymin", "xmax", "ymax")
    tris = rows(spark, sf, "supplier_tri").selectExpr("fid", "x0 AS xmin", "y0 AS ymin", "x0 + w AS xmax", "y0 + h AS ymax")
    met = grid.box_classes(boxes, sp.one_each(tris, BOUNDS))
    return sp.without_match(boxes, ids(met, "a").withColumnRenamed("fid", "a_fid")).select("fid", "xmin", "ymin")


# ---------------------------------------------------------------- F14-F20: relations


@query("rel_equals", with_layers("part_box") + f"SELECT a.fid AS a_fid, b.fid AS b_fid FROM part_box a JOIN part_box b ON {_SAME}")
def rel_equals(spark, sf):
    boxes = layer(spark, sf, "part_box").select("fid", "geom")
    # the same squares, started at another corner and run the other way round
    turned = boxes.withColumn("geom", F.expr(x.polygon(
        f"array(reverse(concat(slice({x.first_ring('geom')}, 3, 3), slice({x.first_ring('geom')}, 2, 2))))")))
    return sp.equal_pairs(boxes, turned)


@query("rel_disjoint", with_layers("part_box", "supplier_tri") + f"""
    SELECT b.fid, b.p_size FROM part_box b WHERE NOT EXISTS (SELECT 1 FROM supplier_tri t WHERE {_BOX_TRI})""")
def rel_disjoint(spark, sf):
    boxes, tris = layer(spark, sf, "part_box"), layer(spark, sf, "supplier_tri")
    return sp.disjoint_rows(boxes, tris, 2, 2).select("fid", "p_size")


@query("rel_within", with_layers("part_box", "customer_pt", "supplier_tri", "part_seg") + """
    SELECT 'box in tri' AS kinds, b.fid AS a_fid, t.fid AS b_fid FROM part_box b JOIN supplier_tri t
      ON b.xmin >= t.x0 AND b.ymin >= t.y0 AND (b.xmax - t.x0) * t.h + (b.ymax - t.y0) * t.w <= t.w * t.h
    UNION ALL SELECT 'point in tri', c.fid, t.fid FROM customer_pt c JOIN supplier_tri t
      ON c.x > t.x0 AND c.y > t.y0 AND (c.x - t.x0) * t.h + (c.y - t.y0) * t.w < t.w * t.h
    UNION ALL SELECT 'seg in box', s.fid, b.fid FROM part_seg s JOIN part_box b
      ON s.xmin >= b.xmin AND s.xmax <= b.xmax AND s.ymin >= b.ymin AND s.ymax <= b.ymax
         AND ((s.upright = 0 AND s.ymin > b.ymin AND s.ymin < b.ymax) OR (s.upright = 1 AND s.xmin > b.xmin AND s.xmin < b.xmax))""")
def rel_within(spark, sf):
    tris, boxes = sp.by_shape(layer(spark, sf, "supplier_tri")), sp.by_shape(layer(spark, sf, "part_box"))
    out = sp.related_pairs(boxes, tris, "within", 2, 2).withColumn("kinds", F.lit("box in tri"))
    out = out.unionByName(sp.related_pairs(layer(spark, sf, "customer_pt"), tris, "within", 0, 2).withColumn("kinds", F.lit("point in tri")))
    return out.unionByName(sp.related_pairs(layer(spark, sf, "part_seg"), boxes, "within", 1, 2).withColumn("kinds", F.lit("seg in box")))


@query("rel_contains", with_layers("part_box", "nation_poly") + f"""
    SELECT a.fid AS a_fid, b.fid AS b_fid FROM nation_poly a JOIN part_box b ON {_B_IN_A}""")
def rel_contains(spark, sf):
    return sp.related_pairs(layer(spark, sf, "nation_poly"), layer(spark, sf, "part_box"), "contains", 2, 2)


@query("rel_touches", with_layers("part_box", "nation_poly", "customer_pt", "part_seg") + f"""
    SELECT 'cell x cell' AS kinds, a.fid AS a_fid, b.fid AS b_fid FROM nation_poly a JOIN nation_poly b ON {_MEET} AND NOT ({_INNER})
    UNION ALL SELECT 'box x box', a.fid, b.fid FROM part_box a JOIN part_box b ON {_MEET} AND NOT ({_INNER})
    UNION ALL SELECT 'point x cell', c.fid, n.fid FROM customer_pt c JOIN nation_poly n ON c.x >= n.xmin AND c.x <= n.xmax AND c.y >= n.ymin AND c.y <= n.ymax
      AND NOT (c.x > n.xmin AND c.x < n.xmax AND c.y > n.ymin AND c.y < n.ymax)
    UNION ALL SELECT 'seg x box', a.fid, b.fid FROM part_seg a JOIN part_box b ON {_MEET} AND NOT ({_INNER})""")
def rel_touches(spark, sf):
    cells, boxes = sp.by_shape(layer(spark, sf, "nation_poly")), sp.by_shape(layer(spark, sf, "part_box"))
    out = sp.related_pairs(cells, cells, "touches", 2, 2).withColumn("kinds", F.lit("cell x cell"))
    points, segs = layer(spark, sf, "customer_pt"), layer(spark, sf, "part_seg")
    for kinds, a, b, a_dim in (("box x box", boxes, boxes, 2), ("point x cell", points, cells, 0), ("seg x box", segs, boxes, 1)):
        out = out.unionByName(sp.related_pairs(a, b, "touches", a_dim, 2).withColumn("kinds", F.lit(kinds)))
    return out


# the lines of the parts against the same lines moved two along their own direction
_MOVED = """, moved AS (SELECT fid, upright, xmin + 2 * (1 - upright) AS xmin, ymin + 2 * upright AS ymin, xmax + 2 * (1 - upright) AS xmax,
      ymax + 2 * upright AS ymax FROM part_seg) """


@query("rel_overlaps", with_layers("part_box", "nation_poly", "part_seg") + _MOVED + f"""
    SELECT 'box x cell' AS kinds, a.fid AS a_fid, b.fid AS b_fid FROM part_box a JOIN nation_poly b ON {_INNER} AND NOT ({_A_IN_B}) AND NOT ({_B_IN_A})
    UNION ALL SELECT 'seg x seg', a.fid, b.fid FROM part_seg a JOIN moved b ON a.upright = b.upright AND
      ((a.upright = 0 AND a.ymin = b.ymin AND a.xmin < b.xmax AND a.xmax > b.xmin) OR (a.upright = 1 AND a.xmin = b.xmin AND a.ymin < b.ymax AND a.ymax > b.ymin))
      AND NOT ({_A_IN_B}) AND NOT ({_B_IN_A})""")
def rel_overlaps(spark, sf):
    boxes, cells, segs = layer(spark, sf, "part_box"), layer(spark, sf, "nation_poly"), layer(spark, sf, "part_seg")
    moved = segs.select("fid", F.expr(x.translate("geom", "2D * (1 - upright)", "2D * upright")).alias("geom"))
    return sp.related_pairs(boxes, cells, "overlaps", 2, 2).withColumn("kinds", F.lit("box x cell")).unionByName(
        sp.related_pairs(segs, moved, "overlaps", 1, 1).withColumn("kinds", F.lit("seg x seg")))


@query("rel_crosses", with_layers("part_box", "part_seg") + f"""
    SELECT 'seg x box' AS kinds, a.fid AS a_fid, b.fid AS b_fid FROM part_seg a JOIN part_box b ON {_INNER} AND NOT ({_A_IN_B})
    UNION ALL SELECT 'seg x seg', a.fid, b.fid FROM part_seg a JOIN part_seg b ON a.upright <> b.upright AND {_INNER}""")
def rel_crosses(spark, sf):
    boxes, segs = (sp.by_shape(layer(spark, sf, n)) for n in ("part_box", "part_seg"))
    return sp.related_pairs(segs, boxes, "crosses", 1, 2).withColumn("kinds", F.lit("seg x box")).unionByName(
        sp.related_pairs(segs, segs, "crosses", 1, 1).withColumn("kinds", F.lit("seg x seg")))


# ---------------------------------------------------------------- F21-F22: distance


@query("geo_distance", with_layers("customer_pt", "supplier_tri") + f""", d AS (
      SELECT c.fid AS a_fid, t.fid AS b_fid, CASE WHEN {_IN_TRI} THEN 0 ELSE sqrt({_TRI_DIST2}) END AS dist
      FROM customer_pt c, LATERAL (SELECT *, {_TRI_K} AS k FROM supplier_tri t) AS t)
    SELECT a_fid, b_fid, round(dist, 6) AS dist FROM d WHERE dist <= 25""")
def geo_distance(spark, sf):
    near = sp.near_classes(layer(spark, sf, "customer_pt"), layer(spark, sf, "supplier_tri"), 25.0, 0, 2)
    return each(near.select("a_fid", "b_fid", F.round("dist", 6).alias("dist")))


@query("geo_closest", with_layers("customer_pt", "part_seg") + """, q AS (
      SELECT c.fid AS a_fid, s.fid AS b_fid, greatest(s.xmin, least(s.xmax, c.x)) AS near_x, greatest(s.ymin, least(s.ymax, c.y)) AS near_y,
             c.x AS ax, c.y AS ay FROM customer_pt c CROSS JOIN part_seg s),
    r AS (SELECT *, (ax - near_x) * (ax - near_x) + (ay - near_y) * (ay - near_y) AS d2 FROM q)
    SELECT a_fid, arg_min(b_fid, (d2, b_fid)) AS b_fid, round(sqrt(min(d2)), 6) AS dist, arg_min(near_x, (d2, b_fid)) AS near_x,
           arg_min(near_y, (d2, b_fid)) AS near_y FROM r GROUP BY a_fid""")
def geo_closest(spark, sf):
    points, segs = layer(spark, sf, "customer_pt").select("fid", "geom"), layer(spark, sf, "part_seg")
    best = sp.nearest(points, segs, a_dim=0, b_dim=1)
    return best.select("a_fid", "b_fid", F.round("dist", 6).alias("dist"), F.col("bx").alias("near_x"), F.col("by").alias("near_y"))
