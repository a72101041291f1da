"""Clipping to convex windows, overlap areas, snapping and points on surfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.grid import candidate_pairs
from lamina.operators.packed import Tree
from lamina.operators.tables import BOUNDS, vertex_table, with_bounds


def window_edges(ring: list[tuple[float, float]]) -> str:
    """Edges of a convex window given by its corners, counter-clockwise; raises when it is not convex."""
    n = len(ring)
    if n < 3:
        raise ValueError("a window needs at least three corners")
    turns = []
    for i in range(n):
        (ax, ay), (bx, by), (cx, cy) = ring[i], ring[(i + 1) % n], ring[(i + 2) % n]
        turns.append((bx - ax) * (cy - by) - (by - ay) * (cx - bx))
    if min(turns) < 0 < max(turns) or not any(turns):
        raise ValueError("the window is not convex")
    if min(turns) < 0:
        ring = ring[::-1]
    edges = ", ".join(
        f"named_struct('x1', {float(a[0])!r}D, 'y1', {float(a[1])!r}D, 'x2', {float(b[0])!r}D, 'y2', {float(b[1])!r}D)"
        for a, b in zip(ring, ring[1:] + ring[:1]))
    return f"array({edges})"


def clip_layer(layer: DataFrame, ring: list[tuple[float, float]]) -> DataFrame:
    """Layer cut to a convex window; features left empty are dropped.

    Boxes that miss the window are filtered before any clipping.
    """
    edges = window_edges(ring)
    xs, ys = [float(p[0]) for p in ring], [float(p[1]) for p in ring]
    near = with_bounds(layer).filter(
        (F.col("xmin") <= max(xs)) & (F.col("xmax") >= min(xs)) & (F.col("ymin") <= max(ys)) & (F.col("ymax") >= min(ys)))
    kept = [c for c in layer.columns if c not in ("geom", *BOUNDS)]
    cut = near.select(*kept, F.expr(f"explode(array({x.clip_geometry('geom', edges)}))").alias("geom"))
    return cut.filter("geom IS NOT NULL")


def overlap_areas(a: DataFrame, b: DataFrame, **options) -> DataFrame:
    """(a_fid, b_fid, area_a, area_b, overlap) of polygons whose interiors meet; ``b`` must be convex.

    Difference, symmetric difference and union areas follow from the three numbers.
    A ring of ``b`` that is not convex raises.
    """
    def side(layer: DataFrame) -> DataFrame:
        return with_bounds(layer).select("fid", *BOUNDS, "geom", F.expr(x.area("geom")).alias("area"))

    # the cutting ring, counter-clockwise, checked for convexity
    outer = x.first_ring("geom")
    ccw = f"IF({x.ring_area(outer)} > 0, {outer}, reverse({outer}))"
    turn = x.orient("ov_e.x1", "ov_e.y1", "ov_e.x2", "ov_e.y2", "ov_v.x", "ov_v.y")
    convex = "forall(w, ov_e -> forall(ring, ov_v -> " + turn + " >= 0))"
    cutters = side(b).withColumn("ring", F.expr(ccw)).withColumn("w", F.expr(x.ring_edges("ring")))
    checked = cutters.select(
        "fid", *BOUNDS, "area",
        F.expr(f"IF(geom.gtype = 3 AND size(geom.parts[0].rings) = 1 AND {convex}, w, CAST(raise_error('overlap_areas needs convex polygons on the right') AS {x.EDGES}))").alias("w"))
    pairs = candidate_pairs(side(a), checked, **options)
    ring = f"IF(oa_i = 0, 1D, -1D) * abs({x.ring_area('oa_c')})"
    one = f"aggregate(transform(oa_p.rings, (oa_r, oa_i) -> {x.let(x.clip_ring('oa_r', 'b_w'), 'oa_c', ring)}), 0D, (oa_t, oa_u) -> oa_t + oa_u)"
    overlap = f"aggregate(filter(a_geom.parts, oa_k -> oa_k.kind = 3), 0D, (oa_s, oa_p) -> oa_s + {one})"
    cut = pairs.select("a_fid", "b_fid", F.col("a_area").alias("area_a"), F.col("b_area").alias("area_b"),
                       F.explode(F.array(F.expr(overlap))).alias("overlap"))
    return cut.filter("overlap > 0")


def snap_pairs(layer: DataFrame, reference: DataFrame, tolerance: float, **options) -> DataFrame:
    """(a_fid, a_part, a_ring, a_seq, a_x, a_y, b_x, b_y): each vertex with the few reference vertices that hold its nearest.

    A packed tree over the reference vertices is descended from the tolerance on, so a dense reference costs no more than a sparse one.
    """
    def boxes(df: DataFrame, *names: str) -> DataFrame:
        return df.select(F.struct(*names).alias("fid"), F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"), F.col("x").alias("px"), F.col("y").alias("py"))

    target = boxes(vertex_table(reference, keep=()).select("x", "y").distinct(), "x", "y")
    pairs = Tree(target).near(boxes(vertex_table(layer), "fid", "part", "ring", "seq", "x", "y"), tolerance, **options)
    return pairs.select(*(F.col(f"a_fid.{c}").alias(f"a_{c}") for c in ("fid", "part", "ring", "seq", "x", "y")), F.col("b_fid.x").alias("b_x"), F.col("b_fid.y").alias("b_y"))


def snap(layer: DataFrame, reference: DataFrame, tolerance: float, **options) -> DataFrame:
    """Move each vertex to the nearest reference vertex within ``tolerance`` (ties: smallest x, y).

    Only the vertices that move are gathered per feature; the rest of the row stays in place.
    """
    d2 = "(a_x - b_x) * (a_x - b_x) + (a_y - b_y) * (a_y - b_y)"
    near = snap_pairs(layer, reference, tolerance, **options).withColumn("d2", F.expr(d2)).filter(F.col("d2") <= tolerance * tolerance)
    best = near.groupBy("a_fid", "a_part", "a_ring", "a_seq").agg(
        F.min_by(F.struct(F.col("b_x").alias("x"), F.col("b_y").alias("y")), F.struct("d2", "b_x", "b_y")).alias("to"))
    place = F.struct(F.col("a_part").alias("part"), F.col("a_ring").alias("ring"), F.col("a_seq").alias("seq"))
    moved = best.groupBy(F.col("a_fid").alias("fid")).agg(
        F.map_from_entries(F.collect_list(F.struct(place, "to"))).alias("_to"))
    spot = "_to[named_struct('part', sn_i, 'ring', sn_j, 'seq', sn_k)]"
    ring = f"transform(sn_r, (sn_v, sn_k) -> IF({spot} IS NULL, sn_v, {x.vertex(spot + '.x', spot + '.y', 'sn_v.z')}))"
    parts = "transform(geom.parts, (sn_p, sn_i) -> " + x.part("sn_p.kind", f"transform(sn_p.rings, (sn_r, sn_j) -> {ring})") + ")"
    joined = layer.join(moved, "fid", "left")
    keep = [c for c in layer.columns if c not in ("geom", *BOUNDS)]
    return joined.select(*keep, F.expr(f"IF(_to IS NULL, geom, {x.geom('geom.gtype', 'geom.srid', parts)})").alias("geom"))
