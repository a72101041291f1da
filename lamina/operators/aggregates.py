"""Geometry aggregates over groups of features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.grid import candidate_pairs
from lamina.operators.ordered import dense_ids, group_numbers
from lamina.operators.tables import edge_table, vertex_table, with_bounds
from lamina.session import cut_lineage

PIECE_PARTS = 10_000  # of a collected geometry; a bigger group is several


def extent(layer: DataFrame, by: list[str]) -> DataFrame:
    """Bounding box of each group."""
    return with_bounds(layer).groupBy(*by).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def collect_summary(layer: DataFrame, by: list[str]) -> DataFrame:
    """What collecting each group gives: type code, parts, vertices and srid, without collecting."""
    rows = layer.select(
        *by, F.size("geom.parts").alias("_n"), F.expr(x.n_points("geom")).alias("_v"), F.col("geom.srid").alias("_s"),
        F.expr("array_min(transform(geom.parts, cs_p -> cs_p.kind))").alias("_lo"),
        F.expr("array_max(transform(geom.parts, cs_p -> cs_p.kind))").alias("_hi"))
    agg = rows.groupBy(*by).agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("n_parts"),
        F.sum("_v").alias("n_points"), F.max("_s").alias("srid"))
    gtype = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") + 3).otherwise(F.lit(0))
    return agg.select(*by, gtype.alias("gtype"), "n_parts", "n_points", "srid")


def collect(layer: DataFrame, by: list[str], piece_parts: int = PIECE_PARTS) -> DataFrame:
    """(by, piece, geom): the parts of each group, by fid, as multi geometries (or mixed collections) of at most ``piece_parts`` parts.

    Pieces count from 0 in every group; a group of up to ``piece_parts`` parts is one geometry, a bigger one as many rows as it needs.
    Parts are numbered by two-step prefix sums over ranges of (group, fid), so no task holds a group.  The type is that of the group.
    """
    flat = layer.select(*by, F.coalesce(F.col("geom.srid"), F.lit(0)).alias("_s"), "fid", F.posexplode("geom.parts").alias("_i", "_p"))
    numbered = group_numbers(flat, by, ["fid", "_i"], "_n")
    kinds = layer.groupBy(*by).agg(*(F.expr(f"{f}(array_{f}(transform(geom.parts, co_p -> co_p.kind)))").alias(f"_{f}") for f in ("min", "max")), F.max("geom.srid").alias("_srid"))
    pieces = numbered.groupBy(*by, F.expr(f"_n div {piece_parts}").alias("piece")).agg(F.array_sort(F.collect_list(F.struct("_n", "_p"))).alias("_ps"))
    known = kinds.select(*(F.col(c).alias(f"_{c}") for c in by), "_min", "_max", "_srid")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    made = x.geom("IF(_min = _max, _min + 3, 0)", "_srid", "transform(_ps, co_q -> co_q._p)")
    return pieces.join(known, same).select(*by, "piece", F.expr(made).alias("geom"))


def group_measures(layer: DataFrame, by: list[str]) -> DataFrame:
    """Features, area, length, perimeter and vertices per group."""
    rows = layer.select(
        *by, F.expr(x.area("geom")).alias("_a"), F.expr(x.length("geom")).alias("_l"),
        F.expr(x.perimeter("geom")).alias("_p"), F.expr(x.n_points("geom")).alias("_v"))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_a").alias("area"), F.sum("_l").alias("length"),
        F.sum("_p").alias("perimeter"), F.sum("_v").alias("n_points"))


# ---------------------------------------------------------------- dissolve

def _oriented(layer: DataFrame) -> DataFrame:
    """Outer rings counter-clockwise, holes clockwise."""
    ring = f"IF(({x.ring_area('or_r')} > 0) = (or_i = 0), or_r, reverse(or_r))"
    parts = "transform(geom.parts, or_p -> " + x.part("or_p.kind", f"transform(or_p.rings, (or_r, or_i) -> {ring})") + ")"
    return layer.withColumn("geom", F.expr(x.geom("geom.gtype", "geom.srid", parts)))


def outline_edges(layer: DataFrame, by: list[str]) -> DataFrame:
    """Edges on the outline of the union of each group (edge-matched coverages).

    Neighbours share whole edges, so an edge inside the union occurs twice and one on the
    outline once.  Edges keep a direction that has the union on their left.
    """
    edges = edge_table(_oriented(layer), keep=tuple(by))
    flip = "(x1 > x2 OR (x1 = x2 AND y1 > y2))"
    keyed = edges.select(
        *by, F.expr(f"IF({flip}, x2, x1)").alias("ax"), F.expr(f"IF({flip}, y2, y1)").alias("ay"),
        F.expr(f"IF({flip}, x1, x2)").alias("bx"), F.expr(f"IF({flip}, y1, y2)").alias("by_"),
        F.expr(flip).alias("flipped"))
    once = keyed.groupBy(*by, "ax", "ay", "bx", "by_").agg(
        F.count(F.lit(1)).alias("n"), F.first("flipped").alias("flipped")).filter("n = 1")
    return once.select(
        *by, F.expr("IF(flipped, bx, ax)").alias("x1"), F.expr("IF(flipped, by_, ay)").alias("y1"),
        F.expr("IF(flipped, ax, bx)").alias("x2"), F.expr("IF(flipped, ay, by_)").alias("y2"))


def dissolve_measures(layer: DataFrame, by: list[str]) -> DataFrame:
    """Outline edges, perimeter and area of the union of each group."""
    return outline_edges(layer, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_edges"),
        F.sum(F.expr("sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))")).alias("perimeter"),
        (F.sum(F.expr("x1 * y2 - x2 * y1")) / 2).alias("area"))


def trace_rings(edges: DataFrame, by: list[str]) -> DataFrame:
    """Chain directed edges into rings: (by, ring, n, area, pts); ``ring`` is the first edge of the ring.

    Every edge is followed by the edge leaving its end with the sharpest left turn.  Each edge learns the smallest edge of its ring
    and the steps to it in one loop of pointer doubling (two doublings a round): an edge that looks 2^k edges ahead knows the
    smallest of them and where it is.  About log2(ring length) / 2 rounds, whatever the number or size of the groups.
    """
    ided = cut_lineage(dense_ids(edges, name="id"))
    out = ided.select(*by, F.col("id").alias("nid"), F.col("x1").alias("x2"), F.col("y1").alias("y2"),
                      F.col("x2").alias("qx"), F.col("y2").alias("qy"))
    # turn from the reversed arriving direction, clockwise, in (0, 2 pi]
    back, ahead = "atan2(y1 - y2, x1 - x2)", "atan2(qy - y2, qx - x2)"
    turn = f"IF({back} - {ahead} > 0, {back} - {ahead}, {back} - {ahead} + 2 * pi())"
    # a missing group is a group like any other
    apart = out.select(*(F.col(c).alias(f"_{c}") for c in (*by, "x2", "y2")), "nid", "qx", "qy")
    meets = F.lit(True)
    for c in by:
        meets = meets & F.col(c).eqNullSafe(F.col(f"_{c}"))
    meets = meets & (F.col("x2") == F.col("_x2")) & (F.col("y2") == F.col("_y2"))
    follow = ided.join(apart, meets).groupBy("id").agg(F.min_by("nid", F.struct(F.expr(turn), F.col("nid"))).alias("next"))
    # low: the smallest edge among this one and the ``span - 1`` after it, d: steps to it
    state, span = cut_lineage(follow.withColumn("low", F.col("id")).withColumn("d", F.lit(0).cast("long")).withColumn("moved", F.lit(False))), 1

    def doubled(of: DataFrame, span: int) -> DataFrame:
        beyond = of.select(F.col("id").alias("next"), F.col("next").alias("_nn"), F.col("low").alias("_nl"), F.col("d").alias("_nd"))
        less = F.col("_nl") < F.col("low")
        return of.join(beyond, "next").select("id", F.col("_nn").alias("next"), F.least("low", "_nl").alias("low"), F.when(less, F.col("_nd") + span).otherwise(F.col("d")).alias("d"), (F.col("moved") | less).alias("moved"))

    while True:
        state = cut_lineage(doubled(doubled(state.withColumn("moved", F.lit(False)), span), 2 * span))
        span *= 4
        if state.filter("moved").isEmpty():
            break
    placed = ided.join(state.select("id", "low", "d"), "id")
    # first edge first, then by falling distance
    where = F.when(F.col("d") == 0, F.lit(0)).otherwise(F.lit(1))
    rings = placed.groupBy(*by, F.col("low").alias("ring")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.expr("x1 * y2 - x2 * y1")) / 2).alias("area"),
        F.array_sort(F.collect_list(F.struct(where.alias("w"), (-F.col("d")).alias("k"), "x1", "y1"))).alias("_v"))
    pts = f"transform(_v, tr_v -> {x.vertex('tr_v.x1', 'tr_v.y1')})"
    return rings.select(*by, "ring", "n", "area", F.expr(f"concat({pts}, slice({pts}, 1, 1))").alias("pts"))


def _boxed(df: DataFrame, pts: str) -> DataFrame:
    return df.select("*", F.expr(f"inline(array({x.bounds(x.polygon(f'array({pts})'))}))"))


def _same(by: list[str]) -> F.Column:
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return same


def _owned(holes: DataFrame, outer: DataFrame, by: list[str]) -> DataFrame:
    """(by, hole, ring): the smallest ring of ``outer`` (ring, pts, area) that surrounds each of ``holes`` (hole, hole_pts)."""
    # a vertex of the hole that is not on the outer ring decides; a hole that shares all its vertices with a ring fills it
    es = x.ring_edges("b_pts")
    spot = (
        "aggregate(a_hole_pts, 0, (ho_s, ho_v) -> IF(ho_s <> 0, ho_s, "
        f"CASE {x.locate('ho_v.x', 'ho_v.y', es)} WHEN 1 THEN 1 WHEN 0 THEN -1 ELSE 0 END))"
    )
    inside = candidate_pairs(_boxed(holes, "hole_pts"), _boxed(outer, "pts")).filter(_same(by)).filter(F.expr(f"{spot} = 1"))
    return inside.groupBy(*(F.col(f"a_{c}").alias(c) for c in by), F.col("a_hole").alias("hole")).agg(F.min_by("b_ring", F.struct("b_area", "b_ring")).alias("ring"))


def _with_holes(outer: DataFrame, holes: DataFrame, by: list[str], srid: int) -> DataFrame:
    """Polygons (by, fid, geom) of the outer rings, with the holes they own."""
    owned = _owned(holes, outer, by).join(holes.select("hole", "hole_pts"), "hole").groupBy("ring").agg(F.collect_list("hole_pts").alias("_h"))
    # ring numbers are unique over all groups
    joined = outer.join(owned, "ring", "left")
    none = f"CAST(array() AS ARRAY<{x.RING}>)"
    return joined.select(*by, F.col("ring").alias("fid"), F.expr(x.polygon(f"concat(array(pts), coalesce(_h, {none}))", srid)).alias("geom"))


def dissolve(layer: DataFrame, by: list[str], srid: int = 0) -> DataFrame:
    """Union of each group of an edge-matched coverage as a polygon layer, one row per outer ring.

    Holes are given to the smallest outer ring of their group that surrounds them.
    """
    rings = cut_lineage(trace_rings(outline_edges(layer, by), by))
    outer = rings.filter("area > 0").select(*by, "ring", "pts", "area")
    holes = rings.filter("area < 0").select(*by, F.col("ring").alias("hole"), F.col("pts").alias("hole_pts"))
    return _with_holes(outer, holes, by, srid)


def _faces(lines: DataFrame, by: list[str]) -> DataFrame:
    """Rings (by, ring, n, area, pts) of a noded network: faces have an area above 0, outer borders of its parts one below."""
    edges = edge_table(lines, keep=tuple(by)).filter("x1 <> x2 OR y1 <> y2").select(*by, "x1", "y1", "x2", "y2")
    both = edges.unionByName(edges.select(
        *by, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))).distinct()
    return cut_lineage(trace_rings(both, by))


def polygonize(lines: DataFrame, by: list[str], srid: int = 0) -> DataFrame:
    """Faces enclosed by a noded network of lines, as polygons; parts of the network inside a face are its holes (Polygonize)."""
    rings = _faces(lines, by)
    outer = rings.filter("area > 0").select(*by, "ring", "pts", "area")
    holes = rings.filter("area < 0").select(*by, F.col("ring").alias("hole"), F.col("pts").alias("hole_pts"))
    return _with_holes(outer, holes, by, srid)


def build_area(lines: DataFrame, by: list[str], srid: int = 0) -> DataFrame:
    """The area that a noded network of lines encloses, as polygons: what lies in the hole of a face is none, in a hole of that again one (BuildArea).

    The borders of the network's parts form a tree: a part hangs in the smallest border of another that surrounds it.  A part's border
    is an outer ring at an even depth and a hole of its parent at an odd one.
    """
    rings = _faces(lines, by)
    borders = cut_lineage(rings.filter("area < 0").select(*by, "ring", F.expr("reverse(pts)").alias("pts"), (-F.col("area")).alias("area")))
    inner = borders.select(*by, F.col("ring").alias("hole"), F.col("pts").alias("hole_pts"))
    up = _owned(inner, borders, by).select(F.col("hole").alias("id"), F.col("ring").alias("up"))
    tree = cut_lineage(borders.select(F.col("ring").alias("id")).join(up, "id", "left").withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1)))
    parent = tree.select(F.col("id").alias("hole"), F.col("up").alias("ring"))
    while not tree.filter("up IS NOT NULL").isEmpty():  # doubles the part of the tree that is known
        above = tree.select(F.col("id").alias("up"), F.col("up").alias("_uu"), F.col("depth").alias("_ud"))
        tree = cut_lineage(tree.join(above, "up", "left").select("id", F.col("_uu").alias("up"), (F.col("depth") + F.coalesce("_ud", F.lit(0))).alias("depth")))
    odd = tree.filter("depth % 2 = 1").select(F.col("id").alias("hole"))
    holes = odd.join(parent, "hole").join(borders.select(F.col("ring").alias("hole"), "pts"), "hole").groupBy("ring").agg(F.collect_list(F.expr("reverse(pts)")).alias("_h"))
    outer = borders.join(odd.withColumnRenamed("hole", "ring"), "ring", "left_anti").join(holes, "ring", "left")
    none = f"CAST(array() AS ARRAY<{x.RING}>)"
    return outer.select(*by, F.col("ring").alias("fid"), F.expr(x.polygon(f"concat(array(pts), coalesce(_h, {none}))", srid)).alias("geom"))


# ---------------------------------------------------------------- hull

DIRECTIONS = 16
HULL_POINTS = 512  # points whose hull is made in one row


def _outermost(points: DataFrame, by: str) -> DataFrame:
    """Points (by, x, y) without those inside the polygon of their group's extremes in ``DIRECTIONS`` directions: they are no corners."""
    turn = 2 * math.pi / DIRECTIONS
    reach = [F.max_by(F.struct("x", "y"), F.expr(f"x * {math.cos(i * turn)!r}D + y * {math.sin(i * turn)!r}D")) for i in range(DIRECTIONS)]
    tips = points.groupBy(by).agg(F.array(*reach).alias("_t"))
    fence = tips.select(F.col(by).alias("_k"), F.expr(x.hull_points("_t")).alias("_c")).withColumn("_fence", F.expr("zip_with(_c, concat(slice(_c, 2, size(_c)), slice(_c, 1, 1)), (p, q) -> named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y))"))
    inside = "size(_fence) >= 3 AND forall(_fence, hu_e -> " + x.orient("hu_e.x1", "hu_e.y1", "hu_e.x2", "hu_e.y2", "x", "y") + " > 0)"
    return points.join(fence.select("_k", "_fence"), F.col(by).eqNullSafe(F.col("_k"))).filter(f"NOT ({inside})").select(by, "x", "y")


def convex_hull(layer: DataFrame, by: str) -> DataFrame:
    """(by, n, area, geom): hull of all vertices of each group.

    Points inside the polygon of the extremes in 16 directions go first.  The rest is numbered along x and cut into rows of
    ``HULL_POINTS`` points, whose hulls are points again, until every group is one row: as long as its hull is, no task holds more.
    """
    tips = vertex_table(layer, keep=(by,)).groupBy(by, "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    points = _outermost(tips.select(by, "x", F.explode(F.array("lo", "hi")).alias("y")), by)
    room = HULL_POINTS
    while True:
        packed = group_numbers(points.distinct(), [by], ["x", "y"], "_n").groupBy(by, F.expr(f"_n div {room}").alias("_b")).agg(F.collect_list(F.struct("x", "y")).alias("_p"))
        hulls = cut_lineage(packed.select(by, "_b", F.expr(x.hull_points("_p")).alias("_c")))
        if hulls.filter("_b > 0").isEmpty():
            break
        points = hulls.select(by, F.explode("_c").alias("_v")).select(by, "_v.x", "_v.y")
        room *= 2  # a round shape has as many corners as it has
    shaped = hulls.select(by, F.size("_c").alias("n"), F.expr(x.hull_geometry("_c")).alias("geom"))
    return shaped.select(by, "n", F.expr(x.area("geom")).alias("area"), "geom")
