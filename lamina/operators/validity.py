"""Report of broken geometries, one row per feature and defect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators import outlines
from lamina.operators.grid import candidate_pairs
from lamina.operators.tables import RUN, _edge_bounds, ring_table


def _crossings(rings: DataFrame, any_long: bool) -> DataFrame:
    """(fid, part, ring) with two edges of the same ring that meet where they should not.

    A ring that fits a run is looked at in its row; longer ones are cut into runs of edges, which are joined where their boxes meet.
    """
    listed = rings.select("fid", "part", "ring", F.expr(x.ring_edges("pts")).alias("_es"), F.expr(x.closed_ring("pts")).alias("closed"))
    runs = listed.select(
        "fid", "part", "ring", "closed", F.size("_es").alias("n"),
        F.posexplode(F.expr(f"transform(sequence(0, greatest(size(_es) - 1, 0) div {RUN}), cr_i -> "
                            f"slice(_es, CAST(cr_i * {RUN} + 1 AS INT), {RUN}))")).alias("run", "es"),
    ).filter(F.size("es") > 0)
    keys = ("fid", "part", "ring", "closed", "n")
    pairs = runs.filter(f"n <= {RUN}").select(*keys, F.col("run").alias("a_run"), F.col("run").alias("b_run"), F.col("es").alias("a_es"), F.col("es").alias("b_es"))
    if any_long:
        boxed = runs.filter(f"n > {RUN}").select("*", *_edge_bounds("es"))
        met = candidate_pairs(boxed, boxed).filter("a_fid = b_fid AND a_part = b_part AND a_ring = b_ring AND a_run <= b_run")
        pairs = pairs.unionByName(met.select(*(F.col(f"a_{c}").alias(c) for c in keys), "a_run", "b_run", "a_es", "b_es"))
    i, j = f"(a_run * {RUN} + vc_i)", f"(b_run * {RUN} + vc_j)"
    apart = f"({j} > {i} + 1 AND NOT (closed AND {i} = 0 AND {j} = n - 1))"
    # neighbours share a vertex; they are wrong only when the second runs back over the first
    def runs_back(first: str, second: str) -> str:
        turn = x.orient(f"{first}.x1", f"{first}.y1", f"{first}.x2", f"{first}.y2", f"{second}.x2", f"{second}.y2")
        dot = f"({first}.x2 - {first}.x1) * ({second}.x2 - {second}.x1) + ({first}.y2 - {first}.y1) * ({second}.y2 - {second}.y1)"
        return f"({turn} = 0 AND {dot} < 0)"

    back = (
        f"({j} = {i} + 1 AND {runs_back('vc_e', 'vc_f')}) OR "
        f"(closed AND {i} = 0 AND {j} = n - 1 AND {j} > {i} AND {runs_back('vc_f', 'vc_e')})"
    )
    hit = (
        "array_contains(flatten(transform(a_es, (vc_e, vc_i) -> transform(b_es, (vc_f, vc_j) -> "
        f"({apart} AND {x.edges_touch('vc_e', 'vc_f')}) OR {back}))), true)"
    )
    return pairs.filter(F.expr(hit)).select("fid", "part", "ring").distinct()


def _holes(rings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fid, part, ring) of holes that lie outside their shell or across it, and of those that overlap an earlier hole of their part.

    Rings of any length: their outlines are compared by runs.
    """
    whole = rings.filter((F.col("kind") == 3) & (F.size("pts") >= 4) & F.expr(x.closed_ring("pts")))
    polygons = whole.select(F.struct("fid", "part", "ring").alias("fid"), F.expr(x.polygon("array(pts)")).alias("geom"))
    shells, holes = polygons.filter("fid.ring = 0"), polygons.filter("fid.ring > 0")
    together = "a_fid.fid = b_fid.fid AND a_fid.part = b_fid.part"
    placed = outlines.pair_bits(holes, shells, together)
    inside = placed.filter(f"a_bits & {outlines.OUTSIDE} = 0").select(F.col("a_fid").alias("fid"))
    outside = holes.select("fid").join(inside, "fid", "left_anti")
    met = outlines.pair_bits(holes, holes, f"{together} AND a_fid.ring < b_fid.ring")
    both = f"(a_bits & {outlines.INSIDE} <> 0 OR b_bits & {outlines.INSIDE} <> 0 OR a_bits & {outlines.OUTSIDE} = 0 AND b_bits & {outlines.OUTSIDE} = 0)"
    overlapping = met.filter(both).select(F.col("b_fid").alias("fid")).distinct()
    return outside.select("fid.*"), overlapping.select("fid.*")


def defects(layer: DataFrame) -> DataFrame:
    """(fid, defect, n): n rings (or the whole feature) with each kind of defect.

    empty, not_closed, too_few_vertices, zero_area, hole_outside, holes_overlap (polygons) and self_crossing (any ring or line).
    """
    empty = layer.filter(F.expr(f"coalesce({x.n_points('geom')}, 0) <= 0")).select("fid", F.lit("empty").alias("defect"))
    rings = ring_table(layer)
    poly = F.col("kind") == 3
    found = F.array_compact(F.array(
        F.when(poly & ~F.expr(x.closed_ring("pts")), F.lit("not_closed")),
        F.when(poly & (F.size("pts") < 4) | (F.col("kind") == 2) & (F.size("pts") < 2), F.lit("too_few_vertices")),
        F.when(poly & F.expr(x.closed_ring("pts")) & (F.expr(x.ring_area("pts")) == 0), F.lit("zero_area")),
    ))
    simple = rings.select("fid", F.explode(found).alias("defect"))
    long = outlines.big(layer)
    any_long = not long.isEmpty()
    crossed = _crossings(rings.filter("kind > 1"), any_long).select("fid", F.lit("self_crossing").alias("defect"))
    # holes of features that fit a run are looked at in their row
    parts = outlines.small(layer).select("fid", F.explode("geom.parts").alias("p")).filter("p.kind = 3 AND size(p.rings) > 1").select("fid", F.expr(x.hole_faults("p")).alias("f"))
    for count, defect in (("outside", "hole_outside"), ("overlapping", "holes_overlap")):
        crossed = crossed.unionByName(parts.select("fid", F.explode(F.expr(f"IF(f.{count} > 0, sequence(1, f.{count}), CAST(array() AS array<int>))"))).select("fid", F.lit(defect).alias("defect")))
    if any_long:
        outside, overlapping = _holes(ring_table(long))
        crossed = crossed.unionByName(outside.select("fid", F.lit("hole_outside").alias("defect"))).unionByName(overlapping.select("fid", F.lit("holes_overlap").alias("defect")))
    return empty.unionByName(simple).unionByName(crossed).groupBy("fid", "defect").agg(F.count(F.lit(1)).alias("n"))


def validity(layer: DataFrame) -> DataFrame:
    """(fid, is_valid, is_simple, is_empty, is_closed) of every feature."""
    bad = defects(layer).groupBy("fid").agg(
        F.lit(True).alias("_bad"), F.bool_or(F.col("defect") == "self_crossing").alias("_crossed"))
    closed = f"forall({x.rings('geom')}, va_r -> {x.closed_ring('va_r')})"
    return layer.join(bad, "fid", "left").select(
        "fid", F.col("_bad").isNull().alias("is_valid"), (~F.coalesce("_crossed", F.lit(False))).alias("is_simple"),
        F.expr(f"coalesce({x.n_points('geom')}, 0) <= 0").alias("is_empty"), F.expr(closed).alias("is_closed"))
