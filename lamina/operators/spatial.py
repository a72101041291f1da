"""Spatial joins and relations of two layers.

Layers are DataFrames with ``fid`` and ``geom`` (and, optionally, xmin..ymax).  Every
operator returns pairs ``(a_fid, b_fid, ...)``; join them back to attributes as needed.

Features of one shape are held as one row with the list of their ids (:mod:`lamina.operators.copies`), so a rule runs once per pair
of shapes; ``*_classes`` return pairs of such rows, in which a_fid and b_fid are lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.functions import relate as r
from lamina.operators import outlines
from lamina.operators.copies import each, ids, packed
from lamina.operators.grid import candidate_pairs, keep_pairs
from lamina.operators.packed import Tree, anchored
from lamina.operators.tables import BOUNDS, edge_runs, polygon_pieces, shapes, with_bounds
from lamina.session import cut_lineage


def _points(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Point rows with a box of no size."""
    x_, y_ = F.col("x"), F.col("y")
    return rows.select(*keep, "x", "y", x_.alias("xmin"), y_.alias("ymin"), x_.alias("xmax"), y_.alias("ymax"))


def _anchor_points(layer: DataFrame) -> DataFrame:
    """First vertex of every part of every feature."""
    tips = layer.select("fid", F.explode(F.expr(x.anchors("geom"))).alias("_v"))
    return tips.select("fid", "_v.x", "_v.y")


def _classes(layer: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(bounds, geom, fid) of the features that have a place, one row per shape; ``fid`` is a list."""
    return packed(with_bounds(layer).filter("xmin IS NOT NULL AND ymin IS NOT NULL"), [*BOUNDS, "geom"], carried)


def one_each(rows: DataFrame, on: tuple[str, ...] = ("geom",)) -> DataFrame:
    """One row (fid, on) of those with equal values in ``on``: enough to see what has a match."""
    return rows.groupBy(*on).agg(F.min("fid").alias("fid"))


def point_in_polygon(points: DataFrame, polygons: DataFrame, point_columns: tuple[str, ...] = (),
                     polygon_columns: tuple[str, ...] = (), **options) -> DataFrame:
    """(a_fid, b_fid, place) for points (fid, x, y) in polygons; place is 'inside' or 'boundary'.

    Holes are honoured.  Each point meets one band of a polygon, so a pair appears once.  Columns
    named in ``point_columns`` and ``polygon_columns`` travel along as a_* and b_*, which saves
    joining them back.
    """
    return each(place_classes(points, polygons, point_columns, polygon_columns, **options), point_columns, polygon_columns)


def place_classes(points: DataFrame, polygons: DataFrame, point_columns: tuple[str, ...] = (),
                  polygon_columns: tuple[str, ...] = (), **options) -> DataFrame:
    """(a_fid, b_fid, place) as :func:`point_in_polygon`, by lists."""
    spots = packed(points.filter("x IS NOT NULL AND y IS NOT NULL"), ["x", "y"], point_columns)
    pieces = polygon_pieces(_classes(polygons, polygon_columns))
    pairs = candidate_pairs(_points(spots, ["fid"]), pieces, **options)
    mine = pairs.filter("b_top OR a_y < b_ymax")
    placed = mine.select("a_fid", "b_fid", F.explode(F.array(F.expr(x.locate("a_x", "a_y", "b_es")))).alias("_at"))
    return placed.filter("_at > 0").select(
        "a_fid", "b_fid", F.when(F.col("_at") == 1, "inside").otherwise("boundary").alias("place"))


@dataclass(frozen=True)
class Shapes:
    """A layer made ready to be joined: ``small`` has the features that fit a run of edges, one row per shape; ``big`` the longer ones, None without any.

    Features are split by their own size, so a big one doesn't move the others out of the rows they lie in.
    """

    small: DataFrame
    big: DataFrame | None
    whole: DataFrame


def by_shape(layer: DataFrame | Shapes) -> Shapes:
    """The layer, read and packed once; hand the result to several joins of the same layer."""
    if isinstance(layer, Shapes):
        return layer
    big = outlines.big(layer)
    if big.isEmpty():
        return Shapes(shapes(_classes(layer)), None, layer)
    return Shapes(shapes(_classes(outlines.small(layer))), big, layer)


def _by_size(a: DataFrame | Shapes, b: DataFrame | Shapes) -> tuple[tuple[DataFrame, DataFrame], list[tuple[DataFrame, DataFrame]]]:
    """Parts of two layers that make up all pairs: the packed small features, and the pairs of parts with big ones (more vertices than a run has edges)."""
    left = by_shape(a)
    right = left if b is a else by_shape(b)
    parts = []
    if left.big is not None:
        parts.append((left.big, right.whole))
    if right.big is not None:
        parts.append((left.whole if left.big is None else outlines.small(left.whole), right.big))
    return (left.small, right.small), parts


def intersecting_pairs(a: DataFrame | Shapes, b: DataFrame | Shapes, a_dim: int | None = None, b_dim: int | None = None,
                       **options) -> DataFrame:
    """Distinct (a_fid, b_fid) of features of any kind that share a point.

    Either some edges touch, or one feature lies wholly inside a polygon of the other.
    Give the dimension of a layer (0 points, 1 lines, 2 polygons) when known to skip branches.
    """
    return related_pairs(a, b, "intersects", a_dim, b_dim, **options)


def _held(a: DataFrame, b: DataFrame, a_dim: int | None, b_dim: int | None, options: dict) -> list[DataFrame]:
    """Pairs in which a polygon of one layer holds the first vertex of some part of the other."""
    found = []
    if b_dim in (None, 2):
        found.append(point_in_polygon(_anchor_points(a), b, **options).select("a_fid", "b_fid"))
    if a_dim in (None, 2):
        held = point_in_polygon(_anchor_points(b), a, **options)
        found.append(held.select(F.col("b_fid").alias("a_fid"), F.col("a_fid").alias("b_fid")))
    return found


def left_spatial(a: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """LEFT JOIN semantics: every row of ``a``, with b_fid NULL where nothing matched."""
    return a.select(F.col("fid").alias("a_fid"), *columns).join(pairs, "a_fid", "left")


def left_classes(a: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`left_spatial` for pairs of lists: no more than the rows of ``a`` and the lists are shuffled, not the pairs."""
    classes = cut_lineage(classes.select("a_fid", "b_fid"))
    lists = cut_lineage(classes.select("a_fid").distinct().withColumn("_l", F.monotonically_increasing_id()))
    met = classes.join(lists, "a_fid").select("_l", "b_fid")
    own = a.select(F.col("fid").alias("a_fid"), *columns).join(lists.select("_l", F.explode("a_fid").alias("a_fid")), "a_fid", "left")
    return own.join(met, "_l", "left").select("a_fid", *columns, F.explode_outer("b_fid").alias("b_fid"))


def disjoint_rows(a: DataFrame, b: DataFrame, a_dim: int | None = None, b_dim: int | None = None, **options) -> DataFrame:
    """Rows of ``a`` that share no point with any feature of ``b``."""
    own = ["fid", "geom", *(c for c in BOUNDS if c in b.columns)]
    # long outlines aren't shuffled as keys
    others = one_each(outlines.small(b), tuple(own[1:])).select(*own).unionByName(outlines.big(b).select(*own))
    met = related_classes(a, others, "intersects", a_dim, b_dim, **options)
    return without_match(a, ids(met, "a").withColumnRenamed("fid", "a_fid"))


def without_match(a: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``a`` that occur in no pair."""
    return a.join(pairs.select(F.col("a_fid").alias("fid")), "fid", "left_anti")


def related_pairs(a: DataFrame | Shapes, b: DataFrame | Shapes, relation: str, a_dim: int | None = None, b_dim: int | None = None,
                  **options) -> DataFrame:
    """(a_fid, b_fid) for one of within, contains, touches, overlaps, crosses, intersects.

    A pair whose features both fit a run of edges is decided in its row; where either is bigger, by the
    bits of its runs (:mod:`lamina.operators.outlines`), whatever the length of the outlines.
    """
    return each(related_classes(a, b, relation, a_dim, b_dim, **options))


def related_classes(a: DataFrame | Shapes, b: DataFrame | Shapes, relation: str, a_dim: int | None = None, b_dim: int | None = None,
                    **options) -> DataFrame:
    """(a_fid, b_fid) as :func:`related_pairs`, by lists."""
    (left, right), long = _by_size(a, b)
    pairs = candidate_pairs(left, right, **options)
    if relation in r.BOX_RULES:
        pairs = pairs.filter(r.BOX_RULES[relation])
    out = keep_pairs(pairs, r.predicate(relation, r.Side("a_", a_dim), r.Side("b_", b_dim))).select("a_fid", "b_fid")
    for left, right in long:
        found = outlines.related(left, right, relation, **options)
        out = out.unionByName(found.select(F.array("a_fid").alias("a_fid"), F.array("b_fid").alias("b_fid")))
    return out


def equal_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_fid, b_fid) of features with the same outline, whatever its start and direction.

    Equal geometries are grouped first (so outlines are shuffled once), then joined on the bounds and a hash of the outline.
    """
    def keyed(layer: DataFrame, side: str) -> DataFrame:
        base = _classes(layer).select(
            F.col("fid").alias(f"{side}_fid"), *(F.col(c).alias(f"_{c}") for c in BOUNDS),
            F.expr(r.edge_key(x.edges("geom"))).alias(f"_{side}key"), F.expr(x.dimension("geom")).alias("_dim"))
        return base.withColumn("_hash", F.xxhash64(f"_{side}key"))

    on = [*(f"_{c}" for c in BOUNDS), "_dim", "_hash"]
    return each(keyed(a, "a").join(keyed(b, "b"), on).filter("_akey = _bkey").select("a_fid", "b_fid"))


def _measured(pairs: DataFrame, meet: str) -> DataFrame:
    """Distance, its square and closest places of joined pairs of edge sets.

    Features that meet have places only where ends of their edges meet: elsewhere the nearest
    ends lie apart and would be no places at distance 0.
    """
    near = f"named_struct('t', {meet}, 'n', {x.closest('a_es', 'b_es')})"
    once = pairs.select("a_fid", "b_fid", F.explode(F.array(F.expr(near))).alias("_m"))
    apart = F.expr("_m.t AND _m.n.d2 > 0")
    return once.select("a_fid", "b_fid", F.expr("IF(_m.t, 0D, _m.n.d2)").alias("d2"), F.expr("IF(_m.t, 0D, sqrt(_m.n.d2))").alias("dist"),
                       *(F.when(~apart, F.col(f"_m.n.{c}")).alias(c) for c in ("ax", "ay", "bx", "by")))


def near_pairs(a: DataFrame | Shapes, b: DataFrame | Shapes, within: float, a_dim: int | None = None, b_dim: int | None = None,
               **options) -> DataFrame:
    """(a_fid, b_fid, dist, ax, ay, bx, by) of features at most ``within`` apart.

    dist is 0 for features that meet; (ax, ay) and (bx, by) are the ends of the shortest
    line between the two outlines, the least ones of several.  Features that meet nowhere at
    an end of an edge have no places (NULL).
    """
    return each(near_classes(a, b, within, a_dim, b_dim, **options))


def near_classes(a: DataFrame | Shapes, b: DataFrame | Shapes, within: float, a_dim: int | None = None, b_dim: int | None = None,
                 **options) -> DataFrame:
    """(a_fid, b_fid, dist, ax, ay, bx, by) as :func:`near_pairs`, by lists."""
    (left, right), long = _by_size(a, b)
    # the widened box of ``a`` only selects pairs; edges and anchors are untouched by it
    pairs = candidate_pairs(left, right, reach=within, **options)
    out = _measured(pairs, r.meets(r.Side("a_", a_dim), r.Side("b_", b_dim))).filter(F.col("dist") <= within).drop("d2")
    for left, right in long:
        found = _near_runs(left, right, within, a_dim, b_dim, options)
        out = out.unionByName(found.withColumns({"a_fid": F.array("a_fid"), "b_fid": F.array("b_fid")}))
    return out


def _near_runs(a: DataFrame, b: DataFrame, within: float, a_dim: int | None, b_dim: int | None, options: dict) -> DataFrame:
    spots = ("ax", "ay", "bx", "by")
    runs = candidate_pairs(edge_runs(a), edge_runs(b), reach=within, **options)
    measured = _measured(runs, x.any_edges_touch("a_es", "b_es"))
    for pairs in _held(a, b, a_dim, b_dim, options):
        zero = pairs.select("a_fid", "b_fid", F.lit(0.0).alias("d2"), F.lit(0.0).alias("dist"), *(F.lit(None).cast("double").alias(c) for c in spots))
        measured = measured.unionByName(zero)
    best = measured.filter(F.col("dist") <= within).groupBy("a_fid", "b_fid").agg(
        F.min_by(F.struct("dist", *spots), F.struct("d2", F.isnull("ax"), *spots)).alias("_m"))
    return best.select("a_fid", "b_fid", "_m.dist", *(f"_m.{c}" for c in spots))


def nearest(a: DataFrame, b: DataFrame, a_dim: int | None = None, b_dim: int | None = None, **options) -> DataFrame:
    """The nearest feature of ``b`` for every feature of ``a`` (ties: smallest b_fid): (a_fid, b_fid, dist, ax, ay, bx, by).

    A packed tree over ``b`` gives every feature of ``a`` its own first distance and the few features within it, wherever
    both are crowded or far apart; only those are measured.
    """
    mine = cut_lineage(_classes(a.filter("fid IS NOT NULL")).withColumn("_id", F.monotonically_increasing_id()))
    known = with_bounds(b).filter("fid IS NOT NULL AND xmin IS NOT NULL AND ymin IS NOT NULL")
    # of equal shapes the smallest id is the nearest
    other = cut_lineage(one_each(known, (*BOUNDS, "geom")).withColumn("_id", F.monotonically_increasing_id()))

    def numbered(classes: DataFrame) -> DataFrame:
        return anchored(classes.select(F.col("_id").alias("fid"), *BOUNDS, "geom"))

    def side(classes: DataFrame, name: str) -> DataFrame:
        own = shapes(classes, keep=("_id", "fid"))
        return own.select(*(F.col(c).alias(f"{name}_{c}") for c in own.columns))

    near = Tree(numbered(other)).near(numbered(mine), **options)
    pairs = cut_lineage(near.select(F.col("a_fid").alias("a__id"), F.col("b_fid").alias("b__id")))
    whole = pairs.join(side(mine, "a"), "a__id").join(side(other, "b"), "b__id")
    measured = _measured(whole.drop("a_fid").withColumnRenamed("a__id", "a_fid"), r.meets(r.Side("a_", a_dim), r.Side("b_", b_dim)))
    first = F.min_by(F.struct("b_fid", "dist", "ax", "ay", "bx", "by"), F.struct("dist", "b_fid")).alias("_m")
    best = measured.groupBy(F.col("a_fid").alias("_id")).agg(first).join(mine.select("_id", "fid"), "_id")
    every = best.select(F.explode("fid").alias("a_fid"), "_m.*")
    # an id may stand for several shapes
    return every.groupBy("a_fid").agg(first).select("a_fid", "_m.*")
