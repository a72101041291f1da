"""Layers as plain tables: vertices, edges, rings, parts and join-ready shapes.

All of these are map-only: one layer row is expanded where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x

BOUNDS = ("xmin", "ymin", "xmax", "ymax")
RUN = 256  # edges kept together in one run
PIECE_EDGES = 64  # polygons with more edges are sliced into bands


def with_bounds(layer: DataFrame, geom: str = "geom") -> DataFrame:
    """Add xmin..ymax from the geometry unless the layer already carries them."""
    if set(BOUNDS) <= set(layer.columns):
        return layer
    boxed = layer.withColumn("_box", F.expr(x.bounds(f"`{geom}`")))
    return boxed.select(*layer.columns, *(F.col(f"_box.{b}").alias(b) for b in BOUNDS))


def _rings(layer: DataFrame, keep: tuple[str, ...], geom: str) -> DataFrame:
    parts = layer.select(*keep, F.posexplode(f"{geom}.parts").alias("part", "_p"))
    return parts.select(*keep, "part", F.col("_p.kind").alias("kind"), F.posexplode("_p.rings").alias("ring", "_r"))


def ring_table(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom") -> DataFrame:
    """One row per ring: part, kind, ring and its vertices as ``pts``."""
    return _rings(layer, keep, geom).withColumnRenamed("_r", "pts")


def vertex_table(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom") -> DataFrame:
    """One row per vertex: part, ring and seq count from 0."""
    flat = _rings(layer, keep, geom).select(*keep, "part", "ring", F.posexplode("_r").alias("seq", "_v"))
    return flat.select(*keep, "part", "ring", "seq", "_v.x", "_v.y", "_v.z")


def spread(rows: DataFrame) -> DataFrame:
    """The same rows over all tasks: a table of few bytes lies in one split, whose task would also make all geometries of its rows.

    Rows are dealt in turn by their number in the split; dealing them without a key would first sort the split in its one task.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.withColumn("_turn", F.monotonically_increasing_id()).repartition(tasks, "_turn").drop("_turn")


def edge_table(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom") -> DataFrame:
    """One row per edge of lines and polygon rings."""
    flat = _rings(layer, keep, geom).select(
        *keep, "part", "kind", "ring", F.posexplode(F.expr(x.ring_edges("_r"))).alias("seq", "_e"))
    return flat.select(*keep, "part", "kind", "ring", "seq", "_e.x1", "_e.y1", "_e.x2", "_e.y2")


def part_table(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom") -> DataFrame:
    """One row per part, as a geometry of its own."""
    parts = layer.select(*keep, F.col(f"{geom}.srid").alias("_s"), F.posexplode(f"{geom}.parts").alias("part", "_p"))
    return parts.select(*keep, "part", F.expr(x.geom("_p.kind", "_s", "array(_p)")).alias("geom"))


def shapes(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom") -> DataFrame:
    """Bounds, edges, dimension, line ends and part anchors of every feature."""
    return with_bounds(layer, geom).select(
        *keep, *BOUNDS,
        F.expr(x.edges(geom)).alias("es"),
        F.expr(x.dimension(geom)).alias("dim"),
        F.expr(x.ends(geom)).alias("ends"),
        F.expr(x.anchors(geom)).alias("anchors"),
    )


def _edge_bounds(es: str) -> list[Column]:
    lo, hi = "array_min(transform({e}, eb_e -> least(eb_e.{c}1, eb_e.{c}2)))", "array_max(transform({e}, eb_e -> greatest(eb_e.{c}1, eb_e.{c}2)))"
    return [
        F.expr(lo.format(e=es, c="x")).alias("xmin"), F.expr(lo.format(e=es, c="y")).alias("ymin"),
        F.expr(hi.format(e=es, c="x")).alias("xmax"), F.expr(hi.format(e=es, c="y")).alias("ymax"),
    ]


def edge_runs(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom", run: int = RUN) -> DataFrame:
    """Consecutive edges in runs of at most ``run``, each with its own bounds.

    A feature of ordinary size is one run; a very long outline becomes many small
    join rows instead of one that meets everything.
    """
    whole = layer.select(*keep, F.expr(x.edges(geom)).alias("_es"))
    cut = whole.select(
        *keep,
        F.expr(f"explode(transform(sequence(0, greatest(size(_es) - 1, 0) div {run}), "
               f"er_i -> slice(_es, CAST(er_i * {run} + 1 AS INT), {run})))").alias("es"),
    ).filter(F.size("es") > 0)
    return cut.select(*keep, "es", *_edge_bounds("es"))


def polygon_pieces(layer: DataFrame, keep: tuple[str, ...] = ("fid",), geom: str = "geom",
                   piece_edges: int = PIECE_EDGES) -> DataFrame:
    """Polygons sliced into horizontal bands, each holding just the edges that reach it.

    Whether a point lies in a polygon depends only on the edges at its height, so a
    point needs one band (``y0 <= y < y1``; the topmost band keeps its upper bound).
    Small polygons stay whole; a polygon of n edges gets about sqrt(n) bands.
    """
    only = f"filter({geom}.parts, pp_p -> pp_p.kind = 3)"
    whole = with_bounds(layer, geom).select(
        *keep, *BOUNDS,
        F.expr("flatten(transform(" + only + ", pp_q -> flatten(transform(pp_q.rings, pp_r -> "
               + x.ring_edges("pp_r") + "))))").alias("_es"),
    ).filter(F.size("_es") > 0)
    banded = whole.withColumn(
        "_n", F.expr(f"IF(size(_es) <= {piece_edges}, 1, CAST(ceil(sqrt(size(_es))) AS INT))")
    ).withColumn("_i", F.expr("explode(sequence(0, _n - 1))"))
    low = "ymin + (ymax - ymin) * _i / _n"
    high = "IF(_i = _n - 1, ymax, ymin + (ymax - ymin) * (_i + 1) / _n)"
    cut = banded.select(*keep, "xmin", "xmax", "_n", "_i", "_es",
                        F.expr(low).alias("y0"), F.expr(high).alias("y1"))
    return cut.select(
        *keep, "xmin", F.col("y0").alias("ymin"), "xmax", F.col("y1").alias("ymax"),
        F.expr("_i = _n - 1").alias("top"),
        F.expr("IF(_n = 1, _es, filter(_es, pb_e -> greatest(pb_e.y1, pb_e.y2) >= y0 AND least(pb_e.y1, pb_e.y2) <= y1))").alias("es"),
    )
