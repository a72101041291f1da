"""Tracks and positions along lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.ordered import TRACK_ROWS, Tracks, group_numbers

PIECE_POINTS = 10_000  # edges of a made line; a longer track is several

_STEP = "sqrt((x - prev_x) * (x - prev_x) + (y - prev_y) * (y - prev_y))"


def track_steps(vertices: DataFrame, order: list[str], track_rows: int = TRACK_ROWS) -> DataFrame:
    """Vertices (fid, x, y, order columns) with seq, the previous vertex, step length and distance so far."""
    tracks = Tracks(vertices, "fid", order, track_rows).number("seq").previous(["x", "y"])
    tracks.df = tracks.df.withColumn("step", F.expr(_STEP))
    return tracks.running("step", "dist").result()


def track_summary(vertices: DataFrame, order: list[str], track_rows: int = TRACK_ROWS) -> DataFrame:
    """(fid, n, length) of the line through the ordered vertices of each fid."""
    tracks = Tracks(vertices, "fid", order, track_rows).previous(["x", "y"])
    steps = tracks.result().select("fid", F.expr(_STEP).alias("step"))
    return steps.groupBy("fid").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"))


def make_line(vertices: DataFrame, order: list[str], srid: int = 0, piece_points: int = PIECE_POINTS) -> DataFrame:
    """(fid, piece, geom): the line through the ordered vertices of each fid, as lines of at most ``piece_points`` edges.

    Pieces count from 0 and each begins where the one before ends, so together they are the track; a track of up to ``piece_points``
    edges is one line.  Vertices are numbered by two-step prefix sums over ranges, so no task holds a track.
    """
    numbered = group_numbers(vertices.select("fid", *order, "x", "y"), ["fid"], order, "_n")
    # the vertex between two pieces belongs to both
    spread = numbered.select("fid", "_n", "x", "y", F.explode(F.expr(f"IF(_n > 0 AND _n % {piece_points} = 0, array(_n div {piece_points} - 1, _n div {piece_points}), array(_n div {piece_points}))")).alias("piece"))
    rows = spread.groupBy("fid", "piece").agg(F.array_sort(F.collect_list(F.struct("_n", "x", "y"))).alias("_v")).filter("piece = 0 OR size(_v) > 1")
    ring = f"transform(_v, ml_v -> {x.vertex('ml_v.x', 'ml_v.y')})"
    return rows.select("fid", "piece", F.expr(x.line(ring, srid)).alias("geom"))


def interpolate_tracks(vertices: DataFrame, order: list[str], fractions: list[float],
                       track_rows: int = TRACK_ROWS) -> DataFrame:
    """(fid, fraction, x, y): the places at the given fractions of each track's length."""
    steps = track_steps(vertices, order, track_rows).filter("seq > 1")
    totals = steps.groupBy("fid").agg(F.max("dist").alias("total"))
    at = F.explode(F.array(*map(F.lit, fractions))).alias("fraction")
    spans = steps.join(totals, "fid").select("fid", "seq", "x", "y", "prev_x", "prev_y", "step", "dist", "total", at)
    target = F.col("fraction") * F.col("total")
    # the first span reaching the target; the slack keeps it in spite of rounding
    slack = F.lit(1e-9) * (F.lit(1.0) + F.col("total"))
    hit = spans.filter((F.col("dist") >= target) & ((F.col("dist") - F.col("step")) <= target + slack))
    part = F.when(F.col("step") == 0, F.lit(0.0)).otherwise((target - (F.col("dist") - F.col("step"))) / F.col("step"))
    placed = hit.select(
        "fid", "fraction", "seq",
        (F.col("prev_x") + part * (F.col("x") - F.col("prev_x"))).alias("x"),
        (F.col("prev_y") + part * (F.col("y") - F.col("prev_y"))).alias("y"))
    first = placed.groupBy("fid", "fraction").agg(F.min_by(F.struct("x", "y"), "seq").alias("_p"))
    return first.select("fid", "fraction", "_p.x", "_p.y")
