"""Packed trees over the boxes of a layer, as tables, and the order along a space-filling curve they rest on.

Features are numbered along a space-filling curve; ``FAN`` consecutive ones make a node, ``FAN`` consecutive nodes a node of the next
level, up to one root.  A node's number divided by ``FAN`` is its parent's, so a level is one aggregation of the level below and a descent
one equi-join a level.  Depth depends on the number of features alone, not on how they lie: crowded places and far outliers get nodes
that fit them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import exprs as x
from lamina.operators.grid import SMALL_BYTES
from lamina.operators.ordered import dense_ids
from lamina.operators.tables import BOUNDS, with_bounds
from lamina.session import cut_lineage

FAN = 16
NODE_BYTES = 160  # of a node's or a feature's row without its geometry, in a broadcast
STEPS = 30  # bits of a place along each axis
SLACK = 1e-9  # relative; bounds of rounded squares are no sharper


def _spread(v: str) -> str:
    """SQL: the bits of a number below 2^31, each followed by a zero."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = x.let(v, f"sp_{shift}", f"((sp_{shift} | shiftleft(sp_{shift}, {shift})) & {mask}L)")
    return v


def curve(px: str, py: str, extent: tuple[float, float, float, float]) -> str:
    """SQL: place along a Z-shaped curve through an extent (xmin, ymin, xmax, ymax), a long."""
    x0, y0, x1, y1 = extent
    side = max(x1 - x0, y1 - y0) or 1.0

    def step(v: str, low: float) -> str:
        return f"CAST(least(greatest(({v} - ({low!r}D)) / ({side!r}D), 0D), 1D) * {(1 << STEPS) - 1} AS bigint)"

    return f"(shiftleft({_spread(step(py, y0))}, 1) | {_spread(step(px, x0))})"


def along_curve(boxed: DataFrame) -> tuple[str | None, int]:
    """Place along the curve of every row's middle (SQL over xmin .. ymax), and the number of rows; one pass over the bounds."""
    e = boxed.agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0"), F.max("xmax").alias("x1"), F.max("ymax").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    if e.x0 is None:
        return None, e.n
    return curve("((xmin + xmax) / 2)", "((ymin + ymax) / 2)", (e.x0, e.y0, e.x1, e.y1)), e.n


def anchored(layer: DataFrame) -> DataFrame:
    """(fid, bounds, px, py) of the features that have a place; the anchor (px, py) is a vertex of the feature."""
    first = F.expr(x.anchors("geom"))[0]
    return with_bounds(layer).select("fid", *BOUNDS, first["x"].alias("px"), first["y"].alias("py")).filter("xmin IS NOT NULL AND px IS NOT NULL")


class Tree:
    """Levels of a packed tree: level 0 has the boxes (id, fid, bounds, anchor), the levels above the nodes (id, bounds, anchor bounds)."""

    def __init__(self, boxes: DataFrame):
        """``boxes``: (fid, xmin, ymin, xmax, ymax, px, py) with an anchor in every box; fid may be any column that can be sorted."""
        place, self.n = along_curve(boxes)
        self.kind = boxes.schema["fid"].dataType
        self.levels: list[tuple[DataFrame, int]] = []
        if place is None:
            return
        # the id is the last key, so any number of equal places spreads over the ranges
        numbered = cut_lineage(dense_ids(boxes.select("fid", *BOUNDS, "px", "py", F.expr(place).alias("_z")), ["_z", "xmin", "ymin", "fid"], "id").drop("_z"))
        below = numbered.withColumns({"ax0": F.col("px"), "ay0": F.col("py"), "ax1": F.col("px"), "ay1": F.col("py")})
        self.levels.append((below.drop("px", "py"), self.n))
        n = self.n
        while n > 1:
            n = -(-n // FAN)
            below = below.groupBy(F.expr(f"id div {FAN}").alias("id")).agg(*(F.min(c).alias(c) for c in ("xmin", "ymin", "ax0", "ay0")), *(F.max(c).alias(c) for c in ("xmax", "ymax", "ax1", "ay1")))
            below = cut_lineage(below)
            self.levels.append((below, n))

    def near(self, a: DataFrame, within: float = float("inf"), small_bytes: int = SMALL_BYTES) -> DataFrame:
        """(a_fid, b_fid) that hold the nearest box of the tree for every box of ``a`` (fid, bounds, px, py): few pairs each.

        From the root down a box of ``a`` keeps the nodes whose box isn't farther than the nearest anchor it is sure of (``within`` at
        first): every side of a node's anchor bounds has an anchor on it, so one lies no farther than the farther end of the nearest side.
        """
        asks = a.select(F.col("fid").alias("a_fid"), *(F.col(c).alias(f"a_{c}") for c in BOUNDS), F.col("px").alias("x"), F.col("py").alias("y"))
        if not self.levels:
            return asks.select("a_fid", F.lit(None).cast(self.kind).alias("b_fid")).filter("false")
        # rows of a box stay in their partition down to the leaves
        front = asks.repartition("a_fid").withColumn("node", F.lit(0).cast("long")).withColumn("sure", F.lit(within * within))
        own = front.columns
        for level, (nodes, n) in reversed(list(enumerate(self.levels))):
            side = nodes.select(F.expr(f"id div {FAN}").alias("node"), "id", *([] if level else ["fid"]), *BOUNDS, "ax0", "ay0", "ax1", "ay1")
            met = front.join(F.broadcast(side) if n * NODE_BYTES <= small_bytes else side.hint("merge"), "node")
            apart = "power(greatest(xmin - a_xmax, a_xmin - xmax, 0D), 2) + power(greatest(ymin - a_ymax, a_ymin - ymax, 0D), 2)"
            both = met.withColumn("low", F.expr(apart)).withColumn("high", F.expr(_farthest_of_nearest_side())).filter(F.col("low") <= F.col("sure") * (1 + SLACK))
            best = F.least("sure", F.min("high").over(Window.partitionBy("a_fid")))
            front = both.withColumn("best", best).filter(F.col("low") <= F.col("best") * (1 + SLACK))
            if level:
                front = front.select(*(c for c in own if c not in ("node", "sure")), F.col("id").alias("node"), F.col("best").alias("sure")).select(*own)
        return front.select("a_fid", F.col("fid").alias("b_fid"))


def _farthest_of_nearest_side() -> str:
    """SQL: square of the distance within which a place (x, y) surely meets an anchor of the bounds ax0 .. ay1."""
    def near(v: str, lo: str, hi: str) -> str:
        return f"IF({v} <= ({lo} + {hi}) / 2, {lo}, {hi})"

    def far(v: str, lo: str, hi: str) -> str:
        return f"IF({v} >= ({lo} + {hi}) / 2, {lo}, {hi})"

    nx, ny, fx, fy = near("x", "ax0", "ax1"), near("y", "ay0", "ay1"), far("x", "ax0", "ax1"), far("y", "ay0", "ay1")
    return f"least(power(x - {nx}, 2) + power(y - {fy}, 2), power(x - {fx}, 2) + power(y - {ny}, 2))"
