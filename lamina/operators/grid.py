"""Pairs of rows whose bounding boxes meet, found by an equi-join on grid cells.

Cells come in several sizes.  A row lives at the level whose cells are about as big as
its own box, so it covers at most four of them, and is looked up at the coarser levels
the other side really uses; a pair is joined once, at the coarser of its two levels, in
the one cell that holds the lower left corner of the common box.  Nothing is capped and
no duplicates have to be removed, however uneven the box sizes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import exprs as x
from lamina.operators.copies import each, packed
from lamina.operators.tables import BOUNDS
from lamina.sources.readers import is_geometry

SMALL_BYTES = 64 << 20  # a side below this (checked) is broadcast
HOT_ROWS = 1_000_000  # cells with more rows than this are split
HOT_KEY_BYTES = 256  # room for one hot key when their table is broadcast
FEW_ROWS = 2_000_000  # up to here a side is spread over all tasks before it is joined
RARE_ROWS = 1_000  # levels holding at most so many rows of each side join the next coarser one


def salted_join(left: DataFrame, right: DataFrame, on: list[str], hot_rows: int = HOT_ROWS,
                extra: Column | None = None, rows: int | None = None) -> DataFrame:
    """Inner equi-join in which keys with many rows are split over several tasks.

    Keys holding more than ``hot_rows`` rows on one side are looked up first.  The rows of such
    a key are spread over its salts, in number by the key's own rows, and the rows of the other
    side are repeated per salt.  There are at most ``rows / hot_rows`` such keys (``rows`` of
    both sides, counted when not given): their table is broadcast while that bound stays under
    SMALL_BYTES, and merge-joined beyond.
    """
    if rows is None:
        rows = left.count() + right.count()
    few = rows // max(hot_rows, 1) * HOT_KEY_BYTES <= SMALL_BYTES

    def heavy(side: DataFrame, name: str) -> DataFrame:
        counts = side.groupBy(*on).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > hot_rows)
        return counts.select(*on, F.ceil(F.col("_c") / hot_rows).cast("int").alias(name))

    hot = heavy(left, "_nl").join(heavy(right, "_nr"), on, "full")
    hot = hot.select(*on, F.coalesce("_nl", F.lit(1)).alias("_nl"), F.coalesce("_nr", F.lit(1)).alias("_nr"))

    def spread(side: DataFrame, own: str, own_salt: str, other: str, other_salt: str) -> DataFrame:
        cols = [c for c in side.columns if c not in on]
        plain = [f"`{f.name}`" for f in side.schema.fields
                 if f.name in cols and not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        tagged = side.join(F.broadcast(hot) if few else hot.hint("merge"), on, "left")
        return tagged.select(
            *on, *cols,
            F.expr(f"pmod(xxhash64({', '.join(plain)}), coalesce({own}, 1))").cast("int").alias(own_salt),
            F.explode(F.expr(f"sequence(0, coalesce({other}, 1) - 1)")).alias(other_salt),
        )

    l = spread(left, "_nl", "_sl", "_nr", "_sr")
    r = spread(right, "_nr", "_sr", "_nl", "_sl")
    joined = l.join(r.hint("merge"), [*on, "_sl", "_sr"])
    return (joined if extra is None else joined.filter(extra)).drop("_sl", "_sr")


def _sized(df: DataFrame, reach: float) -> DataFrame:
    """Drop rows without a box, widen the rest by ``reach`` and add the level of the box."""
    df = df.filter(F.col("xmin").isNotNull() & F.col("ymin").isNotNull())
    if reach:
        df = df.withColumns({
            "xmin": F.col("xmin") - reach, "ymin": F.col("ymin") - reach,
            "xmax": F.col("xmax") + reach, "ymax": F.col("ymax") + reach,
        })
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return df.withColumn("_lv", F.when(side > 0, F.ceil(F.log(4.0, side)).cast("int")))


def _census(a: DataFrame, b: DataFrame) -> tuple[dict, dict]:
    """Rows per level of both sides, in one pass over the bounds only."""
    def one(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.lit(side).alias("side"), "_lv")

    rows = one(a, "a").unionByName(one(b, "b")).groupBy("side", "_lv").count().collect()
    levels: dict = {"a": {}, "b": {}}
    for r in rows:  # one row per side and level: a few dozen at most
        levels[r["side"]][r["_lv"]] = r["count"]
    return levels["a"], levels["b"]


def _fits(df: DataFrame, n: int, spread: int, small_bytes: int) -> bool:
    """Whether a side is certainly small once spread over its cells; looks at sizes only when few rows are left."""
    row = 48 + 16 * len(df.columns)
    if n * row * spread > small_bytes:
        return False
    sized = []
    for f in df.schema.fields:
        size = _varying_bytes(f)
        if size is None:
            return False
        sized += size
    if not sized:
        return True
    held = df.agg(F.coalesce(F.sum(sum(sized[1:], sized[0])), F.lit(0))).first()[0]
    return (n * row + held) * spread <= small_bytes


def _varying_bytes(f: T.StructField) -> list[Column] | None:
    """Bytes of a column beyond a fixed 16 a row, as at most one expression; None where they can't be told."""
    t, name = f.dataType, f"`{f.name}`"
    if is_geometry(t):
        return [F.coalesce(F.expr(x.n_points(name)), F.lit(0)) * 48]
    if isinstance(t, T.StringType | T.BinaryType):
        return [F.coalesce(F.octet_length(name), F.lit(0))]
    if isinstance(t, T.ArrayType):
        fixed = T.NumericType | T.BooleanType | T.DateType | T.TimestampType
        items = F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(0))
        if isinstance(t.elementType, fixed):
            return [items * 16]
        leaves = t.elementType.fields if isinstance(t.elementType, T.StructType) else [T.StructField("e", T.NullType())]
        texts = [e.name for e in leaves if isinstance(e.dataType, T.StringType | T.BinaryType)]
        if all(isinstance(e.dataType, fixed) or e.name in texts for e in leaves):
            held = [F.expr(f"coalesce(aggregate({name}, 0L, (vb_s, vb_e) -> vb_s + coalesce(octet_length(vb_e.`{t}`), 0)), 0L)") for t in texts]
            return [sum(held, items * max(48, 8 * len(leaves) + 8))]
        return None
    return None if isinstance(t, T.MapType | T.StructType | T.VariantType) else []


def _kept_levels(la: dict, lb: dict) -> list[int]:
    """Levels worth their own cell size.  Only a few rows, counted and not as a share, may move up: they stay few at any scale."""
    every = sorted({lv for lv in (*la, *lb) if lv is not None})
    kept, ca, cb = [], 0, 0
    for lv in every:
        ca, cb = ca + la.get(lv, 0), cb + lb.get(lv, 0)
        if max(ca, cb) > RARE_ROWS or lv == every[-1]:
            kept.append(lv)
            ca = cb = 0
    return kept


def _own(kept: list[int]) -> Column:
    """Kept level of a row: the smallest one not below its own."""
    level = F.lit(kept[-1])
    for lv in reversed(kept[:-1]):
        level = F.when(F.col("_lv").isNull() | (F.col("_lv") <= lv), F.lit(lv)).otherwise(level)
    return level


def _used(levels: dict, kept: list[int]) -> set[int]:
    out = set()
    for lv in levels:
        out.add(kept[0] if lv is None else next(k for k in kept if k >= lv))
    return out


def _cells(df: DataFrame, kept: list[int], mine: set[int], other: set[int], prefix: str) -> DataFrame:
    """One row per cell and join level of every box."""
    cols = [c for c in df.columns if c not in ("_lv", "_own")]
    lowest = min(other, default=kept[-1])
    join_at = [
        F.when((F.col("_own") == lv) & F.lit(lv >= lowest) | (F.col("_own") < lv) & F.lit(lv in other), F.lit(lv))
        for lv in kept
        if (lv in mine and lv >= lowest) or lv in other
    ] or [F.lit(None).cast("int")]
    owned = df.withColumn("_own", _own(kept))
    if len(kept) == 1:
        leveled = owned.select(*cols, "_own", F.lit(kept[0]).alias("_at"))
    else:
        leveled = owned.select(*cols, "_own", F.explode(F.array(*join_at)).alias("_at")).filter(F.col("_at").isNotNull())
    s = F.pow(F.lit(4.0), F.col("_at"))

    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / s), F.floor(F.col(hi) / s)))

    wide = leveled.select("*", span("xmin", "xmax").alias("_cx")).select("*", span("ymin", "ymax").alias("_cy"))
    return wide.select("_at", "_cx", "_cy", F.col("_own").alias(f"_{prefix}own"),
                       *(F.col(c).alias(f"{prefix}_{c}") for c in cols))


def candidate_pairs(a: DataFrame, b: DataFrame, reach: float = 0.0, *,
                    small_bytes: int = SMALL_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All (a, b) whose boxes meet; columns of the sides come back as ``a_*`` and ``b_*``.

    ``a`` and ``b`` are any tables with xmin, ymin, xmax, ymax.  With ``reach`` the boxes
    of ``a`` are widened first (and come back widened), which finds everything within that
    distance.  Pass only the columns you need: they travel with the join.
    """
    a, b = _sized(a, reach), _sized(b, 0.0)
    la, lb = _census(a, b)
    na, nb = sum(la.values()), sum(lb.values())
    kept = _kept_levels(la, lb)
    meets = F.expr("a_xmin <= b_xmax AND a_xmax >= b_xmin AND a_ymin <= b_ymax AND a_ymax >= b_ymin")
    if not kept:  # points against points: equal places
        on = ["_x", "_y"]
        left = a.drop("_lv").select(F.col("xmin").alias("_x"), F.col("ymin").alias("_y"),
                                    *(F.col(c).alias(f"a_{c}") for c in a.columns if c != "_lv"))
        right = b.drop("_lv").select(F.col("xmin").alias("_x"), F.col("ymin").alias("_y"),
                                     *(F.col(c).alias(f"b_{c}") for c in b.columns if c != "_lv"))
        spread, exact = 1, meets
    else:
        on = ["_at", "_cx", "_cy"]
        ua, ub = _used(la, kept), _used(lb, kept)
        left, right = _cells(a, kept, ua, ub, "a"), _cells(b, kept, ub, ua, "b")
        s = F.pow(F.lit(4.0), F.col("_at"))
        exact = (
            meets
            & (F.greatest("_aown", "_bown") == F.col("_at"))
            & (F.floor(F.greatest("a_xmin", "b_xmin") / s) == F.col("_cx"))
            & (F.floor(F.greatest("a_ymin", "b_ymin") / s) == F.col("_cy"))
        )
        spread = 4 * len(kept)

    small = "a" if na < nb else "b"
    if _fits({"a": a, "b": b}[small], min(na, nb), spread, small_bytes):
        # the streamed side keeps the splits of its files; few rows may sit in one split, so spread them
        if max(na, nb) <= FEW_ROWS:
            tasks = a.sparkSession.sparkContext.defaultParallelism
            left, right = (left.repartition(tasks), right) if small == "b" else (left, right.repartition(tasks))
        joined = left.join(F.broadcast(right), on) if small == "b" else F.broadcast(left).join(right, on)
    elif (na + nb) * spread > hot_rows:
        joined = salted_join(left, right, on, hot_rows, rows=(na + nb) * spread)
    else:
        # no proven bound on either side, so not left to a size estimate either
        joined = left.join(right.hint("merge"), on)
    sides = [f"a_{c}" for c in a.columns if c != "_lv"] + [f"b_{c}" for c in b.columns if c != "_lv"]
    return joined.filter(exact).select(*sides)


def keep_pairs(pairs: DataFrame, predicate: str) -> DataFrame:
    """Pairs satisfying a costly predicate.

    The predicate is evaluated on the joined rows: left to itself the optimizer would move it
    into the join condition, where it also runs for rows that only share a cell.
    """
    return pairs.select("*", F.explode(F.array(F.expr(predicate))).alias("_keep")).filter("_keep").drop("_keep")


def box_pairs(a: DataFrame, b: DataFrame, where: str | None = None, **options) -> DataFrame:
    """(a_fid, b_fid) of boxes that meet and satisfy a predicate over a_xmin .. b_ymax."""
    return each(box_classes(a, b, where, **options))


def box_classes(a: DataFrame, b: DataFrame, where: str | None = None, **options) -> DataFrame:
    """(a_fid, b_fid) as :func:`box_pairs`, by lists: boxes in the same place are compared once."""
    def one(side: DataFrame) -> DataFrame:
        return packed(side.filter("xmin IS NOT NULL AND ymin IS NOT NULL"), list(BOUNDS))

    mine = one(a)
    pairs = candidate_pairs(mine, mine if b is a else one(b), **options)
    return (pairs.filter(where) if where else pairs).select("a_fid", "b_fid")
