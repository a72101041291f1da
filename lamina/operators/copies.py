"""Features that are copies of each other, kept as one row.

Whether two features meet depends on their shapes alone.  ``packed`` puts the features of one shape into a row with the list of their
ids, and ``each`` takes pairs of such rows apart again: costly rules run once per pair of shapes, and a pair of ids costs no more than
handing it out.  A list holds about ``COPIES`` ids, so a shape with more copies than that has several rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import cut_lineage

COPIES = 512  # ids of a row
SMALL_BYTES = 64 << 20  # the table of shapes with more copies is broadcast up to here
SHAPE_BYTES = 256  # room for one of them


def packed(rows: DataFrame, on: list[str], carried: tuple[str, ...] = (), copies: int | None = None) -> DataFrame:
    """One row (on, fid) per set of equal values in ``on``; ``fid`` is the list of ids, as structs with the ``carried`` columns if any.

    Missing and repeated ids stay as they are.
    """
    copies = COPIES if copies is None else copies
    # the hash only sorts fast and tells how many rows a shape gets; shapes are told apart by their values
    keyed = rows.select(*on, "fid", *carried).withColumn("_h", F.xxhash64(*on))
    # counted once and written: the rows are read twice in all, here and for the lists
    often = cut_lineage(keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > copies).select(
        "_h", F.ceil(F.col("_c") / copies).cast("long").alias("_n")))
    salt, n = F.lit(0), often.count()
    if n:
        keyed = keyed.join(F.broadcast(often) if n * SHAPE_BYTES <= SMALL_BYTES else often.hint("merge"), "_h", "left")
        salt = F.expr("pmod(xxhash64(fid), coalesce(_n, 1L))")
    lists = keyed.withColumn("_salt", salt).groupBy("_h", *on, "_salt").agg(F.collect_list(F.struct("fid", *carried)).alias("_m"))
    return cut_lineage(lists.select(*on, F.expr("_m" if carried else "transform(_m, pk_m -> pk_m.fid)").alias("fid")))


def each(pairs: DataFrame, a_carried: tuple[str, ...] = (), b_carried: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of ids (a_fid, b_fid, carried columns as a_* and b_*, other columns) behind pairs of packed rows."""
    rest = [c for c in pairs.columns if c not in ("a_fid", "b_fid")]
    one = pairs.select(F.explode("a_fid").alias("_a"), "b_fid", *rest)
    both = one.select("_a", F.explode("b_fid").alias("_b"), *rest)

    def side(name: str, carried: tuple[str, ...]) -> list:
        if not carried:
            return [F.col(f"_{name}").alias(f"{name}_fid")]
        return [F.col(f"_{name}.{c}").alias(f"{name}_{c}") for c in ("fid", *carried)]

    (a_fid, *a_rest), (b_fid, *b_rest) = side("a", a_carried), side("b", b_carried)
    return both.select(a_fid, b_fid, *a_rest, *b_rest, *rest)


def ids(pairs: DataFrame, side: str) -> DataFrame:
    """(fid): every id on one side of pairs of packed rows, once for each time it stands in a row."""
    return pairs.select(f"{side}_fid").distinct().select(F.explode(f"{side}_fid").alias("fid"))
