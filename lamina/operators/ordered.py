"""Order-dependent work that stays parallel: dense ids and ordered tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import cut_lineage

TRACK_ROWS = 5_000_000  # longer tracks are cut into chunks
_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


def dense_ids(df: DataFrame, order: list[str] | None = None, name: str = "fid") -> DataFrame:
    """Number the rows 0..n-1, in the given order or in read order.

    Rows are range-partitioned and sorted, numbered inside each partition, and shifted by the
    row counts of the partitions before (one tiny row per partition).  The numbered rows are
    written out first, so that counts and numbers always come from the same partitions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    marked = cut_lineage(ranged.withColumn("_m", F.monotonically_increasing_id()))
    marked = marked.withColumn("_p", F.shiftright("_m", _SHIFT))
    counts = marked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = marked.join(F.broadcast(shift), "_p")
    local = F.col("_m").bitwiseAND((1 << _SHIFT) - 1)
    return numbered.select((F.col("_base") + local).alias(name), *df.columns)


def group_numbers(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of every group 0, 1, 2, ... in the given order, whatever the size of a group.

    The rows are cut into ranges of (group, order) by Spark's sample, numbered in each range, and shifted by the group's rows in the
    ranges before: a small table of one row per group and range that it has rows in.
    """
    ranged = cut_lineage(df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_r", F.spark_partition_id()))
    own = Window.partitionBy(*by, "_r").orderBy(*order)
    numbered = ranged.withColumn(name, F.row_number().over(own).cast("long") - 1)
    counts = ranged.groupBy(*by, "_r").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*by).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    # only groups that lie in several ranges are shifted
    shift = counts.withColumn("_b", F.sum("_c").over(before)).filter("_b IS NOT NULL").select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col("_r").alias("_kr"), "_b")
    on = F.col("_r") == F.col("_kr")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return numbered.join(shift, on, "left").select(*df.columns, (F.col(name) + F.coalesce("_b", F.lit(0))).alias(name))


class Tracks:
    """Rows ordered within a key, with lag, row number and running sum over each track.

    A track is handled by one window task as long as it has at most ``track_rows`` rows.
    When a longer one exists, the rows are range-partitioned by key and order, windows run
    per (key, partition), and the few tracks that span partitions are stitched together
    with a table that has one row per track and partition.
    """

    def __init__(self, df: DataFrame, key: str, order: list[str], track_rows: int = TRACK_ROWS):
        self.key, self.order = key, order
        longest = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        self.chunked = longest > track_rows
        if self.chunked:
            parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-longest // track_rows) * 2)
            ranged = df.repartitionByRange(parts, key, *order)
            df = cut_lineage(ranged.withColumn("_chunk", F.spark_partition_id()))
        self.df = df

    def _window(self):
        return Window.partitionBy(self.key, *(["_chunk"] if self.chunked else [])).orderBy(*self.order)

    def _stitch(self, carried: Column) -> DataFrame:
        """(key, _chunk, _in) for tracks over several chunks; ``_in`` aggregates one chunk."""
        per = self.df.groupBy(self.key, "_chunk").agg(carried.alias("_out"))
        many = per.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(self.key))).filter("_k > 1")
        return many.drop("_k")

    def number(self, name: str = "seq") -> Tracks:
        """Row number from 1."""
        self.df_numbered = self.df.withColumn(name, F.row_number().over(self._window()).cast("long"))
        if self.chunked:
            ends = self._stitch(F.count(F.lit(1)))
            w = Window.partitionBy(self.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
            base = ends.select(self.key, "_chunk", F.sum("_out").over(w).alias("_in"))
            joined = self.df_numbered.join(F.broadcast(base), [self.key, "_chunk"], "left")
            self.df_numbered = joined.withColumn(name, F.col(name) + F.coalesce("_in", F.lit(0))).drop("_in")
        self.df = self.df_numbered
        return self

    def previous(self, cols: list[str], prefix: str = "prev_") -> Tracks:
        """Values of the row before, NULL on the first row of a track."""
        w = self._window()
        packed = self.df.withColumn("_prev", F.lag(F.struct(*cols)).over(w))
        if self.chunked:
            ends = self._stitch(F.max_by(F.struct(*cols), F.struct(*self.order)))
            across = Window.partitionBy(self.key).orderBy("_chunk")
            base = ends.select(self.key, "_chunk", F.lag("_out").over(across).alias("_in"))
            joined = packed.join(F.broadcast(base), [self.key, "_chunk"], "left")
            packed = joined.withColumn("_prev", F.coalesce("_prev", "_in")).drop("_in")
        self.df = packed.select("*", *(F.col(f"_prev.{c}").alias(prefix + c) for c in cols)).drop("_prev")
        return self

    def running(self, value: str, name: str) -> Tracks:
        """Sum of ``value`` from the first row of the track up to the current one."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        summed = self.df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0.0)))
        if self.chunked:
            ends = self._stitch(F.coalesce(F.sum(value), F.lit(0.0)))
            before = Window.partitionBy(self.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
            base = ends.select(self.key, "_chunk", F.sum("_out").over(before).alias("_in"))
            joined = summed.join(F.broadcast(base), [self.key, "_chunk"], "left")
            summed = joined.withColumn(name, F.col(name) + F.coalesce("_in", F.lit(0.0))).drop("_in")
        self.df = summed
        return self

    def result(self) -> DataFrame:
        return self.df.drop("_chunk") if self.chunked else self.df
