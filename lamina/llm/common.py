"""Small helpers of the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from inspect import ismethod
from weakref import WeakMethod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_KEYS = 1_000_000  # keys of two longs that are broadcast as they are
FILTER_WORDS = 1 << 20  # 64-bit words of a filter: 64 million bits
BATCH_BYTES = 4 << 20  # of an Arrow batch of a session with small batches; the row that fills it may be of any length
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BLOCK_BYTES = 4_000_000  # text worked on at once in a Python task; a longer single text is a block of its own


def adds(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` that stay when an operator adds ``names``: one of the same name (in any case) gives way."""
    new = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in new]


def quoted(names: list[str]) -> list[str]:
    return ["`" + n.replace("`", "``") + "`" for n in names]


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of BATCH_BYTES from now on, unless the session asks for smaller ones.

    An executor holds a batch several times outside its heap (as vectors that double their room, and in the buffer of the worker's
    stream), once for each task and side, and keeps part of that room; the default of 64 MB comes on top of a full heap.
    """
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", spark.conf.get(BATCH_SETTING).lower()).groups()
    if int(number) << 10 * "bkmgtp".index(unit[:1] or "b") > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def beside_text(df: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, str]:
    """(``df`` with the columns ``kept`` and its text as a string, the name of that column): a kept string isn't sent to workers twice."""
    if text in kept and df.schema[text].dataType == T.StringType():
        return df.select(*quoted(kept)), text
    return df.select(*quoted(kept), F.col(quoted([text])[0]).cast("string").alias("__text")), "__text"


def blocks(batch: pa.RecordBatch, column: str, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch whose values in ``column`` (text, or lists of 4 bytes an item) take about ``block_bytes``, with those values.

    What a task holds beside Spark's own batch is therefore bounded by a block or one value.
    """
    data = batch.column(batch.schema.get_field_index(column))
    at = 0
    while at < batch.num_rows:
        end, size = at, 0
        while end < batch.num_rows and (end == at or size < block_bytes):
            v = data[end]
            size += 64 + (0 if not v.is_valid else v.as_buffer().size if pa.types.is_string(data.type) else 4 * len(v.values))
            end += 1
        part = batch.slice(at, end - at)
        yield part, data.slice(at, end - at).to_pylist() if pa.types.is_string(data.type) else data.slice(at, end - at)
        at = end


def matched(rows: DataFrame, keys: DataFrame, on: list[str], keep: bool = True, small: int = SMALL_KEYS) -> DataFrame:
    """The rows whose key is among ``keys`` (or, with ``keep=False``, isn't); wide rows aren't shuffled.

    ``keys`` is a written table of the columns ``on``, hashes as longs.  Up to ``small`` keys are broadcast.  More make a filter of
    FILTER_WORDS words, one bit a key, which is broadcast and tells most of the other rows for certain; only what it leaves is joined
    by shuffling.  Both ways are exact.
    """
    how = "left_semi" if keep else "left_anti"
    if keys.count() <= small:
        return rows.join(F.broadcast(keys), on, how)
    word, bit = f"pmod(shiftrightunsigned(`{on[0]}`, 6), {FILTER_WORDS}L)", f"CAST(`{on[0]}` & 63 AS int)"
    bits = keys.groupBy(F.expr(word).alias("__word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("__bits"))
    tested = rows.withColumn("__word", F.expr(word)).join(F.broadcast(bits), "__word", "left").withColumn("__maybe", F.expr(f"coalesce(getbit(__bits, {bit}) = 1, false)"))
    left = tested.where("__maybe").select(*quoted(rows.columns)).join(keys.hint("merge"), on, how)
    return left if keep else left.union(tested.where("NOT __maybe").select(*quoted(left.columns)))


class Memo(dict):
    """A dict that computes missing values and forgets everything when ``room`` keys are held, so its memory is bounded.

    A method is held weakly: its owner mostly holds the memo, and a cycle of the two would stay in the worker after its task, one for
    each task, until Python happens to collect the oldest objects.
    """

    def __init__(self, compute, room: int = 400_000, longest: int = 64):
        super().__init__()
        self.compute = WeakMethod(compute) if ismethod(compute) else lambda: compute
        self.room, self.longest = room, longest

    def __missing__(self, key: str):
        value = self.compute()(key)
        if len(key) <= self.longest:
            if len(self) >= self.room:
                self.clear()
            self[key] = value
        return value
