"""Consistent-hash ring with virtual nodes and bounded loads, with DataFrame functions only.

Every shard has ``virtual`` points on a ring of 64-bit hashes; a key belongs to the first point clockwise from its own hash.  Shards
have a bounded load; keys that find theirs full continue clockwise to the next point of a shard with room.  With the default bound
(the rows dealt evenly, ``counts at most one apart``) balance is exact, and a row leaves its first shard only if that one is full.

The walk needs only the number of keys in front of each point: ``walk`` works on these counts (shards * virtual * ``SPLITS`` numbers,
bounded by parameters, whatever the data) and returns which ranks of which point go to which shard, from which slot on.  Rows are ranked
within their point and split, so the largest sort is a small part of the data, and then look up their range: one shuffle in all.

Rows with the same key and text are interchangeable.  Where one such kind holds more than a thousandth of all rows (there are fewer than
``HOT`` such kinds), it is dealt to splits of its own, of a thousandth each, so no task sorts more than a small share.  The rows with their
place are written once to the shared folder: texts are hashed once, and a row's split is the same in every later pass.
"""

from __future__ import annotations

import json
from bisect import bisect_left

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import adds, quoted
from lamina.session import cut_lineage

SPLITS = 4  # parts of a point's keys that are ranked apart
HOT = 1000  # a kind of equal rows that holds more than this part of all rows is dealt to splits of its own
CELLS = 4096  # cells of the ring in which a key looks for its point


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(place, shard) of all points in order of their place, a signed 64-bit number."""
    return sorted({_signed(xxhash.xxh64_intdigest(f"shard {s} point {v}")): s for s in range(shards) for v in range(virtual)}.items())


def walk(points: list[int], room: list[int], counts: dict[tuple[int, int], int]) -> list[tuple[int, int, int, int, int, int]]:
    """(point, split, from rank, to rank, shard, first slot) for all keys.

    ``points``: shard of each point, clockwise; ``room``: rows a shard may hold; ``counts``: keys by (point, split).  First each shard
    takes the keys of its own points, clockwise and in rank order, until it is full.  What is left moves from point to point, again
    clockwise, to the next shards with room.
    """
    free, filled, out = list(room), [0] * len(room), []

    def take(point: int, split: int, start: int, end: int, shard: int) -> int:
        n = min(end - start, free[shard])
        if n:
            out.append((point, split, start, start + n, shard, filled[shard]))
            free[shard] -= n
            filled[shard] += n
        return start + n

    left = [(p, s, first, n) for (p, s), n in sorted(counts.items()) if (first := take(p, s, 0, n, points[p])) < n]
    for p, s, start, n in left:
        at = p
        while start < n:
            at = (at + 1) % len(points)
            start = take(p, s, start, n, points[at])
    return out


def _rows(df: DataFrame, rows: list, schema: str) -> DataFrame:
    """A small local table without Python rows behind it."""
    fields = T.StructType.fromDDL(schema)
    values = F.lit(json.dumps([dict(zip(fields.names, r)) for r in rows]))
    return df.sparkSession.range(1).select(F.explode(F.from_json(values, T.ArrayType(fields))).alias("r")).select("r.*")


def _cell(place: Column) -> Column:
    return F.shiftright(place, 64 - CELLS.bit_length() + 1).cast("int")


def _point_table(df: DataFrame, places: list[int]) -> DataFrame:
    """(cell, start, inside): number of the first point at or after the cell's start, and the places of points inside the cell."""
    width = (1 << 64) // CELLS
    rows = []
    for c in range(-CELLS // 2, CELLS // 2):
        lo, hi = bisect_left(places, c * width), bisect_left(places, (c + 1) * width)
        rows.append((c, lo, places[lo:hi]))
    return _rows(df, rows, "cell int, start int, inside array<bigint>")


def _hot_splits(dealt: DataFrame) -> list[tuple[int, int, int, int]]:
    """(place, tie, first split, splits) of the kinds of equal rows with more than N / HOT rows: fewer than HOT kinds, at most 2 * HOT splits."""
    total = dealt.count()
    kinds = dealt.groupBy("__place", "__tie").count().where(F.col("count") * HOT > total).orderBy("__place", "__tie").collect()
    out, first = [], SPLITS
    for place, tie, n in kinds:
        parts = -(-n * HOT // total)
        out.append((place, tie, first, parts))
        first += parts
    return out


def assign(df: DataFrame, shards: int, virtual: int = 128, load_factor: float | None = None, id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (without its text if ``keep_text`` is false) with size, text_crc32, shard and slot (columns of these names give way).

    ``load_factor`` None deals rooms of N div shards or one more row (the first N mod shards shards); a factor c >= 1 allows
    ceil(c * N / shards) rows a shard, which moves fewer keys.  Slots count from 0 in each shard without gaps.  Size: UTF-8 bytes of the
    text (null: none) plus 16.  Keys with the same id hash to the same place and are told apart by their text; rows repeated in whole are
    dealt one by one like others, as are rows with a null id.  An empty table gives an empty result.
    """
    if load_factor is not None and load_factor < 1:
        raise ValueError("a load factor is at least 1")
    points = ring(shards, virtual)
    places = [p for p, _ in points]
    kept = [c for c in adds(df, "size", "text_crc32", "shard", "slot") if keep_text or c.lower() != text.lower()]
    t = F.col(quoted([text])[0]).cast("string")
    key = F.col(quoted([id])[0])
    rows = df.select(*quoted(kept), (F.coalesce(F.octet_length(t), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
                     F.xxhash64(key).alias("__place"), F.xxhash64(key, t).alias("__tie"), F.xxhash64(F.monotonically_increasing_id()).alias("__row"))
    rows = cut_lineage(rows)
    looked = rows.withColumn("__cell", _cell(F.col("__place"))).join(F.broadcast(_point_table(df, places)), F.col("__cell") == F.col("cell"))
    point = F.expr(f"(start + size(filter(inside, p -> p < __place))) % {len(points)}")
    split = F.pmod(F.col("__tie"), F.lit(SPLITS)).cast("int")
    if hot := _hot_splits(rows):  # fewer than HOT rows
        kinds = _rows(df, hot, "hp long, ht long, first int, parts int")
        looked = looked.join(F.broadcast(kinds), (F.col("__place") == F.col("hp")) & (F.col("__tie") == F.col("ht")), "left")
        split = F.coalesce(F.expr("CAST(first + pmod(__row, parts) AS int)"), split)
    dealt = looked.select(*quoted(kept), "size", "text_crc32", "__place", "__tie", point.alias("__point"), split.alias("__split"))
    found = {(r[0], r[1]): r[2] for r in dealt.groupBy("__point", "__split").count().collect()}  # bounded: points * SPLITS + 2 * HOT
    n = sum(found.values())
    room = [n // shards + (s < n % shards) for s in range(shards)] if load_factor is None else [-int(-load_factor * n // shards)] * shards
    ranges = _rows(df, walk([s for _, s in points], room, found), "p int, s int, lo long, hi long, shard int, base long")
    order = Window.partitionBy("__point", "__split").orderBy("__place", "__tie")
    ranked = dealt.withColumn("__rank", F.row_number().over(order).cast("long") - 1)
    out = ranked.join(F.broadcast(ranges), (F.col("__point") == F.col("p")) & (F.col("__split") == F.col("s")) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi")))
    return out.select(*quoted(kept), "size", "text_crc32", "shard", (F.col("base") + F.col("__rank") - F.col("lo")).alias("slot"))
