"""MinHash near-duplicates with sequential Bayesian verification.

Link: two documents whose shingle sets have ``100 * |A & B| >= percent * |A | B|``.  Class: documents joined by links.

1. Each document gives the digest of its shingle set and a MinHash signature of ``BANDS * ROWS`` values.  Equal sets (copies) collapse
   to one node per digest before anything is compared, so a group of copies of any size is one candidate.
2. Signatures are cut into bands; nodes that share a band's values (a bucket) are candidates.  A bucket of up to ``SMALL`` nodes gives
   all its pairs.  A larger one gives the pairs of one pivot with the others; then, for ``PIVOT_ROUNDS`` rounds, the nodes outside
   its largest component are paired with another pivot of that component.  Pairs inside a component need no comparison, so a bucket
   of m near copies costs about m comparisons.  Buckets that then still hold several components are compared in whole: nodes that
   hang together by such buckets form a cluster, and blocks of it meet blocks in tasks that return only confirmed links between
   different components.  A block is bounded in rows and bytes, and no bucket is capped.
3. Verification of a candidate compares the signatures batch by batch (``BATCH`` values).  With m equal of n the posterior of the
   similarity is Beta(m + 1, n - m + 1); a pair is dropped as soon as the chance that it reaches the threshold is below ``MISS``.
4. Survivors are compared on their full shingle sets (64-bit shingle hashes): only those links count.

A pair at the threshold meets in no band with probability (1 - 0.8 ** ROWS) ** BANDS = 5e-8, and is dropped by a batch with at most
about ``MISS``.  Intermediate tables lie in the shared folder, so a lost executor repeats only its tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import Memo, blocks, matched, quoted
from lamina.session import cut_lineage

if TYPE_CHECKING:  # only the blocks of clusters need it: other tasks don't load it
    import pandas as pd

BANDS, ROWS = 32, 4
BATCH = 16  # signature values compared at once
MISS = 1e-6  # chance of dropping a pair that reaches the threshold, a batch
SMALL = 6  # nodes up to which a bucket gives all its pairs at once
PIVOT_ROUNDS = 1
HOT_BUCKETS, HOT_ROWS = 50_000, 1000  # a bucket is hot with more rows than this, and more than this share of all
BLOCK, BLOCK_SET_BYTES = 1024, 8 << 20  # nodes, and bytes of their sets, in a block of a cluster
PLACE = ("__p1", "__p2")  # columns that name the rows of one id and text
ODD = (np.random.default_rng(20240601).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


class Shingler:
    """64-bit hashes of the distinct word shingles of texts.  Words: runs without ASCII white space, A-Z lower-cased."""

    def __init__(self, width: int):
        self.width = width
        self.memo = Memo(xxhash.xxh3_64_intdigest, room=300_000, longest=128)

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
        if not words:
            return np.empty(0, dtype=np.uint64)
        h = np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))
        k = min(self.width, len(h))
        out = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            out = (out ^ h[i : len(h) - k + 1 + i]) * MIX[0]
            out ^= out >> np.uint64(29)
        return np.unique(_mixed(out))


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (one row per set, none empty) of all sets at once."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), len(ODD)), dtype=np.uint32)
    for j, odd in enumerate(ODD):
        out[:, j] = np.minimum.reduceat(flat * odd, starts) >> np.uint64(32)
    return out


def survives(percent: int, batch: int = BATCH, miss: float = MISS) -> list[int]:
    """Fewest equal values after each batch for which P(similarity >= percent / 100) is at least ``miss``.

    The posterior tail of Beta(m + 1, n - m + 1) at t is P(Binomial(n + 1, t) <= m).
    """
    t, least = percent / 100, []
    for n in range(batch, len(ODD) + 1, batch):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        least.append(m)
    return least


def shingle_table(docs: DataFrame, width: int, with_set: bool) -> DataFrame:
    """(id, place, n_shingles, digest, sig) or (..., shingles) of every row; null digest for a text without words."""
    extra = T.StructField("shingles" if with_set else "sig", T.BinaryType())
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("id", *PLACE, "n_shingles")), T.StructField("digest", T.BinaryType()), extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            for part, texts in blocks(batch, "__text", 2_000_000):
                sets = [shingle(t) for t in texts]
                full = [s for s in sets if len(s)]
                if with_set:
                    last = [s.tobytes() if len(s) else None for s in sets]
                else:
                    rows = iter(signature(full)) if full else iter(())
                    last = [next(rows).tobytes() if len(s) else None for s in sets]
                columns = [*part.columns[:3], pa.array([len(s) for s in sets], type=pa.int64()), pa.array(map(digest_of, sets), type=pa.binary()), pa.array(last, type=pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("id", *PLACE, "__text").mapInArrow(run, schema)


def digest_of(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def placed(df: DataFrame, id: str, text: str) -> DataFrame:
    """``df`` with its place, 128 bits that name the rows of one id and text, and the text as ``__text``."""
    key, t = F.col(quoted([id])[0]).cast("long"), F.col(quoted([text])[0]).cast("string")
    return df.select("*", F.xxhash64(key, t).alias(PLACE[0]), F.xxhash64(F.lit(1), t, key).alias(PLACE[1]), t.alias("__text"))


def own_words(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, place, __text): a place finds the rows of a text again, with or without an id."""
    return placed(df.select(F.col(quoted([id])[0]).cast("long").alias("id"), F.col(quoted([text])[0]).alias("text")), "id", "text").select("id", *PLACE, "__text")


def ends(up: DataFrame) -> DataFrame:
    """(node, comp) with every pointer followed to its end, by doubling."""
    while True:
        hop = cut_lineage(up.join(up.toDF("comp", "end"), "comp").select("node", "comp", "end"))
        up = hop.select("node", F.col("end").alias("comp"))
        if hop.where("end <> comp").isEmpty():
            return up


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of the nodes in ``links`` (a, b): the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers to their ends, and goes on with the links between
    different ends.  An end stands for two nodes or more, so the links shrink from round to round and settled ones are not read again.
    """
    edges = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    label: DataFrame | None = None
    while True:
        up = ends(cut_lineage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp"))))
        if label is None:
            label = up
        else:
            label = cut_lineage(label.join(up.toDF("comp", "end"), "comp", "left").select("node", F.coalesce("end", "comp").alias("comp")))
        left = edges.join(up.toDF("a", "ea"), "a").join(up.toDF("b", "eb"), "b").where("ea <> eb")
        edges = cut_lineage(left.select(F.col("ea").alias("a"), F.col("eb").alias("b")).distinct())
        if edges.isEmpty():
            return label


def likely(least: list[int], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the rows of a and b (signatures) that keep the threshold likely after every batch."""
    alive, same = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, m in enumerate(least):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        same[alive] += (a[alive, cols] == b[alive, cols]).sum(axis=1)
        alive = alive[same[alive] >= m]
    return alive


def _signatures(column: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint32).reshape(len(column), -1)


def pruned(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sequential comparison of signatures leaves."""
    least = survives(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sa, sb = (_signatures(batch.column(i).to_pylist()) for i in (2, 3))
                yield batch.select(["a", "b"]).take(pa.array(likely(least, sa, sb)))

    both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def agree(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two shingle sets (distinct hashes) reach the threshold."""
    common = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * common >= percent * (len(p) + len(q) - common)


def sets_of(named: DataFrame, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the nodes in ``named``, made again from one text of each.

    Texts are found by their place where they are read: no text is shuffled, only the sets that are asked for.
    """
    known = cut_lineage(named.join(nodes.select("node", "digest", *PLACE), "node"))
    texts = matched(docs, known.select(*PLACE), list(PLACE))
    sets = shingle_table(texts, width, with_set=True).groupBy("digest").agg(F.first("shingles").alias("shingles"))  # repeated rows are one
    return cut_lineage(known.select("node", "digest").join(sets, "digest").select("node", "shingles"))


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs that hold on their full sets."""
    sets = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), docs, nodes, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xa, xb = batch.column(2), batch.column(3)  # compared where they lie
            keep = [agree(np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64), percent) for x, y in zip(xa, xb)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    both = pairs.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b").select("a", "b", "xa", "xb")
    return both.mapInArrow(run, "a long, b long")


def blockwise(members: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links between different components inside clusters of ``members`` (bucket, node, comp), block against block.

    Of the pairs between two components a task returns the first link: more wouldn't change the result.
    """
    least = survives(percent)
    low = members.groupBy("bucket").agg(F.min("node").alias("low"))
    cluster = components(members.join(low, "bucket").select(F.col("node").alias("a"), F.col("low").alias("b"))).withColumnRenamed("comp", "cluster")
    own = members.select("node", "comp").distinct().join(cluster, "node")
    held = cut_lineage(own.join(sets_of(own.select("node"), docs, nodes, width), "node").join(nodes.select("node", "sig"), "node"))
    sizes = held.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("shingles")) / BLOCK_SET_BYTES)).alias("k"))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        left, right = f[f["side"] != 2], f[f["side"] != 1]
        sa, sb, out, done = _signatures(left["sig"]), _signatures(right["sig"]), [], set()
        na, nb, ca, cb = (x.to_numpy() for x in (left["node"], right["node"], left["comp"], right["comp"]))
        xa, xb = ([np.frombuffer(x, dtype=np.uint64) for x in side["shingles"]] for side in (left, right))
        same = left["side"].eq(0).all() and right["side"].eq(0).all()
        for i in range(len(left)):
            others = np.flatnonzero((cb != ca[i]) & (nb > na[i])) if same else np.flatnonzero(cb != ca[i])
            for j in others[likely(least, np.broadcast_to(sa[i], (len(others), sa.shape[1])), sb[others])]:
                between = (min(ca[i], cb[j]), max(ca[i], cb[j]))
                if between not in done and agree(xa[i], xb[j], percent):
                    done.add(between)
                    out.append((na[i], nb[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    dealt = held.join(sizes, "cluster").withColumn("s", F.pmod(F.xxhash64("node"), "k")).withColumn("t", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    # side 1 and 2: rows and columns of a block pair; 0: both, on the diagonal
    side = F.when(F.col("s") == F.col("t"), 0).when(F.col("s") < F.col("t"), 1).otherwise(2)
    dealt = dealt.select("cluster", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"), side.alias("side"), "node", "comp", "sig", "shingles")
    return dealt.groupBy("cluster", "i", "j").applyInPandas(run, "a long, b long")


def links(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame | None:
    """Confirmed links (a, b) that join the nodes to their components; None where there is none."""
    bands = nodes.select("node", F.posexplode(F.expr(f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(sig, 1 + i * {4 * ROWS}, {4 * ROWS})))"))).select("node", F.col("col").alias("bucket"))
    full = cut_lineage(bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    hot = max(HOT_ROWS, (full.agg(F.sum("n")).first()[0] or 0) // HOT_BUCKETS)
    # at most HOT_BUCKETS buckets are hot: their rows stay where they are
    few, many = F.broadcast(full.where(F.col("n") > hot)), full.where(F.col("n") <= hot)
    members = cut_lineage(bands.join(few, "bucket").select("bucket", "node", "n").union(bands.join(few, "bucket", "left_anti").join(many, "bucket").select("bucket", "node", "n")))
    small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    own = small.alias("x").join(small.alias("y"), F.expr("x.bucket = y.bucket AND x.node < y.node")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

    def by_bucket(rows: DataFrame, table: DataFrame) -> DataFrame:
        """Rows (bucket, n, ...) with their bucket's row of ``table`` (bucket, n, ...); the rows of hot buckets aren't shuffled."""
        is_hot = F.col("n") > hot
        return rows.where(is_hot).join(F.broadcast(table.where(is_hot)), ["bucket", "n"]).union(rows.where(~is_hot).join(table.where(~is_hot), ["bucket", "n"]))

    def with_pivot(rows: DataFrame, pivots: DataFrame) -> DataFrame:
        return by_bucket(rows, pivots).where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))

    # one pivot for all bands of a group where it is in all of them, so a pair is compared once
    pivots = large.groupBy("bucket", "n").agg(F.min_by("node", F.xxhash64("node")).alias("pivot"))
    found: DataFrame | None = None

    def add(new: DataFrame) -> None:
        nonlocal found
        new = cut_lineage(new)
        found = new if found is None else found.union(new)

    def confirm(pairs: DataFrame) -> None:
        left = cut_lineage(pruned(pairs.distinct(), nodes, percent))
        if not left.isEmpty():
            add(confirmed(left, docs, nodes, width, percent))

    def open_buckets() -> DataFrame:
        """(bucket, node, comp, n) of the large buckets that hold several components."""
        comp = components(found) if found is not None else None
        rows = large.withColumn("comp", F.col("node")) if comp is None else large.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        rows = cut_lineage(rows.select("bucket", "n", "node", "comp"))
        several = cut_lineage(rows.groupBy("bucket", "n").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket", "n"))
        return cut_lineage(by_bucket(rows, several))

    confirm(own.union(with_pivot(large, cut_lineage(pivots))))
    for k in range(PIVOT_ROUNDS):
        rows = open_buckets()
        if rows.isEmpty():
            return found
        sizes = rows.groupBy("bucket", "n", "comp").agg(F.count("*").alias("c"), F.min_by("node", F.xxhash64("node", F.lit(k))).alias("pivot"))
        major = cut_lineage(sizes.groupBy("bucket", "n").agg(F.max(F.struct("c", "comp", "pivot")).alias("m")).select("bucket", "n", F.col("m.comp").alias("mc"), F.col("m.pivot").alias("pivot")))
        confirm(with_pivot(by_bucket(rows, major.select("bucket", "n", "mc")).where("comp <> mc").select("bucket", "n", "node"), major.select("bucket", "n", "pivot")))
    rows = open_buckets()
    if not rows.isEmpty():
        add(blockwise(rows, docs, nodes, width, percent))
    return found


def classified(df: DataFrame, width: int, percent: int, id: str, text: str) -> DataFrame:
    """(id, place, n_shingles, digest, component_id, class_digest) of every row."""
    docs = own_words(df, id, text)
    base = cut_lineage(shingle_table(docs, width, with_set=False))
    alike = base.where("digest IS NOT NULL").groupBy("digest").agg(F.first("sig").alias("sig"), F.min("id").alias("low_id"), F.min(F.struct(*PLACE)).alias("place"))
    nodes = cut_lineage(alike.select("digest", "sig", "low_id", "place.*", F.monotonically_increasing_id().alias("node")))  # written, so the numbers stay
    found = links(nodes, docs, width, percent)
    classes = nodes.select("digest", "node", "low_id")
    if found is not None:
        comp = classes.join(components(found), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        low = comp.groupBy("comp").agg(F.min("low_id").alias("component_id"), F.min("digest").alias("class_digest"))
        classes = comp.join(low, "comp").select("digest", "component_id", "class_digest")
    else:
        classes = classes.select("digest", F.col("low_id").alias("component_id"), F.col("digest").alias("class_digest"))
    lone = base.where("digest IS NULL").select("id", *PLACE, "n_shingles", "digest", F.col("id").alias("component_id"), F.col("digest").alias("class_digest"))
    return base.where("digest IS NOT NULL").select("id", *PLACE, "n_shingles", "digest").join(classes, "digest").select("id", *PLACE, "n_shingles", "digest", "component_id", "class_digest").union(lone)


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id`` (long), n_shingles, digest, component_id, class_digest, kept.

    component_id is the smallest id reachable over links, kept says whether it is the row's own.  Classes without an id, or of one
    repeated id, share a component_id; class_digest, the smallest digest of the class, tells them apart.  Null, empty and blank texts
    have no shingles, link with nothing and are their own component (null id: null, kept).  Texts of fewer words than ``width`` are one
    shingle.  Repeated rows are copies of each other and share a class; rows that share an id keep their own texts and classes.  An
    empty table gives an empty result.  Only ``id`` and ``text`` are read, so other columns don't matter.
    """
    rows = classified(df, width, percent, id, text)
    return rows.select(F.col("id").alias(id), "n_shingles", "digest", "component_id", "class_digest", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` with one row of each class left: one with the smallest id, a null id only where the class has no other.

    Rows without words all stay, but for those repeated in whole.  All columns of ``df`` are kept.  Texts aren't shuffled: the places of
    the rows that go are looked up where the texts are read.
    """
    wordless = ~F.coalesce(F.col(quoted([text])[0]).cast("string").rlike(r"\S"), F.lit(False))  # ASCII white space, as in Shingler
    rows = cut_lineage(classified(df, width, percent, id, text).where("digest IS NOT NULL"))
    # a class may hold several texts under its smallest id, or without an id: one of them stays
    first = rows.groupBy("class_digest").agg(F.min(F.struct(F.col("id").isNull(), "id", "digest", *PLACE)).alias("m"))
    stays = cut_lineage(first.select(*(F.col(f"m.{c}").alias(c) for c in PLACE)))
    places = cut_lineage(rows.groupBy(*PLACE).agg(F.count("*").alias("n")))
    repeated = cut_lineage(places.where("n > 1").join(stays, list(PLACE), "left_semi").select(*PLACE))
    gone = cut_lineage(places.join(stays, list(PLACE), "left_anti").select(*PLACE).union(repeated))
    own = placed(df.where(~wordless), id, text).drop("__text")
    left = matched(own, gone, list(PLACE), keep=False).select(*quoted(df.columns))
    if not repeated.isEmpty():
        left = left.union(matched(own, repeated, list(PLACE)).dropDuplicates(list(PLACE)).select(*quoted(df.columns)))
    whole = {f"__c{i}": F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for i, (c, kind) in enumerate(zip(quoted(df.columns), (k for _, k in df.dtypes)))}
    blank = df.where(wordless).withColumns(whole).dropDuplicates(list(whole))
    return left.union(blank.select(*quoted(df.columns)))
