"""Ranked lexical search by MaxScore with bounds of term pairs.

The score of a document is the sum of its terms' impacts, so a list of terms can't lift a document above the sum of their largest
impacts.  MaxScore leaves the lists of weak terms unread as long as all of them together stay below the k-th best score.  Largest
impacts of two terms are rarely met in one document, though: the index also holds, for pairs of terms, the list of the documents with
both and the *joint* maximum of their impacts.  At query time the bound of a set of weak terms is put together from pairs and single
terms (max(a, b, joint) <= a + b), so more lists stay unread than by independent maxima; the joint impacts of a pair's list also give the first
threshold, before any list is read.

1. *Scan*: every whole text is cut into terms; (id, number of terms, asked terms and how often) of every document is written.  The terms
   of the queries are sent to the tasks; their size is bounded: queries are worked on in blocks of at most ``BLOCK_TERMS`` terms.
2. *Statistics* over all documents: N, L and the number of documents of each asked term, each added up by Spark.
3. *Segments*: a task gathers up to ``SEGMENT`` documents (or ``POSTINGS`` postings), builds lists, maxima and pair lists and answers all queries, keeping k
   results a query; its next segment starts with the thresholds reached.
4. *Merge*: k rows a task and query, ranked in groups of tasks and then as a whole.

Skipping drops a document only if its bound is below the k-th best score, so results are exact; equal scores are never dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import blocks, quoted
from lamina.session import cut_lineage

SEGMENT, POSTINGS = 16_384, 4_000_000
BLOCK_TERMS = 200_000  # terms (with repeats) of the queries that are worked on at once
MERGE_GROUPS = 64
# bytes to bytes: A-Z lower-cased, what is no letter or digit a space; bytes beyond ASCII belong to terms
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

POSTED = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])
FOUND = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, with repeats."""
    return text.encode().translate(TABLE).split() if text else []


def scan(docs: DataFrame, vocabulary: dict[bytes, int], id: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of every document: how often it holds terms at all, and which of the vocabulary how often."""
    given = docs.select(F.col(quoted([id])[0]).cast("long").alias("id"), F.col(quoted([text])[0]).cast("string").alias("__text"))
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            for part, texts in blocks(batch, "__text"):
                counts, terms, tfs, sizes = [], [], [], [0]
                for t in texts:
                    own = terms_of(t)
                    found = np.fromiter((x for x in map(number, own) if x is not None), dtype=np.int32)
                    which, often = np.unique(found, return_counts=True)
                    counts.append(len(own))
                    terms.append(which)
                    tfs.append(often.astype(np.int32))
                    sizes.append(sizes[-1] + len(which))
                lists = [pa.ListArray.from_arrays(pa.array(sizes, type=pa.int32()), pa.array(np.concatenate(x) if x else np.empty(0, np.int32), type=pa.int32())) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, type=pa.int64()), *lists], names=POSTED.names)

    return given.mapInArrow(run, POSTED)


class Query:
    """Terms of one query with their counts, and the partner each has in the pair lists."""

    def __init__(self, counts: dict[int, int], weight: np.ndarray):
        # weak terms are bounded together, so neighbours by weight are partners
        order = sorted(counts, key=lambda t: (weight[t], t))
        self.counts = counts
        self.pairs = [(order[i], order[i + 1]) for i in range(0, len(order) - 1, 2)]
        self.partner = {a: b for a, b in self.pairs} | {b: a for a, b in self.pairs}


class Segment:
    """Lists of some documents: per term the documents and their impacts, and the joint maxima of pairs of terms."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, lengths: list[int], term: np.ndarray, doc: np.ndarray, tf: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.nulls = ids, nulls
        m = np.array([75 + 25 * n * n_docs // n_terms for n in lengths], dtype=np.int64)
        order = np.argsort(term, kind="stable")  # documents stay in order
        self.doc, own = doc[order], term[order]
        often = tf[order].astype(np.int64)
        self.impact = weight[own] * (1_000_000_000 * often // (1000 * often + 12 * m[self.doc]))
        self.known, starts = np.unique(own, return_index=True)
        ends = np.append(starts[1:], len(own))
        self.at = {int(t): (int(a), int(b)) for t, a, b in zip(self.known, starts, ends)}
        largest = np.maximum.reduceat(self.impact, starts) if len(own) else np.empty(0, np.int64)
        self.largest = {int(t): int(x) for t, x in zip(self.known, largest)}
        self.joint: dict[tuple[int, int], np.ndarray] = {}
        self.place = np.full(len(ids), -1, dtype=np.int64)

    def list_of(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.at[t]
        return self.doc[a:b], self.impact[a:b]

    def add_pairs(self, pairs: set[tuple[int, int]], k: int) -> None:
        """Joint impacts of the documents that hold both terms, the k largest last, for every pair in the segment."""
        for a, b in sorted(pairs):
            if a in self.at and b in self.at:
                (da, ia), (db, ib) = self.list_of(a), self.list_of(b)
                self.place[da] = np.arange(len(da))
                there = self.place[db]
                both = there >= 0
                joint = ib[both] + ia[there[both]]
                self.place[da] = -1
                self.joint[a, b] = np.sort(joint if len(joint) <= k else np.partition(joint, len(joint) - k)[-k:])

    def bound(self, a: int, b: int, counts: dict[int, int]) -> int:
        """No document gets more from the terms a and b together."""
        joint = self.joint.get((a, b), self.joint.get((b, a)))
        qa, qb = counts[a], counts[b]
        ua, ub = qa * self.largest[a], qb * self.largest[b]
        if joint is None:
            return ua + ub
        both = int(joint[-1]) + (qa - 1) * self.largest[a] + (qb - 1) * self.largest[b] if len(joint) else 0
        return min(ua + ub, max(ua, ub, both))

    def search(self, query: Query, k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of all documents that can be among the k best with at least ``threshold`` points, best scores exact."""
        counts = {t: c for t, c in query.counts.items() if t in self.at}
        if not counts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        threshold = max(threshold, 1)
        for pair in query.pairs:  # k documents reach the k-th largest joint impact
            joint = self.joint.get(pair)
            if joint is not None and len(joint) >= k:
                threshold = max(threshold, int(joint[-k]))
        order = sorted(counts, key=lambda t: (counts[t] * self.largest[t], t))
        # bounds[i]: what the i weakest terms can give together
        bounds, inside = [0], set()
        for t in order:
            mate = query.partner.get(t)
            if mate in inside:
                bounds.append(bounds[-1] - counts[mate] * self.largest[mate] + self.bound(t, mate, counts))
            else:
                bounds.append(bounds[-1] + counts[t] * self.largest[t])
            inside.add(t)
        weak = len(order)
        while bounds[weak] >= threshold:
            weak -= 1
        scores = np.zeros(len(self.ids), dtype=np.int64)
        for t in order[weak:]:
            docs, impact = self.list_of(t)
            scores[docs] += counts[t] * impact
        alive = np.flatnonzero(scores)
        partial = scores[alive]
        for i in range(weak, -1, -1):
            if len(alive) > k:
                threshold = max(threshold, int(np.partition(partial, len(partial) - k)[-k]))
            keep = partial + bounds[i] >= threshold
            alive, partial = alive[keep], partial[keep]
            if i == 0 or not len(alive):
                break
            docs, impact = self.list_of(order[i - 1])
            spot = np.searchsorted(docs, alive)
            spot[spot == len(docs)] = 0
            hit = docs[spot] == alive
            partial[hit] += counts[order[i - 1]] * impact[spot[hit]]
        return alive, partial


def best(ids: np.ndarray, nulls: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score, then smallest id, rows without an id last."""
    return np.lexsort((ids, nulls, -scores))[:k]


def searched(posted: DataFrame, queries: list[Query], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, part, id, score): the k best of every task's documents for every query."""
    sent = posted.sparkSession.sparkContext.broadcast((queries, weight, {p for q in queries for p in q.pairs}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        asked, weights, pairs = sent.value
        none = np.empty(0, np.int64)
        top = [(none, none.astype(bool), none) for _ in asked]
        rows: list[pa.RecordBatch] = []
        held = [0, 0]

        def answer() -> None:
            table = pa.Table.from_batches(rows).combine_chunks()
            rows.clear()
            held[:] = [0, 0]
            ids = table.column("id").combine_chunks()
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            lists = table.column("terms").combine_chunks()
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            segment = Segment(ids.fill_null(0).to_numpy(), nulls, table.column("n").to_pylist(), lists.flatten().to_numpy(), doc, table.column("tfs").combine_chunks().flatten().to_numpy(), weights, n_docs, n_terms)
            segment.add_pairs(pairs, k)
            for q, query in enumerate(asked):
                known, empty, points = top[q]
                at, scores = segment.search(query, k, int(points[-1]) if len(points) == k else 0)
                if len(at):
                    known, empty, points = (np.concatenate(x) for x in ((known, segment.ids[at]), (empty, segment.nulls[at]), (points, scores)))
                    first = best(known, empty, points, k)
                    top[q] = known[first], empty[first], points[first]

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                part = part.filter(pc.greater(pc.list_value_length(part.column(2)), 0))
                rows.append(part)
                held[0] += part.num_rows
                held[1] += len(part.column(2).flatten())
                if held[0] >= SEGMENT or held[1] >= POSTINGS:
                    answer()
        if held[0]:
            answer()
        number = TaskContext.get().partitionId()
        for q, (known, empty, points) in enumerate(top):
            if len(known):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(known), pa.int32()), pa.array([number] * len(known), pa.int32()), pa.array(known, pa.int64(), mask=empty), pa.array(points, pa.int64())], names=FOUND.names)

    return posted.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, id, score): the k best documents with a score above 0 for every row of ``items``, all if fewer.

    Terms: runs of letters, digits and characters beyond ASCII, A-Z lower-cased.  With N documents that have terms, L terms in all,
    n terms in the document, df documents with the term and tf of it in this one: w = floor(1000 * ln((2N + 2) / (2 df + 1))),
    m = 75 + (25 n N) div L, score = sum of w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms with repeats.

    Null and empty texts have no terms: such documents are no result and no part of N, such items have no results.  Ties go to the
    smaller id; rows without an id come last and keep a null.  Documents that share an id all count.  Items that share an id have a
    list each, null item ids too.  Empty tables give an empty result; other columns aren't read.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    out: DataFrame | None = None
    block: list[tuple] = []
    size = 0
    asked = items.select(F.col(quoted([item_id])[0]).alias("id"), F.col(quoted([item_text])[0]).cast("string").alias("t"))

    def answered() -> DataFrame:
        names = sorted({w for _, own in block for w in own})
        vocabulary = {w: i for i, w in enumerate(names)}
        posted = cut_lineage(scan(docs, vocabulary, id, text))
        whole = posted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(len(names), dtype=np.int64)
        for r in posted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # a row a term of the block
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * whole.docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
        queries = []
        for _, own in block:
            counts: dict[int, int] = {}
            for w in own:
                counts[vocabulary[w]] = counts.get(vocabulary[w], 0) + 1
            queries.append(Query({t: c for t, c in counts.items() if df[t]}, weight))
        found = searched(posted.where(F.size("terms") > 0).select(*POSTED.names), queries, weight, whole.docs, whole.terms or 1, k)
        first = _ranked(found.withColumn("part", F.col("part") % MERGE_GROUPS), k, "query", "part").drop("rank")
        rows = _ranked(first, k, "query")
        listed = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField(item_id, kind)]))
        return rows.join(F.broadcast(listed), "query").select(F.col(quoted([item_id])[0]), "rank", F.col("id").alias(id), "score")

    for r in asked.toLocalIterator():
        own = terms_of(r["t"])
        if own:
            if block and size + len(own) > BLOCK_TERMS:
                out = answered() if out is None else out.union(answered())
                block, size = [], 0
            block.append((r["id"], own))
            size += len(own)
    if block:
        out = answered() if out is None else out.union(answered())
    if out is None:
        return items.select(F.col(quoted([item_id])[0]).alias(item_id)).where("false").select(quoted([item_id])[0], F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id), F.lit(0).cast("long").alias("score"))
    return out
